"""Repeated windows of a fixed length, found by anchors: what the two substring operators share.

A window's anchor is its k-gram of the least hash (the leftmost of equals), so equal windows have their anchor at the same
offset. Consecutive windows of a document with one anchor form a segment, about (window - k) / 2 units apart; a segment's row
holds the hash of its anchor, the hash of its content and its place. Rows of one anchor meet in one partition:

* segments of equal content are repeats of each other in all their windows, decided without their text;
* segments that share their anchor but not their content may share some windows. Only those go on, with their content (one
  copy of each), to the exact search of the operator, in shards of whole anchor groups;
* all other segments hold no repeated window and end here.

Equal segments inside a map task are reduced to one row before the shuffle. Anchors that a documented sample of documents
shows to be in very many segments (a line that a third of all documents share) are not gathered in one task: their segments
are routed by anchor and content, and their windows by their own 128-bit hash, through aggregates that combine on the map
side. The sample only chooses the route; the result is the same on either.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import _arrow_schema, stored
from claimlake.llm.words import every_slice_hash, mix, running, slice_hash, words_of

SECOND = 0xC2B2AE3D27D4EB4F | 1
CHUNK = 1 << 19  # units handled at once; longer documents are cut with an overlap of one window less a unit
POSITION_BITS = np.uint64(24)
GROUPED, REPEATED, CANDIDATE = 0, 1, 2


@dataclass(frozen=True)
class Kind:
    """How texts become units, and the lengths."""

    units: Callable[[str | None], np.ndarray]  # unsigned 64-bit value of each unit of a text
    window: int
    gram: int
    later_only: bool  # only windows that start earlier elsewhere are repeats, else all that start elsewhere


def byte_units(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint64) + np.uint64(1)


def word_units(text: str | None) -> np.ndarray:
    return words_of([text]).hash


def chunks(units: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """(place, units) of slices that together hold every window once."""
    at = 0
    while len(units) - at >= window:
        yield at, units[at : at + CHUNK + window - 1]
        at += CHUNK


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive keys."""
    n = len(keys)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).reshape(-1)
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def segments(pieces: list[tuple[int, int, np.ndarray]], kind: Kind) -> dict[str, np.ndarray]:
    """Segments of (document id, place of its first unit, units) pieces.

    ``first`` and ``last`` are the starts of a segment's first and last window, ``lead`` the anchor's distance from ``first``.
    """
    window, gram = kind.window, kind.gram
    sizes = np.array([len(p[2]) for p in pieces])
    units = np.concatenate([p[2] for p in pieces])
    begin = np.cumsum(sizes) - sizes
    sums = running(units)
    grams = every_slice_hash(sums, gram)
    keys = (grams & ~np.uint64((1 << 24) - 1)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_least(keys, window - gram + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
    owner = np.repeat(np.arange(len(pieces)), sizes - window + 1)
    start = np.arange(len(owner)) + np.repeat(begin - (np.cumsum(sizes - window + 1) - (sizes - window + 1)), sizes - window + 1)
    anchor = anchor[start]
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])))
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(start)) - 1
    a, b, spot, own = start[head], start[tail], anchor[head], owner[head]
    other = running(units, SECOND)
    shift = (np.array([p[1] for p in pieces]) - begin)[own]
    return {
        "anchor": grams[spot].view(np.int64),
        "content": slice_hash(other, a, b + window, SECOND).view(np.int64),
        "doc_id": np.array([p[0] for p in pieces], np.int64)[own],
        "first": (a + shift).astype(np.int64),
        "last": (b + shift).astype(np.int64),
        "lead": (spot - a).astype(np.int32),
    }


def of_texts(ids: list[int | None], texts: list[str | None], kind: Kind) -> Iterator[dict[str, np.ndarray]]:
    held, size = [], 0
    for key, text in zip(ids, texts, strict=True):
        if key is None:
            continue
        for place, units in chunks(kind.units(text), kind.window):
            held.append((key, place, units))
            size += len(units)
            if size >= CHUNK:
                yield segments(held, kind)
                held, size = [], 0
    if held:
        yield segments(held, kind)


COLUMNS = ("anchor", "content", "doc_id", "first", "last", "lead")
SEGMENT = "anchor long, content long, doc_id long, first long, last long, lead int, state int, route long"


def _gathered(parts: list[dict[str, np.ndarray]], names) -> dict[str, np.ndarray]:
    return {n: np.concatenate([p[n] for p in parts]) for n in names}


def _sorted_groups(rows: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Rows by (anchor, content, doc_id, first) without repeats, and where a new anchor and a new content begin."""
    order = np.lexsort((rows["first"], rows["doc_id"], rows["content"], rows["anchor"]))
    rows = {n: v[order] for n, v in rows.items()}
    differs = lambda *names: np.concatenate(([True], np.logical_or.reduce([rows[n][1:] != rows[n][:-1] for n in names])))
    own = differs("anchor", "content", "doc_id", "first")
    rows = {n: v[own] for n, v in rows.items()}
    return rows, differs("anchor"), differs("anchor", "content")


def anchored(docs: DataFrame, kind: Kind, crowded: np.ndarray, key: str, text: str) -> DataFrame:
    """A row for each segment, equal ones of a task as one ``GROUPED`` row and ``REPEATED`` verdicts."""
    target = _arrow_schema(docs.sparkSession, SEGMENT)
    shared = docs.sparkSession.sparkContext.broadcast(crowded)

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in of_texts(batch.column(0).to_pylist(), batch.column(1).to_pylist(), kind):
                held.append(part)
                size += len(part["anchor"])
                if size > 1_000_000:
                    yield combined(held)
                    held, size = [], 0
        if held:
            yield combined(held)

    def combined(held: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        rows, _, fresh = _sorted_groups(_gathered(held, COLUMNS))
        group = np.cumsum(fresh) - 1
        many = np.bincount(group) > 1
        state = np.where(fresh, GROUPED, REPEATED).astype(np.int32)
        if not kind.later_only:  # the one that goes on says that it has met its like
            state[fresh & many[group]] = CANDIDATE
        by_content = mix(rows["anchor"].view(np.uint64) ^ mix(rows["content"].view(np.uint64))).view(np.int64)
        hot = np.isin(rows["anchor"], shared.value)
        anywhere = mix(rows["doc_id"].view(np.uint64) ^ mix(rows["first"].view(np.uint64))).view(np.int64)  # a verdict meets nobody
        route = np.where(state == REPEATED, anywhere, np.where(hot, by_content, rows["anchor"]))
        columns = [*(rows[n] for n in COLUMNS), state, route]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return docs.select(F.col(key).cast("long"), text).mapInArrow(loop, SEGMENT)


def verdicts(docs: DataFrame, kind: Kind, crowded: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The segments that matter: ``REPEATED`` ones, and ``CANDIDATE`` ones whose windows must be looked at."""
    target = _arrow_schema(docs.sparkSession, SEGMENT)
    shared = docs.sparkSession.sparkContext.broadcast(crowded)
    names = [*COLUMNS, "state"]

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [{n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(names)} for batch in batches]
        parts = [p for p in parts if len(p["anchor"])]
        if not parts:
            return
        rows = _gathered(parts, names)
        known = rows["state"] == REPEATED
        done = {n: v[known] for n, v in rows.items()}
        rows, new_anchor, fresh = _sorted_groups({n: v[~known] for n, v in rows.items()})
        if len(rows["anchor"]):
            group, family = np.cumsum(fresh) - 1, np.cumsum(new_anchor) - 1
            many = (np.bincount(group) > 1) | (np.maximum.reduceat(rows["state"], np.flatnonzero(fresh)) == CANDIDATE)
            several = np.bincount(family, weights=fresh) > 1
            open_ = fresh & (several[family] | np.isin(rows["anchor"], shared.value))
            again = ~fresh if kind.later_only else many[group]
            for mask, state in ((again, REPEATED), (open_, CANDIDATE)):
                out = {n: v[mask] for n, v in rows.items()}
                out["state"] = np.full(int(mask.sum()), state, np.int32)
                done = _gathered([done, out], names)
        columns = [*(done[n] for n in names), np.zeros(len(done["anchor"]), np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return anchored(docs, kind, crowded, key, text).repartition("route").mapInArrow(loop, SEGMENT).drop("route")


def crowded_anchors(docs: DataFrame, kind: Kind, key: str, text: str, share: float = 0.01, least: int = 200, most: int = 100_000, seed: int = 5) -> np.ndarray:
    """The anchors met most often, ``least`` times or more, in a sample of ``share`` of the documents; at most ``most``.

    At the default share that is an anchor in about 20,000 segments, as many as one shard of the exact search may hold. It
    decides routes only, never results.
    """
    sample = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).sample(share, seed)

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in of_texts(batch.column(0).to_pylist(), batch.column(1).to_pylist(), kind):
                values, counts = np.unique(part["anchor"], return_counts=True)
                yield pa.RecordBatch.from_pydict({"anchor": values, "n": counts})

    counted = sample.mapInArrow(loop, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    frequent = counted.where(F.col("n") >= least).orderBy(F.desc("n"), "anchor").limit(most).collect()
    return np.array([r.anchor for r in frequent], np.int64)


def repeated_spans(
    docs: DataFrame, kind: Kind, search: Callable[[list[dict]], list[tuple[int, int, int]]], shard: int,
    key: str = "doc_id", text: str = "text", crowd_share: float = 0.01,
) -> DataFrame:
    """(doc_id, spans): the places [start, end) covered by repeated windows, merged and in order, of the documents with any.

    ``search`` gets the candidates of a shard of whole anchor groups (dicts of id, first, lead, units) and gives (id, start of
    first window, start of last window) runs of repeated windows. ``shard`` is about how many candidates it gets at once.
    """
    crowded = crowded_anchors(docs, kind, key, text, crowd_share)
    found = stored(verdicts(docs, kind, crowded, key, text), "segments")
    whole = found.where(f"state = {REPEATED}").select("doc_id", "first", "last")
    candidates = found.where(f"state = {CANDIDATE}")
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    wanted = candidates.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "first", "last", "lead")).alias("places"))
    texts = source.join(wanted, "doc_id").select("doc_id", "text", "places")
    window = kind.window
    hot = docs.sparkSession.sparkContext.broadcast(set(crowded.tolist()))
    content = "anchor long, doc_id long, first long, lead int, units binary, one long, two long"
    content_type = _arrow_schema(docs.sparkSession, content)
    dtype = np.uint8 if kind.units is byte_units else np.uint64

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in content_type}
            size = 0
            for doc, value, places in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                raw = (value or "").encode("utf-8", "surrogatepass") if dtype is np.uint8 else None
                units = kind.units(value) if raw is None or any(p["anchor"] in hot.value for p in places) else None
                for place in places:
                    a, b = place["first"], place["last"] + window
                    crowd = place["anchor"] in hot.value
                    part = units[a:b] if crowd or raw is None else raw[a:b]
                    if len(part) < b - a:
                        continue  # another text under the same id
                    if crowd:
                        lines = np.arange(b - a - window + 1)
                        one = slice_hash(running(part), lines, lines + window).view(np.int64)
                        two = slice_hash(running(part, SECOND), lines, lines + window, SECOND).view(np.int64)
                        rows = [(place["anchor"], doc, a + i, 0, None, int(x), int(y)) for i, (x, y) in enumerate(zip(one, two, strict=True))]
                    else:
                        rows = [(place["anchor"], doc, a, place["lead"], bytes(part) if raw is not None else part.tobytes(), None, None)]
                    for row in rows:
                        for name, item in zip(out, row, strict=True):
                            out[name].append(item)
                    size += 8 * len(part) if crowd or raw is None else len(part) + 64
                if size > 8_000_000:
                    yield pa.RecordBatch.from_pydict(out, schema=content_type)
                    out, size = {f.name: [] for f in content_type}, 0
            yield pa.RecordBatch.from_pydict(out, schema=content_type)

    # without crowded anchors there are no window rows, and the texts are read once
    cut_out = texts.mapInArrow(cut, content)
    if len(crowded):
        cut_out = stored(cut_out, "candidates")
    run_type = _arrow_schema(docs.sparkSession, "doc_id long, first long, last long")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        last = None

        def done() -> pa.RecordBatch:
            runs = search(held)
            columns = [pa.array([r[i] for r in runs], pa.int64()) for i in range(3)]
            return pa.RecordBatch.from_arrays(columns, schema=run_type)

        for batch in batches:
            for anchor, doc, first, lead, units in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if (anchor, doc, first) == last:
                    continue  # a document given twice
                if last and anchor != last[0] and len(held) >= shard:
                    yield done()
                    held = []
                last = (anchor, doc, first)
                values = np.frombuffer(units, dtype)
                held.append({"id": doc, "first": first, "lead": lead, "units": values + 1 if dtype is np.uint8 else values})
        if held:
            yield done()

    grouped = cut_out.where("units IS NOT NULL").select("anchor", "doc_id", "first", "lead", "units").repartition("anchor").sortWithinPartitions("anchor", "doc_id", "first")
    runs = grouped.mapInArrow(look, "doc_id long, first long, last long")
    every = whole.unionByName(runs)
    if len(crowded):
        windows = cut_out.where("units IS NULL").select("doc_id", "first", "one", "two").distinct()
        groups = windows.groupBy("one", "two").agg(F.min(F.struct("doc_id", "first")).alias("head"), F.count("*").alias("n")).where("n > 1")
        alike = windows.join(groups, ["one", "two"])
        if kind.later_only:
            alike = alike.where(F.struct("doc_id", "first") != F.col("head"))
        every = every.unionByName(alike.select("doc_id", "first", F.col("first").alias("last")))
    return merged(every, window)


def merged(runs: DataFrame, window: int) -> DataFrame:
    """(doc_id, spans) with overlapping and touching spans of each document as one; a document's runs meet in one row."""
    ordered = runs.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(F.col("first").alias("start"), (F.col("last") + window).alias("end")))).alias("runs"))

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.int64()))])
        for batch in batches:
            out = []
            for found in batch.column(1).to_pylist():
                flat: list[int] = []
                for run in found:
                    if flat and run["start"] <= flat[-1]:
                        flat[-1] = max(flat[-1], run["end"])
                    else:
                        flat += [run["start"], run["end"]]
                out.append(flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, schema.field(1).type)], schema=schema)

    return ordered.mapInArrow(loop, "doc_id long, spans array<long>")
