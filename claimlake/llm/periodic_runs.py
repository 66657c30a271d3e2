"""Periodic runs of words: stretches in which the words repeat with a period.

A run is a stretch whose smallest period is q, of max(``least``, ``copies`` * q) words or more, that no neighbouring word
extends. Every word of a run occurs in it ``copies`` times at least. So a word that occurs less often in a segment joins no run
there and splits it; the parts are counted anew and split in their turn until no word is too rare (``segments``). Of a split the
smaller part is counted and taken off the counts of the larger, so that splitting n words takes n log n steps however they lie.

The segments that survive are scanned lag by lag (``scan``). Equal pairs at lag q that make a run are so many in a row that
several of every few places tell; only where they all agree is the stretch measured. A lag that is a multiple of the period of a
run found before is skipped within that run, as the period there is the smaller one.

Documents are independent: nothing is shuffled, a task holds one document's words beside a batch. Null and empty texts have no
words and no runs; repeated rows and ids are documents of their own; other columns pass through, unless they bear the name of
an output, which takes their place.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from claimlake.llm.common import _arrow_schema, slices

RUN = "struct<start: bigint, length: bigint, period: bigint>"
ADDED = f"n_words bigint, runs array<{RUN}>, strongest {RUN}, n_dropped bigint, collapsed string"
SAMPLES = 4  # places of a stretch that must agree before it is measured
SLICE = 8 << 20  # bytes of texts whose results are held at once


def segments(ids: np.ndarray, least: int, copies: int) -> list[tuple[int, int]]:
    """(first, end) of the stretches of ``least`` words or more in which every word occurs ``copies`` times or more."""
    if len(ids) < least:
        return []
    frequent = np.bincount(ids)[ids] >= copies
    edges = np.flatnonzero(np.diff(np.concatenate(([False], frequent, [False])).astype(np.int8)))
    settled = []
    for first, end in edges.reshape(-1, 2).tolist():
        if end - first >= least:
            words = ids[first:end].tolist()
            settled += [(first + a, first + b) for a, b in _split(words, least, copies)]
    return sorted(settled)


def _split(words: list[int], least: int, copies: int) -> list[tuple[int, int]]:
    settled = []
    pending = [(0, len(words), Counter(words))]
    while pending:
        first, end, seen = pending.pop()
        if end - first < least:
            continue
        cut = _too_rare(words, first, end, seen, copies)
        if cut is None:
            settled.append((first, end))
            continue
        seen[words[cut]] -= 1
        small, large = sorted(((first, cut), (cut + 1, end)), key=lambda part: part[1] - part[0])
        part = Counter(words[small[0] : small[1]])
        seen.subtract(part)
        pending += [(*large, seen), (*small, part)]
    return settled


def _too_rare(words: list[int], first: int, end: int, seen: Counter, copies: int) -> int | None:
    """A place of a word that occurs too rarely, sought from both ends: no more steps than the smaller part is long."""
    low, high = first, end - 1
    while low <= high:
        if seen[words[low]] < copies:
            return low
        if seen[words[high]] < copies:
            return high
        low, high = low + 1, high - 1
    return None


def scan(ids: np.ndarray, least: int, copies: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a segment."""
    found: list[tuple[int, int, int]] = []
    by_period: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for lag in range(1, len(ids) // copies + 1):
        need = max(least, copies * lag) - lag
        if need > len(ids) - lag:
            continue
        places = _agreeing(ids, lag, need)
        for period, (starts, ends) in by_period.items():
            if len(places) and lag % period == 0:
                at = np.searchsorted(starts, places, side="right") - 1
                places = places[(at < 0) | (places + lag >= ends[at])]
        reached, new = 0, []
        for place in places.tolist():
            if place < reached:
                continue
            first, reached = _stretch(ids, place, lag)
            if reached - first >= need:
                new.append((first, reached + lag - first, lag))
        if new:
            found += new
            by_period[lag] = np.array([r[0] for r in new]), np.array([r[0] + r[1] for r in new])
    return found


def _agreeing(ids: np.ndarray, lag: int, need: int) -> np.ndarray:
    """Places, ``need`` / SAMPLES apart, from which on as many places agree with their partners as any long stretch holds."""
    step = max(1, need // SAMPLES)
    same = ids[: len(ids) - lag : step] == ids[lag::step]
    row = min(SAMPLES, need // step)
    if len(same) < row:
        return np.empty(0, np.int64)
    every = same[: len(same) - row + 1].copy()
    for i in range(1, row):
        every &= same[i : len(same) - row + 1 + i]
    return np.flatnonzero(every) * step


def _stretch(ids: np.ndarray, place: int, lag: int) -> tuple[int, int]:
    """(first, end) of the equal pairs at ``lag`` around the pair at ``place``."""
    first, size = place, 32
    while first > 0:
        low = max(0, first - size)
        differ = np.flatnonzero(ids[low:first] != ids[low + lag : first + lag])
        if len(differ):
            first = low + int(differ[-1]) + 1
            break
        first, size = low, size * 2
    end, size = place + 1, 32
    while end < len(ids) - lag:
        high = min(len(ids) - lag, end + size)
        differ = np.flatnonzero(ids[end:high] != ids[end + lag : high + lag])
        if len(differ):
            end += int(differ[0])
            break
        end, size = high, size * 2
    return first, end


def runs_of(words: list, least: int = 24, copies: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence, by start, then period."""
    if len(words) < least:
        return []
    numbers: dict = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    found = []
    for first, end in segments(ids, least, copies):
        found += [(first + start, length, period) for start, length, period in scan(ids[first:end], least, copies)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def _stronger(one: tuple, other: tuple) -> int:
    """Order by length / period, greatest first, then start, then period."""
    by_exponent = other[1] * one[2] - one[1] * other[2]
    return by_exponent or one[0] - other[0] or one[2] - other[2]


def kept_of(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]


Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def find_runs(
    frame: DataFrame, *, least: int = 24, copies: int = 3, rewrite: Rewrite | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``frame`` with n_words, runs, the strongest run (None without runs), n_dropped and the collapsed text.

    ``rewrite`` may change a document's words, given its key, before they are searched. Words are runs of bytes other than
    blank and \\t \\n \\v \\f \\r.
    """
    fresh = {f.name for f in StructType.fromDDL(ADDED).fields}
    kept = [f for f in frame.schema.fields if f.name.lower() not in fresh]
    names = [f.name for f in frame.schema.fields]
    stay = [names.index(f.name) for f in kept]
    at_key, at_text = names.index(key), names.index(text)
    added = _arrow_schema(frame.sparkSession, ADDED)

    def judge(doc, value) -> tuple:
        words = (value or "").encode("utf-8", "surrogatepass").split()
        if rewrite:
            words = rewrite(doc, words)
        runs = runs_of(words, least, copies)
        left = kept_of(words, runs) if runs else words
        best = min(runs, key=cmp_to_key(_stronger)) if runs else None
        return len(words), [_run(r) for r in runs], best and _run(best), len(words) - len(left), b" ".join(left).decode("utf-8", "surrogatepass")

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(at_text)), 0).to_pylist()
            for part in slices(sizes, SLICE):
                some = batch.slice(part.start, part.stop - part.start)
                rows = [judge(d.as_py(), t.as_py()) for d, t in zip(some.column(at_key), some.column(at_text), strict=True)]
                columns = [pa.array(list(values), f.type) for values, f in zip(zip(*rows, strict=True), added, strict=True)]
                yield pa.RecordBatch.from_arrays([some.column(i) for i in stay] + columns, names=[f.name for f in kept] + added.names)

    return frame.mapInArrow(loop, StructType([*kept, *StructType.fromDDL(ADDED).fields]))


def _run(run: tuple[int, int, int]) -> dict:
    return {"start": run[0], "length": run[1], "period": run[2]}
