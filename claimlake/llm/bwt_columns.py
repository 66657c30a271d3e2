"""Repeated byte strings by column-wise construction of a collection's Burrows-Wheeler transform and common prefixes.

A shard's candidates are short strings. All start as empty suffixes; in each round every string that still has one gives the
symbol before its current suffix. That symbol goes into the transform at the suffix's place, the place of the longer suffix
follows from the counts of the symbols before it, and the suffixes of the round are merged into the sequences (transform,
common prefixes, owners) in one pass over each, as external files would be merged. The common prefix of a new suffix with its
neighbours is one more than the least common prefix between the places of their shorter forms. The sequences are arrays of
the task: a shard is bounded by ``shard`` strings of at most two windows.

Afterwards suffixes of the window's length or more that share as long a prefix stand side by side, and all but the earliest of
such a group, by (doc_id, start), are repeats.

Defined results: a null text counts as empty. Documents are told by their id: repeated rows of one id count as one document
and get the same result; a row with a null id is compared with nothing and kept whole. Other columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import arrow_map
from claimlake.llm.windows import Kind, byte_units, repeated_spans


PLACE_BITS = 40
LOW = np.int64((1 << PLACE_BITS) - 1)


def merged_in(old: np.ndarray, places: np.ndarray, values, out: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """``old`` with ``values`` at ``places`` of the longer sequence, in one pass; into ``out``, with ``rest`` as work space."""
    size = len(old) + len(places)
    out, rest = out[:size], rest[:size]
    rest[:] = True
    rest[places] = False
    out[rest] = old
    out[places] = values
    return out


def _least(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of values[a..b] for each pair, a <= b; pairs in any order. ``values`` has an item more than any b reaches."""
    order = np.argsort(-a, kind="stable")  # falling starts: what lies between two slices is never read
    edges = np.empty(2 * len(a), np.int64)
    edges[::2], edges[1::2] = a[order], b[order] + 1
    found = np.empty(len(a), values.dtype)
    found[order] = np.minimum.reduceat(values, edges)[::2]
    return found


def construct(strings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Transform, common prefix with the suffix before, owner and length of every suffix in order; symbols are 1 to 255.

    ``known`` holds (symbol, place) of the transform in order: after the empty suffixes, the suffixes stand in the order of the
    pairs that begin them. A round merges its pairs, one for each string, and moves the places; nothing is sorted anew. Work
    space is taken once, as fresh arrays of this size cost more than what is done with them.
    """
    n = len(strings)
    lengths = np.array([len(s) for s in strings], np.int64)
    text, begin = np.concatenate(strings), np.cumsum(lengths) - lengths
    longest, size = int(lengths.max(initial=0)), n + len(text)
    known, prefix, place = np.empty(0, np.int64), np.zeros(n + 1, np.uint16), np.arange(n)  # the last common prefix stays last
    spare = [np.empty(len(text), np.int64), np.empty(len(text), np.int64)]
    spare_prefix = [np.empty(size + 1, np.uint16), np.empty(size + 1, np.uint16)]
    rest, moves = np.empty(size + 1, bool), np.empty(len(text), np.int32)
    for column in range(1, longest + 1):
        active = np.flatnonzero(lengths >= column)
        pairs = text[begin[active] + lengths[active] - column].astype(np.int64) << PLACE_BITS | place[active]
        order = np.argsort(pairs)
        active, pairs = active[order], pairs[order]
        spot, symbol, turn = pairs & LOW, pairs >> PLACE_BITS, column % 2
        at = np.searchsorted(known, pairs) + np.arange(len(pairs))
        known = merged_in(known, at, pairs, spare[turn], rest)

        up = np.zeros(len(active), np.uint16)
        above = known[at - 1]
        has = (at > 0) & (above >> PLACE_BITS == symbol)
        up[has] = _least(prefix, (above[has] & LOW) + 1, spot[has]) + 1 if has.any() else 0
        down = np.zeros(len(active), np.uint16)
        below = known[np.minimum(at + 1, len(known) - 1)]
        has = (at + 1 < len(known)) & (below >> PLACE_BITS == symbol)
        down[has] = _least(prefix, spot[has] + 1, below[has] & LOW) + 1 if has.any() else 0

        new = n + at
        inserted = np.concatenate(([0], new - np.arange(len(new)), [len(prefix)]))  # before which old place, in order
        ahead = np.repeat(np.arange(len(new) + 1, dtype=np.int32), np.diff(inserted))
        prefix = merged_in(prefix, new, up, spare_prefix[turn], rest)
        old_below = rest[new + 1] & (new + 2 < len(prefix))
        prefix[new[old_below] + 1] = down[old_below]
        at_now = np.bitwise_and(known, LOW, out=spare[1 - turn][: len(known)])
        known += np.take(ahead, at_now, out=moves[: len(known)], mode="clip")
        place[active] = new

    bwt, spot = np.zeros(size, np.uint8), known & LOW
    bwt[spot] = known >> PLACE_BITS
    longer = np.empty(size, np.int64)  # the place of the suffix that is a symbol longer
    longer[spot] = n + np.arange(len(known))
    owner, size_of, place = np.arange(size, dtype=np.int32), np.zeros(size, np.int32), np.arange(n)
    for column in range(1, longest + 1):
        active = np.flatnonzero(lengths >= column)
        place[active] = longer[place[active]]
        owner[place[active]], size_of[place[active]] = active, column
    return bwt, prefix[:size], owner, size_of


def later_windows(window: int):
    """The search of a shard: every window of it that also starts earlier."""

    def search(held: list[dict]) -> list[tuple[int, int, int]]:
        strings = [h["units"] for h in held]
        _, prefix, owner, length = construct(strings)
        alike = prefix >= window
        inside = alike | np.append(alike[1:], False)
        group = np.cumsum(~alike)[inside]
        owner, length = owner[inside], length[inside]
        if not len(owner):
            return []
        ids = np.array([h["id"] for h in held], np.int64)[owner]
        total = np.array([len(s) for s in strings])
        start = np.array([h["first"] for h in held], np.int64)[owner] + total[owner] - length
        order = np.lexsort((start, ids, group))
        group, ids, start = group[order], ids[order], start[order]
        repeat = np.concatenate(([False], group[1:] == group[:-1]))
        return [(i, s, s) for i, s in zip(ids[repeat].tolist(), start[repeat].tolist(), strict=True)]

    return search


def spans_of(docs: DataFrame, window: int = 100, gram: int = 28, shard: int = 4_000, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) in bytes, of the documents with a byte that an earlier window repeats."""
    return repeated_spans(docs, Kind(byte_units, window, gram, True), later_windows(window), shard, key, text)


def cut_digests(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): what is left of each text outside ``spans``."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).join(spans, "doc_id", "left")

    def work(batch: dict) -> dict:
        out: dict[str, list] = {"doc_id": batch["doc_id"], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        for value, found in zip(batch["text"], batch["spans"], strict=True):
            raw = (value or "").encode("utf-8", "surrogatepass")
            edges = [min(x, len(raw)) for x in found or []]
            kept = b"".join(raw[a:b] for a, b in zip([0, *edges[1::2]], [*edges[::2], len(raw)], strict=True))
            out["n_bytes"].append(len(raw))
            out["n_removed"].append(len(raw) - len(kept))
            out["n_spans"].append(len(edges) // 2)
            out["kept_sha256"].append(sha256(kept).hexdigest())
        return out

    return arrow_map(rows.select("doc_id", "text", "spans"), work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_digests(docs: DataFrame, window: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    return cut_digests(docs, spans_of(docs, window, key=key, text=text), key, text)
