"""Repeated word windows by FM-index: a shard's candidates are indexed, then searched backwards for what occurs twice.

The index holds the Burrows-Wheeler transform of all candidates of a shard, each ended by its own separator, in a wavelet
matrix: one packed bit vector for each bit of a symbol, with a running count for each 64 bits. Every window of the streamed
candidates is searched from its last word to its first; the number of steps for which the interval holds a second occurrence
is the matching statistic at that place, and windows that reach the full length are reported as intervals.

``remove`` cuts every word that a window covers whose word sequence also starts anywhere else, in any document or the same one.

Defined results: a null or empty text has no words, and nothing is removed. Documents are told by their id: repeated rows of
one id count as one document and get the same result; a row with a null id is compared with nothing and kept whole.
Columns beyond id and text are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import arrow_extend
from claimlake.llm.windows import Kind, repeated_spans, word_units
from claimlake.llm.words import words_of


class WaveletMatrix:
    """Rank over a sequence of small integers, one packed bit vector for each bit, most significant first."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self.levels = []
        rest = symbols
        for level in range(self.bits - 1, -1, -1):
            bit = (rest >> level) & 1
            words = np.zeros(len(rest) // 64 + 1, np.uint64)
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.levels.append((words, before, int(len(rest) - bit.sum())))
            rest = np.concatenate((rest[bit == 0], rest[bit == 1]))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        low, high = np.zeros_like(place), place
        for level, (words, before, zeros) in enumerate(self.levels):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            ones_low, ones_high = self._ones(words, before, low), self._ones(words, before, high)
            low = np.where(one, zeros + ones_low, low - ones_low)
            high = np.where(one, zeros + ones_high, high - ones_high)
        return high - low

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, place: np.ndarray) -> np.ndarray:
        at = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return before[at] + np.bitwise_count(words[at] & mask)


class FmIndex:
    """Texts of symbols 1.. (0 is the separator), one after the other, each ended by a separator of its own."""

    def __init__(self, texts: list[np.ndarray]):
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        symbols = np.zeros(int(ends[-1]) + 1, np.int64)
        inside = np.ones(len(symbols), bool)
        inside[ends] = False
        symbols[inside] = np.concatenate(texts)
        self.symbols, self.first = symbols, np.concatenate(([0], ends[:-1] + 1))
        rank = np.where(inside, symbols + len(texts), 0)
        rank[ends] = np.arange(len(texts))
        step, n = 1, len(symbols)
        while True:
            shifted = np.concatenate((rank[step:] + 1, np.zeros(min(step, n), np.int64)))[:n]
            values, rank = np.unique(rank * (n + len(texts) + int(symbols.max()) + 2) + shifted, return_inverse=True)
            if len(values) == n:
                break
            step *= 2
        order = np.argsort(rank)
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(symbols))))
        self.last = WaveletMatrix(symbols[order - 1], int(symbols.max()))

    def matching(self, ends: np.ndarray, most: int) -> np.ndarray:
        """For each place, the length (``most`` at most) of the longest text ending there that occurs more than once."""
        found = np.zeros(len(ends), np.int64)
        alive = np.arange(len(ends))
        symbol = self.symbols[ends]
        low, high = self.starts[symbol], self.starts[symbol + 1]
        for length in range(1, most + 1):
            kept = (high - low >= 2) & (symbol > 0)
            alive, low, high = alive[kept], low[kept], high[kept]
            found[alive] = length
            if length == most or not len(alive):
                break
            place = ends[alive] - length
            symbol = np.where(place >= 0, self.symbols[place], 0)
            low = self.starts[symbol] + self.last.rank(symbol, low)
            high = self.starts[symbol] + self.last.rank(symbol, high)
        return found


def repeated_windows(window: int):
    """The search of a shard: runs of windows that occur more than once in it."""

    def search(held: list[dict]) -> list[tuple[int, int, int]]:
        flat = np.concatenate([h["units"] for h in held])
        _, local = np.unique(flat, return_inverse=True)
        edges = np.cumsum([0, *(len(h["units"]) for h in held)])
        index = FmIndex([local[a:b] + 1 for a, b in zip(edges, edges[1:], strict=False)])
        counts = np.array([len(h["units"]) - window + 1 for h in held])
        owner = np.repeat(np.arange(len(held)), counts)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        hit = index.matching(index.first[owner] + within + window - 1, window) >= window
        owner, within = owner[hit], within[hit]
        if not len(owner):
            return []
        new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (within[1:] != within[:-1] + 1)))
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(owner)) - 1
        return [(held[o]["id"], held[o]["first"] + a, held[o]["first"] + b) for o, a, b in zip(owner[head].tolist(), within[head].tolist(), within[tail].tolist(), strict=True)]

    return search


def cut(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``: the words outside ``spans``, one blank between them."""

    rest = [c for c in docs.columns if c.lower() not in ("spans", "n_words", "n_removed", "kept_text")]
    joined = docs.select(*rest).join(spans.withColumnRenamed("doc_id", "_span_id"), F.col(key).cast("long") == F.col("_span_id"), "left").drop("_span_id")

    def work(batch: dict) -> dict:
        out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_text": []}
        for value, found in zip(batch[text], batch["spans"], strict=True):
            table = words_of([value])
            keep = np.ones(len(table.start), bool)
            for a, b in zip((found or [])[::2], (found or [])[1::2], strict=True):
                keep[a:b] = False
            data = table.data.tobytes()
            words = [data[a:b] for a, b in zip(table.start[keep].tolist(), table.end[keep].tolist(), strict=True)]
            out["n_words"].append(len(keep))
            out["n_removed"].append(int(len(keep) - keep.sum()))
            out["kept_text"].append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return out

    return arrow_extend(joined, [text, "spans"], work, "n_words long, n_removed long, kept_text string").drop("spans")


def spans_of(docs: DataFrame, window: int = 35, gram: int = 8, shard: int = 2_000, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) in words, of the documents with a repeated window."""
    return repeated_spans(docs, Kind(word_units, window, gram, False), repeated_windows(window), shard, key, text)


def remove(docs: DataFrame, window: int = 35, key: str = "doc_id", text: str = "text") -> DataFrame:
    return cut(docs, spans_of(docs, window, key=key, text=text), key, text)


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))

