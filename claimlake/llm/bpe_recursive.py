"""Byte-level BPE as recursive SQL: DuckDB contracts token rows inside each Spark partition, and an ordered aggregate decodes.

A document is cut by the pattern; a match that is a vocabulary entry is its id, any other new match becomes rows (word,
place, token) of single bytes. A recursive query joins neighbouring rows with the merge table and, for each word, contracts
the leftmost pair of the lowest rank, until no pair is left. Ids of a match are remembered, so a worker contracts a word once.
Decoding joins (document, place, id) rows with the vocabulary and gathers the bytes of each document in order of place.

Matches of more than ``LONGEST`` bytes are contracted by the same rule with a heap: the recursion needs a round for each
contraction and reads the whole word in each, which is quadratic. For the same reason words go to the database in batches whose
squared lengths add up to ``MOST_ROWS`` at most, which bounds the rows of all rounds together by half of that; a batch that
runs out of memory all the same is cut in two.

Defined results: a null or empty text has no ids and decodes to no bytes. Strings of special tokens are ordinary text.
Repeated rows give repeated results; columns beyond those named are ignored.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from claimlake.llm.common import arrow_extend, slices

LONGEST = 200
MOST_ROWS = 8_000_000
MOST_PIECES, MOST_WORDS = 500_000, 700_000
SLICE = 2_000_000  # characters encoded at once

CONTRACT = """
WITH RECURSIVE step(round, word, place, token) AS (
    SELECT 0, word, place, token FROM letters
    UNION ALL
    SELECT * FROM (
        WITH pairs AS (
            SELECT p.*, m.merged, m.merged * 65536 + p.place AS cost
            FROM (
                SELECT round, word, place, token, lead(token) OVER spot AS next, lead(place) OVER spot AS next_place
                FROM step WINDOW spot AS (PARTITION BY word ORDER BY place)
            ) p
            LEFT JOIN merges m ON m.one = p.token AND m.other = p.next
        ),
        chosen AS (
            SELECT word, min(cost) AS best, arg_min(next_place, cost) AS gone, arg_min(merged, cost) AS made
            FROM pairs WHERE cost IS NOT NULL GROUP BY word
        )
        SELECT round + 1, word, place, CASE WHEN cost = best THEN made ELSE token END
        FROM pairs JOIN chosen USING (word)
        WHERE place <> gone
    )
)
SELECT word, place, token
FROM step JOIN (SELECT word, max(round) AS round FROM step GROUP BY word) USING (word, round)
ORDER BY word, place
"""

DECODE = """
SELECT doc, list(bytes ORDER BY place) AS parts
FROM ids JOIN vocabulary USING (id)
GROUP BY doc ORDER BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Bpe:
    """Ranks in a DuckDB of this process's memory, and the matches it has contracted so far."""

    def __init__(self, path: str, pattern: str):
        import duckdb

        self.ranks = read_ranks(path)
        self.find = regex.compile(pattern).findall
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.word_ids: dict[str, bytes] = {}
        self.database = duckdb.connect(":memory:")
        for setting in ("threads = 1", "memory_limit = '400MB'", "temp_directory = ''", "preserve_insertion_order = false"):
            self.database.execute(f"SET {setting}")
        entries, numbers = list(self.ranks), list(self.ranks.values())
        self.bytes_of = dict(zip(numbers, entries, strict=True))
        self.letter = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self._load("vocabulary", {"id": pa.array(numbers, pa.int32()), "bytes": pa.array(entries, pa.binary())})
        one, other, merged = [], [], []
        for entry, number in self.ranks.items():
            for cut in range(1, len(entry)):
                a, b = self.ranks.get(entry[:cut]), self.ranks.get(entry[cut:])
                if a is not None and b is not None:
                    one.append(a)
                    other.append(b)
                    merged.append(number)
        self._load("merges", {"one": pa.array(one, pa.int32()), "other": pa.array(other, pa.int32()), "merged": pa.array(merged, pa.int64())})

    def _load(self, name: str, columns: dict[str, pa.Array]) -> None:
        self.database.register("incoming", pa.table(columns))
        self.database.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.database.unregister("incoming")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit numbers.

        A text without two blanks in a row falls into independent pieces at its blanks, each blank going with the piece
        after it; another text is cut by the pattern as a whole.
        """
        for held, most in ((self.first, MOST_PIECES), (self.later, MOST_PIECES), (self.word_ids, MOST_WORDS)):
            if len(held) > most:
                held.clear()
        split = [None if "  " in (t or "") else (t or "").split(" ") for t in texts]
        heads = {p[0] for p in split if p and p[0] not in self.first}
        tails = {x for p in split if p for x in p[1:] if x not in self.later}
        cut_heads = {p: self.find(p) for p in heads}
        cut_tails = {p: self.find(" " + p) for p in tails}
        whole = {i: self.find(t) for i, (t, p) in enumerate(zip(texts, split, strict=True)) if p is None}
        known = self.word_ids
        words = {w for cuts in (cut_heads, cut_tails, whole) for found in cuts.values() for w in found if w not in known}
        self._contract(words)
        self.first.update((p, b"".join([known[w] for w in found])) for p, found in cut_heads.items())
        later = self.later
        later.update((p, b"".join([known[w] for w in found])) for p, found in cut_tails.items())
        out = []
        for i, pieces in enumerate(split):
            if pieces is None:
                out.append(b"".join([known[w] for w in whole[i]]))
            else:
                out.append(self.first[pieces[0]] + b"".join([later[x] for x in pieces[1:]]))
        return out

    def _contract(self, words: set[str]) -> None:
        rest: list[tuple[str, bytes]] = []
        for word in words:
            raw = word.encode("utf-8", "replace")
            number = self.ranks.get(raw)
            if number is not None:
                self.word_ids[word] = number.to_bytes(4, "little")
            elif len(raw) > LONGEST:
                self.word_ids[word] = np.array(self._with_heap(raw), "<u4").tobytes()
            else:
                rest.append((word, raw))
        for at in slices([len(raw) ** 2 for _, raw in rest], MOST_ROWS):
            self._contract_batch(rest[at])

    def _contract_batch(self, part: list[tuple[str, bytes]]) -> None:
        import duckdb

        lengths = np.array([len(raw) for _, raw in part])
        token = self.letter[np.frombuffer(b"".join(raw for _, raw in part), np.uint8)]
        word = np.repeat(np.arange(len(part), dtype=np.int32), lengths)
        place = (np.arange(len(token)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        self._load("letters", {"word": pa.array(word), "place": pa.array(place), "token": pa.array(token)})
        try:
            found = self.database.execute(CONTRACT).fetchnumpy()
        except duckdb.OutOfMemoryException:
            if len(part) == 1:
                raise
            half = len(part) // 2
            self._contract_batch(part[:half])
            self._contract_batch(part[half:])
            return
        ids, owner = np.asarray(found["token"]).astype("<u4"), np.asarray(found["word"])
        edges = np.searchsorted(owner, np.arange(len(part) + 1)) * 4
        flat = ids.tobytes()
        self.word_ids.update((w, flat[a:b]) for (w, _), a, b in zip(part, edges[:-1].tolist(), edges[1:].tolist(), strict=True))

    def _with_heap(self, raw: bytes) -> list[int]:
        """The same contraction in O(n log n): pairs wait in a heap by (rank, place)."""
        part = [raw[i : i + 1] for i in range(len(raw))]
        after, before = list(range(1, len(raw) + 1)), list(range(-1, len(raw) - 1))
        heap: list[tuple[int, int, bytes, bytes]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(part):
                number = self.ranks.get(part[i] + part[j])
                if number is not None:
                    heapq.heappush(heap, (number, i, part[i], part[j]))

        for i in range(len(part)):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if part[i] != a or j >= len(part) or part[j] != b or not a:
                continue
            part[i], part[j] = a + b, b""
            after[i] = after[j]
            if after[i] < len(part):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [self.ranks[p] for p in part if p]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """Bytes of each list of ids."""
        counts = np.array([len(x) // 4 for x in ids])
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        out = [b""] * len(ids)
        if not len(flat):
            return out
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
        place = np.arange(len(flat), dtype=np.int32)
        self.database.register("ids", pa.table({"doc": doc, "place": place, "id": flat}))
        found = self.database.sql(DECODE).to_arrow_table()
        self.database.unregister("ids")
        for chunk in found.to_batches():
            parts = chunk.column(1)
            values = parts.values
            edges = np.frombuffer(parts.buffers()[1], np.int32)[parts.offset : parts.offset + len(parts) + 1]
            wide = pa.types.is_large_binary(values.type)
            spots = np.frombuffer(values.buffers()[1], np.int64 if wide else np.int32)[values.offset :]
            data = values.buffers()[2]
            for d, a, b in zip(chunk.column(0).to_pylist(), spots[edges[:-1]].tolist(), spots[edges[1:]].tolist(), strict=True):
                out[d] = data[a:b].to_pybytes()
        return out


@lru_cache(maxsize=2)
def bpe(path: str, pattern: str) -> Bpe:
    return Bpe(path, pattern)


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` (little-endian unsigned 32-bit numbers) and ``decoded`` (bytes of those ids)."""

    def work(batch: dict) -> dict:
        coder = bpe(path, pattern)
        ids: list[bytes] = []
        decoded: list[bytes] = []
        for at in slices([len(t or "") for t in batch[text]], SLICE):
            part = coder.encode(batch[text][at])
            ids += part
            decoded += coder.decode(part)
        return {"n_tokens": [len(x) // 4 for x in ids], "ids": ids, "decoded": decoded}

    return arrow_extend(docs, [text], work, "n_tokens long, ids binary, decoded binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, hashed where the ids are made."""

    def work(batch: dict) -> dict:
        coder = bpe(path, pattern)
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for at in slices([len(t or "") for t in batch[text]], SLICE):
            ids = coder.encode(batch[text][at])
            out["n_tokens"] += [len(x) // 4 for x in ids]
            out["ids_sha256"] += [sha256(x).hexdigest() for x in ids]
            out["decoded_sha256"] += [sha256(x).hexdigest() for x in coder.decode(ids)]
        return out

    return arrow_extend(docs, [text], work, "n_tokens long, ids_sha256 string, decoded_sha256 string")


