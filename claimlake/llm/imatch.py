"""I-Match fingerprints: hashes of a document's mid-frequency terms, once for each of several randomised lexicons.

Terms are runs of letters and digits, lower-cased. The base lexicon keeps the terms whose document frequency lies in a band;
its lower edge is a share of all documents, so the lexicon holds at most (mean distinct terms of a document) / share terms
however many documents there are, and that bound is checked before the lexicon is broadcast. Each of ``SUBSETS`` random
lexicons keeps a term with a probability between 1/2 and 1/1024; the document's distinct terms in it are sorted and hashed.
A base lexicon of more than 1024 terms has ``EACH`` further ones for every halving down to one term of it all, so that some
speak about a document of any number of terms.

A subset with no term of the document, or more than ``MOST`` of them, says nothing and has a dash in the fingerprint: one
replaced word would change a hash over many terms, so each length of document is told by the subsets that fit it. Likeness is
the share of subsets with equal hashes among those that say something about either document.

Defined results: a null text counts as empty. A document about which no subset says anything, as without any term in the band,
is told by the hash of all its distinct terms (likeness 1 if equal, else 0); so are two empty ones, which are alike. Equal texts
have equal fingerprints.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import broadcast

from claimlake.llm.common import arrow_partitions, numbered_ranges, shuffle_parts

SUBSETS, CLASSES, EACH, MOST = 40, 10, 4, 3
_TERM = re.compile(r"\w+")


def terms(text: str | None) -> set[str]:
    return set(_TERM.findall((text or "").lower()))


def _hashed(words) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64)


def document_frequency(docs: DataFrame, text: str = "text", most_held: int = 300_000) -> DataFrame:
    """(term, n): hash of each term and the documents that hold it; partial sums leave a task before the shuffle."""

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        held: Counter[str] = Counter()

        def flush() -> dict:
            out = {"term": _hashed(held).view(np.int64), "n": np.fromiter(held.values(), np.int64, len(held))}
            held.clear()
            return out

        for batch in batches:
            for value in batch["text"]:
                held.update(terms(value))
                if len(held) > most_held:
                    yield flush()
        yield flush()

    return arrow_partitions(docs.select(F.col(text).alias("text")), count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


class Lexicon:
    """Sorted term hashes and, for each, the packed bits of the random lexicons that keep it."""

    def __init__(self, hashes: np.ndarray, seed: int = 1):
        self.hashes = np.sort(hashes.astype(np.uint64))
        halvings = max(0, len(self.hashes) - 1).bit_length()
        classes = [k % CLASSES for k in range(SUBSETS)] + [c for c in range(CLASSES, halvings) for _ in range(EACH)]
        self.subsets = len(classes)
        self.masks = np.zeros((len(self.hashes), (self.subsets + 7) // 8), np.uint8)
        for k, c in enumerate(classes):
            mixed = (self.hashes ^ np.uint64((seed * SUBSETS + k + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(31)
            mixed *= np.uint64(0x94D049BB133111EB)
            kept = (mixed >> np.uint64(64 - 1 - c)) == 0
            self.masks[:, k // 8] |= kept.astype(np.uint8) << np.uint8(7 - k % 8)

    def fingerprint(self, text: str | None) -> str:
        words = terms(text)
        found = _hashed(words)
        spot = np.searchsorted(self.hashes, found)
        inside = np.zeros(len(found), bool)
        if len(self.hashes):
            spot[spot == len(self.hashes)] = 0
            inside = self.hashes[spot] == found
        spots = np.sort(spot[inside])
        bits = np.unpackbits(self.masks[spots], axis=1, count=self.subsets).view(bool)
        size = bits.sum(axis=0)
        speaks = (size > 0) & (size <= MOST)
        if not speaks.any():
            return "all:" + blake2b("\n".join(sorted(words)).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
        parts = ["-"] * self.subsets
        for k in np.flatnonzero(speaks).tolist():
            parts[k] = blake2b(self.hashes[spots[bits[:, k]]].tobytes(), digest_size=4).hexdigest()
        return ".".join(parts)


def likeness(one: str, other: str) -> float:
    """Share of equal hashes among the subsets that say something about either document."""
    if one == other:
        return 1.0
    if one.startswith("all:") or other.startswith("all:"):
        return 0.0
    pairs = [(a, b) for a, b in zip(one.split("."), other.split("."), strict=True) if a != "-" or b != "-"]
    return sum(a == b for a, b in pairs) / len(pairs)


def learn_lexicon(docs: DataFrame, text: str = "text", least: float = 0.0005, most: float = 0.2) -> Lexicon:
    """The terms held by at least two documents and between ``least`` and ``most`` of them all."""
    n = docs.count()
    frequency = document_frequency(docs, text)
    band = frequency.where((F.col("n") >= max(2, least * n)) & (F.col("n") <= max(2, most * n)))
    return Lexicon(np.array([r.term for r in band.select("term").collect()], np.int64).view(np.uint64))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` in ranges of descending ``key``, each range followed by the first row of the next one (``borrowed``).

    Only keys, one for each range, reach the driver; the borrowed texts are joined in. Rows of equal keys follow one another
    by text, and null keys come last.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    ranged, n = numbered_ranges(rows, "doc_id", shuffle_parts(spark), descending=True)
    heads = [tuple(r) for r in ranged.groupBy("range_id").agg(F.max("doc_id").alias("doc_id")).orderBy("range_id").collect()]
    if not heads:
        return rows.select("*", F.lit(0).alias("range_id"), F.lit(False).alias("borrowed"))
    lend = [(heads[(i + 1) % len(heads)][0], heads[(i + 1) % len(heads)][1], heads[i][0]) for i in range(len(heads))]
    heads_frame = spark.createDataFrame(lend, "range_id int, head_id long, to_range int")
    first = (
        ranged.join(broadcast(heads_frame), (ranged.range_id == heads_frame.range_id) & F.col("doc_id").eqNullSafe(F.col("head_id")))
        .groupBy("to_range")
        .agg(F.min(F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text"))).alias("head"))
        .select("head.doc_id", "head.text", F.col("to_range").alias("range_id"), F.lit(True).alias("borrowed"))
    )
    every = ranged.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "range_id", F.lit(False).alias("borrowed")).unionByName(first)
    return every.repartitionById(n, F.col("range_id")).sortWithinPartitions("range_id", "borrowed", F.col("doc_id").desc_nulls_last(), "text")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every document, of its edited text, and likeness to the edited text and to the next document.

    The edited text has its last third replaced by the beginning of the next document in descending order of ``key``.
    """
    from hashlib import sha256

    lexicon = learn_lexicon(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        names = [x.split()[0] for x in schema.split(", ")]
        held = None  # the row that waits for the one after it: range, key, text, fingerprint
        for batch in batches:
            out: dict[str, list] = {n: [] for n in names}
            for key_, text_, range_, borrowed in zip(batch["doc_id"], batch["text"], batch["range_id"], batch["borrowed"], strict=True):
                mark = shared.value.fingerprint(text_)
                if held and held[0] == range_:
                    own = held[2]
                    cut = len(own) // 3
                    edited = own[: len(own) - cut] + text_[:cut]
                    edited_mark = held[3] if edited == own else shared.value.fingerprint(edited)
                    row = (
                        held[1], len(own), sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), held[3], edited_mark,
                        likeness(held[3], edited_mark), likeness(held[3], mark),
                    )
                    for name, value in zip(names, row, strict=True):
                        out[name].append(value)
                held = None if borrowed else (range_, key_, text_, mark)
            yield out

    return arrow_partitions(with_next(docs, key, text), work, schema)
