"""Language identification as a mixture: every document holds languages in proportions, fitted by expectation-maximisation.

A language is a smoothed distribution over letter trigrams, hashed into ``BUCKETS`` bins and counted over all labelled
training rows. A document's proportions come from expectation-maximisation on its trigram counts; the set of languages is
the one, among the nested sets of likeliest languages up to all of them, whose likelihood less a penalty per language is greatest.

Defined results: a null text, an empty one and one without a letter give ``und`` with score 0. Without any training row,
every document is ``und``. Ties go to the language first in order. A null id is neither held out nor learned from.
Repeated rows give repeated results. Columns beyond those named by the arguments are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import arrow_extend, arrow_partitions, slices

BUCKETS = 1 << 16
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def trigram_bins(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document index and bin of every letter trigram of the lower-cased texts, and the letters of each text.

    A run of other characters counts as one blank, also before the first and after the last letter.
    """
    joined = "\0".join((t or "").lower().replace("\0", " ") for t in texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.cumsum(points == 0) - (points == 0)
    letter = _letters()[points]
    n_letters = np.bincount(doc[letter], minlength=len(texts)) if letter.any() else np.zeros(len(texts), np.int64)
    blank = ~letter
    keep = letter | (blank & ~np.concatenate(([False], blank[:-1] & (doc[1:] == doc[:-1]))))
    symbol = np.where(letter, points, 0)[keep].astype(np.uint64)
    owner = doc[keep]
    if len(symbol) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64), n_letters
    before = np.concatenate((np.zeros(1, np.uint64), symbol[:-1]))
    before[np.concatenate(([True], owner[1:] != owner[:-1]))] = 0
    after = np.concatenate((symbol[1:], np.zeros(1, np.uint64)))
    after[np.concatenate((owner[1:] != owner[:-1], [True]))] = 0
    mixed = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (symbol * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (after * np.uint64(0x165667B19E3779F9))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    bins = (mixed >> np.uint64(48)).astype(np.int64)
    inner = symbol > 0
    return owner[inner], bins[inner], n_letters


class Model:
    """Log-free tables: ``probability[bin, language]``, languages in order."""

    def __init__(self, languages: list[str], probability: np.ndarray):
        self.languages, self.probability = languages, probability

    @classmethod
    def from_counts(cls, counts: dict[str, np.ndarray], smoothing: float = 0.1) -> Model:
        languages = sorted(counts)
        rows = [(counts[x] + smoothing) / (counts[x].sum() + smoothing * BUCKETS) for x in languages]
        return cls(languages, np.stack(rows, axis=1).astype(np.float32) if rows else np.zeros((BUCKETS, 0), np.float32))

    def infer(self, texts: list[str | None], rounds: int = 8, penalty: float = 4.0) -> tuple[list[str], list[float], list[str]]:
        """Main language, its proportion, and the chosen set (comma-separated) of each text."""
        n, width = len(texts), len(self.languages)
        main, score, chosen = [UNKNOWN] * n, [0.0] * n, [""] * n
        owner, bins, letters = trigram_bins(texts)
        if not width or not len(owner):
            return main, score, chosen
        key, count = np.unique(owner * BUCKETS + bins, return_counts=True)
        doc, density = key // BUCKETS, self.probability[key % BUCKETS]
        present, start = np.unique(doc, return_index=True)
        local = np.repeat(np.arange(len(present)), np.diff(np.append(start, len(doc))))
        weight = count.astype(np.float32)
        total = np.add.reduceat(weight, start)
        full = self._fit(density, weight, total, start, local, np.ones((len(present), width), bool), rounds)
        order = np.argsort(-full, axis=1, kind="stable")
        best = np.full(len(present), -np.inf)
        share = np.zeros_like(full)
        for size in range(1, width + 1):
            allowed = np.zeros_like(full, bool)
            np.put_along_axis(allowed, order[:, :size], True, axis=1)
            part = allowed.astype(np.float32) if size == 1 else self._fit(density, weight, total, start, local, allowed, rounds)
            likelihood = np.add.reduceat(np.log((part[local] * density).sum(axis=1) + 1e-30, dtype=np.float64) * weight, start)
            value = likelihood - penalty * size * np.log(total + 1.0)
            better = value > best
            best[better], share[better] = value[better], part[better]
        lead = share.argmax(axis=1)
        for row, d in enumerate(present.tolist()):
            if letters[d]:
                main[d], score[d] = self.languages[lead[row]], float(min(1.0, share[row, lead[row]]))
                chosen[d] = ",".join(x for x, s in zip(self.languages, share[row], strict=True) if s > 0)
        return main, score, chosen

    @staticmethod
    def _fit(density, weight, total, start, local, allowed, rounds):
        part = allowed / allowed.sum(axis=1, keepdims=True)
        part = part.astype(np.float32)
        for _ in range(rounds):
            joint = part[local] * density
            joint *= (weight / (joint.sum(axis=1) + 1e-30))[:, None]
            part = np.add.reduceat(joint, start, axis=0) / total[:, None]
        return part


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Trigram counts of all rows of ``docs`` with a language: one row per language and bin reaches the driver.

    That is at most ``BUCKETS`` rows for each language, however many documents there are.
    """
    labelled = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in slices([len(t or "") for t in batch["text"]], 100_000):
                owner, bins, _ = trigram_bins(batch["text"][at])
                names = np.array(batch["lang"][at], dtype=object)
                for name in set(batch["lang"][at]):
                    sums.setdefault(name, np.zeros(BUCKETS, np.int64))
                    sums[name] += np.bincount(bins[(names == name)[owner]], minlength=BUCKETS)
        for name, total in sums.items():
            full = np.flatnonzero(total)
            yield {"lang": [name] * len(full), "bin": full.astype(np.int32), "n": total[full]}

    counted = arrow_partitions(labelled, count, "lang string, bin int, n long", cut=True).groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    counts: dict[str, np.ndarray] = {}
    for name, spot, n in counted.collect():
        counts.setdefault(name, np.zeros(BUCKETS))[spot] = n
    return Model.from_counts(counts)


def predict(docs: DataFrame, model: Model, text: str = "text", rounds: int = 8, penalty: float = 4.0) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``languages``; columns of those names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers for each language

    def work(batch: dict) -> dict:
        main, score, chosen = [], [], []
        for at in slices([len(t or "") for t in batch[text]], 100_000):
            m, s, c = shared.value.infer(batch[text][at], rounds, penalty)
            main += m
            score += s
            chosen += c
        return {"lang_pred": main, "score": score, "languages": chosen}

    return arrow_extend(docs, [text], work, "lang_pred string, score double, languages string")
