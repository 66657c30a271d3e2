"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

The lexicon is learned: words whose document frequency differs most between toxic and other labelled documents. Features are
densities of lexicon words (plain, and found only after undoing obfuscation), how many stand near a second-person word, rates
of second-person words, capitals, shouted words, punctuation, exclamation marks, digits and obfuscated words, and length.

Everything is fitted on at most ``most_rows`` labelled rows, taken by the hash of their id, in four folds by the crc32 of the
id. A labelled row's features come from a lexicon learned on the other folds; trees are grown on three folds and calibrated on
the fourth; the lexicon that is kept is learned on all. If a fold lacks a class, all rows serve for each step; if they lack
one too, every score is the share of toxic rows (0 without any). Features of all documents are computed where they are scanned, and the forest is evaluated there by Spark.

Defined results: a null text counts as empty and is scored by its features, all 0. A document labelled twice counts as toxic
if one label says so; null labels do not count. A null id is never held out and never learned from. Repeated rows give
repeated results. Other columns keep their values whatever their names, but for ``score`` and ``predicted``. The isotonic steps
leave ties, which the raw margin breaks: a thousandth of the score is the raw one.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import broadcast

from claimlake.llm.common import arrow_extend, stored

FEATURES = (
    "hits", "density", "weight", "strongest", "hidden", "hidden_density", "near_you", "near_share", "you", "capitals", "shouted", "punctuation",
    "exclaimed", "digits", "obfuscated", "length",
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine deiner ihr euch euer tú ti tus usted ustedes vosotros".split()
)
OTHERS, TEXT = "_other_columns", "_scored_text"
_WORD = re.compile(r"\w+")
# from the start of a word only, and without giving back: linear in the text, also in one word of a megabyte
_MASKED = re.compile(r"(?<!\w)(?:\w++(?:[@$!|*.\-+]++\w++)++|[@$|*+]++\w++|(?=[^\W\d_]*+\d)(?=\d*+[^\W\d_])\w++)")
_UNDONE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i", "+": "t", "*": None, ".": None, "-": None})
_REPEATED = re.compile(r"(.)\1{2,}")


def _undone(word: str) -> set[str]:
    low = word.lower()
    return {low.translate(_UNDONE), re.sub(r"[\W\d_]", "", low), _REPEATED.sub(r"\1", low.translate(_UNDONE))}


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    text = text or ""
    words = _WORD.findall(text.lower())
    n = max(1, len(words))
    spots = [i for i, w in enumerate(words) if w in lexicon]
    found = [lexicon[words[i]] for i in spots]
    addressed = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if spots and addressed:
        at = np.searchsorted(addressed, spots)
        you = np.array(addressed)
        left = np.abs(you[np.maximum(at - 1, 0)] - spots)
        right = np.abs(you[np.minimum(at, len(you) - 1)] - spots)
        near = int((np.minimum(left, right) <= 5).sum())
    masked = _MASKED.findall(text)
    hidden = sum(1 for m in masked if m.lower() not in lexicon and not _undone(m).isdisjoint(lexicon))
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256) if text else np.zeros(256, np.int64)
    size = max(1, len(text))
    capitals = int(counts[65:91].sum())
    punctuation = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
    shouted = sum(1 for w in text.split() if len(w) > 2 and w.isupper()) if capitals > size // 50 else 0
    return [
        float(len(spots)), len(spots) / n, sum(found) / n, max(found, default=0.0), float(hidden), hidden / n, float(near), near / max(1, len(spots)),
        len(addressed) / n, capitals / size, shouted / n, punctuation / size, int(counts[33]) / size, int(counts[48:58].sum()) / size, len(masked) / n,
        float(np.log1p(len(words))),
    ]


def with_features(docs: DataFrame, lexicon: dict[str, float], text: str = "text") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def work(batch: dict) -> dict:
        rows = [features(t, shared.value) for t in batch[text]]
        return {name: [r[i] for r in rows] for i, name in enumerate(FEATURES)}

    return arrow_extend(docs, [text], work, ", ".join(f"{n} double" for n in FEATURES))


def learn_lexicon(rows: DataFrame, least: int = 3, odds: float = 2.0, most: int = 1_000) -> dict[str, float]:
    """Words in at least ``least`` toxic documents with a log ratio of document shares of ``odds`` or more, ``most`` at most.

    A word's weight grows with the toxic documents that hold it: one met in many is no chance.
    """
    words = rows.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)(\w+)")))).alias("word"))
    counted = words.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).where(F.col("bad") >= least)
    total = rows.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).first()
    ratio = F.log((F.col("bad") + 0.5) / ((total.bad or 0) + 1)) - F.log((F.col("good") + 1.0) / ((total.good or 0) + 1))
    kept = counted.withColumn("ratio", ratio).where(F.col("ratio") >= odds).orderBy(F.desc("bad"), F.desc("ratio"), "word").limit(most)
    return {r.word: float(np.log2(1 + r.bad)) for r in kept.collect()}


class Scorer:
    def __init__(self, lexicon: dict[str, float], forest=None, isotonic=None, constant: float = 0.0):
        self.lexicon, self.forest, self.isotonic, self.constant = lexicon, forest, isotonic, constant

    def score(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with ``score`` and ``predicted``, which replace columns of those names."""
        kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
        # all but the text in one column, so that none can bear the name of a feature or of a column the model adds
        others = [F.col(f"`{c}`") for c in kept if c != text]
        packed = docs.select(F.struct(*others or [F.lit(None).alias("none")]).alias(OTHERS), F.col(f"`{text}`").alias(TEXT))
        if self.forest is None:
            score = F.lit(self.constant)
        else:
            packed = self.isotonic.transform(_raw(self.forest, with_features(packed, self.lexicon, TEXT)))
            score = 0.999 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated"))) + 0.001 * F.col("raw_score")
        again = [(F.col(TEXT) if c == text else F.col(OTHERS)[c]).alias(c) for c in kept]
        scored = packed.select(*again, score.alias("score"))
        return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _raw(forest, rows: DataFrame) -> DataFrame:
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    found = forest.transform(assembled).withColumn("raw_score", vector_to_array("probability")[1])
    return found.drop("features", "rawPrediction", "probability", "prediction")


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000, trees: int = 20, depth: int = 3, seed: int = 7) -> Scorer:
    """Fit on the labelled rows of ``labels`` (doc_id, toxic); the caller leaves out those that must not be seen."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)  # most_rows ids and flags: small enough to broadcast
    rows = docs.where("doc_id IS NOT NULL").join(broadcast(chosen), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    rows = stored(rows.withColumn("fold", fold.cast("int")), "labelled")
    counts = {(r.fold, r.toxic): r.n for r in rows.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    n = {t: sum(c for (_, x), c in counts.items() if x == t) for t in (0, 1)}
    if not n[0] or not n[1]:
        return Scorer({}, constant=1.0 if n[1] else 0.0)
    apart = all(counts.get((f, t), 0) for f in (1, 2, 3, 4) for t in (0, 1))
    if apart:
        parts = [with_features(rows.where(F.col("fold") == f), learn_lexicon(rows.where(F.col("fold") != f))) for f in (1, 2, 3, 4)]
        table = reduce(DataFrame.union, parts)
    else:
        table = with_features(rows, learn_lexicon(rows))
    table = stored(table.drop("text"), "features")
    of = lambda folds: table.where(F.col("fold").isin(*folds)) if apart else table
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(of([1, 2, 3]))
    forest = GBTClassifier(labelCol="toxic", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, maxBins=64).fit(assembled)
    isotonic = IsotonicRegression(featuresCol="raw_score", labelCol="toxic", predictionCol="calibrated").fit(_raw(forest, of([4])))
    lexicon = learn_lexicon(rows)
    return Scorer(lexicon, forest, isotonic)


