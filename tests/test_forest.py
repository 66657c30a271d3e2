"""The forest against plain arithmetic, its samples whatever the partitioning, and what its tasks add up."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from claimlake.functions import trees as t
from claimlake.operators import forest


def made(seed=0, n=400):
    r = np.random.default_rng(seed)
    values = np.stack([r.integers(0, 6, n), r.random(n).round(1), r.integers(0, 2, n)], 1).astype(float)
    return values, values[:, 0] * 10 + values[:, 2] * 25 + r.normal(0, 1, n), r.integers(0, 2**62, n).astype(np.uint64)


def sums_of(keys, labels, bins, tree, usual, widths):
    rows = list(t.level_sums(keys, labels, bins, [tree], usual, widths, 7))
    cells = int(widths.sum())
    join = lambda n, kind, shape: np.concatenate([np.frombuffer(r[n], kind).reshape(shape) for r in rows], -1 if shape[0] == 3 else 0)
    return join(2, np.int32, (-1, cells)), join(3, float, (-1, cells)), join(4, float, (3, -1))


def test_splits_are_those_of_plain_arithmetic():
    values, labels, keys = made()
    splits = [(np.unique(c)[1:] + np.unique(c)[:-1]) / 2 for c in values.T]
    bins, widths = t.binned(values, splits), np.array([len(s) + 1 for s in splits])
    usual = np.array([np.bincount(c).argmax() for c in bins.T], np.uint8)
    tree, times = t.Tree(), t.drawn(keys, 0, 7).astype(float)
    for _ in range(4):
        ends = t.leaves(bins, tree)
        opened = np.flatnonzero(tree.slot >= 0)
        slots, feature, cut, counts, means = t.best_splits(*sums_of(keys, labels, bins, tree, usual, widths), usual, widths)
        for row, slot in enumerate(slots):
            here = (ends == opened[slot]) & (times > 0)
            w, y, b = times[here], labels[here], bins[here]

            def left_over(side):
                return sum(np.sum(w[s] * (y[s] - np.average(y[s], weights=w[s])) ** 2) for s in (side, ~side))

            tried = [b[:, f] <= c for f in range(3) for c in range(widths[f] - 1)]
            least = min(left_over(side) for side in tried if side.any() and not side.all())
            side = b[:, feature[row]] <= cut[row]
            assert left_over(side) == pytest.approx(least)
            assert list(counts[row]) == [w[side].sum(), w[~side].sum()]
            assert list(means[row]) == pytest.approx([np.average(y[side], weights=w[side]), np.average(y[~side], weights=w[~side])])
        tree.split(slots, feature, cut, counts, means)
    assert len(tree.feature) > 15


def test_rows_name_their_unusual_bins_only():
    bins = np.eye(30, dtype=np.uint8)[np.arange(300) % 30]
    codes = t.cells(bins, np.zeros(30, np.uint8), 2 * np.arange(30), 60)
    assert codes.shape == (300, 1) and list(codes[:30, 0]) == [2 * n + 1 for n in range(30)]


def test_samples_are_bootstraps():
    times = np.stack([t.drawn(np.arange(20000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), n, 42) for n in range(8)]).astype(float)
    assert times.mean(1) == pytest.approx(np.ones(8), abs=0.05) and times.var(1) == pytest.approx(np.ones(8), abs=0.08)
    assert np.abs(np.corrcoef(times) - np.eye(8)).max() < 0.05


def rows(spark, count=900):
    made = spark.range(count).select(
        "id", (F.col("id") * 7 % 50).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"),
        (F.col("id") * 7 % 50 * 20 + F.col("id") % 3 * 500 + F.col("id") % 11).cast("double").alias("label"),
    )
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(made)


def predictions(model, df):
    return {r.id: r.prediction for r in model.transform(df).select("id", "prediction").collect()}


def test_the_forest_is_the_same_however_rows_lie(spark, tmp_path):
    df = rows(spark)
    learner = forest.ForestRegressor(numTrees=6, maxDepth=6)
    model = learner.fit(df)
    found = predictions(model, df)
    assert len(model.trees) == 6 and np.mean([abs(r.label - found[r.id]) for r in df.collect()]) < 60
    assert predictions(learner.fit(df.repartition(7).sortWithinPartitions(F.desc("id"))), df) == pytest.approx(found)
    assert predictions(learner.copy({learner.seed: 1}).fit(df), df) != pytest.approx(found)
    model.write().save(str(tmp_path / "model"))
    again = forest.ForestModel.load(str(tmp_path / "model"))
    assert again.uid == model.uid and predictions(again, df) == found


def test_rows_without_a_label_are_refused(spark):
    with pytest.raises(ValueError, match="0 rows"):
        forest.ForestRegressor().fit(rows(spark).where("FALSE"))
    with pytest.raises(ValueError, match="3 without a label"):
        forest.ForestRegressor().fit(rows(spark).withColumn("label", F.when(F.col("id") > 2, F.col("label"))))
