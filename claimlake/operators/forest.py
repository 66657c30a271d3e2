"""A random forest for regression that reads its rows once a level, for all trees, in tasks that hold one tree's sums at a time.

Each tree learns from a bootstrap sample, over all features, by the greatest fall of the variance, on candidate splits between values
(at quantiles where a feature has more than ``maxBins``). A level is one pass: tasks walk their rows down the trees and add draws and
labels up by node and bin, a shuffle adds up the tasks, and the best splits, some numbers a node, go to the driver, which holds the model.
Rows name only their unusual bins: of one-hot columns that is the hot one, so a category costs one sum, not one for each value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.functions import trees as t

HELD = 1 << 21  # rows that a task adds up before it hands sums on
KEY, LABEL, BINS = "_key", "_label", "_bins"


class _ForestParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels below the root", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, at most 256", TypeConverters.toInt)
    keyCol = Param(Params._dummy(), "keyCol", "column whose hash draws a row into the samples", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(keyCol="id", numTrees=20, maxDepth=5, maxBins=32, seed=42)


def _matrix(lists: pa.Array, dtype=float) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0).astype(dtype)


def _few_values(rows: DataFrame, most: int) -> list[np.ndarray | None]:
    """Each feature's distinct values, None if they are more than ``most``."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for n, column in enumerate(_matrix(batch.column(0)).T):
                if len(found.get(n, ())) <= most:
                    found[n] = np.unique(np.concatenate([found.get(n, np.empty(0)), np.unique(column)]))[: most + 1]
        yield pa.RecordBatch.from_pydict({"feature": pa.array(found, pa.int32()), "found": pa.array(list(found.values()), pa.list_(pa.float64()))})

    parts = rows.mapInArrow(per_task, "feature int, found array<double>")
    seen = parts.groupBy("feature").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("found")).orderBy("feature").collect()
    return [np.sort(r.found) if len(r.found) <= most else None for r in seen]


def _splits(rows: DataFrame, most: int) -> list[np.ndarray]:
    """Candidate splits: between neighbouring values of a feature that has few, else at quantiles of all rows."""
    few = _few_values(rows.select("values"), most)
    wide = [n for n, values in enumerate(few) if values is None]
    shares = F.array(*[F.lit(k / most) for k in range(1, most)])
    quantiles = rows.agg(*[F.percentile_approx(F.get("values", F.lit(n)), shares, F.lit(10_000)) for n in wide]).first() if wide else ()
    at = dict(zip(wide, quantiles, strict=True))
    return [np.unique(at[n]) if values is None else (values[1:] + values[:-1]) / 2 for n, values in enumerate(few)]


class ForestRegressor(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction", keyCol: str = "id",
        numTrees: int = 20, maxDepth: int = 5, maxBins: int = 32, seed: int = 42,
    ) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ForestModel:
        label = F.col(self.getLabelCol()).cast("double")
        rows = dataset.select(
            F.xxhash64(self.getOrDefault("keyCol")).alias(KEY), label.alias(LABEL), vector_to_array(self.getFeaturesCol()).alias("values")
        )
        facts = rows.agg(F.count(F.lit(1)).alias("n"), F.avg(LABEL).alias("mean"), F.count_if(F.col(LABEL).isNull() | F.isnan(LABEL)).alias("bad")).first()
        if not facts.n or facts.bad:
            raise ValueError(f"a forest needs rows with labels: {facts.n} rows, {facts.bad} without a label")
        splits = _splits(rows, self.getOrDefault("maxBins"))
        held = rows.mapInArrow(_binning(splits, facts.mean), f"{KEY} bigint, {LABEL} double, {BINS} binary").persist()
        try:
            grown = self._grown(held, np.array([len(at) + 1 for at in splits]))
        finally:
            held.unpersist()
        for tree in grown:
            tree.mean += facts.mean
        return self._copyValues(ForestModel(grown, splits))

    def _grown(self, held: DataFrame, widths: np.ndarray) -> list[t.Tree]:
        grown = [t.Tree() for _ in range(self.getOrDefault("numTrees"))]
        usual = _usual(held, widths)
        context = held.sparkSession.sparkContext
        for _ in range(self.getOrDefault("maxDepth")):
            if not any(tree.open for tree in grown):
                break
            shared = context.broadcast(grown)
            sums = held.mapInArrow(_adding(shared, usual, widths, self.getSeed()), "tree int, block int, counts binary, sums binary, whole binary")
            found = sums.groupBy("tree", "block").applyInArrow(_choosing(usual, widths), CHOSEN).toArrow().sort_by([("tree", "ascending"), ("slot", "ascending")])
            shared.destroy()
            of_tree, slot, feature, cut, *sides = (c.to_numpy() for c in found.columns)
            bounds = np.searchsorted(of_tree, np.arange(len(grown) + 1))
            for tree, low, high in zip(grown, bounds, bounds[1:], strict=False):
                counts, means = (np.stack([x[low:high] for x in pair], 1) for pair in (sides[:2], sides[2:]))
                tree.split(slot[low:high], feature[low:high], cut[low:high], counts, means)
        return grown


CHOSEN = "tree int, slot int, feature int, cut int, n_left double, n_right double, mean_left double, mean_right double"


def _binning(splits: list[np.ndarray], mean: float):
    def bin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins = t.binned(_matrix(batch.column(2)), splits)
                packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(bins.shape[1]), len(bins), [None, pa.py_buffer(bins.tobytes())])
                labels = pa.array(batch.column(1).to_numpy() - mean)
                yield pa.RecordBatch.from_arrays([batch.column(0), labels, packed.cast(pa.binary())], names=[KEY, LABEL, BINS])

    return bin_rows


def _bins(column: pa.Array, features: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, features)


def _usual(held: DataFrame, widths: np.ndarray) -> np.ndarray:
    """The bin of each feature that most rows have."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(widths), 256), np.int64)
        for batch in batches:
            for n, column in enumerate(_bins(batch.column(0), len(widths)).T):
                counts[n] += np.bincount(column, minlength=256)
        feature, cell = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(feature, pa.int32()), pa.array(cell, pa.int32()), pa.array(counts[feature, cell])], names=["feature", "bin", "n"])

    counted = held.select(BINS).mapInArrow(per_task, "feature int, bin int, n bigint").groupBy("feature", "bin").agg(F.sum("n").alias("n"))
    most = counted.groupBy("feature").agg(F.max_by("bin", F.struct("n", "bin")).alias("bin"))
    return np.array([r.bin for r in most.orderBy("feature").collect()], np.uint8)


def _adding(shared, usual: np.ndarray, widths: np.ndarray, seed: int):
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed() -> Iterator[pa.RecordBatch]:
            keys, labels = (np.concatenate([b.column(n).to_numpy() for b in kept]) for n in (0, 1))
            bins = np.concatenate([_bins(b.column(2), len(widths)) for b in kept])
            for row in t.level_sums(keys.view(np.uint64), labels, bins, shared.value, usual, widths, seed):
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["tree", "block", "counts", "sums", "whole"]).cast(SUMS)

        kept = []
        for batch in batches:
            kept.append(batch)
            if sum(b.num_rows for b in kept) >= HELD:
                yield from summed()
                kept = []
        if sum(b.num_rows for b in kept):
            yield from summed()

    return add_up


SUMS = pa.schema([("tree", pa.int32()), ("block", pa.int32()), ("counts", pa.binary()), ("sums", pa.binary()), ("whole", pa.binary())])


def _choosing(usual: np.ndarray, widths: np.ndarray):
    def choose(sums: pa.Table) -> pa.Table:
        add = lambda name, kind: sum(np.frombuffer(x.as_buffer(), kind) for x in sums[name])
        cells = int(widths.sum())
        slots, *found = t.best_splits(
            add("counts", np.int32).reshape(-1, cells), add("sums", float).reshape(-1, cells), add("whole", float).reshape(3, -1), usual, widths
        )
        feature, cut, counts, means = found
        tree, block = sums["tree"][0].as_py(), sums["block"][0].as_py()
        columns = [np.full(len(slots), tree), slots + block * t.BLOCK, feature, cut, *counts.T, *means.T]
        names = [c.split()[0] for c in CHOSEN.split(", ")]
        return pa.table([pa.array(c, pa.int32() if n < 4 else pa.float64()) for n, c in enumerate(columns)], names)

    return choose


class ForestModel(Model, _ForestParams, MLReadable, MLWritable):
    """Trees and the splits between bins. It is kept as tables: one row a node, one row a feature."""

    def __init__(self, grown: list[t.Tree] | None = None, splits: list[np.ndarray] | None = None) -> None:
        super().__init__()
        self.trees, self.splits = grown or [], splits or []

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast((self.trees, self.splits))

        @F.arrow_udf("double")
        def predict(values: pa.Array) -> pa.Array:
            grown, splits = shared.value
            return pa.array(t.predicted(t.binned(_matrix(values), splits), grown) if len(values) else [], pa.float64())

        return dataset.withColumn(self.getPredictionCol(), predict(vector_to_array(self.getFeaturesCol())))

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader(cls)


class _ForestWriter(MLWriter):
    def __init__(self, instance: ForestModel) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        model, spark = self.instance, self.sparkSession
        DefaultParamsWriter.saveMetadata(model, path, spark)
        sizes = [len(tree.feature) for tree in model.trees]
        nodes = {"tree": np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), "node": np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])}
        nodes |= {c: np.concatenate([getattr(tree, c) for tree in model.trees]) for c in ("feature", "left", "mean")}
        nodes["cut"] = np.concatenate([tree.cut for tree in model.trees]).astype(np.int16)
        spark.createDataFrame(pa.table(nodes)).write.parquet(f"{path}/nodes")
        splits = pa.table({"feature": pa.array(range(len(model.splits)), pa.int32()), "splits": pa.array([at.tolist() for at in model.splits], pa.list_(pa.float64()))})
        spark.createDataFrame(splits).write.parquet(f"{path}/splits")


class _ForestReader(MLReader):
    def __init__(self, cls: type[ForestModel]) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ForestModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        nodes = spark.read.parquet(f"{path}/nodes").toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])
        columns = {c: nodes[c].to_numpy() for c in nodes.column_names}
        bounds = np.searchsorted(columns["tree"], np.arange(columns["tree"].max() + 2))
        grown = []
        for low, high in zip(bounds, bounds[1:], strict=False):
            feature, cut, left, mean = (columns[c][low:high].copy() for c in ("feature", "cut", "left", "mean"))
            grown.append(t.Tree(feature, cut.astype(np.uint8), left, mean, np.full(high - low, -1, np.int32), 0))
        splits = spark.read.parquet(f"{path}/splits").orderBy("feature").collect()
        model = self.cls(grown, [np.array(r.splits, float) for r in splits])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
