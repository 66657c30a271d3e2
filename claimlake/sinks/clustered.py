"""Tables laid out along a space-filling curve over two or three columns, with the range of every file kept beside them.

Each column is cut into as many cells as ``bits`` allow, by its quantiles, so that cells hold about equally many rows whatever the
values. The bits of a row's cells, interleaved, are its place on the curve; rows are dealt to files by ranges of it. A file then
covers a narrow range of every column, and a query over any of them reads few files. Which ones, the index tells: one row a
file with the least and greatest value of each column, so no footers are opened to find out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CURVE, FILE = "_curve", "_file"
Bounds = Mapping[str, tuple]


def _number(df: DataFrame, name: str) -> Column:
    """A column as numbers in its own order."""
    kind = dict(df.dtypes)[name]
    if kind == "date":
        return F.unix_date(name).cast("double")
    if kind.startswith("timestamp"):
        return F.col(name).cast("timestamp").cast("double")
    if kind.startswith(("decimal", "int", "bigint", "smallint", "tinyint", "double", "float")):
        return F.col(name).cast("double")
    raise ValueError(f"{name}: a column of type {kind} has no place on the curve")


def with_curve(df: DataFrame, keys: Sequence[str], bits: int = 8) -> DataFrame:
    """``df`` with ``_curve``, a row's place on the curve; NULLs lie in the first cell.

    The cells' bounds are quantiles, at most 2**bits numbers a column on the driver, told within a quarter of a cell.
    """
    numbers = df.select(*[_number(df, k).alias(k) for k in keys])
    steps = [i / 2**bits for i in range(1, 2**bits)]
    found = numbers.approxQuantile(list(keys), steps, 0.25 / 2**bits)
    placed = df
    for n, (key, quantiles) in enumerate(zip(keys, found, strict=True)):
        splits = [float("-inf"), *(sorted(set(quantiles)) or [0.0]), float("inf")]
        placed = placed.withColumn("_value", F.coalesce(_number(df, key), F.lit(float("-inf"))))
        placed = Bucketizer(splits=splits, inputCol="_value", outputCol=f"_cell_{n}").transform(placed).drop("_value")
    woven = F.lit(0).cast("bigint")
    for bit in range(bits):
        for n in range(len(keys)):
            woven = woven + F.shiftleft(F.shiftright(F.col(f"_cell_{n}").cast("bigint"), bit).bitwiseAND(1), bit * len(keys) + n)
    return placed.withColumn(CURVE, woven).drop(*[f"_cell_{n}" for n in range(len(keys))])


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], files: int, bits: int = 8) -> None:
    """Write ``df`` in about ``files`` files along the curve over ``keys``, and the index of what each file covers."""
    spark = df.sparkSession
    laid = with_curve(df, keys, bits).repartitionByRange(files, CURVE).sortWithinPartitions(CURVE).drop(CURVE)
    laid.write.mode("overwrite").parquet(f"{path}/rows")
    ranges = [f(k).alias(f"{side}_{k}") for k in keys for side, f in (("low", F.min), ("high", F.max))]
    nulls = [F.count_if(F.col(k).isNull()).alias(f"nulls_{k}") for k in keys]
    rows = spark.read.parquet(f"{path}/rows").withColumn(FILE, F.col("_metadata.file_path"))
    rows.groupBy(FILE).agg(*ranges, *nulls, F.count(F.lit(1)).alias("rows")).coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def files_of(spark: SparkSession, path: str, bounds: Bounds) -> DataFrame:
    """The index rows of the files that may hold rows within ``bounds``: (low, high) by column, None for an open end."""
    index = spark.read.parquet(f"{path}/index")
    for key, (low, high) in bounds.items():
        if low is not None:
            index = index.where(F.col(f"high_{key}") >= F.lit(low))
        if high is not None:
            index = index.where(F.col(f"low_{key}") <= F.lit(high))
    return index


def read_clustered(spark: SparkSession, path: str, bounds: Bounds | None = None) -> DataFrame:
    """The rows within ``bounds``, ends included, from the files that may hold some."""
    if not bounds:
        return spark.read.parquet(f"{path}/rows")
    schema = spark.read.parquet(f"{path}/rows").schema
    files = [r[FILE] for r in files_of(spark, path, bounds).select(FILE).collect()]  # the driver lists the files of a read anyway
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for key, (low, high) in bounds.items():
        rows = rows.where(F.col(key) >= F.lit(low)) if low is not None else rows
        rows = rows.where(F.col(key) <= F.lit(high)) if high is not None else rows
    return rows
