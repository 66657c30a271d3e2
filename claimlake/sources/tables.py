"""Tables and table folders as batch or stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    """New rows of a catalog table as they are appended."""
    return spark.readStream.table(name)


def stream_folder(
    spark: SparkSession, path: str, schema: T.StructType, *, pattern: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """New Parquet files of a table folder as they appear."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_changes(spark: SparkSession, path: str, schema: T.StructType, expressions: Sequence[str]) -> DataFrame:
    """The change feed of an append-only table with a projection: its appended rows."""
    return stream_folder(spark, path, schema).selectExpr(*expressions)
