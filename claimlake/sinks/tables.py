"""Writing tables: names, modes, layers, listings."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.sources.csv import read_csv_with_audit
from claimlake.sources.landing import list_csv_files

SUMMARY = "table string, source string, rows bigint, cols array<string>"


def bronze_table_name(file_name: str) -> str:
    """``Claims Bordereau.csv`` -> ``bronze_claims_bordereau``."""
    stem = file_name.rsplit(".", 1)[0].lower()
    for separator in "- ":
        stem = stem.replace(separator, "_")
    return f"bronze_{stem}"


def write_table(
    df: DataFrame,
    name: str,
    *,
    mode: str = "overwrite",
    overwrite_schema: bool = True,
    file_format: str = "parquet",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> int:
    """Write a managed table and return the rows written, counted on the way.

    ``overwrite_schema=False`` keeps the existing schema: columns it lacks are refused and missing ones
    become NULL. ``cluster_by`` range-partitions the rows so that files cover narrow key ranges.
    """
    spark = df.sparkSession
    if mode == "overwrite" and not overwrite_schema and spark.catalog.tableExists(name):
        df = _fit(df, spark.table(name).schema)
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(file_format)
    if mode == "overwrite":
        # A whole-table replacement, whatever the session says about partitions.
        writer = writer.option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return counted.get["rows"]


def _fit(df: DataFrame, schema: T.StructType) -> DataFrame:
    unknown = set(df.columns) - set(schema.names)
    if unknown:
        raise ValueError(f"columns not in the table: {sorted(unknown)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def write_layer(tables: Mapping[str, DataFrame], database: str, **options) -> dict[str, int]:
    """Overwrite a layer's tables from their DataFrames; rows per table.

    A DataFrame must not read the table it replaces: stage such a result first.
    """
    return {name: write_table(df, f"{database}.{name}", **options) for name, df in tables.items()}


def create_table_as(spark: SparkSession, name: str, select: str, **options) -> int:
    """Create or replace a table from a query text."""
    return write_table(spark.sql(select), name, **options)


def write_quarantine(df: DataFrame, target: str, **options) -> int:
    """The ``<target>_quarantine`` companion table."""
    return write_table(df, f"{target}_quarantine", **options)


def list_layer_tables(spark: SparkSession, database: str, prefix: str = "bronze_") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if t.name.startswith(prefix) and not t.isTemporary)


def ingest_folder(
    spark: SparkSession, folder: str, database: str, *, clock: Column | None = None, **options
) -> DataFrame:
    """One bronze table per CSV file of a folder; a row (table, source, rows, cols) for each."""
    files = list_csv_files(spark, folder).collect()
    if not files:
        raise FileNotFoundError(f"no CSV files found in {folder}")
    names = Counter(bronze_table_name(file.name) for file in files)
    shared = sorted(name for name, n in names.items() if n > 1)
    if shared:
        raise ValueError(f"several files would become one table: {shared}")
    written = []
    for file in files:
        name = f"{database}.{bronze_table_name(file.name)}"
        df = read_csv_with_audit(spark, file.path, clock)
        written.append((name, file.name, write_table(df, name, **options), df.columns))
    return spark.createDataFrame(written, SUMMARY)
