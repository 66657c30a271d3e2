"""Row counts, freshness and quarantine figures over the tables of a medallion."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.functions.casting import now_or


@dataclass(frozen=True)
class Listed:
    """One table of the inventory and its optional time and source-file columns."""

    layer: str
    table: str
    rows: DataFrame
    ingested_at: str | None = None
    source_file: str | None = None


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def inventory(tables: Iterable[Listed]) -> DataFrame:
    """(layer, table_name, row_count, latest_ingest_ts): one aggregate per table, reading one column at most."""
    return _union(
        listed.rows.agg(
            F.lit(listed.layer).alias("layer"),
            F.lit(listed.table).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            (F.max(listed.ingested_at) if listed.ingested_at else F.lit(None).cast("timestamp")).alias("latest_ingest_ts"),
        )
        for listed in tables
    )


def medallion_counts(tables: Iterable[Listed]) -> DataFrame:
    """(layer, table_name, row_count, source_file_count); tables without a file column count NULL files."""
    return _union(
        listed.rows.agg(
            F.lit(listed.layer).alias("layer"),
            F.lit(listed.table).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            (F.count_distinct(listed.source_file) if listed.source_file else F.lit(None).cast("bigint")).alias("source_file_count"),
        )
        for listed in tables
    )


def quarantine_summary(quarantines: Mapping[str, DataFrame]) -> DataFrame:
    """(stream, quarantine_reason, row_count, latest_quarantine_ts)."""
    return _union(
        rows.groupBy("quarantine_reason")
        .agg(F.count(F.lit(1)).alias("row_count"), F.max("_quarantine_ts").alias("latest_quarantine_ts"))
        .withColumn("stream", F.lit(stream))
        for stream, rows in quarantines.items()
    ).select("stream", "quarantine_reason", "row_count", "latest_quarantine_ts")


def with_ingest_age(table_inventory: DataFrame, clock: Column | None = None) -> DataFrame:
    """Hours since the latest ingest, two digits, NULL where a table has no ingest time."""
    minutes = F.timestamp_diff("MINUTE", F.col("latest_ingest_ts"), now_or(clock))
    return table_inventory.withColumn("ingest_age_hours", F.round(minutes / F.lit(60.0), 2))


def quarantine_total(summary: DataFrame) -> DataFrame:
    return summary.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_quarantine"))


def monitoring_counters(counts: DataFrame, raw_table: str, current_table: str) -> DataFrame:
    """Rows of one bronze and one current table, rows per layer, and how many gold tables hold rows."""
    rows = F.col("row_count")

    def where(condition: Column) -> Column:
        return F.sum(F.when(condition, rows).otherwise(0))

    return counts.agg(
        where(F.col("table_name") == raw_table).alias("bronze_claims_rows"),
        where(F.col("table_name") == current_table).alias("silver_current_rows"),
        where(F.col("layer") == "bronze").alias("bronze_rows"),
        where(F.col("layer") == "silver").alias("silver_rows"),
        F.count_if((F.col("layer") == "gold") & (rows > 0)).alias("gold_populated"),
    )


def rows_by(summary: DataFrame, key: str) -> DataFrame:
    """Rows per table, stream or reason."""
    return summary.groupBy(key).agg(F.sum("row_count").alias("rows"))


def oldest_by_table(aged: DataFrame) -> DataFrame:
    return aged.groupBy("table_name").agg(F.max("ingest_age_hours").alias("ingest_age_hours"))
