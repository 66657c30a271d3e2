"""The file and table layer over the driver's tables: each query writes them below the work folder and reads them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.operators import eventlog, quality
from claimlake.plans.flows import FlowRunner, FlowSpec
from claimlake.schemas import RISK_ZONES
from claimlake.session import work_path
from claimlake.sinks import tables as sinks
from claimlake.sources import csv, landing
from claimlake.sources.tables import read_table, stream_changes
from claimlake.streaming import runs
from claimlake.workload import tables as t
from claimlake.workload.oracle import with_raw
from claimlake.workload.registry import query

ZONES = ["postcode", "region_name", "wind_risk_band"]
ZONE_TEXT_SQL = "CASE WHEN postcode IS NOT NULL THEN lpad(CAST(postcode AS VARCHAR), 4, '0') END AS postcode, region_name, wind_risk_band"


def _landed(spark, folder, root: str, *columns: str) -> str:
    """Risk zones as CSV files of a landing folder."""
    path = f"{root}/landing/risk_zones"
    t.raw_zones(spark, folder).select(*(columns or ZONES)).write.option("header", True).csv(path)
    return path


@query("file_csv_inferred", with_raw("SELECT postcode, region_name, wind_risk_band, TRUE AS audited FROM raw_zones"))
def _(spark, folder):
    """Inferred types lose the leading zeros of postcodes."""
    rows = csv.read_csv_with_audit(spark, _landed(spark, folder, work_path(spark, "csv-inferred")))
    audited = F.col("ingestion_timestamp").isNotNull() & F.col("source_file_name").endswith(".csv")
    return rows.select(*ZONES, audited.alias("audited"))


@query("file_csv_text", with_raw(f"SELECT {ZONE_TEXT_SQL} FROM raw_zones"))
def _(spark, folder):
    """All text, by the header: the files hold the columns in another order than the contract."""
    path = _landed(spark, folder, work_path(spark, "csv-text"), *reversed(ZONES))
    return csv.read_csv_text(spark, path, RISK_ZONES.raw_schema()).select(*ZONES)


@query("file_csv_fallback", with_raw(f"SELECT {ZONE_TEXT_SQL} FROM raw_zones"))
def _(spark, folder):
    root = work_path(spark, "csv-fallback")
    return csv.read_csv_or_fallback(spark, f"{root}/missing", _landed(spark, folder, root))


@query("file_text_lines", with_raw("SELECT coalesce(region_name, wind_risk_band) AS value FROM raw_zones"))
def _(spark, folder):
    """Every region on a line of its own with a blank line after it."""
    path = f"{work_path(spark, 'lines')}/text"
    named = F.coalesce("region_name", "wind_risk_band")
    t.raw_zones(spark, folder).select(F.explode(F.array(named, F.lit("  "))).alias("value")).write.text(path)
    return csv.read_text_lines(spark, path)


@query(
    "file_folder_to_tables",
    with_raw("SELECT count(*) AS rows, 'ingestion_timestamp,postcode,region_name,source_file_name,wind_risk_band' AS columns, TRUE AS named FROM raw_zones"),
)
def _(spark, folder):
    """One bronze table for each CSV file of the folder; the tables' database goes when they have been counted."""
    path = _landed(spark, folder, work_path(spark, "folder"))
    database = f"files_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {database}")
    try:
        found = sinks.ingest_folder(spark, path, database)
        listed = sinks.list_layer_tables(spark, database)
        whole = found.agg(
            F.sum("rows").alias("rows"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("cols")))), ",").alias("columns"),
            (F.count("*") == len(listed)).alias("named"),
        )
        return spark.createDataFrame(whole.collect(), whole.schema)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


@query(
    "file_dataset_registry",
    with_raw("SELECT 'bronze_risk_zone_lookup' AS table_name, count(*) AS files_rows FROM raw_zones"),
)
def _(spark, folder):
    """The registry's own paths for one dataset, and the rows found there."""
    root = work_path(spark, "registry")
    dataset = next(d for d in landing.DATASETS if d.entity is RISK_ZONES)
    _landed(spark, folder, root)
    rows = csv.read_csv_text(spark, dataset.source_path(f"{root}/landing"))
    return rows.agg(F.lit(dataset.table).alias("table_name"), F.count("*").alias("files_rows"))


@query(
    "table_writes",
    with_raw(
        """SELECT 'zones' AS step, count(*) AS written FROM raw_zones UNION ALL SELECT 'again', 2 * count(*) FROM raw_zones
        UNION ALL SELECT 'as_select', count(*) FROM (SELECT DISTINCT wind_risk_band FROM raw_zones)
        UNION ALL SELECT 'quarantine', count(*) FROM raw_zones WHERE postcode IS NULL"""
    ),
)
def _(spark, folder):
    """Overwrite, append, create as, quarantine companion; what the tables hold afterwards."""
    database = f"writes_{uuid.uuid4().hex[:10]}"
    zones = t.raw_zones(spark, folder)
    spark.sql(f"CREATE DATABASE {database}")
    try:
        steps = [("zones", sinks.write_table(zones, f"{database}.zones"))]
        sinks.write_table(zones, f"{database}.zones", mode="append")
        steps.append(("again", read_table(spark, f"{database}.zones").count()))
        sinks.create_table_as(spark, f"{database}.bands", f"SELECT DISTINCT wind_risk_band FROM {database}.zones")
        steps.append(("as_select", read_table(spark, f"{database}.bands").count()))
        sinks.write_quarantine(zones.filter("postcode IS NULL"), f"{database}.zones")
        steps.append(("quarantine", read_table(spark, f"{database}.zones_quarantine").count()))
        return spark.createDataFrame(steps, "step string, written long")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


@query("stream_change_feed", with_raw("SELECT postcode, upper(region_name) AS region FROM raw_zones"))
def _(spark, folder):
    """The appended rows of a table as a stream, under a projection."""
    root = work_path(spark, "changes")
    zones = t.raw_zones(spark, folder).select(*ZONES)
    zones.write.parquet(f"{root}/zones")
    feed = stream_changes(spark, f"{root}/zones", zones.schema, ["CAST(postcode AS INT) AS postcode", "upper(region_name) AS region"])
    runs.finish(runs.append_to_folder(feed, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/out")


def _two_hard_rules() -> tuple[quality.Rule, ...]:
    return (quality.required("postcode"), quality.Rule("known_band", "wind_risk_band <> 'HIGH'", quality.DROP))


@query(
    "log_of_our_runs",
    with_raw(
        """SELECT 'COMPLETED' AS final_status, count(*) FILTER (postcode IS NOT NULL AND wind_risk_band <> 'HIGH') AS output_records,
        count(*) FILTER (postcode IS NULL OR wind_risk_band = 'HIGH') AS dropped_records,
        count(*) FILTER (postcode IS NULL) AS no_postcode, count(*) FILTER (wind_risk_band = 'HIGH') AS unknown_band FROM raw_zones"""
    ),
)
def _(spark, folder):
    """A flow with two hard rules that fail on different rows, and what the log it wrote says."""
    root = work_path(spark, "own-log")
    t.raw_zones(spark, folder).select(*ZONES).write.parquet(f"{root}/landing")
    log = eventlog.RunLog(spark, f"{root}/log", "p1", "zones")
    spec = FlowSpec(name="zones", source=f"{root}/landing", source_format="parquet", rules=_two_hard_rules())
    FlowRunner(spark, f"{root}/out", log).run([spec])
    rows = eventlog.read_log(spark, f"{root}/log")
    failing = eventlog.expectation_metrics(rows).agg(
        F.sum(F.when(F.col("expectation") == "postcode_not_null", F.col("failing_records"))).alias("no_postcode"),
        F.sum(F.when(F.col("expectation") == "known_band", F.col("failing_records"))).alias("unknown_band"),
    )
    flows: DataFrame = eventlog.flow_metrics(rows).select(
        "final_status", F.col("total_output_records").alias("output_records"), F.col("total_expectation_dropped_records").alias("dropped_records")
    )
    one = F.lit(1).alias("one")
    return flows.select("*", one).join(failing.select("*", one), "one").drop("one")  # one row each
