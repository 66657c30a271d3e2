"""Run-log analytics, and the writer that produces such logs.

A log row is ``timestamp, level, event_type, message, origin struct, details`` with details as JSON text.
The JSON is parsed once per row by the schema of the paths in use.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlake.functions.casting import now_or
from claimlake.operators.quality import Rule

LOG_SCHEMA = (
    "timestamp timestamp, level string, event_type string, message string, "
    "origin struct<pipeline_id: string, pipeline_name: string, update_id: string, flow_name: string>, details string"
)

# ---- fixed values: event types, states and the JSON paths of the log format ----
RUN_CREATED = "create_update"
RUN_PROGRESS = "update_progress"
FLOW_PROGRESS = "flow_progress"
RUN_END_STATES = ("COMPLETED", "FAILED", "CANCELED")
FLOW_ACTIVE_STATES = ("STARTING", "RUNNING", "COMPLETED")
FLOW_FINAL_STATES = ("COMPLETED", "FAILED", "CANCELLED", "EXCLUDED", "SKIPPED", "STOPPED", "IDLE")
UNNAMED_FLOW = "pipelines.flowTimeMetrics.missingFlowName"
PROBLEM_LEVELS = ("ERROR", "WARN")
RUN_DETAILS = "update_progress struct<state: string>"
FLOW_DETAILS = (
    "flow_progress struct<status: string, metrics: struct<num_output_rows: string>, "
    "data_quality: struct<dropped_records: string, expectations: "
    "array<struct<name: string, dataset: string, passed_records: int, failed_records: int>>>>"
)
# ---- end of fixed values ----


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds, rounded from milliseconds; NULL when either end is missing."""
    return F.round(F.timestamp_diff("MILLISECOND", start, end) / F.lit(1000.0)).cast("bigint")


def update_runs(log: DataFrame, clock: Column | None = None) -> DataFrame:
    """Last status, start, end and duration of every run that was created.

    A run without an end state ends now. The log is read once and added up per run and pipeline, so a run with very many
    events is combined before it moves; the last state is chosen among those few rows.
    """
    rows = log.filter(F.col("event_type").isin(RUN_CREATED, RUN_PROGRESS)).select(
        "timestamp", "event_type", "origin.pipeline_id", "origin.pipeline_name",
        F.col("origin.update_id").alias("pipeline_update_id"),
        F.from_json("details", RUN_DETAILS)["update_progress"]["state"].alias("state"),
    ).filter(F.col("pipeline_update_id").isNotNull())
    progress = F.col("event_type") == RUN_PROGRESS
    ended = progress & F.col("state").isin(*RUN_END_STATES)
    per_pipeline = rows.groupBy("pipeline_id", "pipeline_name", "pipeline_update_id").agg(
        F.min(F.when(F.col("event_type") == RUN_CREATED, F.col("timestamp"))).alias("start_time"),
        F.coalesce(F.max(F.when(ended, F.col("timestamp"))), now_or(clock)).alias("end_time"),
        F.max(F.when(progress, F.struct("timestamp", "pipeline_id", "pipeline_name", "state"))).alias("last"),
    )
    latest = F.max("last").over(Window.partitionBy("pipeline_update_id"))
    known = per_pipeline.withColumn("last", latest).filter((F.col("last.pipeline_id") == F.col("pipeline_id")) & F.col("start_time").isNotNull())
    return known.select(
        "pipeline_id", F.col("last.pipeline_name").alias("pipeline_name"), "pipeline_update_id", "start_time", "end_time",
        seconds_between(F.col("start_time"), F.col("end_time")).alias("duration_seconds"),
        F.col("last.state").alias("pipeline_update_status"),
    )


def _flow_rows(log: DataFrame) -> DataFrame:
    return log.filter(F.col("event_type") == FLOW_PROGRESS).select(
        "timestamp", "origin.*", F.from_json("details", FLOW_DETAILS)["flow_progress"].alias("flow")
    )


def flow_metrics(log: DataFrame, unnamed: str = UNNAMED_FLOW) -> DataFrame:
    """First and last activity, final status, rows written and dropped per run and flow.

    Output rows add up over the events; the dropped count is a running figure, so its maximum counts.
    """
    rows = (
        _flow_rows(log)
        .filter(F.col("flow_name").isNotNull() & (F.col("flow_name") != unnamed))
        .withColumns(
            {
                "status": F.col("flow.status"),
                "output": F.coalesce(F.col("flow.metrics.num_output_rows").try_cast("bigint"), F.lit(0)),
                "dropped": F.coalesce(F.col("flow.data_quality.dropped_records").try_cast("bigint"), F.lit(0)),
            }
        )
    )
    active = F.when(F.col("status").isin(*FLOW_ACTIVE_STATES), F.col("timestamp"))
    final = F.when(F.col("status").isin(*FLOW_FINAL_STATES), F.struct("timestamp", "status"))
    return (
        rows.groupBy("pipeline_name", "pipeline_id", "update_id", F.col("flow_name").alias("table_name"))
        .agg(
            F.min(active).alias("start_timestamp"),
            F.max(active).alias("end_timestamp"),
            F.max(final).getField("status").alias("final_status"),
            F.sum("output").alias("total_output_records"),
            F.max("dropped").alias("total_expectation_dropped_records"),
        )
        .withColumn("duration_seconds", seconds_between(F.col("start_timestamp"), F.col("end_timestamp")))
    )


def expectation_metrics(log: DataFrame) -> DataFrame:
    """Passing and failing records per run, dataset and rule."""
    return (
        _flow_rows(log)
        .select("update_id", F.explode("flow.data_quality.expectations").alias("e"))
        .groupBy("update_id", F.col("e.dataset").alias("dataset"), F.col("e.name").alias("expectation"))
        .agg(F.sum("e.passed_records").alias("passing_records"), F.sum("e.failed_records").alias("failing_records"))
    )


def problem_events(log: DataFrame, levels: Sequence[str] = PROBLEM_LEVELS) -> DataFrame:
    """Errors and warnings with the run and flow they belong to."""
    return log.filter(F.col("level").isin(*levels)).select(
        "timestamp", "level", "event_type", "message",
        "origin.pipeline_name", "origin.update_id", "origin.flow_name",
    )


def run_counters(runs: DataFrame) -> DataFrame:
    failed = F.when(F.col("pipeline_update_status") == "FAILED", F.col("pipeline_update_id"))
    return runs.agg(
        F.count_distinct("pipeline_update_id").alias("update_count"), F.count_distinct(failed).alias("failed_updates")
    )


def failing_total(expectations: DataFrame) -> DataFrame:
    return expectations.agg(F.coalesce(F.sum("failing_records"), F.lit(0)).alias("failing_records"))


def events_by_level(problems: DataFrame) -> DataFrame:
    return problems.groupBy("level").agg(F.count(F.lit(1)).alias("events"))


def duration_by_run(runs: DataFrame) -> DataFrame:
    return runs.groupBy("pipeline_update_id").agg(F.sum("duration_seconds").alias("duration_seconds"))


def output_by_flow(flows: DataFrame) -> DataFrame:
    return flows.groupBy("table_name").agg(F.sum("total_output_records").alias("total_output_records"))


def outcomes_by_expectation(expectations: DataFrame) -> DataFrame:
    return expectations.groupBy("expectation").agg(
        F.sum("failing_records").alias("failing_records"), F.sum("passing_records").alias("passing_records")
    )


def expectation_entries(dataset: str, rules: Sequence[Rule], observed: Mapping[str, int]) -> list[dict]:
    """Log entries from the counters an observation of the rules collected."""
    return [
        {
            "name": rule.name,
            "dataset": dataset,
            "passed_records": int(observed[f"{rule.name}__passed"]),
            "failed_records": int(observed[f"{rule.name}__failed"]),
        }
        for rule in rules
    ]


class RunLog:
    """Appends the events of one run to a log folder; a handful of rows per flow."""

    def __init__(self, spark: SparkSession, path: str, pipeline_id: str, pipeline_name: str) -> None:
        self.spark, self.path = spark, path
        self.pipeline_id, self.pipeline_name = pipeline_id, pipeline_name
        self.update_id = uuid.uuid4().hex
        self._rows: list[tuple] = []
        self._add("INFO", RUN_CREATED, "run created")

    def _add(self, level: str, event_type: str, message: str, flow: str | None = None, details: dict | None = None) -> None:
        origin = (self.pipeline_id, self.pipeline_name, self.update_id, flow)
        now = dt.datetime.now(dt.timezone.utc)
        self._rows.append((now, level, event_type, message, origin, json.dumps(details or {})))

    def flow(
        self,
        name: str,
        status: str,
        *,
        rows: int | None = None,
        dropped: int | None = None,
        expectations: Sequence[dict] = (),
    ) -> None:
        """Progress of one flow with its metrics."""
        progress: dict = {"status": status}
        if rows is not None:
            progress["metrics"] = {"num_output_rows": rows}
        if dropped is not None or expectations:
            progress["data_quality"] = {"dropped_records": dropped or 0, "expectations": list(expectations)}
        self._add("INFO", FLOW_PROGRESS, f"{name} is {status}", name, {FLOW_PROGRESS: progress})

    def problem(self, level: str, message: str, flow: str | None = None) -> None:
        self._add(level, FLOW_PROGRESS if flow else RUN_PROGRESS, message, flow)

    def finish(self, state: str) -> None:
        """Record the end state and write the run's rows."""
        self._add("INFO", RUN_PROGRESS, f"run is {state}", details={RUN_PROGRESS: {"state": state}})
        rows = self.spark.createDataFrame(self._rows, LOG_SCHEMA).coalesce(1)
        rows.write.mode("append").parquet(self.path)
        self._rows = []


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)
