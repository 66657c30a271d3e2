"""Run-log analytics over the driver's events read as a run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlake.operators import eventlog as e
from claimlake.workload.registry import query
from claimlake.workload.tables import read

NOW = "2024-02-01 00:00:00"


def run_log(spark, folder):
    """Users are runs; sign-ups create them, views report their state, all other events report flows."""
    events = read(spark, folder, "events")
    key, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("int")

    def choose(index, *values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int") + 1)

    def expectation(name, dataset, passed, failed):
        return F.struct(
            F.lit(name).alias("name"), F.lit(dataset).alias("dataset"), passed.alias("passed_records"), failed.alias("failed_records")
        )

    kind = F.when(F.col("event_type") == "signup", e.RUN_CREATED).when(F.col("event_type") == "view", e.RUN_PROGRESS).otherwise(e.FLOW_PROGRESS)
    metrics = F.when(key % 3 != 0, F.struct(k.alias("num_output_rows")))
    quality = F.when(
        key % 4 != 0,
        F.struct(
            (key % 5).alias("dropped_records"),
            F.array(
                expectation("claim_id_not_null", "claims_bordereau", k, key % 7),
                expectation("postcode_not_null", "risk_zone_lookup", key % 11, key % 2),
            ).alias("expectations"),
        ),
    )
    flow = F.struct(
        choose(key, "STARTING", "RUNNING", "COMPLETED", "FAILED", "SKIPPED", "QUEUED").alias("status"),
        metrics.alias("metrics"),
        quality.alias("data_quality"),
    )
    details = F.when(
        kind == e.RUN_PROGRESS,
        F.to_json(F.struct(F.struct(choose(k, "RUNNING", "COMPLETED", "FAILED", "CANCELED").alias("state")).alias("update_progress"))),
    ).when(kind == e.FLOW_PROGRESS, F.to_json(F.struct(flow.alias("flow_progress"))))
    user = F.col("user_id")
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(F.col("event_type") == "error", "ERROR").when(F.col("value") < 2, "WARN").otherwise("INFO").alias("level"),
        kind.alias("event_type"),
        F.concat_ws(" ", "event_type", "event_id").alias("message"),
        F.struct(
            F.concat(F.lit("pipe-"), user % 5).alias("pipeline_id"),
            F.concat(F.lit("claims-"), user % 5).alias("pipeline_name"),
            F.when(key % 211 != 0, F.concat(F.lit("run-"), user)).alias("update_id"),
            F.when(key % 8 == 6, e.UNNAMED_FLOW).when(key % 8 != 7, F.concat(F.lit("flow-"), key % 8)).alias("flow_name"),
        ).alias("origin"),
        details.alias("details"),
    )


LOG = f"""log AS (
  SELECT ts, event_id AS id, 'pipe-' || user_id % 5 AS pipeline_id, 'claims-' || user_id % 5 AS pipeline_name,
    CASE WHEN event_id % 211 <> 0 THEN 'run-' || user_id END AS update_id,
    CASE WHEN event_id % 8 = 6 THEN '{e.UNNAMED_FLOW}' WHEN event_id % 8 <> 7 THEN 'flow-' || event_id % 8 END AS flow_name,
    CASE event_type WHEN 'signup' THEN 'create_update' WHEN 'view' THEN 'update_progress' ELSE 'flow_progress' END AS kind,
    CASE WHEN event_type = 'error' THEN 'ERROR' WHEN value < 2 THEN 'WARN' ELSE 'INFO' END AS level,
    event_type || ' ' || event_id AS message, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
)"""
RUNS = f"""states AS (SELECT *, list_extract(['RUNNING', 'COMPLETED', 'FAILED', 'CANCELED'], k % 4 + 1) AS state FROM log),
last_state AS (SELECT * FROM states WHERE kind = 'update_progress' AND update_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY update_id ORDER BY ts DESC, pipeline_id DESC, state DESC) = 1),
spans AS (SELECT pipeline_id, update_id, min(ts) FILTER (kind = 'create_update') AS start_time,
  coalesce(max(ts) FILTER (kind = 'update_progress' AND state <> 'RUNNING'), TIMESTAMP '{NOW}') AS end_time
  FROM states WHERE kind <> 'flow_progress' AND update_id IS NOT NULL GROUP BY ALL HAVING start_time IS NOT NULL),
runs AS (SELECT l.pipeline_id, l.pipeline_name, l.update_id AS pipeline_update_id, start_time, end_time,
  CAST(round(trunc(epoch_us(end_time) / 1000.0 - epoch_us(start_time) / 1000.0) / 1000.0) AS BIGINT) AS duration_seconds,
  state AS pipeline_update_status
  FROM last_state l JOIN spans s ON l.pipeline_id = s.pipeline_id AND l.update_id = s.update_id)"""
FLOWS = """flow_rows AS (SELECT *, list_extract(['STARTING', 'RUNNING', 'COMPLETED', 'FAILED', 'SKIPPED', 'QUEUED'], CAST(id % 6 + 1 AS INTEGER)) AS status,
  CASE WHEN id % 3 <> 0 THEN k ELSE 0 END AS output, CASE WHEN id % 4 <> 0 THEN id % 5 ELSE 0 END AS dropped
  FROM log WHERE kind = 'flow_progress'),
flows AS (SELECT pipeline_name, pipeline_id, update_id, flow_name AS table_name,
  min(ts) FILTER (status IN ('STARTING', 'RUNNING', 'COMPLETED')) AS start_timestamp,
  max(ts) FILTER (status IN ('STARTING', 'RUNNING', 'COMPLETED')) AS end_timestamp,
  arg_max(status, ts) FILTER (status IN ('COMPLETED', 'FAILED', 'SKIPPED')) AS final_status,
  CAST(sum(output) AS BIGINT) AS total_output_records, max(dropped) AS total_expectation_dropped_records
  FROM flow_rows WHERE flow_name LIKE 'flow-%' GROUP BY ALL)"""
EXPECTATIONS = """checks AS (
  SELECT update_id, 'claims_bordereau' AS dataset, 'claim_id_not_null' AS expectation, k AS passed, id % 7 AS failed FROM log WHERE kind = 'flow_progress' AND id % 4 <> 0
  UNION ALL SELECT update_id, 'risk_zone_lookup', 'postcode_not_null', id % 11, id % 2 FROM log WHERE kind = 'flow_progress' AND id % 4 <> 0),
expectations AS (SELECT update_id, dataset, expectation, CAST(sum(passed) AS BIGINT) AS passing_records,
  CAST(sum(failed) AS BIGINT) AS failing_records FROM checks GROUP BY ALL)"""
RUN_COLUMNS = """pipeline_id, pipeline_name, pipeline_update_id, start_time, end_time,
  duration_seconds, pipeline_update_status"""


def log_sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([LOG, *ctes]) + "\n" + body


def runs(spark, folder):
    return e.update_runs(run_log(spark, folder), F.lit(NOW).cast("timestamp"))


@query("log_update_runs", log_sql(f"SELECT {RUN_COLUMNS} FROM runs", RUNS), instants="timestamp_ntz")
def _(spark, folder):
    return runs(spark, folder)


@query(
    "log_flow_metrics",
    log_sql(
        """SELECT pipeline_name, pipeline_id, update_id, table_name, start_timestamp, end_timestamp, final_status, total_output_records, total_expectation_dropped_records,
        CAST(round(trunc(epoch_us(end_timestamp) / 1000.0 - epoch_us(start_timestamp) / 1000.0) / 1000.0) AS BIGINT) AS duration_seconds FROM flows""",
        FLOWS,
    ),
    instants="timestamp_ntz",
)
def _(spark, folder):
    return e.flow_metrics(run_log(spark, folder))


@query("log_expectation_metrics", log_sql("SELECT * FROM expectations", EXPECTATIONS))
def _(spark, folder):
    return e.expectation_metrics(run_log(spark, folder))


@query(
    "log_problem_events",
    log_sql(
        """SELECT ts AS timestamp, level, kind AS event_type, message, pipeline_name, update_id, flow_name
        FROM log WHERE level IN ('ERROR', 'WARN')"""
    ),
    instants="timestamp_ntz",
)
def _(spark, folder):
    return e.problem_events(run_log(spark, folder))


@query(
    "log_run_counters",
    log_sql(
        """SELECT count(DISTINCT pipeline_update_id) AS update_count,
        count(DISTINCT pipeline_update_id) FILTER (pipeline_update_status = 'FAILED') AS failed_updates FROM runs""",
        RUNS,
    ),
)
def _(spark, folder):
    return e.run_counters(runs(spark, folder))


@query("log_failing_total", log_sql("SELECT CAST(coalesce(sum(failing_records), 0) AS BIGINT) AS failing_records FROM expectations", EXPECTATIONS))
def _(spark, folder):
    return e.failing_total(e.expectation_metrics(run_log(spark, folder)))


@query("log_events_by_level", log_sql("SELECT level, count(*) AS events FROM log WHERE level IN ('ERROR', 'WARN') GROUP BY level"))
def _(spark, folder):
    return e.events_by_level(e.problem_events(run_log(spark, folder)))


@query(
    "log_duration_by_run",
    log_sql("SELECT pipeline_update_id, CAST(sum(duration_seconds) AS BIGINT) AS duration_seconds FROM runs GROUP BY 1", RUNS),
)
def _(spark, folder):
    return e.duration_by_run(runs(spark, folder))


@query(
    "log_output_by_flow",
    log_sql("SELECT table_name, CAST(sum(total_output_records) AS BIGINT) AS total_output_records FROM flows GROUP BY 1", FLOWS),
)
def _(spark, folder):
    return e.output_by_flow(e.flow_metrics(run_log(spark, folder)))


@query(
    "log_outcomes_by_expectation",
    log_sql(
        """SELECT expectation, CAST(sum(failing_records) AS BIGINT) AS failing_records,
        CAST(sum(passing_records) AS BIGINT) AS passing_records FROM expectations GROUP BY 1""",
        EXPECTATIONS,
    ),
)
def _(spark, folder):
    return e.outcomes_by_expectation(e.expectation_metrics(run_log(spark, folder)))
