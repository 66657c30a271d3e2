"""Whole runs over the driver's tables: medallion, streams, upserts and ingests.

Each writes into a fresh path below the shared folder and returns what it wrote.
"""

from __future__ import annotations

import datetime
import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.operators import eventlog, monitor, quality, rulesets
from claimlake.operators.projection import typed_claims, typed_premiums
from claimlake.plans.flows import FlowRunner, FlowSpec
from claimlake.plans.graph import FlowGraph, GraphRunner, read_specs
from claimlake.plans.medallion import TableFolders, run_batch
from claimlake.plans.streamed import StreamedTables, run_streamed
from claimlake.schemas import CLAIMS, PREMIUMS
from claimlake.session import work_path
from claimlake.sinks import clustered
from claimlake.sinks.merge_table import MergeTable
from claimlake.sinks.upsert import Upsert
from claimlake.sources.paths import children, remove
from claimlake.sources.rescue import apply_hints
from claimlake.sources.tables import stream_folder
from claimlake.streaming import current, evolving, inferring, logged, runs
from claimlake.workload import mart_queries as m
from claimlake.workload import report_queries as rq
from claimlake.workload import tables as t
from claimlake.workload.oracle import money, with_raw, with_silver
from claimlake.workload.registry import query


def _bronze_rules_sql(name: str, hard: str, every: str, source: str) -> str:
    """Kept and quarantined counts of one bronze table."""
    return f"""SELECT 'bronze' AS layer, 'bronze_{name}' AS table_name, count(*) AS row_count, max(ingested) AS latest_ingest_ts
      FROM {source} WHERE {hard}
    UNION ALL SELECT 'bronze', 'bronze_{name}_quarantine', count(*), NULL FROM {source} WHERE NOT ({every})"""


BRONZE_KEPT = {
    "claims": "claim_id IS NOT NULL AND policy_id IS NOT NULL AND trim(policy_id) <> ''",
    "zones": "postcode IS NOT NULL",
    "events": "event_id IS NOT NULL",
}
# The same silver rules, over bronze rows that passed their own.
LAYERS = f"""
kept_claims AS (SELECT * FROM silver_claims WHERE {BRONZE_KEPT['claims']}),
kept_current AS (SELECT * FROM kept_claims
  QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY snapshot_date DESC, policy_id DESC, event_id DESC NULLS LAST,
    date_of_loss DESC, reported_date DESC, peril_type DESC, claim_status DESC, incurred DESC, paid DESC,
    source_file_name DESC, ingested DESC) = 1)"""
CATEGORY = "CASE WHEN c.event_id IS NOT NULL THEN 'Catastrophe' ELSE 'Non-Catastrophe' END"
GOLD_GROUPS = {
    "claims_summary": """SELECT DISTINCT peril_type, claim_status, region_name, wind_risk_band, building_type
      FROM kept_current c LEFT JOIN silver_premiums p ON c.policy_id = p.policy_id""",
    "loss_ratio_by_risk": f"SELECT DISTINCT {m.RISK} FROM silver_premiums",
    "policy_loss_ratio": f"SELECT DISTINCT {m.RISK} FROM silver_premiums",
    "event_loss_summary": f"""SELECT DISTINCT {CATEGORY}, e.event_name, e.start_date, e.end_date, region_name, peril_type
      FROM kept_current c LEFT JOIN silver_events e ON c.event_id = e.event_id LEFT JOIN silver_premiums p ON c.policy_id = p.policy_id""",
    "portfolio_exposure": f"SELECT DISTINCT {m.RISK.replace('region_name', 'p.region_name').replace('wind_risk_band', 'p.wind_risk_band')} FROM silver_premiums p JOIN silver_zones z ON p.postcode = z.postcode",
    "claims_development": """SELECT DISTINCT peril_type, region_name, wind_risk_band, date_trunc('month', date_of_loss), date_trunc('month', reported_date)
      FROM kept_claims c LEFT JOIN silver_premiums p ON c.policy_id = p.policy_id""",
    "risk_band_performance": "SELECT DISTINCT wind_risk_band, region_name FROM silver_premiums",
}
SILVER_SOURCES = {
    "claims_bordereau": "kept_claims", "premium_bordereau": "silver_premiums", "cyclone_events": "silver_events",
    "risk_zone_lookup": "silver_zones", "claims_current": "kept_current",
}
INVENTORY = " UNION ALL ".join(
    [
        _bronze_rules_sql(
            "claims_bordereau", BRONZE_KEPT["claims"],
            BRONZE_KEPT["claims"] + " AND peril_type IS NOT NULL AND claim_status IS NOT NULL", "raw_claims",
        ),
        _bronze_rules_sql("premium_bordereau", "TRUE", "TRUE", "raw_premiums"),
        _bronze_rules_sql(
            "risk_zone_lookup", BRONZE_KEPT["zones"], BRONZE_KEPT["zones"] + " AND region_name IS NOT NULL", "raw_zones"
        ),
        _bronze_rules_sql("cyclone_events", BRONZE_KEPT["events"], BRONZE_KEPT["events"], "raw_events"),
        *[
            f"SELECT 'silver', 'silver_{name}', count(*), max(ingested) FROM {source}" for name, source in SILVER_SOURCES.items()
        ],
        *[f"SELECT 'gold', 'gold_{name}', count(*), NULL FROM ({groups})" for name, groups in GOLD_GROUPS.items()],
        *[
            f"SELECT 'gold', 'gold_{name}_quarantine', 0, NULL" for name in GOLD_GROUPS if name in rulesets.GOLD
        ],
    ]
)


def _medallion(spark, folder) -> tuple[TableFolders, DataFrame]:
    folders = TableFolders(spark, work_path(spark, "medallion"))
    bronze = {name: build(spark, folder) for name, build in t.RAW.items()}
    return folders, run_batch(bronze, folders, clock=F.lit("2025-01-01").cast("timestamp"))


@query("medallion_inventory", with_silver(f"SELECT * FROM ({INVENTORY})", LAYERS))
def _(spark, folder):
    return _medallion(spark, folder)[1]


def _streamed_medallion(spark, folder) -> tuple[StreamedTables, DataFrame]:
    """Bordereaux that land in two parts, files up to 1995 and later ones, with a run after each; the second is a new process."""
    root = work_path(spark, "medallion-streamed")
    for earlier in (True, False):
        streams = {}
        for name, build in t.RAW.items():
            rows, landing = build(spark, folder), f"{root}/landing/{name}"
            part = F.col("source_file_name") < "claims-1996" if name == "claims" else F.col("source_file_name").endswith("-0.csv")
            rows.where(part if earlier else ~part).write.mode("append").parquet(landing)
            streams[name] = stream_folder(spark, landing, rows.schema)
        tables = StreamedTables(spark, f"{root}/tables", buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
        found = run_streamed(streams, tables, clock=F.lit("2025-01-01").cast("timestamp"))
    return tables, found


@query("medallion_streamed", with_silver(f"SELECT * FROM ({INVENTORY})", LAYERS))
def _(spark, folder):
    """The inventory after two runs over what had landed: that of one batch run over all rows."""
    return _streamed_medallion(spark, folder)[1]


@query(
    "medallion_streamed_marts",
    with_silver(
        f"""SELECT 'claims_summary' AS mart, peril_type, claim_status, region_name, wind_risk_band, building_type, count(c.claim_id) AS claim_count,
          {money('sum(incurred)')} AS total_incurred, {money('sum(paid)')} AS total_paid
        FROM kept_current c LEFT JOIN silver_premiums p ON c.policy_id = p.policy_id GROUP BY ALL
        UNION ALL SELECT 'claims_development', peril_type, NULL, region_name, wind_risk_band, NULL, count(c.claim_id),
          {money('sum(incurred)')}, {money('sum(paid)')}
        FROM kept_claims c LEFT JOIN silver_premiums p ON c.policy_id = p.policy_id GROUP BY ALL""",
        LAYERS,
    ),
)
def _(spark, folder):
    """Two marts of the streamed medallion, over current claims and over all snapshots."""
    tables = _streamed_medallion(spark, folder)[0]
    sums = [F.sum(c).alias(c) for c in ("claim_count", "total_incurred", "total_paid")]
    summary = tables.read("gold_claims_summary").groupBy("peril_type", "claim_status", "region_name", "wind_risk_band", "building_type").agg(*sums)
    by_month = tables.read("gold_claims_development").groupBy("peril_type", "region_name", "wind_risk_band").agg(*sums)
    by_month = by_month.withColumns({"claim_status": F.lit(None).cast("string"), "building_type": F.lit(None).cast("string")})
    return summary.select(F.lit("claims_summary").alias("mart"), "*").unionByName(by_month.select(F.lit("claims_development").alias("mart"), "*"))


RAW_TABLES = {
    "claims_bordereau": "raw_claims", "premium_bordereau": "raw_premiums", "risk_zone_lookup": "raw_zones", "cyclone_events": "raw_events",
}


def _listed(spark, folder) -> list[monitor.Listed]:
    """The four raw tables as they come, without writing them."""
    builders = {"claims_bordereau": t.raw_claims, "premium_bordereau": t.raw_premiums, "risk_zone_lookup": t.raw_zones, "cyclone_events": t.raw_events}
    return [
        monitor.Listed("bronze", name, build(spark, folder), "ingestion_timestamp", "source_file_name")
        for name, build in builders.items()
    ] + [monitor.Listed("silver", "claims_current", t.current_claims(spark, folder))]


COUNTS = " UNION ALL ".join(
    [
        f"SELECT 'bronze' AS layer, '{name}' AS table_name, count(*) AS row_count, count(DISTINCT source_file_name) AS source_file_count FROM {raw}"
        for name, raw in RAW_TABLES.items()
    ]
    + ["SELECT 'silver', 'claims_current', count(*), NULL FROM current_claims"]
)


@query("monitor_medallion_counts", with_silver(COUNTS))
def _(spark, folder):
    return monitor.medallion_counts(_listed(spark, folder))


@query(
    "monitor_counters",
    with_silver(
        f"""SELECT CAST(sum(row_count) FILTER (table_name = 'claims_bordereau') AS BIGINT) AS bronze_claims_rows,
        CAST(sum(row_count) FILTER (table_name = 'claims_current') AS BIGINT) AS silver_current_rows,
        CAST(sum(row_count) FILTER (layer = 'bronze') AS BIGINT) AS bronze_rows,
        CAST(sum(row_count) FILTER (layer = 'silver') AS BIGINT) AS silver_rows, CAST(0 AS BIGINT) AS gold_populated FROM ({COUNTS})"""
    ),
)
def _(spark, folder):
    return monitor.monitoring_counters(monitor.medallion_counts(_listed(spark, folder)), "claims_bordereau", "claims_current")


@query("monitor_rows_by_table", with_silver(f"SELECT table_name, CAST(sum(row_count) AS BIGINT) AS rows FROM ({COUNTS}) GROUP BY 1"))
def _(spark, folder):
    return monitor.rows_by(monitor.inventory(_listed(spark, folder)), "table_name")


AGES = " UNION ALL ".join(
    f"SELECT 'bronze' AS layer, '{name}' AS table_name, count(*) AS row_count, max(ingested) AS latest_ingest_ts FROM {raw}"
    for name, raw in RAW_TABLES.items()
)
AGED = f"SELECT *, (DATE '2030-01-01' - latest_ingest_ts) * 24.0 AS ingest_age_hours FROM ({AGES})"


@query("monitor_ingest_age", with_raw(f"SELECT * REPLACE (CAST(ingest_age_hours AS DOUBLE) AS ingest_age_hours) FROM ({AGED})"))
def _(spark, folder):
    return _aged(spark, folder)


def _aged(spark, folder):
    counted = monitor.inventory([x for x in _listed(spark, folder) if x.layer == "bronze"])
    return monitor.with_ingest_age(counted, F.lit("2030-01-01").cast("timestamp"))


@query("monitor_freshness", with_raw(f"SELECT table_name, CAST(max(ingest_age_hours) AS DOUBLE) AS ingest_age_hours FROM ({AGED}) GROUP BY 1"))
def _(spark, folder):
    return monitor.oldest_by_table(_aged(spark, folder))


QUARANTINES = f"""quarantines AS (
  SELECT 'claims' AS stream, concat_ws(',', CASE WHEN rescued IS NOT NULL THEN 'rescued_data' END, CASE WHEN claim_id IS NULL THEN 'claim_id_null' END)
    AS quarantine_reason FROM (SELECT *, {rq.RESCUED_SQL} AS rescued FROM raw_claims) WHERE rescued IS NOT NULL OR claim_id IS NULL
  UNION ALL SELECT 'premiums', 'rescued_data' FROM raw_premiums WHERE postcode IS NULL
  UNION ALL SELECT 'risk_zones', 'postcode_null' FROM raw_zones WHERE postcode IS NULL)"""


def _quarantines(spark, folder) -> dict[str, DataFrame]:
    """Hard-typed raw tables with their misfits rescued; policies whose postcode is no number, and so on."""
    from claimlake.schemas import ENTITIES

    return {
        name: quality.quarantine_from_raw(
            apply_hints(t.derived_once(t.RAW[name](spark, folder)), ENTITIES[name].hints),
            ENTITIES[name].key,
            clock=F.lit("2025-01-01").cast("timestamp"),
        )
        for name in ("claims", "premiums", "risk_zones")
    }


@query(
    "monitor_quarantine_summary",
    with_raw(
        "SELECT stream, quarantine_reason, count(*) AS row_count, DATE '2025-01-01' AS latest_quarantine_ts FROM quarantines GROUP BY ALL",
        QUARANTINES,
    ),
)
def _(spark, folder):
    return monitor.quarantine_summary(_quarantines(spark, folder))


@query("monitor_quarantine_total", with_raw("SELECT count(*) AS total_quarantine FROM quarantines", QUARANTINES))
def _(spark, folder):
    return monitor.quarantine_total(monitor.quarantine_summary(_quarantines(spark, folder)))


for _key in ("stream", "quarantine_reason"):
    query(
        f"monitor_quarantine_by_{_key}", with_raw(f"SELECT {_key}, count(*) AS rows FROM quarantines GROUP BY 1", QUARANTINES)
    )(lambda spark, folder, key=_key: monitor.rows_by(monitor.quarantine_summary(_quarantines(spark, folder)), key))


# ---- streams over the given tables ----


def streamed_claims(spark, folder) -> DataFrame:
    """The order lines as a stream, joined to the orders table: raw claims as they arrive."""
    lines = stream_folder(spark, folder, t.read(spark, folder, "lineitem").schema, pattern="lineitem.parquet")
    orders = t.read(spark, folder, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(*t.CLAIM_TEXT)


@query(
    "stream_claims_upsert",
    with_raw(
        f"""SELECT {m.CLAIM_COLUMNS} FROM raw_claims WHERE claim_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY claim_id, snapshot_date ORDER BY ingested DESC, policy_id DESC NULLS LAST,
          event_id DESC NULLS LAST, date_of_loss DESC NULLS LAST, reported_date DESC, peril_type DESC NULLS LAST, claim_status DESC,
          incurred DESC NULLS LAST, paid DESC) = 1
        UNION ALL SELECT {m.CLAIM_COLUMNS} FROM raw_claims WHERE claim_id IS NULL"""
    ),
)
def _(spark, folder):
    """Typed snapshots merged by claim and date, the later ingest wins; rows without a key, which go to quarantine."""
    root = work_path(spark, "stream-upsert")
    order = "bronze_ingestion_timestamp"
    spec = Upsert(("claim_id", "snapshot_date"), order, month_of="snapshot_date", except_columns=(order,))
    stream = typed_claims(t.derived_once(streamed_claims(spark, folder))).drop("source_file_name")
    table = MergeTable(spark, f"{root}/claims", spec)
    keyed = runs.merge_stream(stream.filter("claim_id IS NOT NULL"), table, f"{root}/checkpoint")
    unkeyed = runs.append_to_folder(stream.filter("claim_id IS NULL"), f"{root}/quarantine", f"{root}/quarantine-checkpoint")
    runs.finish(keyed)
    runs.finish(unkeyed)
    return table.read().unionByName(spark.read.parquet(f"{root}/quarantine").drop(order))


def _claim_changes(spark, folder) -> DataFrame:
    """Claim snapshots with the columns an update may leave empty, ordered by snapshot date within a claim."""
    return typed_claims(t.raw_claims(spark, folder)).filter("claim_id IS NOT NULL").select(
        "claim_id", "policy_id", "event_id", "peril_type", "incurred_amount", F.struct("snapshot_date", "reported_date").alias("at")
    )


NEWEST = ", ".join(
    f"arg_max({c}, (snapshot_date, reported_date, {c})) FILTER ({c} IS NOT NULL) AS {c}" for c in ("policy_id", "event_id", "peril_type")
)


@query(
    "upsert_ignore_nulls",
    with_raw(
        f"""SELECT claim_id, {NEWEST}, arg_max(incurred, (snapshot_date, reported_date, incurred)) FILTER (incurred IS NOT NULL) / 100.0 AS incurred_amount
        FROM (SELECT * REPLACE (split_part(claim_id, '-', 1) AS claim_id) FROM raw_claims WHERE claim_id IS NOT NULL) GROUP BY claim_id"""
    ),
)
def _(spark, folder):
    """Orders as claims: each column keeps its latest value that is not NULL, over batches that come newest first."""
    root = work_path(spark, "upsert-nulls")
    spec = Upsert(("claim_id",), "at", buckets=8, ignore_null_updates=True, except_columns=("at",))
    table = MergeTable(spark, f"{root}/claims", spec)
    changes = _claim_changes(spark, folder).withColumn("claim_id", F.split("claim_id", "-")[0])
    for number, part in enumerate(("month(at.snapshot_date) > 6", "NOT coalesce(month(at.snapshot_date) > 6, FALSE)")):
        table.upsert(changes.filter(part), number, "halves")
    return table.read()


@query(
    "upsert_two_streams",
    with_raw("SELECT claim_id, count(*) AS snapshots FROM (SELECT DISTINCT claim_id, snapshot_date FROM raw_claims WHERE claim_id IS NOT NULL) GROUP BY 1"),
)
def _(spark, folder):
    """Two streams, each with its own checkpoint and so with the same batch numbers, into one type-1 table.

    Both read what a first stream has landed, so the claims are derived once.
    """
    root = work_path(spark, "upsert-two")
    spec = Upsert(("claim_id", "snapshot_date"), "bronze_ingestion_timestamp", month_of="snapshot_date")
    table = MergeTable(spark, f"{root}/claims", spec)
    stream = typed_claims(t.derived_once(streamed_claims(spark, folder))).drop("source_file_name").filter("claim_id IS NOT NULL")
    runs.finish(runs.append_to_folder(stream, f"{root}/landing", f"{root}/landing-checkpoint"))
    landed = stream_folder(spark, f"{root}/landing", stream.schema)
    for name, part in (("odd", "crc32(encode(claim_id, 'UTF-8')) % 2 = 1"), ("even", "crc32(encode(claim_id, 'UTF-8')) % 2 = 0")):
        runs.finish(runs.merge_stream(landed.filter(part), table, f"{root}/{name}"))
    return table.read().groupBy("claim_id").agg(F.count(F.lit(1)).alias("snapshots"))


# Order lines as changes of one claim per order, in three batches that do not follow the sequence; a claim of unknown status is
# withdrawn until a later snapshot brings it back.


def _batched_changes(spark, folder, root) -> DataFrame:
    """The changes as they landed, a folder a batch, so that no batch derives the rows of the others."""
    at = F.struct("snapshot_date", "reported_date", "line")
    lines = typed_claims(t.derived_once(t.raw_claims(spark, folder))).filter("claim_id IS NOT NULL")
    lines = lines.withColumns({"line": F.split("claim_id", "-")[1].cast("int"), "claim_id": F.split("claim_id", "-")[0]})
    changes = lines.select("claim_id", "policy_id", "claim_status", "incurred_amount", at.alias("at"), (F.col("line") % 3).alias("batch"))
    changes.write.partitionBy("batch").parquet(f"{root}/batches")
    return spark.read.schema(changes.schema).parquet(f"{root}/batches")


DIFF = """
log AS (SELECT split_part(claim_id, '-', 1) AS claim_id, policy_id, claim_status, incurred, CAST(split_part(claim_id, '-', 2) AS INTEGER) AS line,
  snapshot_date, reported_date FROM raw_claims WHERE claim_id IS NOT NULL),
states AS (
  SELECT v.version, l.* FROM log l, (VALUES (1), (2), (3)) v(version) WHERE l.line % 3 < v.version
  QUALIFY row_number() OVER (PARTITION BY version, claim_id ORDER BY snapshot_date DESC NULLS LAST, reported_date DESC NULLS LAST, line DESC,
    policy_id DESC NULLS LAST, claim_status DESC, incurred DESC NULLS LAST) = 1),
alive AS (SELECT * FROM states WHERE claim_status <> 'Unknown'),
pairs AS (
  SELECT coalesce(o.version + 1, n.version) AS version, coalesce(o.claim_id, n.claim_id) AS claim_id, o, n
  FROM alive o FULL JOIN alive n ON o.claim_id = n.claim_id AND n.version = o.version + 1),
diff AS (
  SELECT version, claim_id, unnest(CASE
    WHEN o.claim_id IS NULL THEN [{'kind': 'insert', 'row': n}] WHEN n.claim_id IS NULL THEN [{'kind': 'delete', 'row': o}]
    WHEN (o.policy_id, o.claim_status, o.incurred) IS DISTINCT FROM (n.policy_id, n.claim_status, n.incurred)
      THEN [{'kind': 'update_preimage', 'row': o}, {'kind': 'update_postimage', 'row': n}] END) AS change
  FROM pairs WHERE version <= 3)"""


@query(
    "stream_change_feed_updates",
    with_raw(
        """SELECT CAST(version AS BIGINT) AS _commit_version, change.kind AS _change_type, claim_id, change.row.policy_id AS policy_id,
        change.row.claim_status AS claim_status, change.row.incurred / 100.0 AS incurred_amount FROM diff""",
        DIFF,
    ),
)
def _(spark, folder):
    """The change feed of a rewritten table, followed by a stream in two runs: inserts, updates before and after, deletes."""
    root = work_path(spark, "change-feed")
    table = MergeTable(spark, f"{root}/claims", CHANGED_CLAIMS)
    batches = _batched_changes(spark, folder, root)
    take = lambda changes, stream, version: changes.write.mode("overwrite").parquet(f"{root}/feed/upto={stream}-{version:012d}")
    for number in range(3):
        table.upsert(batches.filter(F.col("batch") == number).drop("batch"), number, "lines")
        if number != 1:  # the second run finds two versions
            runs.finish(runs.change_stream(table, f"{root}/checkpoint", take))
    return spark.read.parquet(f"{root}/feed").drop("upto")


CHANGED_CLAIMS = Upsert(("claim_id",), "at", buckets=8, except_columns=("at",), deleted="claim_status = 'Unknown'")


@query(
    "merge_table_versions",
    with_raw(
        """SELECT CAST(version AS BIGINT) AS version, claim_status, count(*) AS claims, sum(incurred) / 100.0 AS incurred_amount
        FROM (SELECT version, claim_status, incurred FROM alive WHERE version < 3
          UNION ALL SELECT unnest([3, 4]), claim_status, incurred FROM alive WHERE version = 3)
        GROUP BY 1, 2""",
        DIFF,
    ),
)
def _(spark, folder):
    """Every version of a merge table as it was read: three batches, each one delta, and a compaction that changes no row."""
    root = work_path(spark, "merge-versions")
    table = MergeTable(spark, f"{root}/claims", CHANGED_CLAIMS)
    batches = _batched_changes(spark, folder, root)
    for number in range(3):
        table.upsert(batches.filter(F.col("batch") == number).drop("batch"), number, "lines")
    table.compact()
    read = [table.read(v).withColumn("version", F.lit(v).cast("bigint")) for v in table.versions()]
    every = reduce(DataFrame.unionByName, read)
    return every.groupBy("version", "claim_status").agg(F.count(F.lit(1)).alias("claims"), F.sum("incurred_amount").alias("incurred_amount"))


def _order_claims(spark, folder, root) -> DataFrame:
    """Order lines as rows of one claim per order, as they arrive in files, the odd lines first."""
    batches = _batched_changes(spark, folder, root).withColumns({"snapshot_date": F.col("at.snapshot_date"), "line": F.col("at.line")}).drop("at")
    files = t.landed_files(spark, folder, 3)
    for number in (1, 0, 2):
        batches.filter(F.col("batch") == number).drop("batch").repartition(files).write.mode("append").parquet(f"{root}/landing")
        yield stream_folder(spark, f"{root}/landing", batches.drop("batch").schema, files_per_batch=-(-files * 2 // 3))


LATEST_OF_ORDER = """
log AS (SELECT split_part(claim_id, '-', 1) AS claim_id, policy_id, claim_status, incurred, CAST(split_part(claim_id, '-', 2) AS INTEGER) AS line,
  snapshot_date FROM raw_claims WHERE claim_id IS NOT NULL),
latest AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY snapshot_date DESC NULLS LAST, line DESC,
  policy_id DESC NULLS LAST, claim_status DESC, incurred DESC NULLS LAST) = 1)"""


@query(
    "current_claims_stateful",
    with_raw("SELECT claim_id, policy_id, claim_status, incurred / 100.0 AS incurred_amount, snapshot_date, line FROM latest", LATEST_OF_ORDER),
)
def _(spark, folder):
    """The latest row of every claim from keyed state, over three starts of the stream that go on from one checkpoint."""
    root = work_path(spark, "stateful")
    table = MergeTable(spark, f"{root}/claims", Upsert(("claim_id",), "at", buckets=8, except_columns=("at",)))
    for stream in _order_claims(spark, folder, root):
        rows = stream.withColumn("at", F.struct("snapshot_date", "line"))
        runs.finish(current.keep_latest(rows, table, ["at"], f"{root}/checkpoint"))
    return table.read()


@query(
    "stream_clean_and_quarantine",
    with_raw(
        f"""SELECT 'clean' AS flow, '' AS reason, count(*) AS rows FROM raw_claims WHERE claim_id IS NOT NULL
        UNION ALL SELECT 'quarantine', concat_ws(',', CASE WHEN rescued IS NOT NULL THEN 'rescued_data' END,
          CASE WHEN claim_id IS NULL THEN 'claim_id_null' END), count(*)
        FROM (SELECT *, {rq.RESCUED_SQL} AS rescued FROM raw_claims) WHERE rescued IS NOT NULL OR claim_id IS NULL GROUP BY 2"""
    ),
)
def _(spark, folder):
    """Raw stream to a raw table, then two flows from it; rows per flow and reason."""
    root = work_path(spark, "stream-split")
    raw = apply_hints(streamed_claims(spark, folder), CLAIMS.hints)
    runs.finish(runs.append_to_folder(raw, f"{root}/raw", f"{root}/raw-checkpoint"))
    again = stream_folder(spark, f"{root}/raw", raw.schema)
    for flow in runs.split_stream(again, "claim_id", f"{root}/clean", f"{root}/quarantine", f"{root}/checkpoint"):
        runs.finish(flow)
    clean = spark.read.parquet(f"{root}/clean").agg(F.lit("clean").alias("flow"), F.lit("").alias("reason"), F.count(F.lit(1)).alias("rows"))
    bad = spark.read.parquet(f"{root}/quarantine").groupBy(F.lit("quarantine").alias("flow"), F.col("quarantine_reason").alias("reason"))
    return clean.unionByName(bad.agg(F.count(F.lit(1)).alias("rows")))


@query(
    "ingest_evolving_csv",
    with_raw(
        f"""SELECT policy_id, insurer_name, CAST(postcode AS INTEGER) AS postcode, {money('premium')} AS annual_premium, policy_end_date,
        CASE WHEN CAST(policy_id AS BIGINT) % 2 = 0 THEN region_name END AS region_note,
        CASE WHEN postcode IS NULL THEN '{{"postcode":"n/a"}}' END AS _rescued_data FROM raw_premiums"""
    ),
)
def _(spark, folder):
    """Policies as CSV files, ingested in two runs: the second finds files with a further column elsewhere in the line."""
    root = work_path(spark, "evolving")
    rows = t.raw_premiums(spark, folder)
    base = ["policy_id", "insurer_name", "postcode", "annual_premium", "policy_end_date"]
    odd = F.col("policy_id").cast("bigint") % 2 == 1
    rows.filter(odd).select(*base).write.option("header", True).csv(f"{root}/landing/premiums")
    ingest = lambda: evolving.ingest_available_now(
        spark, f"{root}/landing/premiums", f"{root}/bronze", f"{root}/schema", f"{root}/checkpoint", hints=PREMIUMS.hints
    )
    ingest()
    wider = rows.filter(~odd).select(F.col("region_name").alias("region_note"), *reversed(base))
    wider.write.mode("append").option("header", True).csv(f"{root}/landing/premiums")
    ingest()
    return evolving.read_ingested(spark, f"{root}/bronze").select(*base, "region_note", "_rescued_data")


@query(
    "ingest_inferred_csv",
    with_raw(
        f"""SELECT CAST(policy_id AS INTEGER) AS policy_id, {money('premium')} AS annual_premium, policy_end_date,
        CASE CAST(policy_id AS BIGINT) % 3 WHEN 0 THEN lpad(policy_id, 6, '0') WHEN 1 THEN policy_id || '.50' ELSE region_name END AS code,
        CASE WHEN CAST(policy_id AS BIGINT) % 3 > 0 THEN CAST(policy_id AS DOUBLE) / 2 END AS half FROM raw_premiums"""
    ),
)
def _(spark, folder):
    """Policies as CSV files in three runs: a column goes from whole numbers to decimals to text, another comes later."""
    root = work_path(spark, "inferring")
    number = F.col("policy_id").cast("bigint")
    rows = t.raw_premiums(spark, folder).select("policy_id", "region_name", "annual_premium", "policy_end_date")
    codes = [F.lpad("policy_id", 6, "0"), F.concat("policy_id", F.lit(".50")), F.col("region_name")]
    for run, code in enumerate(codes):
        part = rows.filter(number % 3 == run).withColumn("code", code).drop("region_name")
        part = part.withColumn("half", (number / 2).cast("decimal(20,1)").cast("string")) if run else part
        part.write.mode("append").option("header", True).csv(f"{root}/landing")
        inferring.ingest_inferred(spark, f"{root}/landing", f"{root}/bronze", f"{root}/kinds", f"{root}/checkpoint")
    read = inferring.read_inferred(spark, f"{root}/bronze", f"{root}/kinds")
    return read.select("policy_id", "annual_premium", "policy_end_date", "code", F.col("half").cast("double").alias("half"))


FLOWS_SQL = " UNION ALL ".join(
    [
        f"SELECT 'silver_policies' AS table_name, count(*) AS rows, {money('sum(premium)')} AS premium FROM raw_premiums WHERE premium > 0",
        f"SELECT 'silver_policies_quarantine', count(*), {money('sum(premium)')} FROM raw_premiums WHERE NOT (premium > 0 AND insured > 0 AND policy_start_date < policy_end_date)",
        f"SELECT 'gold_premium_by_region', count(*), {money('sum(s)')} FROM (SELECT sum(premium) AS s FROM raw_premiums WHERE premium > 0 GROUP BY region_name)",
    ]
)


@query("declared_flows", with_raw(FLOWS_SQL))
def _(spark, folder):
    """A streamed type-1 table with rules and quarantine and a query over it, both from specifications."""
    root = work_path(spark, "flows")
    typed_premiums(t.derived_once(t.raw_premiums(spark, folder))).write.parquet(f"{root}/landing")
    runner = FlowRunner(spark, root)
    policies = FlowSpec(
        name="policies", layer="silver", source=f"{root}/landing", source_format="parquet", mode="stream",
        rules=(
            quality.Rule("positive_annual_premium", "annual_premium > 0", quality.DROP),
            quality.Rule("positive_sum_insured", "sum_insured > 0"),
            quality.Rule("policy_start_before_end", "policy_start_date < policy_end_date"),
        ),
        keys=("policy_id",), sequence="bronze_ingestion_timestamp",
    )
    by_region = FlowSpec(
        name="premium_by_region", layer="gold",
        sql="""SELECT region_name, sum(annual_premium) AS annual_premium FROM silver_policies
        GROUP BY ALL HAVING annual_premium > 0""",
    )
    runner.run([policies, by_region])
    parts = [
        runner.read(name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.sum("annual_premium").alias("premium")
        )
        for name in ("silver_policies", "silver_policies_quarantine", "gold_premium_by_region")
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "log_of_a_killed_stream",
    with_raw(
        """SELECT 'flow' AS kind, 'bronze_claims' AS name, count(*) FILTER (claim_id IS NOT NULL) AS passed, count(*) FILTER (claim_id IS NULL) AS failed FROM raw_claims
        UNION ALL SELECT 'rule', 'has_id', count(*) FILTER (claim_id IS NOT NULL), count(*) FILTER (claim_id IS NULL) FROM raw_claims
        UNION ALL SELECT 'rule', 'no_refund', count(*) FILTER (incurred >= 0), count(*) FILTER (incurred IS NULL OR incurred < 0) FROM raw_claims
        UNION ALL SELECT 'table', 'bronze_claims', count(*) FILTER (claim_id IS NOT NULL), count(*) FILTER (claim_id IS NULL) FROM raw_claims"""
    ),
)
def _(spark, folder):
    """The log of a stream that was killed after it had written its last batch, and went on with the files that came since."""
    root = work_path(spark, "killed")
    rules = [quality.Rule("has_id", "claim_id IS NOT NULL", quality.DROP), quality.Rule("no_refund", "try_cast(incurred_amount AS DOUBLE) >= 0")]
    rows = t.raw_claims(spark, folder)
    log = logged.BatchLog(spark, f"{root}/log", "p", "claims")
    half = "coalesce(crc32(CAST(claim_id AS BINARY)), 0) % 2"
    files = t.landed_files(spark, folder, 2)
    for number in range(2):
        rows.where(f"{half} = {number}").repartition(files).write.mode("append").parquet(f"{root}/landing")
        stream = stream_folder(spark, f"{root}/landing", rows.schema, files_per_batch=-(-files // 2))
        runs.finish(logged.logged_stream(stream, rules, f"{root}/claims", f"{root}/checkpoint", log, "bronze_claims"))
        if number == 0:
            last = max(int(n) for n in children(spark, f"{root}/checkpoint/commits") if n.isdigit())
            for name in (f"{last}", f".{last}.crc"):
                remove(spark, f"{root}/checkpoint/commits/{name}")
    entries = log.read()
    flow = eventlog.flow_metrics(entries).select(
        F.lit("flow").alias("kind"), F.col("table_name").alias("name"), F.col("total_output_records").alias("passed"),
        F.col("total_expectation_dropped_records").alias("failed"),
    )
    expected = eventlog.expectation_metrics(entries).groupBy(F.lit("rule").alias("kind"), F.col("expectation").alias("name"))
    rule = expected.agg(F.sum("passing_records").alias("passed"), F.sum("failing_records").alias("failed"))
    judged = spark.read.parquet(f"{root}/claims").agg(
        F.lit("table").alias("kind"), F.lit("bronze_claims").alias("name"), F.count_if(F.col("claim_id").isNotNull()).alias("passed"),
        F.count_if(F.col("claim_id").isNull()).alias("failed"),
    )
    return flow.unionByName(rule).unionByName(judged)


WINDOWS = {
    "by_date": {"date_of_loss": (datetime.date(1995, 1, 1), datetime.date(1995, 6, 30))},
    "by_amount": {"incurred_amount": (20000, 30000)},
    "by_both": {"date_of_loss": (datetime.date(1994, 3, 1), None), "incurred_amount": (None, 5000)},
}


@query(
    "clustered_claims",
    with_raw(
        " UNION ALL ".join(
            f"SELECT '{name}' AS win, count(*) AS claims, {money('sum(incurred)')} AS incurred_amount, TRUE AS half_the_files_or_less FROM raw_claims WHERE {test}"
            for name, test in (
                ("by_date", "date_of_loss BETWEEN DATE '1995-01-01' AND DATE '1995-06-30'"),
                ("by_amount", "incurred BETWEEN 2000000 AND 3000000"),
                ("by_both", "date_of_loss >= DATE '1994-03-01' AND incurred <= 500000"),
            )
        )
    ),
)
def _(spark, folder):
    """Claims along a curve over loss date and amount, read by ranges of one or both: equal results from part of the files."""
    path = work_path(spark, "clustered")
    clustered.write_clustered(typed_claims(t.derived_once(t.raw_claims(spark, folder))), path, ["date_of_loss", "incurred_amount"], files=32)
    n_files = clustered.files_of(spark, path, {}).count()
    parts = []
    for name, bounds in WINDOWS.items():
        read = clustered.files_of(spark, path, bounds).count()
        rows = clustered.read_clustered(spark, path, bounds)
        found = rows.agg(F.count(F.lit(1)).alias("claims"), F.sum("incurred_amount").alias("incurred_amount"))
        parts.append(found.select(F.lit(name).alias("win"), "*", F.lit(read * 2 <= n_files).alias("half_the_files_or_less")))
    return reduce(DataFrame.unionByName, parts)


# A medallion as specification files. The keys of the tokens are filled in when the files are read.
SPECS = [
    {"name": "claims", "layer": "bronze", "source": "{landing}/claims", "source_format": "parquet", "rules": {"expect_or_drop": [{"name": "has_id", "constraint": "claim_id IS NOT NULL"}]}},
    {"name": "policies", "layer": "bronze", "source": "{landing}/policies", "source_format": "parquet"},
    {
        "name": "claims", "layer": "silver", "table": "bronze_claims", "mode": "stream",
        "select": ["claim_id", "policy_id", "peril_type", "try_cast(incurred_amount AS {money}) AS incurred_amount"],
        "rules": {
            "expect_or_drop": [{"name": "amount", "constraint": "incurred_amount >= 0"}],
            "expect": [{"name": "peril", "constraint": "peril_type IS NOT NULL"}],
        },
    },
    {
        "name": "policies", "layer": "silver", "table": "bronze_policies", "keys": ["policy_id"], "sequence": "ingestion_timestamp", "buckets": 8,
        "select": ["policy_id", "region_name", "CAST(annual_premium AS {money}) AS annual_premium", "ingestion_timestamp"],
        "except_columns": ["ingestion_timestamp"], "rules": {"expect_or_drop": [{"name": "premium", "constraint": "annual_premium > 0"}]},
    },
    {
        "name": "losses", "layer": "gold",
        "sql": "SELECT region_name, peril_type, count(*) AS claims, sum(incurred_amount) AS incurred FROM silver_claims LEFT JOIN silver_policies USING (policy_id) GROUP BY ALL",
    },
    {"name": "premiums", "layer": "gold", "sql": "SELECT region_name, sum(annual_premium) AS premium FROM silver_policies GROUP BY ALL"},
    {"name": "ratios", "layer": "gold", "sql": "SELECT region_name, peril_type, claims, incurred, premium FROM gold_losses LEFT JOIN gold_premiums USING (region_name)"},
]
DECLARED = f"""losses AS (
  SELECT region_name, peril_type, count(*) AS claims, sum(incurred) AS incurred FROM raw_claims
  LEFT JOIN (SELECT policy_id, region_name FROM raw_premiums WHERE premium > 0) USING (policy_id) WHERE claim_id IS NOT NULL AND incurred >= 0 GROUP BY ALL),
premiums AS (SELECT region_name, sum(premium) AS premium FROM raw_premiums WHERE premium > 0 GROUP BY ALL)"""


@query(
    "medallion_declared",
    with_raw(
        f"""SELECT run, region_name, peril_type, claims, {money('incurred')} AS incurred, {money('premium')} AS premium
        FROM losses LEFT JOIN premiums USING (region_name), (VALUES ('first'), ('refreshed')) v(run)""",
        DECLARED,
    ),
)
def _(spark, folder):
    """A medallion from two specification files, given in reverse, and again after a table and all below it were refreshed."""
    root = work_path(spark, "declared")
    t.raw_claims(spark, folder).write.parquet(f"{root}/landing/claims")
    t.raw_premiums(spark, folder).write.parquet(f"{root}/landing/policies")
    for listed in (SPECS[:3:-1], SPECS[3::-1]):  # gold, then the layers before it
        spark.createDataFrame([(json.dumps(listed),)], "value string").coalesce(1).write.mode("append").text(f"{root}/specs")
    graph = FlowGraph(read_specs(spark, f"{root}/specs", {"landing": f"{root}/landing", "money": "DECIMAL(18,2)"}, pattern="part-*"))
    runner = GraphRunner(spark, root, graph)
    first = runner.run().read("gold_ratios").withColumn("run", F.lit("first"))
    runner.refresh("silver_policies")
    again = GraphRunner(spark, root, graph).flows.read("gold_ratios").withColumn("run", F.lit("refreshed"))
    return first.unionByName(again)
