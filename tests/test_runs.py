"""Sinks, declared flows, the batch medallion, run logs and the severity model."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from claimlake import session
from claimlake.operators import eventlog, quality, severity
from claimlake.operators.monitor import medallion_counts
from claimlake.plans.flows import FlowRunner, FlowSpec, load_specs
from claimlake.plans.medallion import TableFolders, listed_tables, run_batch
from claimlake.sinks import tables
from tests.rows import only, raw


def test_table_names():
    assert tables.bronze_table_name("Claims Bordereau.csv") == "bronze_claims_bordereau"
    assert tables.bronze_table_name("claims-bordereau.CSV") == "bronze_claims_bordereau"


def test_folder_of_csv_becomes_tables(spark, tmp_path, database):
    (tmp_path / "Risk Zones.csv").write_text("postcode,region_name\n0800,Darwin\n4870,Cairns\n")
    (tmp_path / "events.CSV").write_text("event_id\nE1\n")
    (tmp_path / "notes.txt").write_text("no\n")
    summary = {r.source: r for r in tables.ingest_folder(spark, str(tmp_path), database).collect()}
    assert summary["Risk Zones.csv"].table == f"{database}.bronze_risk_zones" and summary["Risk Zones.csv"].rows == 2
    assert summary["events.CSV"].cols == ["event_id", "ingestion_timestamp", "source_file_name"]
    assert tables.list_layer_tables(spark, database) == ["bronze_events", "bronze_risk_zones"]
    with pytest.raises(FileNotFoundError):
        tables.ingest_folder(spark, str(tmp_path / "none"), database)
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        tables.ingest_folder(spark, str(empty), database)


def test_write_modes(spark, database):
    name = f"{database}.numbers"
    first = spark.range(3).withColumn("v", F.lit("a"))
    assert tables.write_table(first, name) == 3
    assert tables.write_table(first, name, mode="append") == 3 and spark.table(name).count() == 6
    assert tables.write_table(spark.range(2), name, overwrite_schema=False) == 2
    assert spark.table(name).columns == ["id", "v"]
    with pytest.raises(ValueError):
        tables.write_table(first.withColumn("w", F.lit(1)), name, overwrite_schema=False)
    assert tables.write_table(spark.range(2).withColumn("w", F.lit(1)), name) == 2
    assert spark.table(name).columns == ["id", "w"]
    assert tables.create_table_as(spark, f"{database}.doubled", f"SELECT id * 2 AS d FROM {name}") == 2
    assert tables.write_layer({"a": spark.range(1), "b": spark.range(4)}, database, cluster_by=["id"]) == {"a": 1, "b": 4}
    assert tables.write_quarantine(first, f"{database}.a") == 3 and spark.table(f"{database}.a_quarantine").count() == 3
    assert tables.write_table(first, f"{database}.parts", partition_by=["v"]) == 3


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.work_path(spark, "x") != session.work_path(spark, "x")


SPECS = """[
  {"name": "policies", "layer": "bronze", "source": "{landing}", "schema": "policy_id string, annual_premium string, seq int",
   "mode": "stream", "select": ["policy_id", "annual_premium", "seq"],
   "rules": {"expect_or_drop": [{"name": "policy_id_not_null", "constraint": "policy_id IS NOT NULL", "tag": "Completeness"}],
             "expect": [{"name": "number", "constraint": "try_cast(annual_premium AS DOUBLE) IS NOT NULL"}]}},
  {"name": "policies", "layer": "silver", "table": "bronze_policies", "mode": "stream",
   "select": ["policy_id", "try_cast(annual_premium AS DECIMAL(18,2)) AS annual_premium", "seq"],
   "keys": ["policy_id"], "sequence": "seq", "except_columns": ["seq"]},
  {"name": "total", "layer": "gold", "sql": "SELECT sum(annual_premium) AS premium, count(*) AS n FROM {silver}_policies"}
]"""


def test_declared_flows_end_to_end(spark, tmp_path):
    landing, root = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    (landing / "a.csv").write_text("policy_id,annual_premium,seq\nP1,100,1\nP2,abc,1\n,5,1\n")
    tokens = {"landing": str(landing), "silver": "silver"}
    filled = SPECS
    for key, value in tokens.items():
        filled = filled.replace("{" + key + "}", value)
    specs = load_specs(filled)
    assert [s.name for s in specs] == ["policies", "policies", "total"] and specs[0].rules[0].action == "drop"
    log_path = str(tmp_path / "log")
    log = eventlog.RunLog(spark, log_path, "p1", "claims")
    runner = FlowRunner(spark, root, log)
    runner.run(specs)
    assert only(runner.read("gold_total")).asDict() == {"premium": 100, "n": 2}
    bad = runner.read("bronze_policies_quarantine")
    assert sorted(r.quarantine_reason for r in bad.collect()) == ["number", "policy_id_not_null"]

    (landing / "b.csv").write_text("policy_id,annual_premium,seq\nP1,50,0\nP2,70,2\n")
    again = FlowRunner(spark, root, eventlog.RunLog(spark, log_path, "p1", "claims"))
    again.run(specs)
    state = again.read("silver_policies")
    assert {r.policy_id: r.annual_premium for r in state.collect()} == {"P1": 100, "P2": 70}
    assert again.read("bronze_policies").count() == 4 and again.read("bronze_policies_quarantine").count() == 2

    rows = eventlog.read_log(spark, log_path)
    flows = eventlog.flow_metrics(rows).filter("table_name = 'policies' AND update_id = '%s'" % log.update_id)
    assert only(flows).final_status == "COMPLETED"
    outcome = {r.expectation: (r.passing_records, r.failing_records) for r in eventlog.expectation_metrics(rows).filter(
        F.col("update_id") == log.update_id).collect()}
    assert outcome == {"policy_id_not_null": (2, 1), "number": (2, 1)}
    assert only(eventlog.run_counters(eventlog.update_runs(rows))).asDict() == {"update_count": 2, "failed_updates": 0}


def test_full_refresh_of_declared_flows(spark, tmp_path):
    from claimlake.streaming.refresh import Versions

    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.csv").write_text("policy_id,annual_premium,seq\nP1,100,1\n")
    specs = load_specs(SPECS.replace("{landing}", str(landing)).replace("{silver}", "silver"))
    versions = Versions(spark, str(tmp_path / "versions"))
    first = versions.refresh(lambda output, _: FlowRunner(spark, output).run(specs) and None)
    (landing / "a.csv").write_text("policy_id,annual_premium,seq\nP1,300,1\nP3,1,1\n")
    second = versions.refresh(lambda output, _: FlowRunner(spark, output).run(specs) and None)
    premiums = [spark.read.parquet(f"{v}/gold/total").first().premium for v in (first, second)]
    assert premiums == [100, 301] and versions.current() == second


def test_failed_flow_is_logged_and_raised(spark, tmp_path):
    log = eventlog.RunLog(spark, str(tmp_path / "log"), "p", "claims")
    with pytest.raises(Exception):
        FlowRunner(spark, str(tmp_path / "out"), log).run([FlowSpec(name="x", sql="SELECT * FROM missing_table")])
    runs = eventlog.update_runs(eventlog.read_log(spark, str(tmp_path / "log")))
    assert only(runs).pipeline_update_status == "FAILED"


def test_specifications_are_checked(spark):
    for wrong in (
        dict(name="a"), dict(name="a", source="x", sql="y"), dict(name="a", source="x", keys=("k",)),
        dict(name="a", source="x", mode="stream"), dict(name="a", sql="x", mode="stream"),
        dict(name="a", source="x", table="y"),
    ):
        with pytest.raises(ValueError):
            FlowSpec(**wrong)
    yaml = pytest.importorskip("yaml")
    text = yaml.safe_dump([{"name": "a", "source": "{root}/x", "rules": {"expect": [{"name": "r", "constraint": "a > 0"}]}}])
    assert load_specs(text, {"root": "/r"})[0].source == "/r/x"


def test_batch_medallion_invariants(spark, tmp_path):
    bronze = {
        "claims": raw(
            spark, "claims", {"claim_id": "A"}, {"claim_id": "A", "snapshot_date": "2025-03-01", "paid_to_date": "1000", "claim_status": "Closed"},
            {"claim_id": "B", "policy_id": "  "}, {"claim_id": None}, {"claim_id": "C", "paid_to_date": "9999"},
        ),
        "premiums": raw(spark, "premiums", {}, {"policy_id": None}),
        "risk_zones": raw(spark, "risk_zones", {}, {"region_name": "Other"}, {"postcode": " "}),
        "cyclone_events": raw(spark, "cyclone_events"),
    }
    folders = TableFolders(spark, str(tmp_path))
    found = {r.table_name: r for r in run_batch(bronze, folders).collect()}
    assert found["bronze_claims_bordereau"].row_count == 3 and found["bronze_claims_bordereau_quarantine"].row_count == 2
    assert found["silver_claims_bordereau"].row_count == 2 and found["silver_claims_current"].row_count == 1
    assert found["silver_risk_zone_lookup"].row_count == 1 and found["silver_premium_bordereau"].row_count == 1
    assert all(r.row_count > 0 for n, r in found.items() if r.layer == "gold" and not n.endswith("_quarantine"))
    assert found["gold_claims_summary_quarantine"].row_count == 0 and found["gold_claims_summary"].latest_ingest_ts is None
    summary = only(folders.read("gold_claims_summary"))
    assert (summary.claim_status, summary.settlement_pct, summary.claim_count) == ("Closed", 100, 1)
    assert only(folders.read("gold_claims_development")).claim_count == 2
    files = {r.table_name: r.source_file_count for r in medallion_counts(listed_tables(folders)).collect()}
    assert files["bronze_claims_bordereau"] == 1 and files["silver_claims_bordereau"] is None


def log_rows(spark, *rows):
    at = lambda s: dt.datetime(2025, 1, 1, 12, 0, s)
    data = [
        (at(s), level, kind, "m", ("p", "claims", run, flow), json.dumps(details)) for s, level, kind, run, flow, details in rows
    ]
    return spark.createDataFrame(data, eventlog.LOG_SCHEMA)


def test_run_log_edge_cases(spark):
    def state(s):
        return {"update_progress": {"state": s}}

    def flow(status, **more):
        return {"flow_progress": {"status": status, **more}}

    log = log_rows(
        spark,
        (0, "INFO", "create_update", "r1", None, {}), (1, "INFO", "update_progress", "r1", None, state("RUNNING")),
        (9, "INFO", "update_progress", "r1", None, state("FAILED")), (0, "INFO", "create_update", "r2", None, {}),
        (5, "INFO", "update_progress", "r2", None, state("RUNNING")), (5, "INFO", "update_progress", "r3", None, state("COMPLETED")),
        (2, "INFO", "flow_progress", "r1", "f", flow("RUNNING", metrics={"num_output_rows": 5}, data_quality={"dropped_records": 2})),
        (4, "INFO", "flow_progress", "r1", "f", flow("COMPLETED", metrics={"num_output_rows": 7}, data_quality={"dropped_records": 3, "expectations": [
            {"name": "e", "dataset": "d", "passed_records": 6, "failed_records": 1}]})),
        (4, "WARN", "flow_progress", "r1", "g", flow("QUEUED")), (4, "ERROR", "flow_progress", "r1", None, flow("COMPLETED")),
    )
    clock = F.lit("2025-01-01 12:00:59").cast("timestamp")
    runs = {r.pipeline_update_id: r for r in eventlog.update_runs(log, clock).collect()}
    assert set(runs) == {"r1", "r2"}
    assert (runs["r1"].duration_seconds, runs["r1"].pipeline_update_status) == (9, "FAILED")
    assert (runs["r2"].duration_seconds, runs["r2"].pipeline_update_status) == (59, "RUNNING")
    flows = {r.table_name: r for r in eventlog.flow_metrics(log).collect()}
    f = flows["f"]
    assert (f.total_output_records, f.total_expectation_dropped_records, f.final_status, f.duration_seconds) == (12, 3, "COMPLETED", 2)
    assert (flows["g"].total_output_records, flows["g"].final_status, flows["g"].duration_seconds) == (0, None, None)
    e = only(eventlog.expectation_metrics(log))
    assert (e.dataset, e.passing_records, e.failing_records) == ("d", 6, 1)
    assert {r.level for r in eventlog.problem_events(log).collect()} == {"WARN", "ERROR"}
    assert only(eventlog.failing_total(eventlog.expectation_metrics(log))).failing_records == 1


def snapshots(spark):
    return raw(
        spark, "claims",
        {"claim_id": "C1", "incurred_amount": "10000", "snapshot_date": "2025-02-17"},
        {"claim_id": "C1", "incurred_amount": "22000", "snapshot_date": "2025-03-01", "claim_status": " Closed "},
        {"claim_id": "C2", "incurred_amount": "5000", "policy_id": "POL-2"},
        {"claim_id": "C3", "incurred_amount": "N/A", "claim_status": "Closed"},
        {"claim_id": "C4", "incurred_amount": "7", "claim_status": "Closed", "policy_id": "GONE"},
    )


def test_severity_features(spark):
    policies = raw(spark, "premiums", {}, {"policy_id": "POL-2"}, {"insurer_name": "Again"})
    features = severity.severity_features(snapshots(spark), policies)
    row = only(features)
    assert (row.claim_id, row.first_incurred, row.ultimate_incurred, row.report_lag_days, row.sum_insured) == ("C1", 10000.0, 22000.0, 7, 10000.0)
    assert features.columns == list(severity.FEATURES) and "paid_to_date" not in features.columns
    with pytest.raises(ValueError, match=r"claims missing columns: \['peril_type', 'snapshot_date'\]"):
        severity.severity_features(snapshots(spark).drop("snapshot_date", "peril_type"), policies)
    with pytest.raises(ValueError, match="policies missing"):
        severity.severity_features(snapshots(spark), policies.drop("region_name"))
    with pytest.raises(ValueError, match="more than 1000"):
        severity.require_rows(features)
    assert severity.require_rows(features, 0) == 1


def test_severity_model_round_trip(spark, tmp_path):
    features = spark.range(600).select(
        F.concat(F.lit("C"), "id").alias("claim_id"), F.lit("P").alias("policy_id"), (F.col("id") % 50 * 10).cast("double").alias("first_incurred"),
        F.element_at(F.array(F.lit("Wind"), F.lit("Storm Surge")), (F.col("id") % 2 + 1).cast("int")).alias("peril_type"),
        (F.col("id") % 9).cast("int").alias("report_lag_days"), F.lit("T-W").alias("wind_risk_band"), F.lit("Home").alias("building_type"),
        F.lit(1000.0).alias("sum_insured"), F.lit("None").alias("mitigation_flag"), F.lit("R").alias("region_name"),
        (F.col("id") % 50 * 20 + F.col("id") % 2 * 500).cast("double").alias("ultimate_incurred"),
    )
    train, held = severity.holdout_split(features)
    assert train.count() + held.count() == 600 and 60 < held.count() < 180
    assert {r.claim_id for r in severity.holdout_split(features.repartition(7))[1].collect()} == {r.claim_id for r in held.collect()}
    model = severity.fit(train, trees=5, depth=5)
    path = str(tmp_path / "model")
    severity.save_model(model, path)
    unseen = held.withColumn("peril_type", F.lit("Hail")).limit(1)
    assert severity.load_model(path).transform(unseen).count() == 1
    scored = severity.load_model(path).transform(held)
    quality_row = only(severity.evaluate(scored))
    pairs = [(r.ultimate_incurred, r.predicted_ultimate) for r in scored.collect()]
    mean = sum(a for a, _ in pairs) / len(pairs)
    assert quality_row.mae == pytest.approx(sum(abs(p - a) for a, p in pairs) / len(pairs))
    assert quality_row.rmse == pytest.approx((sum((p - a) ** 2 for a, p in pairs) / len(pairs)) ** 0.5)
    assert quality_row.r2 == pytest.approx(1 - sum((p - a) ** 2 for a, p in pairs) / sum((a - mean) ** 2 for a, _ in pairs))
    assert quality_row.r2 > 0.8
    out = severity.batch_score(model, features)
    row = out.filter("first_incurred = 0").first()
    assert row.uplift_vs_first == row.predicted_ultimate and row.abs_error == abs(row.predicted_ultimate - row.ultimate_incurred)
    top = [r.uplift_vs_first for r in severity.largest(out, "uplift_vs_first", 3).collect()]
    assert top == sorted(top, reverse=True) and len(top) == 3
    assert severity.compare_holdout(scored).columns[-1] == "error"


def test_streamed_rows_equal_batch_rows(spark, tmp_path):
    from claimlake.schemas import CLAIMS
    from claimlake.sources.csv import read_csv_text, stream_csv
    from claimlake.sources.rescue import apply_hints
    from claimlake.streaming import runs

    rows = snapshots(spark).drop("ingestion_timestamp", "source_file_name")
    landing = str(tmp_path / "land")
    rows.repartition(3).write.option("header", True).csv(landing)
    out = str(tmp_path / "out")
    runs.finish(runs.append_to_folder(stream_csv(spark, landing, CLAIMS, files_per_batch=1), out, str(tmp_path / "c")))
    batch = apply_hints(read_csv_text(spark, landing, CLAIMS.raw_schema()), CLAIMS.hints)
    columns = [*CLAIMS.columns, "_rescued_data"]
    assert batch.select(columns).exceptAll(spark.read.parquet(out).select(columns)).isEmpty()
    assert spark.read.parquet(out).count() == batch.count() == 5
    assert quality.quarantine_from_raw(spark.read.parquet(out), "claim_id").count() == 1
