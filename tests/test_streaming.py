import json

import pytest
from pyspark.sql import functions as F

from claimlake.schemas import CLAIMS, RISK_ZONES
from claimlake.sinks.upsert import Upsert, latest_state, read_state, upsert
from claimlake.sources.csv import stream_csv
from claimlake.operators import eventlog, quality
from claimlake.sources.tables import read_table, stream_changes, stream_folder, stream_table
from claimlake.streaming import evolving, runs
from claimlake.streaming.refresh import Versions

HEADER = "postcode,region_name,wind_risk_band"


def land(folder, name, *lines, header=HEADER):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def test_files_arrive_once_and_misfits_are_rescued(spark, tmp_path):
    source, out, check = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "check")
    run = lambda: runs.finish(runs.append_to_folder(stream_csv(spark, str(source), RISK_ZONES), out, check))
    land(source, "one.csv", "4870,Cairns,T-W", "abc,Darwin,B-F")
    run()
    assert spark.read.parquet(out).count() == 2
    land(source, "two.csv", ",Nowhere,T-W", "4800,Bowen,Q-S,extra")
    run()
    run()
    rows = {r.region_name: r for r in spark.read.parquet(out).collect()}
    assert len(rows) == 4
    assert rows["Cairns"].postcode == 4870 and rows["Cairns"]._rescued_data is None
    assert json.loads(rows["Darwin"]._rescued_data) == {"postcode": "abc"}
    assert "extra" in rows["Bowen"]._rescued_data and rows["Bowen"].postcode == 4800
    assert rows["Nowhere"].postcode is None and rows["Nowhere"]._rescued_data is None

    raw = spark.read.parquet(out)
    for _ in range(2):
        flows = runs.split_stream(
            stream_folder(spark, out, raw.schema), "postcode", str(tmp_path / "clean"), str(tmp_path / "bad"), str(tmp_path / "c2")
        )
        for flow in flows:
            runs.finish(flow)
    clean = spark.read.parquet(str(tmp_path / "clean"))
    bad = {r.region_name: r.quarantine_reason for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert {r.region_name for r in clean.collect()} == {"Cairns", "Bowen"}
    assert bad == {"Darwin": "rescued_data,postcode_null", "Nowhere": "postcode_null", "Bowen": "rescued_data"}


def test_columns_may_appear_over_time(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "bronze")
    args = (spark, str(source), out, str(tmp_path / "schema"), str(tmp_path / "check"))
    land(source, "a.csv", "4870,Cairns,T-W")
    evolving.ingest_available_now(*args, hints=RISK_ZONES.hints)
    land(source, "b.csv", "T-W,coastal,0800,Darwin", header="wind_risk_band,exposure,postcode,region_name")
    land(source, "c.csv", "x,Perth,B-F")
    evolving.ingest_available_now(*args, hints=RISK_ZONES.hints)
    evolving.ingest_available_now(*args, hints=RISK_ZONES.hints)
    rows = {r.region_name: r for r in evolving.read_ingested(spark, out).collect()}
    assert len(rows) == 3
    assert rows["Darwin"].exposure == "coastal" and rows["Darwin"].postcode == 800
    assert rows["Cairns"].exposure is None and rows["Cairns"].wind_risk_band == "T-W"
    assert rows["Perth"].postcode is None and json.loads(rows["Perth"]._rescued_data) == {"postcode": "x"}
    assert evolving.SchemaLog(spark, str(tmp_path / "schema")).columns() == [
        "postcode", "region_name", "wind_risk_band", "exposure",
    ]


def test_all_datasets_of_the_registry(spark, tmp_path):
    for name, header, line in (
        ("claims", ",".join(CLAIMS.columns), "C1,P1,,2025-01-01,2025-01-02,Wind,Open,10,5,2025-01-02"),
        ("premiums", "policy_id,insurer_name", "P1,North"),
        ("risk_zones", HEADER, "4870,Cairns,T-W"),
        ("cyclone_events", "event_id,event_name,start_date,end_date", "E1,Alpha,2025-01-01,2025-01-03"),
    ):
        land(tmp_path / "land" / name, "f.csv", line, header=header)
    bronze = str(tmp_path / "bronze")
    written = evolving.ingest_all_datasets(spark, str(tmp_path / "land"), bronze, str(tmp_path / "state"))
    assert [w.rsplit("/", 1)[1] for w in written] == [
        "bronze_claims_bordereau", "bronze_premium_bordereau", "bronze_risk_zone_lookup", "bronze_cyclone_events",
    ]
    assert evolving.read_ingested(spark, written[0]).first().incurred_amount == 10


def changes(spark, *rows):
    return spark.createDataFrame(rows, "k string, v string, w int, seq int")


SPEC = Upsert(keys=("k",), sequence="seq", buckets=4)


def state(spark, target, spec=SPEC):
    return {r.k: (r.v, r.w) for r in read_state(spark, target, spec).collect()}


def test_upsert_keeps_the_latest_sequence_whatever_the_arrival(spark, tmp_path):
    batches = [[("a", "1", 1, 1), ("b", "1", 1, 5)], [("a", "2", None, 2), ("b", "old", 0, 3)], [("c", "1", 1, 1)]]
    results = []
    for order in ((0, 1, 2), (2, 1, 0)):
        target = str(tmp_path / f"t{order[0]}")
        for number, index in enumerate(order):
            upsert(changes(spark, *batches[index]), target, SPEC, number)
        results.append(state(spark, target))
    assert results[0] == results[1] == {"a": ("2", None), "b": ("1", 1), "c": ("1", 1)}


def test_upsert_survives_a_replay_of_a_half_published_batch(spark, tmp_path):
    import shutil

    target = str(tmp_path / "t")
    upsert(changes(spark, *[(f"k{i}", "1", 1, 1) for i in range(20)]), target, SPEC, 0)
    second = changes(spark, ("k3", "2", 2, 2))
    upsert(second, target, SPEC, 1)
    expected = state(spark, target)
    part = next(p for p in (tmp_path / "t").iterdir() if p.name.startswith("_part=") and "k3" in {
        r.k for r in spark.read.parquet(str(p)).collect()})
    shutil.rmtree(part)
    upsert(second, target, SPEC, 1)
    assert state(spark, target) == expected and len(expected) == 20
    # An old batch number after a newer batch must not bring old rows back.
    upsert(changes(spark, ("k3", "3", 3, 3)), target, SPEC, 2)
    upsert(second, target, SPEC, 1)
    assert state(spark, target)["k3"] == ("3", 3)


def test_null_updates_can_be_ignored(spark):
    log = changes(spark, ("a", "1", 1, 1), ("a", None, 2, 2))
    assert latest_state(log, SPEC).first().v is None
    keep = Upsert(keys=("k",), sequence="seq", ignore_null_updates=True)
    row = latest_state(log, keep).first()
    assert (row.v, row.w, row.seq) == ("1", 2, 2)


def test_layout_must_follow_from_the_key():
    with pytest.raises(ValueError):
        Upsert(keys=("k",), sequence="seq", month_of="day")


def test_stream_into_upsert_by_month(spark, tmp_path):
    spec = Upsert(keys=("k", "day"), sequence="seq", month_of="day", except_columns=("seq",))
    source, target, check = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")

    def push(*rows):
        df = spark.createDataFrame(rows, "k string, day string, v int, seq int").withColumn("day", F.to_date("day"))
        df.write.mode("append").parquet(source)
        runs.finish(runs.upsert_stream(stream_folder(spark, source, df.schema), target, check, spec))

    push(("a", "2025-01-05", 1, 1), ("a", "2025-02-05", 1, 1))
    january = sorted(p.name for p in (tmp_path / "t" / "_part=m2025-01").iterdir())
    push(("a", "2025-02-05", 2, 2), ("a", None, 9, 1))
    rows = {(r.k, str(r.day)): r.v for r in read_state(spark, target, spec).collect()}
    assert rows == {("a", "2025-01-05"): 1, ("a", "2025-02-05"): 2, ("a", "None"): 9}
    assert sorted(p.name for p in (tmp_path / "t" / "_part=m2025-01").iterdir()) == january
    assert "seq" not in read_state(spark, target, spec).columns


def test_table_streams_and_full_refresh(spark, tmp_path, database):
    table = f"{database}.numbers"
    spark.range(5).write.saveAsTable(table)
    copy = f"{database}.copy"
    for _ in range(2):
        runs.finish(runs.append_to_table(stream_table(spark, table), copy, str(tmp_path / "c")))
    assert spark.table(copy).count() == 5

    versions = Versions(spark, str(tmp_path / "out"))
    assert versions.current() is None

    def build(output, checkpoint):
        runs.finish(runs.append_to_folder(stream_table(spark, table), output, checkpoint))

    first = versions.refresh(build)
    spark.range(5, 8).write.mode("append").saveAsTable(table)
    assert spark.read.parquet(versions.current()).count() == 5
    second = versions.refresh(build)
    assert versions.current() == second != first
    assert spark.read.parquet(second).count() == 8
    with pytest.raises(RuntimeError):
        versions.refresh(lambda output, checkpoint: (_ for _ in ()).throw(RuntimeError("stop")))
    assert versions.current() == second


def test_continuous_run_is_stopped_by_the_caller(spark, tmp_path):
    land(tmp_path / "in", "one.csv", "4870,Cairns,T-W")
    out = str(tmp_path / "raw")
    query = runs.append_to_folder(
        stream_csv(spark, str(tmp_path / "in"), RISK_ZONES), out, str(tmp_path / "c"), trigger=runs.continuously(0.1)
    )
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert spark.read.parquet(out).count() == 1


def test_rules_are_counted_inside_a_stream(spark, tmp_path):
    source, log_path = str(tmp_path / "in"), str(tmp_path / "log")
    rules = [quality.required("k"), quality.Rule("positive", "v > 0")]
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", -1)], "k string, v int")
    df.write.parquet(source)
    kept = quality.expect(stream_folder(spark, source, df.schema), rules, "rules")
    query = runs.finish(runs.append_to_folder(kept, str(tmp_path / "out"), str(tmp_path / "c")))
    log = eventlog.RunLog(spark, log_path, "p", "claims")
    runs.log_progress(query, log, "bronze_claims", rules, "rules")
    log.finish("COMPLETED")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    found = eventlog.expectation_metrics(eventlog.read_log(spark, log_path)).collect()
    assert {(r.dataset, r.expectation): (r.passing_records, r.failing_records) for r in found} == {
        ("bronze_claims", "k_not_null"): (2, 1), ("bronze_claims", "positive"): (2, 1),
    }
    assert eventlog.flow_metrics(eventlog.read_log(spark, log_path)).first().total_output_records == 2


def test_change_feed_is_the_appended_rows(spark, tmp_path, database):
    source = str(tmp_path / "bronze")
    rows = spark.createDataFrame([("C1", "10.50"), ("C2", "x")], "claim_id string, incurred_amount string")
    rows.write.parquet(source)
    feed = stream_changes(spark, source, rows.schema, ["claim_id", "try_cast(incurred_amount AS DECIMAL(18,2)) AS amount"])
    runs.finish(runs.append_to_table(feed, f"{database}.silver", str(tmp_path / "c")))
    assert {r.claim_id: r.amount for r in read_table(spark, f"{database}.silver").collect()}["C2"] is None


def test_two_streams_and_new_checkpoints_lose_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    for name, row in (("one", ("a", "1", 1, 1)), ("two", ("b", "2", 2, 2)), ("three", ("c", "3", 3, 3))):
        source = str(tmp_path / name)
        changes(spark, row).write.parquet(source)
        stream = stream_folder(spark, source, changes(spark, row).schema)
        runs.finish(runs.upsert_stream(stream, target, str(tmp_path / f"{name}-check"), SPEC))
    assert state(spark, target) == {"a": ("1", 1), "b": ("2", 2), "c": ("3", 3)}

    landing, out = tmp_path / "in", str(tmp_path / "bronze")
    land(landing, "a.csv", "4870,Cairns,T-W")
    evolving.ingest_available_now(spark, str(landing), out, str(tmp_path / "schema"), str(tmp_path / "c1"))
    land(tmp_path / "in2", "b.csv", "0800,Darwin,T-W")
    evolving.ingest_available_now(spark, str(tmp_path / "in2"), out, str(tmp_path / "schema"), str(tmp_path / "c2"))
    assert {r.region_name for r in evolving.read_ingested(spark, out).collect()} == {"Cairns", "Darwin"}


def test_an_unpublished_slot_is_published_before_another_stream_writes(spark, tmp_path):
    import shutil

    target = str(tmp_path / "t")
    upsert(changes(spark, *[(f"k{i}", "1", 1, 1) for i in range(8)]), target, SPEC, 0, "one")
    (tmp_path / "t__staging_published").exists() and shutil.rmtree(tmp_path / "t__staging_published")
    for part in (tmp_path / "t").glob("_part=*"):
        shutil.rmtree(part)  # the crash came between the staging and the last partition
    upsert(changes(spark, ("z", "1", 1, 1)), target, SPEC, 0, "two")
    assert len(state(spark, target)) == 9


def test_empty_updates_whatever_the_arrival_and_the_batching(spark, tmp_path):
    import itertools

    keep = Upsert(keys=("k",), sequence="seq", buckets=2, ignore_null_updates=True)
    log = [("a", "1", 7, 1), ("a", None, None, 3), ("a", "2", None, 2)]
    expected = {"a": ("2", 7)}
    for n, order in enumerate(itertools.permutations(range(3))):
        target = str(tmp_path / f"t{n}")
        cut = n % 3
        batches = [b for b in ([log[i] for i in order[:cut]], [log[i] for i in order[cut:]]) if b]
        for number, rows in enumerate(batches):
            upsert(changes(spark, *rows), target, keep, number)
        assert state(spark, target, keep) == expected, (order, cut)
        assert read_state(spark, target, keep).first().seq == 3


def test_replayed_batch_keeps_its_counters(spark, tmp_path):
    rows = changes(spark, ("a", "1", 1, 1))
    first = upsert(rows, str(tmp_path / "t"), SPEC, 4, "s", lambda: {"rows": 1})
    assert first == upsert(rows, str(tmp_path / "t"), SPEC, 4, "s", lambda: 1 / 0) == {"rows": 1}


def test_blank_first_lines_and_blanks_in_file_names(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "bronze")
    source.mkdir()
    (source / "Risk Zones [new] 100%+.csv").write_text("\n\npostcode,region_name\n4870,Cairns\n")
    evolving.ingest_available_now(spark, str(source), out, str(tmp_path / "schema"), str(tmp_path / "c"))
    assert [(r.postcode, r.region_name) for r in evolving.read_ingested(spark, out).collect()] == [("4870", "Cairns")]


def test_headers_in_another_order_fail_the_fixed_stream(spark, tmp_path):
    land(tmp_path / "in", "a.csv", "T-W,4870,Cairns", header="wind_risk_band,postcode,region_name")
    with pytest.raises(Exception):
        runs.finish(runs.append_to_folder(stream_csv(spark, str(tmp_path / "in"), RISK_ZONES), str(tmp_path / "o"), str(tmp_path / "c")))


def test_log_counts_rows_that_fail_any_hard_rule(spark, tmp_path):
    source, log_path = str(tmp_path / "in"), str(tmp_path / "log")
    df = spark.createDataFrame([(None, 1), ("a", -1), ("b", 2)], "k string, v int")
    df.repartition(3).write.parquet(source)
    rules = [quality.required("k"), quality.Rule("positive", "v > 0", quality.DROP)]
    tap = runs.ProgressTap.attach(spark)
    try:
        kept = quality.expect(stream_folder(spark, source, df.schema, files_per_batch=1), rules, "two")
        query = runs.finish(runs.append_to_folder(kept, str(tmp_path / "out"), str(tmp_path / "c")))
        log = eventlog.RunLog(spark, log_path, "p", "claims")
        runs.log_progress(query, log, "bronze_claims", rules, "two", tap)
    finally:
        tap.detach(spark)
    log.finish("COMPLETED")
    row = eventlog.flow_metrics(eventlog.read_log(spark, log_path)).first()
    assert row.total_output_records == 1 == spark.read.parquet(str(tmp_path / "out")).count()
    details = [json.loads(r.details) for r in eventlog.read_log(spark, log_path).collect() if r.details and "dropped_records" in r.details]
    assert sum(d["flow_progress"]["data_quality"]["dropped_records"] for d in details) == 2


def test_quarantine_of_a_clean_keyed_table_is_empty(spark, tmp_path):
    from claimlake.plans.flows import FlowRunner, FlowSpec

    changes(spark, ("a", "1", 1, 1)).write.parquet(str(tmp_path / "in"))
    runner = FlowRunner(spark, str(tmp_path / "out"))
    rule = quality.Rule("positive", "w > 0", quality.DROP)
    runner.run([FlowSpec(name="t", source=str(tmp_path / "in"), source_format="parquet", mode="stream", rules=(rule,), keys=("k",), sequence="seq")])
    assert runner.read("bronze_t").count() == 1 and runner.read("bronze_t_quarantine").count() == 0
