import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from claimlake.functions.casting import STRICT, parse_date
from claimlake.operators import monitor, quality, report, rulesets
from claimlake.operators.projection import business_columns, substitute, typed_claims, typed_events, typed_premiums, with_active_flag
from claimlake.sources.rescue import apply_hints
from claimlake.schemas import CLAIMS
from tests.rows import AT, only, raw


def test_bad_text_is_null_or_fails_the_job(spark):
    bad = raw(spark, "claims", {"date_of_loss": "not-a-date", "incurred_amount": "N/A"})
    row = only(typed_claims(bad))
    assert row.date_of_loss is None and row.incurred_amount is None and row.bronze_ingestion_timestamp == AT
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|not-a-date|N/A"):
        typed_claims(bad, mode=STRICT).collect()
    with pytest.raises(ValueError):
        typed_claims(bad, mode="loose")


def test_dates_in_several_spellings(spark):
    df = spark.createDataFrame([("2025/02/08",), ("2025-11-20",), ("02/08/2025",), ("soon",)], "d string")
    assert [str(r[0]) for r in df.select(parse_date("d")).collect()] == ["2025-02-08", "2025-11-20", "2025-02-08", "None"]
    events = quality.events_quality(typed_events(raw(
        spark, "cyclone_events", {"start_date": "2025/02/08"}, {"event_id": "B", "start_date": "2025-03-20", "end_date": "2025-03-10"},
        {"event_id": "C", "event_name": None},
    )))
    assert only(events).event_id == "CYC-1"


def test_silver_claims_rules(spark):
    rows = raw(
        spark, "claims", {"claim_id": "OK"}, {"claim_id": "NO-EVENT", "event_id": None}, {"claim_id": "A", "policy_id": None},
        {"claim_id": "B", "date_of_loss": "2025-03-20"}, {"claim_id": "C", "incurred_amount": "-5", "paid_to_date": "-9"},
        {"claim_id": "D", "paid_to_date": "5000"}, {"claim_id": "E", "date_of_loss": "not-a-date"}, {"claim_id": "F", "policy_id": "GONE"},
    )
    kept = quality.claims_quality(typed_claims(rows))
    assert {r.claim_id for r in kept.collect()} == {"OK", "NO-EVENT", "F"}


def test_silver_premium_rules(spark):
    rows = raw(
        spark, "premiums", {}, {"policy_id": "A", "policy_end_date": "2024-01-01"}, {"policy_id": "B", "sum_insured": "0"},
        {"policy_id": "C", "annual_premium": "-10"}, {"policy_id": "D", "mitigation_flag": None}, {"policy_id": "E", "postcode": "x"},
    )
    assert only(quality.premiums_quality(typed_premiums(rows))).policy_id == "POL-1"
    zeros = raw(spark, "premiums", {"postcode": "0800"})
    assert only(typed_premiums(zeros)).postcode == 800 and only(typed_premiums(zeros, postcode="string")).postcode == "0800"


def test_active_flag(spark):
    rows = typed_premiums(raw(spark, "premiums", {"policy_id": "past"}, {"policy_id": "open", "policy_end_date": None}, {"policy_id": "future", "policy_end_date": "2999-01-01"}))
    flags = {r.policy_id: r.is_active for r in with_active_flag(rows).collect()}
    assert flags == {"past": False, "open": True, "future": True}


def test_split_keeps_soft_failures_and_quarantines_all(spark):
    rules = rulesets.SILVER["claims_snapshots"]
    rows = typed_claims(raw(
        spark, "claims", {"claim_id": "OK"}, {"claim_id": "SOFT", "peril_type": "Hail"}, {"claim_id": "HARD", "policy_id": None},
        {"claim_id": "UNKNOWN", "incurred_amount": None},
    ))
    kept, bad = quality.split(rows, rules)
    assert {r.claim_id for r in kept.collect()} == {"OK", "SOFT"}
    reasons = {r.claim_id: r.quarantine_reason for r in bad.collect()}
    assert reasons == {"SOFT": "valid_peril_type", "HARD": "policy_id_not_null", "UNKNOWN": "incurred_gte_paid,non_negative_incurred"}


def test_judged_rows_are_table_and_quarantine_in_one(spark):
    rules = rulesets.SILVER["claims_snapshots"]
    rows = typed_claims(raw(spark, "claims", {"claim_id": "OK"}, {"claim_id": "SOFT", "peril_type": "Hail"}, {"claim_id": "HARD", "policy_id": None}))
    kept, bad = quality.split(rows, rules)
    judged = quality.judge(rows, rules)
    assert judged.count() == 3
    assert quality.kept_of(judged).exceptAll(kept).isEmpty() and quality.kept_of(judged).columns == kept.columns
    stamp = F.lit(None).alias("_quarantine_ts")
    same = quality.quarantine_of(judged).withColumn("_quarantine_ts", stamp).exceptAll(bad.withColumn("_quarantine_ts", stamp))
    assert same.isEmpty() and quality.quarantine_of(judged).count() == bad.count() == 2


def test_rule_counters_come_with_the_rows(spark):
    rules = [quality.required("policy_id"), quality.Rule("large", "CAST(incurred_amount AS DOUBLE) > 5000")]
    seen = Observation("rules")
    rows = raw(spark, "claims", {"claim_id": "A"}, {"claim_id": "B", "policy_id": None})
    assert quality.expect(rows.withColumn("incurred_amount", F.lit("10")), rules, seen).count() == 1
    assert seen.get == {"rows": 2, "kept": 1, "policy_id_not_null__passed": 1, "policy_id_not_null__failed": 1, "large__passed": 0, "large__failed": 2}
    metrics = {r.expectation: (r.passed_records, r.failed_records) for r in quality.rule_metrics(rows, rules, "claims").collect()}
    assert metrics == {"policy_id_not_null": (1, 1), "large": (0, 2)}


def test_rules_from_plain_data():
    rules = quality.rules_from_mapping({"expect_or_drop": [{"name": "a", "constraint": "x > 0", "tag": "Completeness"}], "expect": [{"name": "b", "constraint": "y"}]})
    assert [(r.name, r.action, r.tag) for r in rules] == [("a", "drop", "Completeness"), ("b", "warn", "Validity")]
    with pytest.raises(ValueError):
        quality.rules_from_mapping({"require": []})
    assert {k: len(v) for k, v in rulesets.BRONZE.items()} == {"claims_bordereau": 6, "premium_bordereau": 5, "risk_zone_lookup": 3, "cyclone_events": 3}
    assert {k: len(v) for k, v in rulesets.SILVER.items()} == {"claims_snapshots": 12, "policies": 8, "risk_zones": 3, "cyclone_events": 3}
    assert len(rulesets.GOLD) == 6 and all(len(v) == 4 for v in rulesets.GOLD.values())
    assert substitute("SELECT * FROM {silver}.claims", {"silver": "s"}) == "SELECT * FROM s.claims"
    with pytest.raises(KeyError):
        substitute("{gold}", {})


def test_raw_quarantine_reasons(spark):
    rows = apply_hints(raw(
        spark, "claims", {"claim_id": "OK"}, {"claim_id": None}, {"claim_id": None, "snapshot_date": "x"}, {"claim_id": "R", "paid_to_date": "y"}
    ), CLAIMS.hints)
    bad = quality.quarantine_from_raw(rows, "claim_id").collect()
    assert sorted(r.quarantine_reason for r in bad) == ["claim_id_null", "rescued_data", "rescued_data,claim_id_null"]
    assert {json.loads(r._rescued_data)["paid_to_date"] for r in bad if r.claim_id} == {"y"}
    assert quality.clean_from_raw(rows, "claim_id").count() == 2


def test_duplicates_ignore_audit_columns(spark):
    rows = raw(spark, "claims", {"source_file_name": "a"}, {"source_file_name": "b"}, {"claim_id": "X"})
    assert business_columns(rows) == CLAIMS.columns
    assert only(report.find_duplicates(rows)).duplicate_count == 2
    assert only(report.duplicate_summary(rows)).asDict() == {"dupe_groups": 1, "dupe_rows": 2, "rows_to_drop": 1, "total_rows": 3}
    assert only(report.duplicate_summary(rows.limit(0))).asDict() == {"dupe_groups": 0, "dupe_rows": 0, "rows_to_drop": 0, "total_rows": 0}


def test_null_severity_is_strict(spark):
    rows = raw(spark, "claims", *[{"claim_id": None if i < 2 else "C", "policy_id": None if i < 1 else "P"} for i in range(10)])
    found = {r.column: (r.null_count, r.null_pct, r.severity) for r in report.null_analysis(rows).collect()}
    assert found == {"claim_id": (2, 20.0, "HIGH"), "policy_id": (1, 10.0, "MEDIUM")}
    assert report.null_analysis(rows.limit(0)).count() == 0


def test_rules_references_and_issue_table(spark):
    claims = raw(
        spark, "claims", {"claim_id": "OK"}, {"claim_id": "A", "date_of_loss": "03/20/2025"}, {"claim_id": "B", "incurred_amount": "-500", "paid_to_date": "-600"},
        {"claim_id": "C", "paid_to_date": "1500"}, {"claim_id": "D", "policy_id": "GONE"}, {"claim_id": "E", "event_id": "GONE"},
        {"claim_id": "F", "event_id": None}, {"claim_id": "G", "policy_id": None},
    )
    premiums = raw(
        spark, "premiums", {"postcode": "0800"}, {"policy_id": "X", "policy_end_date": "2024-01-01", "postcode": "9999"},
        {"policy_id": "Y", "sum_insured": "0", "postcode": "800"}, {"policy_id": "Z", "annual_premium": "-1", "postcode": "800"},
    )
    events = raw(spark, "cyclone_events", {"start_date": "2025/02/08"}, {"event_id": "B", "start_date": "2025-03-20", "end_date": "2025-03-10"})
    zones = raw(spark, "risk_zones", {"postcode": "800"}, {"postcode": None})
    counts = {r.rule: r.violations for r in report.business_rule_violations(claims, events, premiums).collect()}
    assert list(counts.values()) == [1] * 7, counts
    orphans = {r.rule: r.violations for r in report.referential_violations(claims, events, premiums, zones).collect()}
    assert orphans == {"orphan_claim_policies": 2, "orphan_claim_events": 1, "orphan_premium_postcodes": 1}
    issues = report.issue_table({"claims": claims, "premiums": premiums, "events": events, "zones": zones}).collect()
    assert [r.severity for r in issues] == sorted(r.severity for r in issues)
    found = {(r.table, r.check_type, r.column, r.details) for r in issues}
    assert ("bronze_risk_zone_lookup", "NULL values", "postcode", "1 nulls (50.0% of 2 rows)") in found
    assert (
        "bronze_claims_bordereau", "Business rule", "event_id", "1 claims reference an event_id missing from cyclone_events"
    ) in found
    assert len(issues) == 3 + 7 + 3


def test_lookup_uniqueness_and_conflicts(spark):
    zones = raw(spark, "risk_zones", {}, {}, {"region_name": "Other", "source_file_name": "z"}, {"postcode": "1"}, {"postcode": None}, {"postcode": None})
    assert only(report.key_uniqueness(zones)).asDict() == {"total_rows": 6, "unique_keys": 3, "is_unique": False, "extra_rows": 3}
    assert {r.row_count for r in report.exact_repeats(zones, ["postcode", "region_name", "wind_risk_band"]).collect()} == {2}
    keys = {r.postcode: (r.row_count, r.distinct_region_name) for r in report.repeated_keys(zones, "postcode", ["region_name", "wind_risk_band"]).collect()}
    assert keys == {"4870": (3, 2), None: (2, 1)}
    assert report.conflicting_rows(zones, "postcode", ["region_name", "wind_risk_band"]).count() == 3


def test_monitoring(spark):
    rows = raw(spark, "claims", {"source_file_name": "a"}, {"source_file_name": "b"})
    listed = [
        monitor.Listed("bronze", "claims", rows, "ingestion_timestamp", "source_file_name"),
        monitor.Listed("gold", "empty", rows.limit(0)), monitor.Listed("gold", "full", rows),
    ]
    aged = {r.table_name: r for r in monitor.with_ingest_age(monitor.inventory(listed), F.lit("2025-03-01 13:30:00").cast("timestamp")).collect()}
    assert (aged["claims"].row_count, aged["claims"].ingest_age_hours, aged["full"].ingest_age_hours) == (2, 1.5, None)
    counts = monitor.medallion_counts(listed)
    assert {r.table_name: r.source_file_count for r in counts.collect()} == {"claims": 2, "empty": None, "full": None}
    row = only(monitor.monitoring_counters(counts, "claims", "current"))
    assert (row.bronze_claims_rows, row.silver_current_rows, row.bronze_rows, row.gold_populated) == (2, 0, 2, 1)
    bad = quality.quarantine_from_raw(apply_hints(raw(spark, "claims", {"claim_id": None}, {"claim_id": None}), CLAIMS.hints), "claim_id")
    summary = monitor.quarantine_summary({"claims": bad, "none": bad.limit(0)})
    assert only(summary).row_count == 2 and only(monitor.quarantine_total(summary)).total_quarantine == 2
    assert only(monitor.rows_by(summary, "quarantine_reason")).rows == 2
    assert only(monitor.quarantine_total(summary.limit(0))).total_quarantine == 0
