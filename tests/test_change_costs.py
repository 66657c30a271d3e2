"""Change feeds shuffle rows without their states, and marts keep the maxima that they read."""

import pytest
from pyspark.sql import types as T

from claimlake.operators import changing
from claimlake.sinks.merge_table import MergeTable
from claimlake.sinks.upsert import Upsert


def test_changes_are_shuffled_before_states_are_made(spark, tmp_path):
    table = MergeTable(spark, str(tmp_path / "t"), Upsert(("k",), "seq", buckets=2))
    for number in range(3):
        table.upsert(spark.createDataFrame([("a", "1", number), ("b", "2", 0)], "k string, v string, seq int"), number)
    lines = table.changes(1, 3)._jdf.queryExecution().executedPlan().toString().splitlines()
    (exchange,) = [n for n, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert not any("struct(" in line for line in lines[exchange + 1 :]) and any("struct(" in line for line in lines[:exchange])
    found = sorted(tuple(r) for r in table.changes(1, 3).select("_change_type", "k", "seq").collect())
    assert found == [("update_postimage", "a", 1), ("update_postimage", "a", 2), ("update_preimage", "a", 0), ("update_preimage", "a", 1)]


@pytest.mark.parametrize("name", changing.MARTS)
def test_a_mart_keeps_the_maxima_that_it_reads(spark, tmp_path, name):
    mart = changing.MARTS[name]
    claims = "claim_id string, policy_id string, event_id string, date_of_loss date, reported_date date, peril_type string, claim_status string, incurred_amount decimal(18,2), paid_to_date decimal(18,2), at int"
    schemas = {
        "claims": (claims, "claim_id"),
        "policies": ("policy_id string, insurer_name string, mitigation_flag string, region_name string, wind_risk_band string, building_type string, postcode int, sum_insured decimal(18,2), annual_premium decimal(18,2), at int", "policy_id"),
        "events": ("event_id string, event_name string, start_date date, end_date date, at int", "event_id"),
        "zones": ("postcode int, at int", "postcode"),
    }
    tables = {}
    for n in mart.tables:
        schema, key = schemas[n]
        tables[n] = MergeTable(spark, str(tmp_path / n), Upsert((key,), "at", buckets=2, except_columns=("at",)))
        fields = T.StructType.fromDDL(schema).fields
        row = [1 if f.dataType.simpleString() == "int" else "1" if f.dataType.simpleString() == "string" else None for f in fields]
        tables[n].upsert(spark.createDataFrame([tuple(row)], schema), 1)
    kept = changing.ChangingMart(spark, str(tmp_path / "mart"), mart, tables, buckets=2)
    kept.refresh()
    assert {c for c in kept.state.read().columns if c in changing.MAXIMA} == set(mart.maxima)
    assert kept.read().count() == 1
