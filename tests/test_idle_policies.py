"""Policies without a claim are told from the claims as they were and what changed: the claims are not read as they are now."""

from claimlake.operators import changing
from claimlake.operators.changing import CLAIMS, MARTS, POLICIES
from claimlake.sinks.merge_table import MergeTable
from claimlake.sinks.upsert import Upsert


def test_claims_are_read_once_for_idle_policies(spark, tmp_path):
    mart = MARTS["loss_ratio_by_risk"]
    tables = {n: MergeTable(spark, str(tmp_path / n), Upsert((key,), "at")) for n, key in ((CLAIMS, "claim_id"), (POLICIES, "policy_id"))}
    kept = changing.ChangingMart(spark, str(tmp_path / "mart"), mart, tables)
    kept._standing = {CLAIMS, POLICIES}
    named = "policy_id string, " + ", ".join(f"{k} string" for k in mart.keys) + ", annual_premium decimal(18,2)"
    policies = spark.createDataFrame([(p, *[p] * len(mart.keys), n) for p, n in (("p1", 1), ("p2", 2), ("p3", 4), (None, 8))], named.replace("decimal(18,2)", "int"))
    claims = spark.createDataFrame([("c1", "p1"), ("c2", "p3"), ("c3", None)], "claim_id string, policy_id string")
    moved = spark.createDataFrame([("c1", "p1", -1), ("c1", "p2", 1), ("c3", None, -1)], "claim_id string, policy_id string, _weight int")
    parts = kept._idle({CLAIMS: claims, POLICIES: policies}, {POLICIES: policies}, {CLAIMS: moved})
    found = {r[mart.keys[0]]: int(r.idle_premium) for part in parts for r in part.collect()}
    assert found == {"p2": -2, "p1": 1}
