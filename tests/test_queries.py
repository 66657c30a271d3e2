"""The registered queries: complete, named alike in both languages, and equal on the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from claimlake.workload import QUERIES, SQL
from tests.oracle_check import connect, differences

DATA = Path("/root/testdata/sf0.001")
WITHOUT_SQL = {"severity_model_quality", "severity_largest_losses", "severity_scores"}
CHECKED = [
    "claims_current", "mart_claims_summary", "mart_claims_summary_distinct", "mart_loss_ratio_by_risk", "mart_policy_loss_ratio",
    "mart_event_loss_summary_extended", "mart_portfolio_exposure_repeated_zones", "mart_claims_development", "report_issue_table",
    "rules_quarantined_claims", "parse_messages", "log_update_runs", "log_flow_metrics", "severity_features", "stream_claims_upsert",
]

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")


def test_every_query_but_the_model_has_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL and set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns[:2] == ["peril_type", "claim_status"] and df.count() > 0


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, name):
    problem = differences(spark, connect(str(DATA)), str(DATA), name, queries()[name], oracle_sql()[name])
    assert problem is None, problem


def test_severity_scores_gives_every_feature_row(spark):
    scored = queries()["severity_scores"](spark, str(DATA))
    assert scored.count() == queries()["severity_features"](spark, str(DATA)).count() > 0
    assert scored.where("predicted_ultimate IS NULL").count() == 0
