"""Severity features, model quality and scores over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlake.operators import severity as v
from claimlake.session import work_path
from claimlake.workload import tables as t
from claimlake.workload.oracle import with_raw
from claimlake.workload.registry import query

FEATURES_SQL = """numeric AS (SELECT *, reported_date - date_of_loss AS lag FROM raw_claims WHERE claim_id IS NOT NULL AND incurred IS NOT NULL),
first_rows AS (SELECT * FROM numeric QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY snapshot_date, incurred,
  policy_id NULLS FIRST, claim_status, peril_type NULLS FIRST, lag NULLS FIRST) = 1),
last_rows AS (SELECT * FROM numeric QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY snapshot_date DESC, incurred DESC,
  policy_id DESC NULLS LAST, claim_status DESC, peril_type DESC NULLS LAST, lag DESC NULLS LAST) = 1),
features AS (SELECT l.claim_id, l.policy_id, f.incurred / 100.0 AS first_incurred, f.peril_type, CAST(f.lag AS INTEGER) AS report_lag_days,
  wind_risk_band, building_type, insured / 100.0 AS sum_insured, mitigation_flag, region_name, l.incurred / 100.0 AS ultimate_incurred
  FROM last_rows l JOIN first_rows f ON l.claim_id = f.claim_id JOIN raw_premiums p ON l.policy_id = p.policy_id
  WHERE l.claim_status = 'Closed' AND f.peril_type IS NOT NULL AND f.lag IS NOT NULL)"""


def features(spark, folder):
    return v.severity_features(t.derived_once(t.raw_claims(spark, folder)), t.raw_premiums(spark, folder))


@query("severity_features", with_raw("SELECT * FROM features", FEATURES_SQL))
def _(spark, folder):
    return features(spark, folder)


@query(
    "severity_triage",
    with_raw(
        """SELECT claim_id, policy_id, first_incurred, ultimate_incurred, peril_type, wind_risk_band, building_type, region_name,
        first_incurred * 2 AS predicted_ultimate, first_incurred * 2 / greatest(first_incurred, 1.0) AS uplift_vs_first,
        abs(first_incurred * 2 - ultimate_incurred) AS abs_error FROM features""",
        FEATURES_SQL,
    ),
)
def _(spark, folder):
    # A fixed rule in place of the model, so that the figures around a prediction can be checked.
    return v.triage(features(spark, folder).withColumn(v.PREDICTION, F.col("first_incurred") * 2))


def _stored_features(spark, folder):
    """The feature table is written once: fitting reads it many times."""
    path = work_path(spark, "severity-features")
    features(spark, folder).write.parquet(path)
    return spark.read.parquet(path)


@query("severity_model_quality")
def _(spark, folder):
    train, held = v.holdout_split(_stored_features(spark, folder))
    return v.evaluate(v.fit(train).transform(held))


@query("severity_largest_losses")
def _(spark, folder):
    train, held = v.holdout_split(_stored_features(spark, folder))
    return v.largest(v.compare_holdout(v.fit(train).transform(held)), v.LABEL)


@query("severity_scores")
def _(spark, folder):
    stored = _stored_features(spark, folder)
    path = work_path(spark, "severity-model")
    v.save_model(v.fit(v.holdout_split(stored)[0]), path)
    return v.batch_score(v.load_model(path), stored)
