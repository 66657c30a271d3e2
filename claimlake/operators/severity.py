"""Ultimate claim severity: leakage-safe features, a random-forest model, evaluation and scoring.

Everything stays distributed; the model is a Spark ML pipeline.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.functions.casting import retype, safe_double
from claimlake.operators.forest import ForestRegressor
from claimlake.operators.latest import first_and_last, keep_one

# ---- fixed values: the columns of the feature table and how the model uses them ----
FEATURES = (
    "claim_id", "policy_id", "first_incurred", "peril_type", "report_lag_days", "wind_risk_band",
    "building_type", "sum_insured", "mitigation_flag", "region_name", "ultimate_incurred",
)
CATEGORICAL = ("peril_type", "wind_risk_band", "building_type", "mitigation_flag", "region_name")
NUMERIC = ("first_incurred", "report_lag_days", "sum_insured")
CLAIM_INPUTS = (
    "claim_id", "policy_id", "date_of_loss", "reported_date", "peril_type", "claim_status",
    "incurred_amount", "snapshot_date",
)
POLICY_INPUTS = ("policy_id", "wind_risk_band", "building_type", "sum_insured", "mitigation_flag", "region_name")
LABEL = "ultimate_incurred"
PREDICTION = "predicted_ultimate"
# ---- end of fixed values ----


def require_columns(df: DataFrame, names: Sequence[str], what: str) -> None:
    """Name every missing column at once."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} missing columns: {missing}")


def severity_features(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """One row per claim whose latest snapshot with a numeric amount is Closed.

    Predictors come from the first such snapshot only, the label is the latest incurred amount. First and
    latest come from one aggregate, so each claim is shuffled once; open claims leave before the join.
    """
    require_columns(claims, CLAIM_INPUTS, "claims")
    require_columns(policies, POLICY_INPUTS, "policies")
    day = {name: retype(name, "date") for name in ("date_of_loss", "reported_date", "snapshot_date")}
    numeric = claims.select(
        "claim_id", day["snapshot_date"].alias("snapshot_date"), safe_double("incurred_amount").alias("incurred"),
        "policy_id", F.trim("claim_status").alias("status"), "peril_type",
        F.datediff(day["reported_date"], day["date_of_loss"]).alias("lag"),
    ).dropna(subset=["claim_id", "snapshot_date", "incurred"])
    ends = first_and_last(
        numeric, ["claim_id"], ["snapshot_date"],
        first=["incurred", "peril_type", "lag"], last=["incurred", "policy_id", "status"],
    )
    closed = ends.filter("last_status = 'Closed'").select(
        "claim_id",
        F.col("last_policy_id").alias("policy_id"),
        F.col("first_incurred"),
        F.col("first_peril_type").alias("peril_type"),
        F.col("first_lag").alias("report_lag_days"),
        F.col("last_incurred").alias(LABEL),
    )
    insured = policies.select(*POLICY_INPUTS).withColumn("sum_insured", safe_double("sum_insured"))
    one_per_policy = keep_one(insured, ["policy_id"])
    return closed.join(one_per_policy, "policy_id").select(*FEATURES).dropna(subset=list(FEATURES))


def require_rows(df: DataFrame, more_than: int = 1000) -> int:
    """The row count, refused unless it exceeds the gate."""
    rows = df.count()
    if rows <= more_than:
        raise ValueError(f"expected more than {more_than} feature rows, found {rows}")
    return rows


def holdout_split(features: DataFrame, share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, holdout) by a hash of the claim id: the same claims whatever the partitioning."""
    drawn = F.pmod(F.xxhash64("claim_id", F.lit(seed)), F.lit(10_000))
    held = drawn < int(share * 10_000)
    return features.filter(~held), features.filter(held)


def severity_pipeline(trees: int = 100, seed: int = 42, depth: int = 12) -> Pipeline:
    """One-hot categories (unseen ones allowed), numbers as they are, a random forest over all features.

    ``depth`` bounds the trees, and with them the model's size, whatever the number of rows.
    """
    indexed = [f"{c}_index" for c in CATEGORICAL]
    encoded = [f"{c}_onehot" for c in CATEGORICAL]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=list(CATEGORICAL), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep", dropLast=True),
            VectorAssembler(inputCols=[*NUMERIC, *encoded], outputCol="features"),
            ForestRegressor(
                featuresCol="features", labelCol=LABEL, predictionCol=PREDICTION, keyCol="claim_id", numTrees=trees, seed=seed, maxDepth=depth
            ),
        ]
    )


def fit(train: DataFrame, **settings: int) -> PipelineModel:
    return severity_pipeline(**settings).fit(train)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def evaluate(predictions: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """rows, mae, rmse and r2 of a scored holdout in one scan."""
    error = F.col(prediction) - F.col(label)
    squares = F.sum(error * error)
    return predictions.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - squares / F.nullif(F.var_pop(label) * F.count(label), F.lit(0.0))).alias("r2"),
    )


def compare_holdout(predictions: DataFrame) -> DataFrame:
    """Claim keys, first, actual and predicted amounts with the error of each holdout claim."""
    return predictions.select(
        "claim_id", "policy_id", "first_incurred", LABEL, PREDICTION, (F.col(PREDICTION) - F.col(LABEL)).alias("error")
    )


def largest(df: DataFrame, measure: str, k: int = 10) -> DataFrame:
    """The k rows with the greatest measure; ties by claim."""
    return df.orderBy(F.col(measure).desc(), "claim_id").limit(k)


def triage(scored: DataFrame, prediction: str = PREDICTION) -> DataFrame:
    """Uplift over the first amount (at least one) and the absolute error of every scored claim."""
    kept = ["claim_id", "policy_id", "first_incurred", LABEL, "peril_type", "wind_risk_band", "building_type", "region_name"]
    first = F.greatest(F.col("first_incurred"), F.lit(1.0))
    return scored.select(
        *kept,
        F.col(prediction).alias(PREDICTION),
        (F.col(prediction) / first).alias("uplift_vs_first"),
        F.abs(F.col(prediction) - F.col(LABEL)).alias("abs_error"),
    )


def batch_score(model: PipelineModel, features: DataFrame) -> DataFrame:
    return triage(model.transform(features))
