"""Dashboard roll-ups over the marts.

Ratios are recomputed from sums and never averaged; means are weighted by their counts. ``only`` keeps
the rows whose dimensions take the chosen values before anything is added up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def only(df: DataFrame, choices: Mapping[str, Sequence[str]]) -> DataFrame:
    """Multi-select filters: an empty choice keeps everything."""
    for name, values in choices.items():
        if values:
            df = df.filter(F.col(name).isin(list(values)))
    return df


def choices_of(df: DataFrame, dimension: str) -> DataFrame:
    """The values a filter offers and how many mart rows carry each."""
    return df.groupBy(dimension).agg(F.count(F.lit(1)).alias("rows"))


def added(name: str) -> Column:
    return F.sum(name)


def share(part: str, whole: str, digits: int = 2) -> Column:
    return F.round(F.sum(part) / F.nullif(F.sum(whole), F.lit(0)) * 100, digits)


def per(total: str, count: str, digits: int = 2) -> Column:
    return F.round(F.sum(total) / F.nullif(F.sum(count), F.lit(0)), digits)


def weighted(value: str, weight: str, digits: int = 1) -> Column:
    """Count-weighted mean of group means, added up in decimals so that the order of rows cannot matter."""
    total = F.sum(F.col(value).cast("decimal(18,6)") * F.col(weight))
    return F.round(total / F.nullif(F.sum(weight), F.lit(0)), digits).cast("double")


def roll_up(df: DataFrame, by: Sequence[str], **measures: Column) -> DataFrame:
    named = [measure.alias(name) for name, measure in measures.items()]
    return df.groupBy(*by).agg(*named) if by else df.agg(*named)


# ---- claims operations, over the claims summary ----


def claims_totals(summary: DataFrame) -> DataFrame:
    return roll_up(
        summary, [],
        sum_claims=added("claim_count"), sum_incurred=added("total_incurred"),
        sum_reserve=added("outstanding_reserve"), settlement=share("total_paid", "total_incurred"),
    )


def claims_by_status(summary: DataFrame) -> DataFrame:
    return roll_up(summary, ["claim_status"], claims=added("claim_count"))


def frequency_severity_by_peril(summary: DataFrame) -> DataFrame:
    return roll_up(
        summary, ["peril_type"], claim_count=added("claim_count"), avg_severity=per("total_incurred", "claim_count")
    )


def severity_by_peril(summary: DataFrame) -> DataFrame:
    return frequency_severity_by_peril(summary).drop("claim_count")


def reserve_by_region(summary: DataFrame) -> DataFrame:
    return roll_up(summary, ["region_name"], outstanding_reserve=added("outstanding_reserve"))


def settlement_by_peril(summary: DataFrame) -> DataFrame:
    return roll_up(summary, ["peril_type"], settlement_pct=share("total_paid", "total_incurred"))


# ---- catastrophes, over the event loss summary ----


def name_events(event_losses: DataFrame) -> DataFrame:
    """Claims without a known event under the name dashboards show for them."""
    return event_losses.withColumn("event_name", F.coalesce("event_name", F.lit("Non-Catastrophe")))


def catastrophe_totals(event_losses: DataFrame) -> DataFrame:
    def incurred(category: str) -> Column:
        return F.sum(F.when(F.col("claim_category") == category, F.col("total_incurred")).otherwise(0))

    return roll_up(
        event_losses, [],
        cat_incurred=incurred("Catastrophe"), noncat_incurred=incurred("Non-Catastrophe"), sum_claims=added("claim_count"),
    )


def incurred_by_category(event_losses: DataFrame) -> DataFrame:
    return roll_up(event_losses, ["claim_category"], incurred=added("total_incurred"))


def incurred_by_event(event_losses: DataFrame) -> DataFrame:
    return roll_up(event_losses, ["event_name"], total_incurred=added("total_incurred"))


def severity_by_event(event_losses: DataFrame) -> DataFrame:
    return roll_up(
        event_losses, ["event_name"],
        avg_severity=per("total_incurred", "claim_count"), max_severity=F.max("max_claim_severity"),
    )


def paid_and_reserve_by_event(event_losses: DataFrame) -> DataFrame:
    return roll_up(
        event_losses, ["event_name"], total_paid=added("total_paid"), outstanding_reserve=added("outstanding_reserve")
    )


# ---- development, over the claims development mart ----


def development_totals(development: DataFrame) -> DataFrame:
    return roll_up(
        development, [],
        avg_lag=weighted("avg_reporting_lag_days", "claim_count"), sum_reserve=added("outstanding_reserve"),
        payment_progress=share("total_paid", "total_incurred"),
    )


def lag_by_month(development: DataFrame) -> DataFrame:
    return roll_up(development, ["loss_month"], avg_lag=weighted("avg_reporting_lag_days", "claim_count"))


def incurred_and_paid_by_month(development: DataFrame) -> DataFrame:
    return roll_up(development, ["loss_month"], total_incurred=added("total_incurred"), total_paid=added("total_paid"))


def progress_by_peril(development: DataFrame) -> DataFrame:
    return roll_up(development, ["peril_type"], payment_progress_pct=share("total_paid", "total_incurred"))


def max_lag_by(development: DataFrame, dimension: str) -> DataFrame:
    return roll_up(development, [dimension], max_lag=F.max("max_reporting_lag_days"))


# ---- underwriting, over the loss ratio, exposure and risk-band marts ----


def premium_totals(loss_ratio: DataFrame) -> DataFrame:
    return roll_up(
        loss_ratio, [],
        sum_premium=added("total_premium"), sum_policies=added("policy_count"),
        overall_lr=share("total_incurred", "total_premium"),
    )


def loss_ratio_by(loss_ratio: DataFrame, *dimensions: str) -> DataFrame:
    return roll_up(loss_ratio, list(dimensions), loss_ratio=share("total_incurred", "total_premium"))


def sum_insured_total(exposure: DataFrame) -> DataFrame:
    return roll_up(exposure, [], sum_si=added("total_sum_insured"))


def sum_insured_by_insurer(exposure: DataFrame) -> DataFrame:
    return roll_up(exposure, ["insurer_name"], sum_insured=added("total_sum_insured"))


def exposure_by_band(exposure: DataFrame) -> DataFrame:
    return roll_up(
        exposure, ["wind_risk_band"],
        total_sum_insured=added("total_sum_insured"), total_annual_premium=added("total_annual_premium"),
        premium_rate_pct=share("total_annual_premium", "total_sum_insured", 4),
    )


def claim_frequency_by_band(risk_band: DataFrame) -> DataFrame:
    return roll_up(risk_band, ["wind_risk_band", "region_name"], claim_frequency=per("claim_count", "policy_count", 4))
