"""Dashboard roll-ups over the marts of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from claimlake.operators import rollups as u
from claimlake.workload import mart_queries as m
from claimlake.workload.oracle import half_up, money, quotient, shorten, with_silver
from claimlake.workload.registry import query


def coarse_percent(num: str, den: str, digits: int = 2) -> str:
    """100 * num / den from a six-digit quotient."""
    scaled = quotient(num, den, 6) + " * 100"
    return f"CAST({shorten(scaled, 6 - digits)} AS DOUBLE) / {10**digits}.0"


def coarse_mean(cents: str, count: str) -> str:
    """Mean of money from a six-digit quotient, to two digits."""
    return f"CAST({shorten(quotient(cents, count, 4), 4)} AS DOUBLE) / 100.0"


CLAIMS = "current_claims c LEFT JOIN silver_premiums p ON c.policy_id = p.policy_id"
EVENTS = "current_claims c LEFT JOIN silver_events e ON c.event_id = e.event_id LEFT JOIN silver_premiums p ON c.policy_id = p.policy_id"
PREMIUMS = "silver_premiums p LEFT JOIN current_claims c ON c.policy_id = p.policy_id"
EXPOSED = "silver_premiums p JOIN silver_zones z ON p.postcode = z.postcode"
CATEGORY = "CASE WHEN c.event_id IS NOT NULL THEN 'Catastrophe' ELSE 'Non-Catastrophe' END"
EVENT = "coalesce(e.event_name, 'Non-Catastrophe')"
DEVELOPMENT = f"""development AS (
  SELECT date_trunc('month', date_of_loss) AS loss_month, count(*) AS n,
    {quotient('sum(reported_date - date_of_loss)', 'count(*)', 1)} AS lag10
  FROM {CLAIMS} GROUP BY peril_type, region_name, wind_risk_band, date_trunc('month', date_of_loss), date_trunc('month', reported_date))"""
WEIGHTED = f"CAST({shorten(quotient('sum(lag10 * n)', '10 * sum(n)', 6), 5)} AS DOUBLE) / 10.0"
LOSS_RATIO = coarse_percent("coalesce(sum(incurred), 0)", "sum(premium)")


def dash(
    name: str,
    mart: Callable[..., DataFrame],
    roll_up: Callable[[DataFrame], DataFrame],
    columns: str,
    source: str,
    *ctes: str,
    where: str = "",
) -> None:
    """Register ``roll_up(mart)`` against ``SELECT columns FROM source GROUP BY ALL``."""
    sql = with_silver(f"SELECT {columns} FROM {source} {where} GROUP BY ALL", *ctes)
    query(f"dashboard_{name}", sql)(lambda spark, folder: roll_up(mart(spark, folder)))


def _events(spark, folder):
    return u.name_events(m.event_loss_summary(spark, folder))


SUMMARY = m.claims_summary_current
SETTLED = coarse_percent("sum(paid)", "sum(incurred)")
SEVERITY = coarse_mean("sum(incurred)", "count(*)")
RESERVE = money("sum(incurred - paid)")

dash(
    "claims_totals", SUMMARY, u.claims_totals,
    f"count(*) AS sum_claims, {money('sum(incurred)')} AS sum_incurred, {RESERVE} AS sum_reserve, {SETTLED} AS settlement", CLAIMS,
)
dash("claims_by_status", SUMMARY, u.claims_by_status, "claim_status, count(*) AS claims", CLAIMS)
dash(
    "frequency_severity_by_peril", SUMMARY, u.frequency_severity_by_peril,
    f"peril_type, count(*) AS claim_count, {SEVERITY} AS avg_severity", CLAIMS,
)
dash("severity_by_peril", SUMMARY, u.severity_by_peril, f"peril_type, {SEVERITY} AS avg_severity", CLAIMS)
dash("reserve_by_region", SUMMARY, u.reserve_by_region, f"region_name, {RESERVE} AS outstanding_reserve", CLAIMS)
dash("settlement_by_peril", SUMMARY, u.settlement_by_peril, f"peril_type, {SETTLED} AS settlement_pct", CLAIMS)
dash(
    "filtered_settlement", SUMMARY,
    lambda mart: u.settlement_by_peril(u.only(mart, {"claim_status": ["Open", "Reopened"], "region_name": ["NATION_1", "NATION_2"], "peril_type": []})),
    f"peril_type, {SETTLED} AS settlement_pct", CLAIMS,
    where="WHERE claim_status IN ('Open', 'Reopened') AND region_name IN ('NATION_1', 'NATION_2')",
)
dash(
    "filter_values", SUMMARY, lambda mart: u.choices_of(mart, "claim_status"),
    "claim_status, count(*) AS rows",
    f"(SELECT DISTINCT peril_type, claim_status, region_name, wind_risk_band, building_type FROM {CLAIMS})",
)

dash(
    "catastrophe_totals", _events, u.catastrophe_totals,
    f"""{money("coalesce(sum(incurred) FILTER (c.event_id IS NOT NULL), 0)")} AS cat_incurred,
    {money("coalesce(sum(incurred) FILTER (c.event_id IS NULL), 0)")} AS noncat_incurred, count(*) AS sum_claims""", EVENTS,
)
dash("incurred_by_category", _events, u.incurred_by_category, f"{CATEGORY} AS claim_category, {money('sum(incurred)')} AS incurred", EVENTS)
dash("incurred_by_event", _events, u.incurred_by_event, f"{EVENT} AS event_name, {money('sum(incurred)')} AS total_incurred", EVENTS)
dash(
    "severity_by_event", _events, u.severity_by_event,
    f"{EVENT} AS event_name, {SEVERITY} AS avg_severity, {money('max(incurred)')} AS max_severity", EVENTS,
)
dash(
    "paid_and_reserve_by_event", _events, u.paid_and_reserve_by_event,
    f"{EVENT} AS event_name, {money('sum(paid)')} AS total_paid, {RESERVE} AS outstanding_reserve", EVENTS,
)

MONTH = "CAST(date_trunc('month', date_of_loss) AS DATE) AS loss_month"
dash(
    "development_totals", m.claims_development, u.development_totals,
    f"""(SELECT {WEIGHTED} FROM development) AS avg_lag, {RESERVE} AS sum_reserve, {SETTLED} AS payment_progress""", CLAIMS, DEVELOPMENT,
)
dash(
    "lag_by_month", m.claims_development, u.lag_by_month,
    f"CAST(loss_month AS DATE) AS loss_month, {WEIGHTED} AS avg_lag", "development", DEVELOPMENT,
)
dash(
    "incurred_and_paid_by_month", m.claims_development, u.incurred_and_paid_by_month,
    f"{MONTH}, {money('sum(incurred)')} AS total_incurred, {money('sum(paid)')} AS total_paid", CLAIMS,
)
dash("progress_by_peril", m.claims_development, u.progress_by_peril, f"peril_type, {SETTLED} AS payment_progress_pct", CLAIMS)
for _dimension in ("region_name", "wind_risk_band"):
    dash(
        f"max_lag_by_{_dimension}", m.claims_development, lambda mart, d=_dimension: u.max_lag_by(mart, d),
        f"{_dimension}, CAST(max(reported_date - date_of_loss) AS INTEGER) AS max_lag", CLAIMS,
    )

dash(
    "premium_totals", m.loss_ratio_by_risk, u.premium_totals,
    f"{money('sum(premium)')} AS sum_premium, count(DISTINCT p.policy_id) AS sum_policies, {LOSS_RATIO} AS overall_lr", PREMIUMS,
)
for _dimensions in (("wind_risk_band",), ("region_name",), ("building_type", "mitigation_flag")):
    dash(
        f"loss_ratio_by_{'_and_'.join(_dimensions)}", m.loss_ratio_by_risk,
        lambda mart, d=_dimensions: u.loss_ratio_by(mart, *d), f"{', '.join(_dimensions)}, {LOSS_RATIO} AS loss_ratio", PREMIUMS,
    )
dash("sum_insured_total", m.portfolio_exposure, u.sum_insured_total, f"{money('sum(insured)')} AS sum_si", EXPOSED)
dash(
    "sum_insured_by_insurer", m.portfolio_exposure, u.sum_insured_by_insurer,
    f"insurer_name, {money('sum(insured)')} AS sum_insured", EXPOSED,
)
dash(
    "exposure_by_band", m.portfolio_exposure, u.exposure_by_band,
    f"""p.wind_risk_band, {money('sum(insured)')} AS total_sum_insured, {money('sum(premium)')} AS total_annual_premium,
    {coarse_percent('sum(premium)', 'sum(insured)', 4)} AS premium_rate_pct""", EXPOSED,
)
dash(
    "claim_frequency_by_band", m.risk_band_performance, u.claim_frequency_by_band,
    f"wind_risk_band, region_name, {half_up('count(c.claim_id)', 'count(DISTINCT p.policy_id)', 4)} AS claim_frequency", PREMIUMS,
)
