"""Rule sets of the claims medallion, by layer and dataset.

Names, predicates, severities and tags are fixed values of the bordereau contracts.
"""

from __future__ import annotations

from claimlake.operators.quality import DROP, WARN, Rule, at_least_zero, filled, one_of, required
from claimlake.schemas import BUILDING_TYPES, CLAIM_STATUSES, PERIL_TYPES, RISK_BANDS


def _bronze(keys: tuple[str, ...], soft: tuple[str, ...]) -> list[Rule]:
    return [filled(c, DROP, "not_null") for c in keys] + [filled(c, WARN, "not_empty") for c in soft]


def _gold(hard: list[Rule], soft: tuple[str, ...]) -> list[Rule]:
    return hard + [at_least_zero(c) for c in soft]


def _ordered(name: str, earlier: str, later: str, tag: str = "Validity") -> Rule:
    return Rule(name, f"{later} >= {earlier}", WARN, tag)


BRONZE = {
    "claims_bordereau": _bronze(
        ("claim_id", "policy_id", "snapshot_date"), ("date_of_loss", "peril_type", "claim_status")
    ),
    "premium_bordereau": _bronze(
        ("policy_id",), ("sum_insured", "annual_premium", "policy_start_date", "policy_end_date")
    ),
    "risk_zone_lookup": _bronze(("postcode",), ("wind_risk_band", "region_name")),
    "cyclone_events": _bronze(("event_id",), ("start_date", "end_date")),
}

SILVER = {
    "claims_snapshots": [
        *[required(c) for c in ("claim_id", "policy_id", "snapshot_date", "date_of_loss")],
        Rule("incurred_gte_paid", "incurred_amount >= paid_to_date", DROP),
        at_least_zero("incurred_amount", name="non_negative_incurred"),
        at_least_zero("paid_to_date", name="non_negative_paid"),
        _ordered("reported_on_or_after_loss", "date_of_loss", "reported_date"),
        _ordered("snapshot_on_or_after_loss", "date_of_loss", "snapshot_date", "Consistency"),
        _ordered("snapshot_on_or_after_reported", "reported_date", "snapshot_date", "Consistency"),
        one_of("claim_status", CLAIM_STATUSES),
        one_of("peril_type", PERIL_TYPES),
    ],
    "policies": [
        required("policy_id"),
        Rule("positive_sum_insured", "sum_insured > 0"),
        Rule("positive_annual_premium", "annual_premium > 0"),
        Rule("policy_start_before_end", "policy_start_date < policy_end_date"),
        Rule("dates_not_null", "policy_start_date IS NOT NULL AND policy_end_date IS NOT NULL", WARN, "Completeness"),
        one_of("wind_risk_band", RISK_BANDS),
        one_of("building_type", BUILDING_TYPES),
        Rule("premium_lte_sum_insured", "annual_premium <= sum_insured", WARN, "Consistency"),
    ],
    "risk_zones": [required("postcode"), required("wind_risk_band", WARN), one_of("wind_risk_band", RISK_BANDS)],
    "cyclone_events": [
        required("event_id"),
        Rule("start_on_or_before_end", "start_date <= end_date"),
        Rule("dates_not_null", "start_date IS NOT NULL AND end_date IS NOT NULL", WARN, "Completeness"),
    ],
}

_CLAIM_MONEY = ("total_incurred", "total_paid")

GOLD = {
    "claims_summary": _gold([required("peril_type"), at_least_zero("claim_count", DROP)], _CLAIM_MONEY),
    "claims_development": _gold([required("peril_type"), at_least_zero("claim_count", DROP)], _CLAIM_MONEY),
    "event_loss_summary": _gold([required("claim_category"), at_least_zero("claim_count", DROP)], _CLAIM_MONEY),
    "policy_loss_ratio": _gold(
        [at_least_zero("policy_count", DROP), at_least_zero("claim_count", DROP)], ("total_premium", "total_incurred")
    ),
    "portfolio_exposure": _gold(
        [at_least_zero("policy_count", DROP), required("insurer_name")], ("total_sum_insured", "total_annual_premium")
    ),
    "risk_band_performance": _gold(
        [required("wind_risk_band"), at_least_zero("policy_count", DROP)], ("claim_count", "total_incurred")
    ),
}
