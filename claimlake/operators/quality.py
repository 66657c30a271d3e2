"""Named row rules: keep and count, drop and count, or split off to quarantine.

A rule that evaluates to NULL counts as failed. All rules of a set are evaluated in one pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from claimlake.functions.casting import now_or

DROP = "drop"
WARN = "warn"


@dataclass(frozen=True)
class Rule:
    """A named predicate in Spark SQL, what its failure means, and the quality dimension it belongs to."""

    name: str
    predicate: str
    action: str = WARN
    tag: str = "Validity"

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def required(column: str, action: str = DROP) -> Rule:
    return Rule(f"{column}_not_null", f"{column} IS NOT NULL", action, "Completeness")


def filled(column: str, action: str, suffix: str) -> Rule:
    """Text that is neither NULL nor blank."""
    return Rule(f"{column}_{suffix}", f"{column} IS NOT NULL AND length(trim({column})) > 0", action, "Completeness")


def one_of(column: str, values: Sequence[str]) -> Rule:
    listed = ", ".join(f"'{value}'" for value in values)
    return Rule(f"valid_{column}", f"{column} IN ({listed})")


def at_least_zero(column: str, action: str = WARN, name: str | None = None) -> Rule:
    return Rule(name or f"non_negative_{column}", f"{column} >= 0", action)


def rules_from_mapping(sections: dict[str, list[dict[str, str]]]) -> list[Rule]:
    """Rules from a declared set: ``expect_or_drop`` and ``expect`` lists of name, constraint and tag."""
    actions = {"expect_or_drop": DROP, "expect": WARN}
    unknown = set(sections) - set(actions)
    if unknown:
        raise ValueError(f"unknown rule sections: {sorted(unknown)}")
    return [
        Rule(item["name"], item["constraint"], actions[section], item.get("tag", "Validity"))
        for section, items in sections.items()
        for item in items
    ]


def all_pass(rules: Iterable[Rule]) -> Column:
    verdict = F.lit(True)
    for rule in rules:
        verdict = verdict & rule.passes()
    return verdict


def failed_names(rules: Iterable[Rule]) -> Column:
    """Comma-joined names of the rules a row fails, empty when it passes all."""
    return F.concat_ws(",", *[F.when(~rule.passes(), F.lit(rule.name)) for rule in rules])


def drop_failing(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass every hard rule; soft rules never remove a row."""
    return df.filter(all_pass(rule for rule in rules if rule.action == DROP))


def split(df: DataFrame, rules: Sequence[Rule], clock: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined): quarantine takes rows failing any rule, only hard failures leave the table."""
    quarantined = (
        df.filter(~all_pass(rules))
        .withColumn("quarantine_reason", failed_names(rules))
        .withColumn("_quarantine_ts", now_or(clock))
    )
    return drop_failing(df, rules), quarantined


CLEAN, SOFT, HARD = "clean", "soft", "hard"
VERDICT = "_verdict"


def judge(df: DataFrame, rules: Sequence[Rule], clock: Column | None = None) -> DataFrame:
    """Every row with its verdict (clean, soft or hard), its reasons and, if any, the time it was judged.

    Written once and partitioned by the verdict, this is both the table (all but hard) and its quarantine
    (all but clean): the input is read once and rows failing only soft rules are stored once.
    """
    hard = ~all_pass(rule for rule in rules if rule.action == DROP)
    reasons = failed_names(rules)
    return df.withColumns(
        {
            "quarantine_reason": F.nullif(reasons, F.lit("")),
            "_quarantine_ts": F.when(reasons != "", now_or(clock)),
            VERDICT: F.when(hard, HARD).when(reasons != "", SOFT).otherwise(CLEAN),
        }
    )


def kept_of(judged: DataFrame) -> DataFrame:
    """The table: rows without a hard failure, as they came."""
    return judged.filter(F.col(VERDICT) != HARD).drop("quarantine_reason", "_quarantine_ts", VERDICT)


def quarantine_of(judged: DataFrame) -> DataFrame:
    """The quarantine: rows failing any rule, with reason and time."""
    return judged.filter(F.col(VERDICT) != CLEAN).drop(VERDICT)


def rule_counts(rules: Sequence[Rule]) -> list[Column]:
    """Passed and failed counters of every rule, each predicate evaluated once per row."""
    rows = F.count(F.lit(1))
    counters = []
    for rule in rules:
        passed = F.count_if(rule.passes())
        counters += [passed.alias(f"{rule.name}__passed"), (rows - passed).alias(f"{rule.name}__failed")]
    return counters


def flow_counts(rules: Sequence[Rule]) -> list[Column]:
    """``rows`` read, ``kept`` ones that pass every hard rule, and the counters of each rule."""
    kept = all_pass(rule for rule in rules if rule.action == DROP)
    return [F.count(F.lit(1)).alias("rows"), F.count_if(kept).alias("kept"), *rule_counts(rules)]


def observe_rules(df: DataFrame, rules: Sequence[Rule], observation: Observation | str) -> DataFrame:
    """Let the rule counters be collected while the rows flow on, batch or stream, without a second read."""
    return df.observe(observation, *flow_counts(rules))


def expect(df: DataFrame, rules: Sequence[Rule], observation: Observation | str) -> DataFrame:
    """Count all rules, then drop the hard failures."""
    return drop_failing(observe_rules(df, rules, observation), rules)


def rule_metrics(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """(dataset, expectation, action, tag, passed_records, failed_records), one row per rule, one scan."""
    totals = df.agg(*rule_counts(rules))
    rows = F.array(
        *[
            F.struct(
                F.lit(dataset).alias("dataset"),
                F.lit(rule.name).alias("expectation"),
                F.lit(rule.action).alias("action"),
                F.lit(rule.tag).alias("tag"),
                F.col(f"{rule.name}__passed").alias("passed_records"),
                F.col(f"{rule.name}__failed").alias("failed_records"),
            )
            for rule in rules
        ]
    )
    return totals.select(F.inline(rows))


# ---- key and parse quarantine on raw rows ----


def bad_key_or_error(key: str, error: str) -> Column:
    """Rows without a business key or with something in the error column (rescued text, parse error)."""
    return F.col(error).isNotNull() | F.col(key).isNull()


def quarantine_reason(key: str, error: str, label: str | None = None) -> Column:
    """Comma-joined reasons: the error (its own text, or a fixed label) and ``<key>_null``."""
    text = F.lit(label) if label else F.col(error)
    return F.concat_ws(",", F.when(F.col(error).isNotNull(), text), F.when(F.col(key).isNull(), F.lit(f"{key}_null")))


def quarantine_from_raw(
    raw: DataFrame,
    key: str,
    *,
    error: str = "_rescued_data",
    label: str | None = "rescued_data",
    clock: Column | None = None,
) -> DataFrame:
    """The bad rows of a raw table or stream with their reason and time."""
    return (
        raw.filter(bad_key_or_error(key, error))
        .withColumn("quarantine_reason", quarantine_reason(key, error, label))
        .withColumn("_quarantine_ts", now_or(clock))
    )


def message_quarantine(raw: DataFrame, key: str, clock: Column | None = None) -> DataFrame:
    """Quarantine of parsed messages, whose error column carries the reason itself."""
    return quarantine_from_raw(raw, key, error="_parse_error", label=None, clock=clock)


def clean_from_raw(raw: DataFrame, key: str) -> DataFrame:
    """Raw rows with a business key; a rescued row that has its key stays."""
    return raw.filter(F.col(key).isNotNull())


# ---- silver filters ----


def complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every listed column."""
    return df.dropna(subset=list(columns))


def claims_quality(typed: DataFrame) -> DataFrame:
    """Complete claims (the event may be NULL), reported after the loss, 0 <= incurred, paid <= incurred."""
    known = [
        "claim_id", "policy_id", "date_of_loss", "reported_date",
        "peril_type", "claim_status", "incurred_amount", "paid_to_date",
    ]
    return complete(typed, known).filter(
        "date_of_loss <= reported_date AND incurred_amount >= 0 AND paid_to_date <= incurred_amount"
    )


def premiums_quality(typed: DataFrame) -> DataFrame:
    """Complete policies with a term of at least a day, an insured sum and a premium."""
    known = [
        "policy_id", "insurer_name", "postcode", "region_name", "wind_risk_band", "building_type",
        "sum_insured", "mitigation_flag", "annual_premium", "policy_start_date", "policy_end_date",
    ]
    return complete(typed, known).filter(
        "policy_start_date < policy_end_date AND sum_insured > 0 AND annual_premium > 0"
    )


def events_quality(typed: DataFrame) -> DataFrame:
    """Named events with both dates in order."""
    return complete(typed, ["event_id", "event_name", "start_date", "end_date"]).filter("start_date <= end_date")
