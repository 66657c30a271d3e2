"""Marts kept up with changes equal a full run over the tables as they are, whatever changed in between."""

import random
from decimal import Decimal

import pytest

from claimlake.operators import changing, marts
from claimlake.operators.changing import CLAIMS, EVENTS, MARTS, POLICIES, ZONES
from claimlake.sinks.merge_table import MergeTable
from claimlake.sinks.upsert import Upsert

MONEY = "decimal(18,2)"
SCHEMAS = {
    CLAIMS: f"claim_id string, policy_id string, event_id string, date_of_loss date, reported_date date, peril_type string, claim_status string, incurred_amount {MONEY}, paid_to_date {MONEY}, at int",
    POLICIES: f"policy_id string, insurer_name string, postcode int, region_name string, wind_risk_band string, building_type string, sum_insured {MONEY}, mitigation_flag string, annual_premium {MONEY}, at int",
    EVENTS: "event_id string, event_name string, start_date date, end_date date, at int",
    ZONES: "postcode int, region_name string, at int",
}
KEYS = {CLAIMS: "claim_id", POLICIES: "policy_id", EVENTS: "event_id", ZONES: "postcode"}
GONE = {CLAIMS: "claim_status = 'gone'", POLICIES: "insurer_name = 'gone'", EVENTS: "event_name = 'gone'", ZONES: "region_name = 'gone'"}


def batch(rng, number):
    import datetime

    day = lambda: datetime.date(2025, rng.randint(1, 2), rng.randint(1, 28))
    money = lambda: rng.choice([None, Decimal(rng.randint(0, 9)), Decimal(rng.randint(0, 999)) / 100])
    some = lambda n, most: rng.sample(range(most), n)
    pick = lambda *values: rng.choice(values)
    policy = lambda: pick(None, "p9", *[f"p{i}" for i in range(6)])
    claims = [(f"c{i}", policy(), pick(None, "e1", "e2", "e9"), day(), day(), pick("Wind", None), pick("Open", "Closed", "Reopened", "gone"), money(), money(), number) for i in some(25, 40)]
    policies = [(f"p{i}", pick("A", "gone"), pick(1, 2, None), pick("N", "S", None), pick("T-W", "B-F"), "Home", money(), pick("None", "Shutters"), money(), number) for i in some(4, 7)]
    events = [(f"e{i}", pick("one", "two", "gone"), day(), day(), number) for i in some(2, 3)]
    zones = [(i, pick("x", "gone"), number) for i in some(2, 4)]
    return {CLAIMS: claims, POLICIES: policies, EVENTS: events, ZONES: zones}


def full(name, t):
    claims, policies, events, zones = (t[n] for n in (CLAIMS, POLICIES, EVENTS, ZONES))
    return {
        "claims_summary": lambda: marts.claims_summary(claims, policies),
        "loss_ratio_by_risk": lambda: marts.loss_ratio_by_risk(policies, claims),
        "policy_loss_ratio": lambda: marts.policy_loss_ratio(policies, claims),
        "risk_band_performance": lambda: marts.risk_band_performance(policies, claims),
        "event_loss_summary": lambda: marts.event_loss_summary(claims, events, policies),
        "event_loss_summary_extended": lambda: marts.event_loss_summary(claims, events, policies, extended=True),
        "event_losses": lambda: marts.event_losses(claims, events),
        "portfolio_exposure": lambda: marts.portfolio_exposure(policies, zones, unique_policies=True),
        "portfolio_exposure_without_zones": lambda: marts.portfolio_exposure(policies),
        "claims_development": lambda: marts.claims_development(claims, policies),
    }[name]()


def plain(df):
    columns = sorted(df.columns)
    return sorted((tuple(str(v.normalize()) if isinstance(v, Decimal) else v for v in row) for row in df.select(columns).collect()), key=str)


CHECKED = ["loss_ratio_by_risk", "event_loss_summary", "portfolio_exposure", "claims_development"]  # the others have SQL twins


@pytest.mark.parametrize("name", CHECKED)
def test_kept_mart_equals_a_full_run(spark, tmp_path, name, monkeypatch):
    rng = random.Random(name)
    mart = MARTS[name]
    tables = {
        n: MergeTable(spark, str(tmp_path / n), Upsert((KEYS[n],), "at", buckets=2, except_columns=("at",), deleted=GONE[n])) for n in SCHEMAS
    }
    kept = changing.ChangingMart(spark, str(tmp_path / "mart"), mart, tables, buckets=2)
    for number in range(1, 4):
        for n, rows in batch(rng, number).items():
            if number <= 2 or rng.random() < 0.8:
                tables[n].upsert(spark.createDataFrame(rows, SCHEMAS[n]), number, "b")
        if number == 2 and name == "claims_development":
            with monkeypatch.context() as broken:
                broken.setattr(MergeTable, "_commit", lambda *a: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    kept.refresh()
        kept.refresh()
        assert not kept.refresh()
        now = {n: table.read() for n, table in tables.items()}
        assert plain(kept.read()) == plain(full(name, now)), number


def test_a_mart_needs_its_tables(spark, tmp_path):
    tables = {n: MergeTable(spark, str(tmp_path / n), Upsert((KEYS[n],), "at")) for n in SCHEMAS}
    kept = changing.ChangingMart(spark, str(tmp_path / "mart"), MARTS["event_losses"], tables)
    assert not kept.refresh()
    tables[CLAIMS].upsert(spark.createDataFrame(batch(random.Random(1), 1)[CLAIMS], SCHEMAS[CLAIMS]), 1)
    with pytest.raises(ValueError, match="events"):
        kept.refresh()
