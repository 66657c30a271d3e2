"""Small hand-made bordereaux: one valid row per entity, changed by keyword."""

from __future__ import annotations

import datetime as dt

from claimlake.schemas import ENTITIES

AT = dt.datetime(2025, 3, 1, 12, 0)

VALID = {
    "claims": dict(
        claim_id="CLM-1", policy_id="POL-1", event_id="CYC-1", date_of_loss="2025-02-10", reported_date="2025-02-17",
        peril_type="Wind", claim_status="Open", incurred_amount="1000.00", paid_to_date="250.00", snapshot_date="2025-02-17",
    ),
    "premiums": dict(
        policy_id="POL-1", insurer_name="North", postcode="4870", region_name="Cairns", wind_risk_band="T-W",
        building_type="Home", sum_insured="10000.00", mitigation_flag="None", annual_premium="1000.00",
        policy_start_date="2024-01-01", policy_end_date="2025-01-01",
    ),
    "risk_zones": dict(postcode="4870", region_name="Cairns", wind_risk_band="T-W"),
    "cyclone_events": dict(event_id="CYC-1", event_name="Alpha", start_date="2025-02-08", end_date="2025-02-14"),
}


def raw(spark, name, *changes):
    """Text rows with batch audit columns; each change is a dict over the valid row."""
    entity = ENTITIES[name]
    schema = entity.raw_schema().simpleString()[7:-1] + ",ingestion_timestamp:timestamp,source_file_name:string"
    rows = [
        tuple({**VALID[name], **change}.get(c) for c in entity.columns)
        + (change.get("ingestion_timestamp", AT), change.get("source_file_name", f"{name}.csv"))
        for change in (changes or ({},))
    ]
    return spark.createDataFrame(rows, schema.replace(":", " "))


def only(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]
