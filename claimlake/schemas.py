"""The four claims entities: columns, keys, audit columns and enumerations."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import types as T

# ---- fixed values: column names, types, keys and enumerations of the bordereau contracts ----

CLAIM_FIELDS = {
    "claim_id": "string",
    "policy_id": "string",
    "event_id": "string",
    "date_of_loss": "date",
    "reported_date": "date",
    "peril_type": "string",
    "claim_status": "string",
    "incurred_amount": "decimal(18,2)",
    "paid_to_date": "decimal(18,2)",
    "snapshot_date": "date",
}

PREMIUM_FIELDS = {
    "policy_id": "string",
    "insurer_name": "string",
    "postcode": "int",
    "region_name": "string",
    "wind_risk_band": "string",
    "building_type": "string",
    "sum_insured": "decimal(18,2)",
    "mitigation_flag": "string",
    "annual_premium": "decimal(18,2)",
    "policy_start_date": "date",
    "policy_end_date": "date",
}

ZONE_FIELDS = {"postcode": "int", "region_name": "string", "wind_risk_band": "string"}

EVENT_FIELDS = {"event_id": "string", "event_name": "string", "start_date": "date", "end_date": "date"}

CLAIM_STATUSES = ("Open", "Closed", "Reopened")
PERIL_TYPES = ("Wind", "Riverine Flood", "Storm Surge")
RISK_BANDS = ("T-W", "B-F", "Q-S", "L-P")
BUILDING_TYPES = ("Home", "SME", "Strata")

# ---- end of fixed values ----


@dataclass(frozen=True)
class Entity:
    """One bordereau: its landing folder, business key and typed columns in order."""

    name: str
    key: str
    table: str
    fields: dict[str, str]

    @property
    def columns(self) -> list[str]:
        return list(self.fields)

    @property
    def hints(self) -> str:
        """The typed columns as a DDL string."""
        return ", ".join(f"{name} {kind}" for name, kind in self.fields.items())

    def typed_schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.hints)

    def raw_schema(self) -> T.StructType:
        """Every column as a string, the way files are read before typing."""
        return T.StructType([T.StructField(name, T.StringType()) for name in self.fields])


CLAIMS = Entity("claims", "claim_id", "claims_bordereau", CLAIM_FIELDS)
PREMIUMS = Entity("premiums", "policy_id", "premium_bordereau", PREMIUM_FIELDS)
RISK_ZONES = Entity("risk_zones", "postcode", "risk_zone_lookup", ZONE_FIELDS)
CYCLONE_EVENTS = Entity("cyclone_events", "event_id", "cyclone_events", EVENT_FIELDS)

ENTITIES = {entity.name: entity for entity in (CLAIMS, PREMIUMS, RISK_ZONES, CYCLONE_EVENTS)}


@dataclass(frozen=True)
class AuditColumns:
    """Names of the lineage columns a layer carries; None means the layer has no such column."""

    ingested_at: str
    source_file: str
    rescued: str | None = None

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(n for n in (self.ingested_at, self.source_file, self.rescued) if n)


BATCH_AUDIT = AuditColumns("ingestion_timestamp", "source_file_name")
STREAM_AUDIT = AuditColumns("_ingest_ts", "_source_file", "_rescued_data")

# fixed values: the broker's fields and the names they have in bronze tables
BROKER_FIELDS = {
    "value": "_raw_value",
    "topic": "_topic",
    "partition": "_partition",
    "offset": "_offset",
    "timestamp": "_kafka_timestamp",
}
MESSAGE_AUDIT = {
    "_topic": "string",
    "_partition": "int",
    "_offset": "bigint",
    "_kafka_timestamp": "timestamp",
    "_ingest_ts": "timestamp",
}


def schema_from_json(text: str) -> T.StructType:
    """A fixed contract kept as Spark's JSON schema text."""
    return T.StructType.fromJson(json.loads(text))
