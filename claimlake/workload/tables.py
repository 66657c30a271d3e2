"""The driver's tables seen as raw bordereaux.

Claims are order lines, policies are customers, risk zones and cyclone events are suppliers. Every raw
value is text, as a CSV would give it, and fixed residues of the part, customer and supplier keys carry
the usual faults: missing or unknown keys, dates that do not parse, amounts that are no numbers or negative.
No row is left out, everything grows with the tables, and the audit columns are derived from the data so
that results repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.operators.latest import claims_current, unique_zones
from claimlake.operators.projection import typed_claims, typed_events, typed_premiums, typed_zones
from claimlake.operators.quality import claims_quality, events_quality, premiums_quality
from claimlake.schemas import BUILDING_TYPES, PERIL_TYPES, RISK_BANDS
from claimlake.sources.paths import size


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


#: Bytes of the order lines that stand behind one landed file of claims.
LANDED = 32 << 20


def landed_files(spark: SparkSession, folder: str, least: int) -> int:
    """How many files claims land in: as many as the order lines call for, so that no task writes a growing share of them."""
    return max(least, -(-size(spark, f"{folder}/lineitem.parquet") // LANDED))


def derived_once(df: DataFrame) -> DataFrame:
    """The same rows, with their derived columns computed once.

    Filters are pushed below a projection by repeating its expressions, here long derivations of text;
    a generator is a border they do not cross. Bronze read from files has no such derivations.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def _listed(values: tuple[str, ...]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _day(start: str, offset: str) -> str:
    return f"date_add(DATE '{start}', CAST({offset} AS INT))"


PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
CLAIM_TEXT = [
    "CASE WHEN l_partkey % 107 <> 0 THEN concat_ws('-', l_orderkey, l_linenumber) END AS claim_id",
    "CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 103 = 0 THEN ' ' ELSE CAST(o_custkey AS STRING) END AS policy_id",
    "CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_partkey % 71 = 0 THEN 'CYC-GONE' ELSE concat('CYC-', l_suppkey) END AS event_id",
    "CASE WHEN l_partkey % 89 = 0 THEN 'not-a-date' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS date_of_loss",
    "CAST(CAST(l_shipdate AS DATE) AS STRING) AS reported_date",
    f"CASE WHEN l_partkey % 101 <> 0 THEN element_at({_listed(PERIL_TYPES)}, CAST(l_linenumber % 3 AS INT) + 1) END AS peril_type",
    """CASE WHEN l_partkey % 113 = 0 THEN 'Unknown' WHEN o_orderstatus = 'O' THEN 'Open' WHEN o_orderstatus = 'F' THEN 'Closed'
    ELSE 'Reopened' END AS claim_status""",
    f"""CASE WHEN l_partkey % 83 = 0 THEN 'N/A' WHEN l_partkey % 79 = 0 THEN concat('-', {PRICE})
    ELSE CAST({PRICE} AS STRING) END AS incurred_amount""",
    f"CAST(CAST({PRICE} * CAST(round(l_discount * 100) AS INT) * 0.11BD AS DECIMAL(18,2)) AS STRING) AS paid_to_date",
    "CAST(date_add(CAST(l_shipdate AS DATE), CAST(l_quantity AS INT)) AS STRING) AS snapshot_date",
    "CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS ingestion_timestamp",
    "concat('claims-', year(l_shipdate), '.csv') AS source_file_name",
]

START = _day("1994-01-01", "c_custkey % 900")
PREMIUM_TEXT = [
    "CAST(c_custkey AS STRING) AS policy_id",
    "c_mktsegment AS insurer_name",
    "CASE WHEN c_custkey % 37 = 0 THEN '9999' WHEN c_custkey % 43 = 0 THEN 'n/a' ELSE lpad(CAST(c_nationkey AS STRING), 4, '0') END AS postcode",
    "n_name AS region_name",
    f"element_at({_listed(RISK_BANDS)}, CAST(n_regionkey % 4 AS INT) + 1) AS wind_risk_band",
    f"element_at({_listed(BUILDING_TYPES)}, CAST(c_custkey % 3 AS INT) + 1) AS building_type",
    "CAST(CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 100 AS DECIMAL(18,2)) AS STRING) AS sum_insured",
    "CASE WHEN c_custkey % 2 = 0 THEN 'None' ELSE 'Shutters Installed' END AS mitigation_flag",
    "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) AS annual_premium",
    f"CAST({START} AS STRING) AS policy_start_date",
    f"CAST(date_add({START}, CASE WHEN c_custkey % 59 = 0 THEN 0 ELSE 365 END) AS STRING) AS policy_end_date",
    f"CAST({_day('2024-01-01', 'c_custkey % 30')} AS TIMESTAMP) AS ingestion_timestamp",
    "concat('premiums-', c_custkey % 4, '.csv') AS source_file_name",
]

ZONE_TEXT = [
    "CASE WHEN s_suppkey % 31 <> 0 THEN lpad(CAST(s_nationkey AS STRING), 4, '0') END AS postcode",
    "CASE WHEN s_suppkey % 47 <> 0 THEN concat('Region-', s_suppkey % 3) END AS region_name",
    f"CASE WHEN s_suppkey % 53 = 0 THEN 'HIGH' ELSE element_at({_listed(RISK_BANDS)}, CAST(s_suppkey % 4 AS INT) + 1) END AS wind_risk_band",
    f"CAST({_day('2024-02-01', 's_suppkey % 10')} AS TIMESTAMP) AS ingestion_timestamp",
    "concat('zones-', s_suppkey % 2, '.csv') AS source_file_name",
]

EVENT_START = _day("1995-01-01", "s_suppkey * 37 % 2000")
EVENT_TEXT = [
    "CASE WHEN s_suppkey % 43 <> 0 THEN concat('CYC-', s_suppkey) END AS event_id",
    "CASE WHEN s_suppkey % 23 <> 0 THEN concat('Cyclone ', s_suppkey) END AS event_name",
    f"""CASE WHEN s_suppkey % 29 = 0 THEN 'not-a-date' WHEN s_suppkey % 3 = 0 THEN date_format({EVENT_START}, 'yyyy/MM/dd')
    WHEN s_suppkey % 3 = 1 THEN date_format({EVENT_START}, 'yyyy-MM-dd') ELSE date_format({EVENT_START}, 'MM/dd/yyyy') END AS start_date""",
    f"CAST(date_add({EVENT_START}, CAST(s_suppkey % 7 AS INT) - 1) AS STRING) AS end_date",
    f"CAST({_day('2024-03-01', 's_suppkey % 20')} AS TIMESTAMP) AS ingestion_timestamp",
    "concat('events-', s_suppkey % 2, '.csv') AS source_file_name",
]


def raw_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Raw claim snapshots: order lines with their orders."""
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        "l_shipdate", "l_quantity", "l_extendedprice", "l_discount",
    )
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(*CLAIM_TEXT)


def raw_premiums(spark: SparkSession, folder: str) -> DataFrame:
    customers = read(spark, folder, "customer")
    nations = read(spark, folder, "nation")
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).selectExpr(*PREMIUM_TEXT)


def raw_zones(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "supplier").selectExpr(*ZONE_TEXT)


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "supplier").selectExpr(*EVENT_TEXT)


RAW = {
    "claims": raw_claims,
    "premiums": raw_premiums,
    "risk_zones": raw_zones,
    "cyclone_events": raw_events,
}


def silver_claims(spark: SparkSession, folder: str) -> DataFrame:
    return claims_quality(typed_claims(derived_once(raw_claims(spark, folder))))


def current_claims(spark: SparkSession, folder: str) -> DataFrame:
    return claims_current(silver_claims(spark, folder))


def silver_premiums(spark: SparkSession, folder: str) -> DataFrame:
    return premiums_quality(typed_premiums(derived_once(raw_premiums(spark, folder))))


def silver_zones(spark: SparkSession, folder: str) -> DataFrame:
    return unique_zones(typed_zones(raw_zones(spark, folder)))


def silver_events(spark: SparkSession, folder: str) -> DataFrame:
    return events_quality(typed_events(raw_events(spark, folder)))


def comparable(df: DataFrame, instants: str = "date") -> DataFrame:
    """Decimals as doubles and instants as ``instants``, so that two engines can be compared value by value.

    Audit times are whole days in the derived tables, so a date holds them; a log's times keep their clock.
    """
    casts = {"decimal": "double", "timestamp": instants}
    return df.select(
        *[
            next((F.col(f"`{n}`").cast(to).alias(n) for prefix, to in casts.items() if kind.startswith(prefix)), F.col(f"`{n}`"))
            for n, kind in df.dtypes
        ]
    )
