"""Building blocks of the SQL twins: the same bordereaux over the same tables, in whole cents.

Money is kept in integer cents and ratios are rounded with integer arithmetic, step by step the way
decimal division rounds, so no comparison depends on how an engine rounds floating-point ties.
"""

from __future__ import annotations

RAW = """
raw_claims AS (
  SELECT
    CASE WHEN l_partkey % 107 = 0 THEN NULL ELSE concat(l_orderkey, '-', l_linenumber) END AS claim_id,
    CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 103 = 0 THEN ' ' ELSE CAST(o_custkey AS VARCHAR) END AS policy_id,
    CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_partkey % 71 = 0 THEN 'CYC-GONE' ELSE concat('CYC-', l_suppkey) END AS event_id,
    CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date_of_loss,
    l_partkey % 89 = 0 AS bad_loss_text,
    CAST(l_shipdate AS DATE) AS reported_date,
    CASE WHEN l_partkey % 101 = 0 THEN NULL WHEN l_linenumber % 3 = 0 THEN 'Wind'
         WHEN l_linenumber % 3 = 1 THEN 'Riverine Flood' ELSE 'Storm Surge' END AS peril_type,
    CASE WHEN l_partkey % 113 = 0 THEN 'Unknown' WHEN o_orderstatus = 'O' THEN 'Open'
         WHEN o_orderstatus = 'F' THEN 'Closed' ELSE 'Reopened' END AS claim_status,
    CASE WHEN l_partkey % 83 = 0 THEN NULL WHEN l_partkey % 79 = 0 THEN -cents ELSE cents END AS incurred,
    (cents * k * 11 + 50) // 100 AS paid,
    CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS snapshot_date,
    concat('claims-', year(l_shipdate), '.csv') AS source_file_name,
    CAST(l_shipdate AS DATE) AS ingested
  FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(round(l_discount * 100) AS BIGINT) AS k FROM lineitem)
  JOIN orders ON l_orderkey = o_orderkey
),
raw_premiums AS (
  SELECT
    CAST(c_custkey AS VARCHAR) AS policy_id,
    c_mktsegment AS insurer_name,
    CASE WHEN c_custkey % 37 = 0 THEN 9999 WHEN c_custkey % 43 = 0 THEN NULL ELSE c_nationkey END AS postcode,
    n_name AS region_name,
    list_extract(['T-W', 'B-F', 'Q-S', 'L-P'], n_regionkey % 4 + 1) AS wind_risk_band,
    list_extract(['Home', 'SME', 'Strata'], CAST(c_custkey % 3 + 1 AS INTEGER)) AS building_type,
    CAST(round(c_acctbal * 100) AS BIGINT) * 100 AS insured,
    CASE WHEN c_custkey % 2 = 0 THEN 'None' ELSE 'Shutters Installed' END AS mitigation_flag,
    CAST(round(c_acctbal * 100) AS BIGINT) AS premium,
    DATE '1994-01-01' + CAST(c_custkey % 900 AS INTEGER) AS policy_start_date,
    DATE '1994-01-01' + CAST(c_custkey % 900 AS INTEGER) + CASE WHEN c_custkey % 59 = 0 THEN 0 ELSE 365 END AS policy_end_date,
    concat('premiums-', c_custkey % 4, '.csv') AS source_file_name,
    DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) AS ingested
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
raw_zones AS (
  SELECT
    CASE WHEN s_suppkey % 31 = 0 THEN NULL ELSE s_nationkey END AS postcode,
    CASE WHEN s_suppkey % 47 = 0 THEN NULL ELSE concat('Region-', s_suppkey % 3) END AS region_name,
    CASE WHEN s_suppkey % 53 = 0 THEN 'HIGH'
         ELSE list_extract(['T-W', 'B-F', 'Q-S', 'L-P'], CAST(s_suppkey % 4 + 1 AS INTEGER)) END AS wind_risk_band,
    concat('zones-', s_suppkey % 2, '.csv') AS source_file_name,
    DATE '2024-02-01' + CAST(s_suppkey % 10 AS INTEGER) AS ingested
  FROM supplier
),
raw_events AS (
  SELECT
    CASE WHEN s_suppkey % 43 = 0 THEN NULL ELSE concat('CYC-', s_suppkey) END AS event_id,
    CASE WHEN s_suppkey % 23 = 0 THEN NULL ELSE concat('Cyclone ', s_suppkey) END AS event_name,
    CASE WHEN s_suppkey % 29 = 0 THEN NULL ELSE DATE '1995-01-01' + CAST(s_suppkey * 37 % 2000 AS INTEGER) END AS start_date,
    DATE '1995-01-01' + CAST(s_suppkey * 37 % 2000 AS INTEGER) + CAST(s_suppkey % 7 AS INTEGER) - 1 AS end_date,
    concat('events-', s_suppkey % 2, '.csv') AS source_file_name,
    DATE '2024-03-01' + CAST(s_suppkey % 20 AS INTEGER) AS ingested
  FROM supplier
)"""

SILVER = """
silver_claims AS (
  SELECT * FROM raw_claims
  WHERE claim_id IS NOT NULL AND policy_id IS NOT NULL AND date_of_loss IS NOT NULL AND reported_date IS NOT NULL
    AND peril_type IS NOT NULL AND claim_status IS NOT NULL AND incurred IS NOT NULL AND paid IS NOT NULL
    AND date_of_loss <= reported_date AND incurred >= 0 AND paid <= incurred
),
current_claims AS (
  SELECT * FROM silver_claims
  QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY snapshot_date DESC, policy_id DESC, event_id DESC NULLS LAST,
    date_of_loss DESC, reported_date DESC, peril_type DESC, claim_status DESC, incurred DESC, paid DESC,
    source_file_name DESC, ingested DESC) = 1
),
silver_premiums AS (
  SELECT * FROM raw_premiums
  WHERE postcode IS NOT NULL AND policy_start_date < policy_end_date AND insured > 0 AND premium > 0
),
silver_zones AS (
  SELECT * FROM raw_zones
  WHERE postcode IS NOT NULL AND region_name IS NOT NULL AND wind_risk_band IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY postcode ORDER BY region_name, wind_risk_band DESC, source_file_name DESC, ingested DESC) = 1
),
silver_events AS (
  SELECT * FROM raw_events
  WHERE event_id IS NOT NULL AND event_name IS NOT NULL AND start_date IS NOT NULL AND start_date <= end_date
)"""


def with_raw(body: str, *more: str) -> str:
    return "WITH " + ",\n".join([RAW, *more]) + "\n" + body


def with_silver(body: str, *more: str) -> str:
    return with_raw(body, SILVER, *more)


def huge(text: str) -> str:
    return f"CAST({text} AS HUGEINT)"


def money(cents: str) -> str:
    """Cents as a double of whole units."""
    return f"CAST({cents} AS DOUBLE) / 100.0"


def quotient(num: str, den: str, digits: int) -> str:
    """num / den scaled by 10**digits, rounded half up to an integer; NULL for a zero denominator."""
    n, d = huge(num), f"nullif({huge(den)}, 0)"
    return f"(({n} * {2 * 10**digits} + {d}) // (2 * {d}))"


def shorten(scaled: str, drop: int) -> str:
    """Round a scaled integer half up by ``drop`` further digits."""
    return f"(({scaled} + {5 * 10 ** (drop - 1)}) // {10**drop})"


def percent(num: str, den: str, digits: int = 2) -> str:
    """100 * num / den: quotient to 10 digits, product to 6, then to ``digits``."""
    six = shorten(quotient(num, den, 10), 2)
    return f"CAST({shorten(six, 6 - digits)} AS DOUBLE) / {10**digits}.0"


def coarse_ratio(num: str, den: str) -> str:
    """num / den with six digits."""
    return f"CAST({quotient(num, den, 6)} AS DOUBLE) / 1000000.0"


def coarse_percent(num: str, den: str) -> str:
    """100 * num / den from a six-digit quotient, to two digits."""
    return f"CAST({shorten(quotient(num, den, 6) + ' * 100', 4)} AS DOUBLE) / 100.0"


def mean(cents: str, count: str, digits: int = 2) -> str:
    """Mean of money: twelve digits, six digits, then ``digits`` of whole units."""
    six = shorten(quotient(cents, count, 10), 6)
    return f"CAST({shorten(six, 6 - digits)} AS DOUBLE) / {10**digits}.0"


def half_up(num: str, den: str, digits: int) -> str:
    """num / den rounded half up to ``digits``."""
    return f"CAST({quotient(num, den, digits)} AS DOUBLE) / {10**digits}.0"
