"""Time the headline queries: ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from claimlake.session import build_session  # noqa: E402
from claimlake.workload import QUERIES  # noqa: E402

HEADLINES = [
    "silver_claims",
    "claims_current",
    "first_and_last_snapshot",
    "mart_claims_summary",
    "mart_claims_summary_snapshots",
    "mart_loss_ratio_by_risk",
    "mart_policy_loss_ratio",
    "mart_event_loss_summary",
    "mart_event_loss_summary_extended",
    "mart_event_losses",
    "mart_portfolio_exposure",
    "mart_claims_development",
    "mart_risk_band_performance",
    "report_duplicate_summary",
    "report_nulls_claims",
    "report_business_rules",
    "report_referential_integrity",
    "rules_silver_claims",
    "rules_quarantined_claims",
    "parse_messages",
    "dashboard_claims_totals",
    "log_update_runs",
    "log_flow_metrics",
    "log_expectation_metrics",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__ui__enabled="false", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    chosen = [n for n in HEADLINES if n in QUERIES]
    run(chosen[0])
    times = {name: round(run(name), 3) for name in chosen}
    result = {
        "metric": "claims_analytics_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
