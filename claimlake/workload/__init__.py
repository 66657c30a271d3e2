"""The driver's tables seen as claims data, the registered queries and their SQL twins."""

from claimlake.workload import (  # noqa: F401
    dashboard_queries,
    file_queries,
    log_queries,
    mart_queries,
    report_queries,
    run_queries,
    severity_queries,
)
from claimlake.workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
