"""All registered queries."""

from tablebridge.plans import (  # noqa: F401
    queries_billing,
    queries_bookings,
    queries_catchup,
    queries_documents,
    queries_history,
    queries_loads,
    queries_merge,
    queries_reports,
    queries_resolve,
    queries_rows,
)
from tablebridge.plans.registry import ORACLES, QUERIES

FLAGSHIP = "merge_if_changed"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
