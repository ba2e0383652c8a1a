"""Import every query module so the registry is complete, and expose it."""

from __future__ import annotations

from . import geo_queries  # noqa: F401
from .registry import ORACLES, QUERIES

_MODULES = [
    "feature_queries", "dashboard_queries", "cluster_queries", "ml_queries", "io_queries", "table_queries", "model_queries", "request_queries",
]
for _m in _MODULES:
    try:
        __import__(f"{__package__}.{_m}")
    except ModuleNotFoundError as e:  # module not written yet
        if _m not in str(e):
            raise


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
