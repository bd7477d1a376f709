"""All registered queries."""

from __future__ import annotations

from tideshift.plans import (
    feature_queries,
    ingest_queries,
    layout_queries,
    model_queries,
    monitoring_queries,
    regime_queries,
    stream_queries,
)
from tideshift.plans.regime_queries import flagship

__all__ = ["all_oracles", "all_queries", "flagship"]

MODULES = (feature_queries, ingest_queries, regime_queries, monitoring_queries, model_queries, stream_queries, layout_queries)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
