"""All named queries, gathered from the modules that register them."""

from __future__ import annotations

from veinwork.plans import (  # noqa: F401  imported for their registrations
    association_queries,
    check_queries,
    cleaning_queries,
    clustering_queries,
    encoding_queries,
    feature_queries,
    outlier_queries,
    profiling_queries,
    sampling_queries,
    stop_queries,
    tree_queries,
    typing_queries,
)
from veinwork.plans.registry import QUERIES, SQL

REGISTERED = QUERIES
ORACLE = SQL
