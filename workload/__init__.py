"""Queries over the provided tables and the SQL that checks them."""

from workload import (  # noqa: F401
    queries_analysis,
    queries_metrics,
    queries_models,
    queries_prepare,
    queries_resample,
)
from workload.registry import ORACLES, QUERIES


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLES)
