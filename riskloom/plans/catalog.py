"""All registered queries, in the order of their modules."""

from riskloom.plans import (  # noqa: F401  (importing registers)
    drift_queries,
    expression_queries,
    join_metric_queries,
    ml_queries,
    stream_queries,
    table_queries,
)
from riskloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
