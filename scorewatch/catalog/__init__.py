"""Every query of the library over the given tables, with the SQL it must agree with."""

from __future__ import annotations

from .registry import ORACLES, QUERIES
from . import (  # noqa: F401  (registration)
    contract_queries, drift_queries, file_queries, governance_queries, log_queries, metric_queries,
    model_queries, perturb_queries, run_queries, split_queries, stats_queries, stream_queries,
)

__all__ = ["ORACLES", "QUERIES"]
