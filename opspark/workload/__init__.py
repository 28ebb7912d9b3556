"""The registered queries. Importing this package fills the registry."""

import importlib

from opspark.workload.registry import ORACLES, QUERIES

MODULES = ("source_queries", "quality_queries", "activity_queries", "transaction_queries",
           "ranking_queries", "benchmark_queries", "table_queries", "model_queries",
           "stream_queries")
for _name in MODULES:
    importlib.import_module(f"opspark.workload.{_name}")

__all__ = ["ORACLES", "QUERIES"]
