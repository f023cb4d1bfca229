"""Registry of the queries run by the driver contract (``__spark_entry__``).

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the driver tables;
the matching DuckDB oracle (when the operator is SQL-expressible) sits next to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.plans import contract_queries, events_drift, feature_queries, io_queries, model_queries, rule_queries, score_queries, serving_queries

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = [events_drift, score_queries, feature_queries, contract_queries, io_queries, model_queries, serving_queries, rule_queries]


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _MODULES:
        out.update(getattr(m, "ORACLES", {}))
    return out
