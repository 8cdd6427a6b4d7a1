"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Each query composes the library operators over the stand-in frames of
``featurelake.sources.fixtures``. Floating outputs are rounded here (not in the
operators) so the result compares exactly with the SQL oracle.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    """Register ``fn(spark, sf_dir)``; the session is pinned to UTC first (all feature times are UTC)."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        REGISTRY[name] = run
        return fn
    return deco


def load_all() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # Importing the modules registers their queries.
    from featurelake.plans import (  # noqa: F401
        q_graph, q_metrics, q_ml, q_quality, q_store, q_stream, q_transform, q_trips, q_views)
    return dict(REGISTRY)
