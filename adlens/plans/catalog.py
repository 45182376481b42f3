"""Named queries over the driver tables and their oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
Every query reads the driver tables (or data Spark derives from them) in
full; the only limits are those that are the feature (top-n questions).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adlens.plans.driver import Driver
from adlens.plans import sql as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Driver(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        QUERIES[name].__name__ = name
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# Importing the query modules registers them.
from adlens.plans import q_core, q_tabs, q_report, q_questions, q_mapping, q_quality, q_extras, q_reports2, q_more, q_store, q_ask  # noqa: E402,F401
