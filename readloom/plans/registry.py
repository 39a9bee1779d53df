"""Names every registered query and, where SQL can express it, the SQL giving the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from readloom.plans.fixtures import with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = _in_utc(fn)
        if sql is not None:
            ORACLE[name] = with_fixtures(sql)
        return fn
    return add


def _in_utc(fn):
    """The tables hold timestamps without a zone and the SQL side reads them as UTC."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    return run


def load_all() -> None:
    from readloom.plans import (  # noqa: F401
        base_queries,
        dna_queries,
        file_queries,
        graph_queries,
        interval_queries,
        read_queries,
        trend_queries,
        variant_queries,
    )
