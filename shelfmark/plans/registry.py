from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.collections import read_collection

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function name, with the SQL that must give the same rows."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    return read_collection(spark, name, root=sf_dir, **options)
