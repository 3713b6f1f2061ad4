"""Registration of queries with the statement that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logharbor import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; ``sql`` gives the same rows."""

    def add(run: Query) -> Query:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(prepare(spark), sf_dir)

        QUERIES[run.__name__] = prepared
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return add
