"""All queries of the stream-analytics side, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .queries import bytes_, metrics, ordering, runs
from .shipping import ship

Query = Callable[[SparkSession, str], DataFrame]
MODULES = (metrics, ordering, bytes_, runs)


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # capture times have no zone of their own
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _shipped(query) for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
