"""Queries that run the operators over whole tables, each beside the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, by its function name or ``name``. Times in the tables are UTC."""

    def register(run: Query) -> Query:
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, sf_dir)

        QUERIES[name or run.__name__] = in_utc
        SQL[name or run.__name__] = sql
        return run

    return register


def load() -> None:
    from headway.queries import feeds, lake, rows  # noqa: F401
