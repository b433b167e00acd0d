"""Registered queries: each binds operators to the given tables and states its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Catalog:
    """Named queries with optional SQL twins."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            self.queries[name] = query
            if sql:
                self.sql[name] = sql
            return query

        return register


def load() -> Catalog:
    """All registered queries of the library."""
    import importlib

    merged = Catalog()
    for part in ("relational", "statistics", "files", "streams", "graphs", "models", "clusters"):
        catalog = importlib.import_module(f"{__name__}.{part}").catalog
        merged.queries.update(catalog.queries)
        merged.sql.update(catalog.sql)
    return merged
