"""The registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``t.orders`` is the table's scan."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return scan(self.spark, self.folder, name)


def query(name: str, sql: str | None = None):
    """Register ``f(t)``, t giving tables, under a name, with its oracle."""

    def add(f: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is there already")
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return f

    return add
