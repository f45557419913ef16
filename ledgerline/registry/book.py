"""The book of registered queries: name, Spark query, checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.registry.inputs import landed, table, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Data:
    """Input tables and landed register views of one data directory, read by attribute."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_"):
            return landed(self.spark, self.sf, name).read(self.spark)
        return table(self.spark, self.sf, name)

    def derived(self, name: str, make: Callable[[], DataFrame], key: str = "num") -> DataFrame:
        """A table derived from the views and landed once by its key, for results that many queries read."""
        return landed(self.spark, self.sf, name, make, key).read(self.spark)


def query(name: str, sql: str | None = None):
    """Register ``fn(data) -> DataFrame`` under ``name`` with its checking SQL."""

    def wrap(fn: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, sf: fn(Data(spark, sf))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return wrap


def add(name: str, fn: Callable[[Data], DataFrame], sql: str | None = None) -> None:
    query(name, sql)(fn)
