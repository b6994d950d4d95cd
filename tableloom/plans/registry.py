"""Every query over the tables, by name, with the SQL that must return the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of a folder by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of Tables as a query."""

    def put(f: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return f

    return put


for module in ("values", "documents", "pages", "structure", "comparison", "summaries", "contents", "rendering", "layouts", "reports", "files"):
    import_module(f"tableloom.plans.{module}")
