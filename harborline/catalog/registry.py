"""Registration of queries and the lazily opened sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from harborline.settings import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``t.orders`` reads ``orders.parquet`` of one scale."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = prepare(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


def query(name: str, sql: str | None = None):
    """Register a job under a name, with the SQL that must give the same rows."""

    def register(job: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: job(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return job

    return register
