"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given tables, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its own name, with SQL of equal result."""

    def add(build: Callable[[Tables], DataFrame]):
        QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
        if sql:
            SQL[build.__name__] = sql
        return build

    return add


def ts(text: str):
    """A timestamp constant without time zone."""
    return F.lit(text).cast("timestamp_ntz")
