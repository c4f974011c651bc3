"""Registration of queries with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables below a folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of Tables under its own name."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def r4(col):
    """Rounded to four decimals."""
    return F.round(col, 4)


def seconds(ts):
    """A timestamp as seconds since the epoch."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)
