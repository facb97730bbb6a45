"""The dealt operators as queries (spark, folder) -> DataFrame, and SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinfold.llm.text import bounded_batches
from kinfold.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``build(spark, folder)``; without SQL the tests hold it against brute force."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(bounded_batches(tune(spark)), folder)
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
