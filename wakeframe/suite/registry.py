"""Where queries and their SQL twins are registered."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame`` under ``name``."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = textwrap.dedent(sql).strip()
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def placed(ordered: DataFrame) -> DataFrame:
    """A few ordered rows with their ``place``, so that comparing rows compares their order."""
    at = ordered.withColumn("__at", F.monotonically_increasing_id())
    return at.withColumn("place", F.row_number().over(Window.orderBy("__at"))).drop("__at")
