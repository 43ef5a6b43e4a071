"""The subpackage's queries on the driver's tables, and their SQL twins."""

from __future__ import annotations

import importlib
import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULES = (
    "near_dedup",
    "line_dedup",
    "quality",
    "vector_dedup",
    "byte_bpe",
    "chat_format",
    "token_counts",
    "toxicity",
    "packing",
    "lm_score",
    "token_records",
    "code_compression",
    "filter_audit",
)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame`` under ``name``."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = textwrap.dedent(sql).strip()
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load() -> tuple[dict, dict]:
    for module in MODULES:
        importlib.import_module(f"wakeframe.llm.{module}")
    import corpus_pipeline

    QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
    return dict(QUERIES), dict(ORACLES)
