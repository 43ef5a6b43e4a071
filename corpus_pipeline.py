"""A corpus pipeline: each stage calls one operator on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeframe.llm.line_dedup import dedup_lines
from wakeframe.llm.near_dedup import drop_near_duplicates, free
from wakeframe.llm.packing import pack
from wakeframe.llm.quality import keep_quality
from wakeframe.llm.toxicity import drop_toxic
from wakeframe.session import Stages


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents judged toxic go; the model is fitted on the labelled ones among ``docs``."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base or are probably bad go."""
    return keep_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of repeated and nearly repeated lines one stays.

    ``n_chars`` follows the text. A document of which nothing is left, because all its
    lines stay in others, goes; one that was empty before stays.
    """
    had_text = free(docs, "had_text")
    cleaned = dedup_lines(docs.withColumn(had_text, F.length("text") > 0))
    left = cleaned.filter(F.coalesce(~F.col(had_text) | (F.length("text") > 0), F.lit(True)))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return drop_near_duplicates(docs, repeats=False)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left, with their ids, in sequences."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: A fitted model, signatures and a tokenizer decide; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read again."""
    stages = Stages(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, stages.keep(stage(spark, docs, sf_dir), name)
        stages.drop(before)
    return docs
