"""Table, document and file-list sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeframe.functions.parsing import file_name, frame_number, label_code, subject_name
from wakeframe.schemas import BASELINE_DOCUMENT, RUN

VIDEO_SUFFIXES = (".mp4", ".avi", ".mov", ".mkv")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV file with a header and a known schema; nothing is inferred."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, first: int | None = None
) -> DataFrame:
    """A Parquet table, optionally some columns or the first rows only."""
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    return df.limit(first) if first is not None else df


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write a table. Use partition columns of low cardinality (label, date)."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_document(one_row: DataFrame, path: str) -> None:
    """Write a one-row table ``value`` of JSON text as a document."""
    one_row.select("value").write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature of a baseline document; no rows if there is none."""
    if not exists(spark, path, "json"):
        return spark.createDataFrame([], "feature string, mean double, std double, variance double")
    doc = read_document(spark, path, BASELINE_DOCUMENT)
    return doc.select("n_samples", F.explode("features").alias("feature", "s")).select(
        "feature", F.col("n_samples").alias("n"), "s.*"
    )


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Runs with metrics, params and tags as arrays of key and value."""
    return spark.read.schema(RUN).json(path)


def exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether a dataset can be opened at ``path``; its rows are not read."""
    try:
        reader = spark.read.format(fmt)
        if fmt in ("csv", "json", "text"):
            reader = reader.schema("value string")
        reader.load(path)
        return True
    except AnalysisException:
        return False


def _suffix_glob(suffixes: Sequence[str]) -> str:
    # file names are matched in either case, as the glob itself is case-sensitive
    forms = []
    for s in suffixes:
        forms.append("*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in s))
    return "{" + ",".join(forms) + "}"


def list_files(spark: SparkSession, root: str, suffixes: Sequence[str]) -> DataFrame:
    """Paths, sizes and parent folder below ``root``; no file is opened."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", _suffix_glob(suffixes))
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )
    return listed.withColumn("label", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))


def frame_manifest(files: DataFrame, path: Column | None = None, label: Column | None = None) -> DataFrame:
    """Subject, frame number and label code out of frame paths."""
    path = F.col("path") if path is None else path
    label = F.col("label") if label is None else label
    name = file_name(path)
    return files.withColumns(
        {
            "name": name,
            "subject_id": subject_name(name, label),
            "frame_id": frame_number(name),
            "label_code": label_code(label),
        }
    )
