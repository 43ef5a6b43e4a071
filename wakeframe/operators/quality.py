"""Data-quality gates: named checks evaluated in one pass over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeframe.constants import FEATURES
from wakeframe.sources.tables import exists, write_table

TABLE_CHECKS = ("not_empty", "has_both_labels", "no_nulls_in_features", "schema")
CHECKS = ("exists", *TABLE_CHECKS)


class QualityError(ValueError):
    """At least one check failed."""


def missing_columns(present: Sequence[str], required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in present]


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``column, nulls`` for all columns, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "nulls")


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def label_classes(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.count_distinct(label).alias("classes"))


def _missing(df: DataFrame, column: str) -> Column:
    """Null, or not a number where the column can hold that."""
    null = F.col(column).isNull()
    return null | F.isnan(column) if isinstance(df.schema[column].dataType, T.FractionalType) and not isinstance(
        df.schema[column].dataType, T.DecimalType
    ) else null


def _known(checks: Sequence[str]) -> None:
    unknown = [c for c in checks if c not in CHECKS]
    if unknown:
        raise ValueError(f"no such checks: {unknown}. Valid: {list(CHECKS)}")


def _counts(df: DataFrame, checks: Sequence[str], features: Sequence[str], label: str, exact: bool) -> dict[str, Column]:
    """The aggregates that the checks need; ``exact``: the number of labels, else 2 for any number above."""
    present = [c for c in features if c in df.columns]
    aggs = {"rows": F.count(F.lit(1))}
    if "has_both_labels" in checks and label in df.columns:
        some, more = (F.count(label) > 0).cast("long"), F.coalesce((F.min(label) < F.max(label)).cast("long"), F.lit(0))
        aggs["classes"] = F.count_distinct(label) if exact else some + more
    if "no_nulls_in_features" in checks:
        aggs |= {f"null_{c}": F.count_if(_missing(df, c)) for c in present}
    return aggs


def _verdicts(
    counted: DataFrame, columns: Sequence[str], checks: Sequence[str], features: Sequence[str], label: str, exact: bool
) -> DataFrame:
    """Rows ``check, passed, message`` from the one row of counts."""
    present = [c for c in features if c in columns]
    results: dict[str, tuple[Column, Column]] = {}
    for check in checks:
        if check == "not_empty":
            results[check] = (F.col("rows") > 0, F.format_string("rows = %d", F.col("rows")))
        elif check == "has_both_labels":
            if label not in columns:
                results[check] = (F.lit(False), F.lit(f"exception - no column {label}"))
            else:
                many = F.col("classes").cast("string")
                many = many if exact else F.when(F.col("classes") == 2, "2 or more").otherwise(many)
                results[check] = (F.col("classes") >= 2, F.format_string("unique labels = %s (need >= 2)", many))
        elif check == "no_nulls_in_features":
            bad = F.concat_ws(
                ", ", *[F.when(F.col(f"null_{c}") > 0, F.format_string(f"{c}: %d", F.col(f"null_{c}"))) for c in present]
            )
            results[check] = (
                bad == "",
                F.when(bad == "", F.lit(f"complete: {len(present)} columns")).otherwise(
                    F.concat(F.lit("missing values: "), bad)
                ),
            )
        elif check == "schema":
            absent = missing_columns(columns, [*features, label])
            text = f"absent: {absent}" if absent else f"{len(features) + 1} columns as required"
            results[check] = (F.lit(not absent), F.lit(text))
    rows = F.array(
        *[F.struct(F.lit(n).alias("check"), p.alias("passed"), m.alias("message")) for n, (p, m) in results.items()]
    )
    return counted.select(F.inline(rows))


def run_checks(
    df: DataFrame,
    checks: Sequence[str] = TABLE_CHECKS,
    features: Sequence[str] = FEATURES,
    label: str = "label",
) -> DataFrame:
    """Rows ``check, passed, message`` for every requested check.

    All checks that read data share one aggregation; an unknown name is
    refused before anything runs. ``exists`` is about a path: see ``check_path``.
    """
    _known(checks)
    if "exists" in checks:
        raise ValueError("'exists' is about a path: use check_path")
    counted = df.agg(*[c.alias(n) for n, c in _counts(df, checks, features, label, True).items()])
    return _verdicts(counted, df.columns, checks, features, label, True)


RESULT = "check string, passed boolean, message string"


def check_path(
    spark: SparkSession, path: str, checks: Sequence[str] = CHECKS, fmt: str = "parquet", **options
) -> DataFrame:
    """The checks of a dataset that may be missing; ``exists`` looks for files that can be opened."""
    _known(checks)
    if not exists(spark, path, fmt):
        return spark.createDataFrame([(c, False, f"NOT found: {path}") for c in checks], RESULT)
    of_table = [c for c in checks if c != "exists"]
    found = spark.createDataFrame([(c, True, f"found: {path}") for c in checks if c == "exists"], RESULT)
    if not of_table:
        return found
    return found.unionByName(run_checks(spark.read.format(fmt).load(path), of_table, **options))


def write_checked(
    df: DataFrame,
    path: str,
    checks: Sequence[str] = CHECKS,
    fmt: str = "parquet",
    features: Sequence[str] = FEATURES,
    label: str = "label",
) -> DataFrame:
    """Write a stage's table and give its checks, without reading it again.

    The counts are gathered while the rows are written. ``has_both_labels`` then compares
    the smallest label with the greatest, as labels can't be told apart by sums.
    """
    _known(checks)
    of_table = [c for c in checks if c != "exists"]
    seen = Observation()
    counts = _counts(df, of_table, features, label, False)
    write_table(df.observe(seen, *[c.alias(n) for n, c in counts.items()]), path, fmt)
    spark = df.sparkSession
    # one row of numbers
    counted = spark.createDataFrame([tuple(seen.get[n] for n in counts)], ", ".join(f"`{n}` long" for n in counts))
    told = _verdicts(counted, df.columns, of_table, features, label, False)
    if "exists" not in checks:
        return told
    there = exists(spark, path, fmt)
    found = [("exists", there, f"found: {path}" if there else f"NOT found: {path}")]
    return spark.createDataFrame(found, RESULT).unionByName(told)


def require(results: DataFrame) -> None:
    """Raise with every failed check; ``results`` has one row per check."""
    failed = results.filter(~F.col("passed")).collect()
    if failed:
        lines = "\n".join(f"  - {r['check']}: {r['message']}" for r in failed)
        raise QualityError(f"{len(failed)} check(s) failed:\n{lines}")


def check_frames(manifest: DataFrame, labels: Sequence[str] = ("drowsy", "alert")) -> DataFrame:
    """Every label has at least one frame."""
    counts = manifest.agg(*[F.count_if(F.col("label") == name).alias(name) for name in labels])
    rows = F.array(
        *[
            F.struct(
                F.lit(f"frames_{n}").alias("check"),
                (F.col(n) > 0).alias("passed"),
                F.format_string("frames = %d", F.col(n)).alias("message"),
            )
            for n in labels
        ]
    )
    return counts.select(F.inline(rows))


def check_landmarks(df: DataFrame, points: str = "landmarks", label: str = "label") -> DataFrame:
    """Required columns, both labels, at least one row."""
    required = [points, label, "subject_id", "frame_id"]
    return run_checks(df, ["not_empty", "has_both_labels", "schema"], features=required[:1] + required[2:], label=label)


def check_features(df: DataFrame, base: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Feature table and baseline are complete."""
    table = run_checks(df, ["not_empty", "has_both_labels", "no_nulls_in_features", "schema"], features)
    covered = base.agg(F.collect_set("feature").alias("have"))  # one entry per feature column
    absent = F.array_except(F.array(*[F.lit(f) for f in features]), F.col("have"))
    baseline = covered.select(
        F.lit("baseline").alias("check"),
        (F.size(absent) == 0).alias("passed"),
        F.concat(F.lit("missing: "), F.array_join(absent, ", ")).alias("message"),
    )
    return table.unionByName(baseline)
