"""Stage summaries, fingerprints and the run report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return F.round(100.0 * part / F.greatest(whole, F.lit(1)), places)


def per_second(amount: Column, seconds: Column, places: int = 1) -> Column:
    return F.round(F.when(seconds > 0, amount / seconds).otherwise(F.lit(0.0)), places)


def detection_summary(frames: DataFrame, keys: Sequence[str] = ("label",), face: str = "face") -> DataFrame:
    """Attempted, succeeded and faceless frames with the detection rate."""
    ok, all_rows = F.count_if(face), F.count(F.lit(1))
    return frames.groupBy(*keys).agg(
        all_rows.alias("attempted"),
        ok.alias("succeeded"),
        (all_rows - ok).alias("no_face"),
        percent(ok, all_rows).alias("rate_pct"),
    )


def detection_totals(per_label: DataFrame, elapsed_sec: float) -> DataFrame:
    """Totals over the labels with the rate and frames per second of the run."""
    attempted, ok = F.sum("attempted"), F.sum("succeeded")
    return per_label.agg(
        attempted.alias("attempted"),
        ok.alias("succeeded"),
        F.sum("no_face").alias("no_face"),
        percent(ok, attempted).alias("rate_pct"),
        per_second(attempted, F.lit(float(elapsed_sec))).alias("throughput_fps"),
    )


def video_summary(
    frames: DataFrame, video: str = "video", total: str = "total_frames", fps: str = "source_fps",
    seconds: str = "elapsed_sec", status: str = "status",
) -> DataFrame:
    """Per video: extracted frames, length, throughput, status."""
    stats = frames.groupBy(video).agg(
        F.count_if(F.col(status) == "success").alias("frames"),
        F.max(total).alias("total"),
        F.max(fps).alias("fps"),
        F.max(seconds).alias("elapsed_sec"),
        F.when(F.count_if(F.col(status) == "success") > 0, "success").otherwise("failed").alias("status"),
    )
    length = F.when(F.col("fps") > 0, F.col("total") / F.col("fps")).otherwise(F.lit(0.0))
    return stats.select(
        video,
        "frames",
        F.round(length, 2).alias("duration_sec"),
        per_second(F.col("frames"), F.col("elapsed_sec")).alias("throughput_fps"),
        F.round("elapsed_sec", 2).alias("elapsed_sec"),
        "status",
    )


def extraction_totals(videos: DataFrame, video: str = "video") -> DataFrame:
    """Totals over the successful videos and the number of failures."""
    good = F.col("status") == "success"
    seconds = F.sum(F.when(good, F.col("elapsed_sec")))
    frames = F.sum(F.when(good, F.col("frames")))
    return videos.agg(
        F.coalesce(frames, F.lit(0)).alias("total_frames"),
        F.count_if(good).alias("videos"),
        F.round(F.coalesce(seconds, F.lit(0.0)), 2).alias("total_elapsed_sec"),
        F.coalesce(per_second(frames, seconds), F.lit(0.0)).alias("overall_fps"),
        F.count_if(~good).alias("failed"),
    )


def missing_labels(files: DataFrame, labels: Sequence[str], label: str = "label") -> DataFrame:
    """One error row per expected label without any file."""
    counts = files.agg(*[F.count_if(F.col(label) == n).alias(n) for n in labels])
    rows = F.array(*[F.struct(F.lit(f"No videos in {n}").alias("error"), F.col(n).alias("n")) for n in labels])
    return counts.select(F.inline(rows)).filter("n = 0").select("error")


def extraction_errors(videos: DataFrame, video: str = "video") -> DataFrame:
    """One row per failed video; a table, as there may be many."""
    return videos.filter(F.col("status") != "success").select(
        F.concat(F.lit("Failed: "), F.col(video).cast("string")).alias("error")
    )


def canonical(df: DataFrame, column: str, places: int = 6) -> Column:
    """A value as text that doesn't depend on the engine, with its length in front; null is ``-``.

    Fractions have ``places``, times are in microseconds.
    """
    kind, value = df.schema[column].dataType, F.col(column)
    text = value.cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        fixed = F.round(value.cast("double"), places).try_cast(f"decimal(38,{places})").cast("string")
        text = F.coalesce(fixed, text)  # not a number, or too large
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.unix_micros(value.cast("timestamp")).cast("string")
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.when(value.isNotNull(), F.to_json(F.struct(value)))
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None, places: int = 6) -> DataFrame:
    """Order-free content hash and row count of a table, in one pass.

    A row's number is the first 60 bits of the MD5 sum of its values' ``canonical`` texts,
    columns in order of their names; numbers are combined by exclusive or and by sum.
    """
    named = sorted(columns or df.columns)
    text = F.concat(*[canonical(df, c, places) for c in named])
    number = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    return df.select(number.alias("h")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.hex(F.bit_xor("h")).alias("hash_xor"),
        F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("hash_sum"),
    )


def section(name: str, summary: DataFrame) -> DataFrame:
    """A one-row summary as ``section, json``."""
    return summary.select(F.lit(name).alias("section"), F.to_json(F.struct(*summary.columns)).alias("json"))


def run_report(sections: Sequence[DataFrame]) -> DataFrame:
    """One JSON document out of the stage summaries: section -> summary.

    Each section is one row, so what is gathered is one row per stage.
    """
    rows = reduce(DataFrame.unionByName, sections)
    entry = F.concat(F.to_json(F.array("section")), F.lit(":"), F.col("json"))
    # '["name"]' -> '"name"'
    entry = F.regexp_replace(entry, r'^\[(".*?")\]:', "$1:")
    return rows.agg(
        F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(entry)), ","), F.lit("}")).alias("value")
    )
