"""Explicit schemas of the tables the engine reads."""

from __future__ import annotations

from pyspark.sql import types as T

from wakeframe.constants import FEATURES, N_LANDMARKS

POINT = T.StructType([T.StructField(a, T.DoubleType()) for a in "xyz"])

LANDMARKS = T.StructType(
    [
        T.StructField("subject_id", T.StringType()),
        T.StructField("frame_id", T.LongType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("landmarks", T.ArrayType(POINT)),
    ]
)

FRAME_FEATURES = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in ("ear", "mar", "head_pitch", "head_yaw", "head_roll")]
    + [
        T.StructField("label", T.IntegerType()),
        T.StructField("subject_id", T.StringType()),
        T.StructField("frame_id", T.LongType()),
    ]
)

WINDOW_FEATURES = T.StructType(
    [T.StructField("subject_id", T.StringType()), T.StructField("frame_id", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in FEATURES]
    + [T.StructField("label", T.IntegerType())]
)

BASELINE_STATS = ["mean", "std", "variance", "min", "max", "p5", "p25", "p50", "p75", "p95"]
BASELINE_FEATURE = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in BASELINE_STATS]
    + [
        T.StructField("histogram_density", T.ArrayType(T.DoubleType())),
        T.StructField("histogram_bins", T.ArrayType(T.DoubleType())),
    ]
)
BASELINE_DOCUMENT = T.StructType(
    [
        T.StructField("description", T.StringType()),
        T.StructField("window_size", T.IntegerType()),
        T.StructField("n_samples", T.LongType()),
        T.StructField("features", T.MapType(T.StringType(), BASELINE_FEATURE)),
    ]
)

MESSAGE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("frame_id", T.LongType()),
        T.StructField("window_size", T.IntegerType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("payload", T.StringType()),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

ALERTS = T.StructType(
    [
        T.StructField(
            "alerts",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
                        T.StructField("status", T.StringType()),
                    ]
                )
            ),
        )
    ]
)

PAIRS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]))
NUMBER_PAIRS = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.DoubleType())])
)
RUN = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("start_time", T.LongType()),
        T.StructField("metrics", NUMBER_PAIRS),
        T.StructField("params", PAIRS),
        T.StructField("tags", PAIRS),
    ]
)


def wide_landmarks(n: int = N_LANDMARKS) -> T.StructType:
    """Schema of the wide landmark file: four meta columns and three per point."""
    meta = [
        T.StructField("frame_path", T.StringType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("subject_id", T.StringType()),
        T.StructField("frame_id", T.LongType()),
    ]
    points = [T.StructField(f"lm_{i}_{axis}", T.DoubleType()) for i in range(n) for axis in "xyz"]
    return T.StructType(meta + points)
