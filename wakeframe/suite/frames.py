"""Frame tables taken from the driver's tables, shared by several queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeframe.suite.registry import table

# Stand-in frame signals from ``events``: value is 0..490 with two decimals. The
# prime divisors keep window means off the exact halves, where two engines may
# round apart.
EVENT_FRAMES = """
frames AS (
  SELECT user_id AS subject_id, event_id AS frame_id, ts,
         value / 100.9 AS ear, value / 202.6 AS mar,
         value / 1.019 - 60 AS head_pitch, 30 - value / 2.042 AS head_yaw, value / 10.31 AS head_roll,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
         event_type <> 'signup' AS face
  FROM events)
"""


def event_frames(spark: SparkSession, folder: str) -> DataFrame:
    ev = table(spark, folder, "events")
    v = F.col("value")
    return ev.select(
        F.col("user_id").alias("subject_id"),
        F.col("event_id").alias("frame_id"),
        "ts",
        (v / 100.9).alias("ear"),
        (v / 202.6).alias("mar"),
        (v / 1.019 - 60).alias("head_pitch"),
        (30 - v / 2.042).alias("head_yaw"),
        (v / 10.31).alias("head_roll"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("label"),
        (F.col("event_type") != "signup").alias("face"),
    )


# The large stand-in: ``lineitem`` rows of a supplier in shipping order.
LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
LINE_FRAMES = """
frames AS (
  SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
         l_quantity / 100 AS ear, l_discount * 10 AS mar,
         l_tax * 100 - 4 AS head_pitch, l_discount - l_tax AS head_yaw, l_quantity - 25 AS head_roll,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label
  FROM lineitem)
"""


def line_frames(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem")
    return li.select(
        "l_suppkey",
        *LINE_ORDER,
        (F.col("l_quantity") / 100).alias("ear"),
        (F.col("l_discount") * 10).alias("mar"),
        (F.col("l_tax") * 100 - 4).alias("head_pitch"),
        (F.col("l_discount") - F.col("l_tax")).alias("head_yaw"),
        (F.col("l_quantity") - 25).alias("head_roll"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
    )


def rounded(df: DataFrame, places: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column, so that both engines agree on the digits."""
    return df.select(
        *[
            F.round(c, places).alias(c) if t == "double" and c not in skip else F.col(c)
            for c, t in df.dtypes
        ]
    )
