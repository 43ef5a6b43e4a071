"""Facial geometry as Column expressions over an array of landmark points.

``points`` is ``ARRAY<STRUCT<x, y, z>>`` with x and y relative to the image.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeframe.constants import (
    FRAME_HEIGHT,
    FRAME_WIDTH,
    LEFT_EYE,
    MOUTH,
    N_LANDMARKS,
    POSE_POINTS,
    RIGHT_EYE,
)
from wakeframe.functions.pose import head_pose

DEGENERATE = 1e-6


def pack_landmarks(df: DataFrame, n: int = N_LANDMARKS, name: str = "landmarks", prefix: str = "lm") -> DataFrame:
    """Fold the wide columns ``lm_<i>_x|y|z`` into one array of points."""
    points = [
        F.struct(*[F.col(f"{prefix}_{i}_{axis}").cast("double").alias(axis) for axis in "xyz"]) for i in range(n)
    ]
    wide = {f"{prefix}_{i}_{axis}" for i in range(n) for axis in "xyz"}
    kept = [c for c in df.columns if c not in wide]
    return df.select(*kept, F.array(*points).alias(name))


def keep_mesh(points: Column, n: int = N_LANDMARKS) -> Column:
    """The first ``n`` points; refined meshes append more."""
    return F.slice(points, 1, n)


def to_pixels(points: Column, width: int = FRAME_WIDTH, height: int = FRAME_HEIGHT) -> Column:
    """Relative coordinates to pixels; z is dropped."""
    return F.transform(points, lambda p: F.struct((p["x"] * width).alias("x"), (p["y"] * height).alias("y")))


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two points in the plane."""
    dx, dy = a["x"] - b["x"], a["y"] - b["y"]
    return F.sqrt(dx * dx + dy * dy)


def _pixel_points(points: Column, at: Sequence[int], width: int, height: int) -> list[Column]:
    out = []
    for i in at:
        p = F.get(points, F.lit(i))
        out.append({"x": p["x"] * width, "y": p["y"] * height})
    return out


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom < DEGENERATE, F.lit(0.0)).otherwise(F.try_divide(top, bottom))


def eye_ratio(points: Column, eye: Sequence[int], width: int = FRAME_WIDTH, height: int = FRAME_HEIGHT) -> Column:
    """Eye aspect ratio: mean lid opening over eye width; 0 for a collapsed eye."""
    p1, p2, p3, p4, p5, p6 = _pixel_points(points, eye, width, height)
    across = distance(p1, p4)
    opening = distance(p2, p6) + distance(p3, p5)
    return F.when(across < DEGENERATE, F.lit(0.0)).otherwise(F.try_divide(opening, 2.0 * across))


def both_eyes_ratio(
    points: Column,
    right: Sequence[int] = RIGHT_EYE,
    left: Sequence[int] = LEFT_EYE,
    width: int = FRAME_WIDTH,
    height: int = FRAME_HEIGHT,
) -> Column:
    return (eye_ratio(points, right, width, height) + eye_ratio(points, left, width, height)) / 2.0


def mouth_ratio(
    points: Column, mouth: Sequence[int] = MOUTH, width: int = FRAME_WIDTH, height: int = FRAME_HEIGHT
) -> Column:
    """Mouth aspect ratio: centre opening over corner distance; 0 if collapsed."""
    if len(mouth) < 8:
        return F.lit(0.0)
    p = _pixel_points(points, mouth, width, height)
    return _ratio(distance(p[4], p[5]), distance(p[0], p[1]))


def euler_angles(r: dict[str, Column], places: int = 4) -> Column:
    """Pitch, yaw and roll in degrees from the entries ``r00 .. r22``."""
    sy = F.sqrt(r["r00"] * r["r00"] + r["r10"] * r["r10"])
    singular = sy < DEGENERATE
    pitch = F.when(singular, F.atan2(-r["r12"], r["r11"])).otherwise(F.atan2(r["r21"], r["r22"]))
    yaw = F.atan2(-r["r20"], sy)
    roll = F.when(singular, F.lit(0.0)).otherwise(F.atan2(r["r10"], r["r00"]))
    return F.struct(
        F.round(F.degrees(pitch), places).alias("pitch"),
        F.round(F.degrees(yaw), places).alias("yaw"),
        F.round(F.degrees(roll), places).alias("roll"),
    )


def frame_features(
    df: DataFrame,
    points: str = "landmarks",
    right: Sequence[int] = RIGHT_EYE,
    left: Sequence[int] = LEFT_EYE,
    mouth: Sequence[int] = MOUTH,
    pose: Sequence[int] = POSE_POINTS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row of ratios and angles per frame, with the defaults for missing keys."""
    lm = F.col(points)

    def given(name, kind, default):
        value = F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
        return F.coalesce(value, F.lit(default)).alias(name)

    posed = df.withColumn("__pose", head_pose(lm, pose))
    return posed.select(
        *keep,
        F.round(both_eyes_ratio(lm, right, left), 6).alias("ear"),
        F.round(mouth_ratio(lm, mouth), 6).alias("mar"),
        F.col("__pose.pitch").alias("head_pitch"),
        F.col("__pose.yaw").alias("head_yaw"),
        F.col("__pose.roll").alias("head_roll"),
        given("label", "int", 0),
        given("subject_id", "string", "unknown"),
        given("frame_id", "long", 0),
    )
