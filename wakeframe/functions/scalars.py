"""Small numeric rules: flags, clamping, scaling, validity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeframe.constants import (
    CONFIDENCE_ALERT,
    EAR_CLOSED,
    FEATURE_RANGES,
    MAR_YAWN,
    PERCLOS_STRONG,
)


def eye_closed(ear: Column, limit: float = EAR_CLOSED) -> Column:
    return (ear < limit).cast("int")


def rule_flags(ear: Column, mar: Column, perclos: Column) -> dict[str, Column]:
    return {
        "closed": ear < EAR_CLOSED,
        "yawn": mar > MAR_YAWN,
        "strong_perclos": perclos > PERCLOS_STRONG,
    }


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def finite_or_null(value: Column) -> Column:
    return F.when(is_finite(value), value)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def clamp(value: Column, low: float | None, high: float | None) -> Column:
    out = value
    if high is not None:
        out = F.least(out, F.lit(high))
    if low is not None:
        out = F.greatest(out, F.lit(low))
    return F.when(value.isNotNull(), out)


def clamp_feature(name: str, value: Column) -> Column:
    return clamp(value, *FEATURE_RANGES.get(name, (None, None)))


def scale(value: Column, low: float, high: float) -> Column:
    """Position between ``low`` and ``high``, bounded to 0..1."""
    return clamp((value - low) / (high - low), 0.0, 1.0)


def range_problems(ranges: dict[str, tuple[float | None, float | None]] | None = None) -> Column:
    """Array of reasons why a feature row is not acceptable; empty if it is."""
    reasons = []
    for name, (low, high) in (ranges or FEATURE_RANGES).items():
        value = F.col(name).try_cast("double")
        reasons.append(F.when(value.isNull() | F.isnan(value), F.lit(f"{name}: missing or not a number")))
        if low is not None:
            reasons.append(F.when(value < low, F.lit(f"{name}: below {low:g}")))
        if high is not None:
            reasons.append(F.when((value > high) & ~F.isnan(value), F.lit(f"{name}: above {high:g}")))
    return F.filter(F.array(*reasons), lambda r: r.isNotNull())


def validated(df, ranges=None):
    """All rows with ``problems``, the reasons against them, and ``valid``: one pass for both sides."""
    return df.withColumn("problems", range_problems(ranges)).withColumn("valid", F.size("problems") == 0)


def split_valid(df, ranges=None):
    """Accepted rows, and rejected rows with their reasons, as two tables (``validated`` reads once)."""
    checked = validated(df, ranges)
    return checked.filter("valid").drop("problems", "valid"), checked.filter("not valid").drop("valid")


def predicted_state(confidence: Column, cut: float = 0.5) -> Column:
    return F.when(confidence >= cut, "drowsy").otherwise("alert")


def alert_decision(state: Column, confidence: Column, limit: float = CONFIDENCE_ALERT) -> Column:
    return (state == "drowsy") & (confidence >= limit)
