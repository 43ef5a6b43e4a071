"""Sliding row-frame features per subject, batch and live rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wakeframe.constants import DECIMATION, EAR_CLOSED, FEATURES, WINDOW
from wakeframe.plans.ordered import KeyedRows


def circular_mean(angle: Column, frame: WindowSpec) -> Column:
    """Mean of angles in degrees that respects the seam at +-180."""
    return F.degrees(
        F.atan2(F.avg(F.sin(F.radians(angle))).over(frame), F.avg(F.cos(F.radians(angle))).over(frame))
    )


def sliding_features(
    df: DataFrame,
    keys: Sequence[str] = ("subject_id",),
    order: Sequence[str] = ("frame_id",),
    window: int = WINDOW,
    ear_closed: float = EAR_CLOSED,
    circular: bool = False,
    rows_per_segment: int | None = None,
    derived: bool = False,
) -> DataFrame:
    """Nine features and a majority label over the last ``window`` frames.

    Input columns: ``ear, mar, head_pitch, head_yaw, head_roll, label``. Rows
    with a null feature go: a sample deviation needs two frames, so that is
    the first row of each key. A label tie counts as 1.
    """
    back = window - 1

    def build(w: WindowSpec) -> dict[str, Column]:
        f = w.rowsBetween(-back, 0)
        angle = (lambda c: circular_mean(F.col(c), f)) if circular else (lambda c: F.avg(c).over(f))
        return {
            "ear_mean": F.avg("ear").over(f),
            "ear_min": F.min("ear").over(f),
            "ear_std": F.stddev("ear").over(f),
            "perclos": F.avg((F.col("ear") < ear_closed).cast("int")).over(f),
            "mar_mean": F.avg("mar").over(f),
            "mar_max": F.max("mar").over(f),
            "head_pitch_mean": angle("head_pitch"),
            "head_yaw_mean": angle("head_yaw"),
            "head_roll_mean": angle("head_roll"),
            "__label": (F.avg("label").over(f) >= 0.5).cast("int"),
        }

    needed = [*keys, *order, "ear", "mar", "head_pitch", "head_yaw", "head_roll", "label"]
    rows = KeyedRows(
        df.select(*dict.fromkeys(needed)), keys, order, halo=back, rows_per_segment=rows_per_segment, derived=derived
    )
    out = rows.frame(build).rows()
    out = out.select(*dict.fromkeys([*keys, *order]), *FEATURES, F.col("__label").alias("label"))
    return out.dropna(subset=[*FEATURES, "label"])


def decimate(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    every: int = DECIMATION,
    rows_per_segment: int | None = None,
) -> DataFrame:
    """Number the rows of each key and mark each ``every``-th as processed."""
    rows = KeyedRows(df, keys, order, rows_per_segment=rows_per_segment).position("seq").rows()
    return rows.withColumn("processed", F.col("seq") % every == 0)


def live_columns(f: WindowSpec, face: str, window: int, ear_closed: float) -> dict[str, Column]:
    """Live statistics over a row frame of at most ``window`` slots."""
    seen = F.col(face)
    closed = F.avg((seen & (F.col("ear") < ear_closed)).cast("int")).over(f)

    def valid(c: str) -> Column:
        return F.when(seen, F.col(c))

    vector = F.struct(
        F.round(F.avg(valid("ear")).over(f), 6).alias("ear_mean"),
        F.round(F.min(valid("ear")).over(f), 6).alias("ear_min"),
        F.round(F.stddev_pop(valid("ear")).over(f), 6).alias("ear_std"),
        F.round(closed, 6).alias("perclos"),
        F.round(F.avg(valid("mar")).over(f), 6).alias("mar_mean"),
        F.round(F.max(valid("mar")).over(f), 6).alias("mar_max"),
        F.round(F.avg(valid("head_pitch")).over(f), 4).alias("head_pitch_mean"),
        F.round(F.avg(valid("head_yaw")).over(f), 4).alias("head_yaw_mean"),
        F.round(F.avg(valid("head_roll")).over(f), 4).alias("head_roll_mean"),
    )
    full = F.count(F.lit(1)).over(f) >= window
    any_face = F.max(seen.cast("int")).over(f) == 1
    return {
        "features": F.when(full & any_face, vector),
        "last_ear": F.last(valid("ear"), ignorenulls=True).over(f),
        "last_mar": F.last(valid("mar"), ignorenulls=True).over(f),
        "now_perclos": F.round(closed, 4),
    }


def live_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    face: str = "face",
    window: int = WINDOW,
    ear_closed: float = EAR_CLOSED,
    rows_per_segment: int | None = None,
) -> DataFrame:
    """Live rules over the last ``window`` slots.

    Mean, minimum, maximum and population deviation use slots with a face;
    PERCLOS counts every slot. ``features`` is null until the window is full
    and while no slot has a face. ``last_ear`` and ``last_mar`` are the most
    recent values with a face inside the window.
    """
    rows = KeyedRows(df, keys, order, halo=window - 1, rows_per_segment=rows_per_segment)
    return rows.frame(lambda w: live_columns(w.rowsBetween(1 - window, 0), face, window, ear_closed)).rows()


def live_features(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    face: str = "face",
    window: int = WINDOW,
    every: int = DECIMATION,
    ear_closed: float = EAR_CLOSED,
    repeat_skipped: bool = True,
    rows_per_segment: int | None = None,
) -> DataFrame:
    """What a live session emits: one row per frame that yields a vector.

    Only each ``every``-th frame enters the window. A processed frame emits
    when it shows a face and the window is full; the skipped frames after it
    repeat the vector of the window as it stands.

    All steps keep the partitioning by key, so the rows are shuffled once.
    """
    rows = KeyedRows(df, keys, order, halo=window * every, rows_per_segment=rows_per_segment).position("seq")
    rows.with_columns(__processed=F.col("seq") % every == 0)
    # skipped frames stand alone, the processed ones of a key follow each other
    lane = F.when(F.col("__processed"), F.lit(0).cast("long")).otherwise(F.col("seq"))
    rows.with_columns(__lane=lane)
    slots = Window.partitionBy(*rows.parts, "__lane").orderBy("seq").rowsBetween(1 - window, 0)
    vector = live_columns(slots, face, window, ear_closed)["features"]
    rows.with_columns(__own=F.when(F.col("__processed"), F.struct(vector.alias("features"))))
    if repeat_skipped:
        rows.frame(lambda w: {"__held": F.last("__own", ignorenulls=True).over(w.rowsBetween(1 - every, 0))})
        shown, emits = F.col("__held.features"), ~F.col("__processed") | F.col(face)
    else:
        shown, emits = F.col("__own.features"), F.col("__processed") & F.col(face)
    out = rows.with_columns(__shown=shown).rows().filter(emits & F.col("__shown").isNotNull())
    return out.select(*keys, *order, "seq", "__shown.*")


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Bounded history: the last ``n`` rows per key, newest ranked 1."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order])
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
