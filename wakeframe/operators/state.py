"""Debounced state: consecutive hits and misses, state changes, alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeframe.constants import ALERT_FRAMES, CONFIDENCE_ALERT, DRIFT_EVERY, DROWSY_FRAMES
from wakeframe.plans.ordered import KeyedRows


def is_hit(state: Column, confidence: Column, limit: float = CONFIDENCE_ALERT) -> Column:
    return F.coalesce((state == "drowsy") & (confidence >= limit), F.lit(False))


def debounce(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hit: str = "hit",
    to_drowsy: int = DROWSY_FRAMES,
    to_alert: int = ALERT_FRAMES,
    rows_per_segment: int | None = None,
    derived: bool = False,
) -> DataFrame:
    """Adds ``seq, hits, misses, state, new_alert`` to each prediction row.

    ``to_drowsy`` hits in a row switch to drowsy, ``to_alert`` misses in a row
    switch back, anything shorter holds the state, which starts as alert.

    The length of a run is the row number minus the row number of the last row
    of the other kind, so running maxima over row numbers are all it takes.
    """
    rows = KeyedRows(df, keys, order, rows_per_segment=rows_per_segment, derived=derived).position("seq")
    seq, is_one = F.col("seq"), F.coalesce(F.col(hit), F.lit(False))
    rows.running(__last_hit=("max", F.when(is_one, seq)), __last_miss=("max", F.when(~is_one, seq)))

    def since(c):
        return seq - F.coalesce(F.col(c), F.lit(0))

    rows.with_columns(hits=since("__last_miss"), misses=since("__last_hit"))
    go, back = F.col("hits") >= to_drowsy, F.col("misses") >= to_alert
    rows.running(upto=-1, __went=("max", F.when(go, seq)), __came=("max", F.when(back, seq)))
    was_drowsy = F.coalesce(F.col("__went"), F.lit(0)) > F.coalesce(F.col("__came"), F.lit(0))
    rows.with_columns(
        state=F.when(go | (was_drowsy & ~back), "drowsy").otherwise("alert"),
        new_alert=go & ~was_drowsy,
    )
    return rows.rows().drop("__last_hit", "__last_miss", "__went", "__came")


def alert_events(debounced: DataFrame) -> DataFrame:
    """One row per change from alert to drowsy."""
    return debounced.filter("new_alert")


def alert_counts(debounced: DataFrame, keys: Sequence[str]) -> DataFrame:
    return debounced.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frames"), F.count_if("new_alert").alias("alerts")
    )


def every_nth(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    n: int = DRIFT_EVERY,
    has: str | None = None,
    rows_per_segment: int | None = None,
) -> DataFrame:
    """The rows at which a periodic message is due.

    All frames are counted; a row is due at each ``n``-th frame if column
    ``has`` is true there (a prediction exists).
    """
    rows = KeyedRows(df, keys, order, rows_per_segment=rows_per_segment).position("frame_no").rows()
    due = rows.filter(F.col("frame_no") % n == 0)
    return due.filter(F.col(has)) if has else due
