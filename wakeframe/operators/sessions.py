"""Session attachment, status, summary and activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeframe.functions.scalars import finite_or_null
from wakeframe.plans.ordered import KeyedRows


def attach(messages: DataFrame, sessions: DataFrame, key: str = "session_id") -> DataFrame:
    """Messages with their session's columns and ``known``; an orphan's are null.

    One left join: both sides are read once, whatever is done with the orphans.
    """
    there = sessions.withColumn("known", F.lit(True))
    return messages.join(there, key, "left").withColumn("known", F.coalesce("known", F.lit(False)))


# Fixed value: what a client hears that sends frames without a session.
NO_INIT = "Send 'init' message first"


def frames_without_init(
    messages: DataFrame,
    keys: Sequence[str] = ("session_id",),
    order: Sequence[str] = ("ts", "frame_id"),
    kind: str = "kind",
    rows_per_segment: int | None = None,
) -> DataFrame:
    """Frames that arrive before an init or after a close, as error rows."""
    rows = KeyedRows(messages, keys, order, rows_per_segment=rows_per_segment).position("__pos")
    at = F.col("__pos")
    rows.running(
        __opened=("max", F.when(F.col(kind) == "init", at)), __closed=("max", F.when(F.col(kind) == "close", at))
    )
    is_open = F.coalesce(F.col("__opened"), F.lit(0)) > F.coalesce(F.col("__closed"), F.lit(0))
    lost = rows.rows().filter((F.col(kind) == "frame") & ~is_open)
    return lost.drop("__pos", "__opened", "__closed").withColumn("message", F.lit(NO_INIT))


def session_spans(
    events: DataFrame,
    keys: Sequence[str] = ("session_id",),
    order: Sequence[str] = ("us", "frame_id"),
    kind: str = "kind",
    opens: Sequence[str] = ("init", "open"),
    timeout_seconds: int | None = 600,
    rows_per_segment: int | None = None,
) -> DataFrame:
    """The rows of sessions with ``span``, the row number at which theirs began (null: in none).

    A span goes from an opening message to a close, or to the last message before a gap
    of more than ``timeout_seconds`` (None: gaps don't matter). Messages before an
    opening belong to no span; an opening within a span is one more message. The first
    ``order`` column is the time in microseconds.
    """
    rows = KeyedRows(events, keys, order, halo=1, rows_per_segment=rows_per_segment).position("__pos")
    at = order[0]
    rows.frame(lambda w: {"__before": F.lag(at).over(w), "__was": F.lag(kind).over(w)})
    fresh = F.col("__was").eqNullSafe(F.lit("close"))
    if timeout_seconds is not None:
        fresh = fresh | F.coalesce(F.col(at) - F.col("__before") > timeout_seconds * 1_000_000, F.lit(False))
    rows.with_columns(__fresh=fresh | (F.col("__pos") == 1))
    rows.running(
        __reset=("max", F.when(F.col("__fresh"), F.col("__pos"))),
        __opened=("max", F.when(F.col(kind).isin(*opens), F.col("__pos"))),
    )
    inside = F.col("__opened") >= F.col("__reset")
    out = rows.rows().withColumn("span", F.when(inside, F.col("__reset")))
    return out.drop("__pos", "__before", "__was", "__fresh", "__reset", "__opened")


def span_summary(
    events: DataFrame,
    keys: Sequence[str] = ("session_id",),
    order: Sequence[str] = ("us", "frame_id"),
    kind: str = "kind",
    ear: str = "ear",
    confidence: str = "confidence",
    new_alert: str = "new_alert",
    timeout_seconds: int | None = 600,
    now_us: Column | int | None = None,
    rows_per_segment: int | None = None,
) -> DataFrame:
    """One row per span: start, end, length, frames, alerts, means and how it ended.

    ``ended_by`` is close, timeout (a later message came after the gap, or ``now_us`` has
    passed it) or active; an active span ends ``now_us`` (the current time).
    """
    at, is_frame = order[0], F.col(kind) == "frame"
    now = F.unix_micros(F.current_timestamp()) if now_us is None else (F.lit(now_us) if isinstance(now_us, int) else now_us)
    rows = session_spans(events, keys, order, kind, timeout_seconds=timeout_seconds, rows_per_segment=rows_per_segment)

    def finite(c: str) -> Column:
        return F.when(is_frame, finite_or_null(F.col(c).cast("double")))

    spans = rows.filter("span is not null").groupBy(*keys, "span").agg(
        F.min(at).alias("started_us"),
        F.max(at).alias("__last"),
        F.max(F.when(F.col(kind) == "close", F.col(at))).alias("__closed"),
        F.count_if(is_frame).alias("frames"),
        F.count_if(is_frame & F.coalesce(F.col(new_alert), F.lit(False))).alias("alerts"),
        F.round(F.avg(finite(ear)), 4).alias("average_ear"),
        F.round(F.avg(finite(confidence)), 4).alias("average_confidence"),
    )
    latest_us = events.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max(at).alias("__seen"))
    same = [spans[k].eqNullSafe(latest_us[f"__{k}"]) for k in keys]
    on = same[0]
    for more in same[1:]:
        on = on & more
    spans = spans.join(latest_us, on)
    silent = F.lit(False)
    if timeout_seconds is not None:
        silent = F.greatest(F.col("__seen"), now) - F.col("__last") > timeout_seconds * 1_000_000
    how = F.when(F.col("__closed").isNotNull(), "close").when(silent, "timeout").otherwise("active")
    ended = F.when(F.col("__closed").isNotNull(), F.col("__closed")).when(silent, F.col("__last")).otherwise(now)
    return spans.select(
        *keys,
        "started_us",
        ended.alias("ended_us"),
        F.round((ended - F.col("started_us")) / 1_000_000, 2).alias("duration_seconds"),
        "frames", "alerts", "average_ear", "average_confidence",
        how.alias("ended_by"),
    )


def session_summary(
    events: DataFrame,
    keys: Sequence[str] = ("session_id",),
    ts: str = "ts",
    kind: str = "kind",
    ear: str = "ear",
    confidence: str = "confidence",
    new_alert: str = "new_alert",
    now: Column | None = None,
    tie: str | None = None,
) -> DataFrame:
    """``span_summary`` with timestamps, for sessions that end by a close only: one row per span.

    ``tie`` orders messages of one time. A span without a close is active and ends
    ``now`` (the current time).
    """
    now = F.current_timestamp() if now is None else now
    timed = events.withColumn("__us", F.unix_micros(F.col(ts).cast("timestamp")))
    spans = span_summary(
        timed, keys, ["__us", tie] if tie else ["__us"], kind, ear, confidence, new_alert, None,
        F.unix_micros(now.cast("timestamp")),
    )
    kept = events.schema[ts].dataType
    return spans.select(
        *keys,
        F.timestamp_micros("started_us").cast(kept).alias("started_at"),
        F.timestamp_micros("ended_us").cast(kept).alias("ended_at"),
        "duration_seconds", "frames", "alerts", "average_ear", "average_confidence",
        F.when(F.col("ended_by") == "close", "completed").otherwise("active").alias("status"),
    )


def latest(value: str, order: Column) -> Column:
    """The last value that is not null, by the order column."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), order))


def session_status(
    rows: DataFrame, keys: Sequence[str], order: Column, values: Sequence[str], counters: dict[str, Column] | None = None
) -> DataFrame:
    """Latest value of each column and counters per session, in one aggregation."""
    return rows.groupBy(*keys).agg(
        *[latest(v, order).alias(f"current_{v}") for v in values],
        *[c.alias(n) for n, c in (counters or {}).items()],
    )


def open_sessions(events: DataFrame, key: str = "session_id", kind: str = "kind") -> DataFrame:
    """Sessions opened and not closed."""
    state = events.groupBy(key).agg(
        F.max((F.col(kind) == "open").cast("int")).alias("o"), F.max((F.col(kind) == "close").cast("int")).alias("c")
    )
    return state.filter("o = 1 AND c = 0").select(key)


def activity(
    events: DataFrame, ts: str = "ts", kind: str = "kind", rows_per_segment: int | None = None
) -> DataFrame:
    """Number of active sessions after each instant at which it changes."""
    change = F.when(F.col(kind) == "open", 1).when(F.col(kind) == "close", -1)
    steps = (
        events.filter(F.col(kind).isin("open", "close"))
        .groupBy(ts)
        .agg(F.sum(change).alias("change"))
    )
    rows = KeyedRows(steps, [], [ts], rows_per_segment=rows_per_segment, derived=True)
    return rows.running(active=("sum", F.col("change"))).rows()
