"""Window queries: sliding features, live windows, histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeframe.functions import scalars as S
from wakeframe.operators import windows
from wakeframe.plans.ordered import KeyedRows
from wakeframe.suite.frames import EVENT_FRAMES, LINE_FRAMES, LINE_ORDER, event_frames, line_frames, rounded
from wakeframe.suite.registry import query, table

SLIDING = """
  SELECT {keys},
         avg(ear) OVER w AS ear_mean, min(ear) OVER w AS ear_min, stddev_samp(ear) OVER w AS ear_std,
         avg(CASE WHEN ear < {closed} THEN 1.0 ELSE 0.0 END) OVER w AS perclos,
         avg(mar) OVER w AS mar_mean, max(mar) OVER w AS mar_max,
         avg(head_pitch) OVER w AS head_pitch_mean, avg(head_yaw) OVER w AS head_yaw_mean,
         avg(head_roll) OVER w AS head_roll_mean, avg(label) OVER w AS label_mean
  FROM frames
  WINDOW w AS (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {back} PRECEDING AND CURRENT ROW)
"""
ROUNDED = """
  SELECT {keys}, round(ear_mean, 6) AS ear_mean, round(ear_min, 6) AS ear_min, round(ear_std, 6) AS ear_std,
         round(perclos, 6) AS perclos, round(mar_mean, 6) AS mar_mean, round(mar_max, 6) AS mar_max,
         round(head_pitch_mean, 6) AS head_pitch_mean, round(head_yaw_mean, 6) AS head_yaw_mean,
         round(head_roll_mean, 6) AS head_roll_mean, CASE WHEN label_mean >= 0.5 THEN 1 ELSE 0 END AS label
  FROM windows WHERE ear_std IS NOT NULL
"""


def sliding_sql(frames: str, keys: str, part: str, order: str, window: int, closed: float) -> str:
    body = SLIDING.format(keys=keys, part=part, order=order, back=window - 1, closed=closed)
    return f"WITH {frames}, windows AS ({body}) {ROUNDED.format(keys=keys)}"


EVENT_SLIDING = sliding_sql(EVENT_FRAMES, "subject_id, frame_id", "subject_id", "ts, frame_id", 30, 0.25)


def _event_sliding(spark, folder, **options):
    out = windows.sliding_features(
        event_frames(spark, folder), ["subject_id"], ["ts", "frame_id"], **options
    )
    return rounded(out.drop("ts"))


@query("sliding_features", EVENT_SLIDING)
def sliding_features(spark, folder):
    """Nine features over the last 30 frames of each subject."""
    return _event_sliding(spark, folder)


@query("sliding_features_split", EVENT_SLIDING)
def sliding_features_split(spark, folder):
    """The same with every subject cut into segments of about 40 rows."""
    return _event_sliding(spark, folder, rows_per_segment=40)


@query(
    "sliding_features_lineitem",
    sliding_sql(
        LINE_FRAMES, f"l_suppkey, {', '.join(LINE_ORDER)}", "l_suppkey", ", ".join(LINE_ORDER), 30, 0.25
    ),
)
def sliding_features_lineitem(spark, folder):
    """The window job at bench size."""
    return rounded(windows.sliding_features(line_frames(spark, folder), ["l_suppkey"], LINE_ORDER))


@query(
    "sliding_features_two_frames",
    sliding_sql(EVENT_FRAMES, "subject_id, frame_id", "subject_id", "ts, frame_id", 2, 0.3),
)
def sliding_features_two_frames(spark, folder):
    """Another window size and threshold; label ties count as 1."""
    return _event_sliding(spark, folder, window=2, ear_closed=0.3)


@query(
    "circular_angle_mean",
    f"""
    WITH {EVENT_FRAMES}
    SELECT subject_id, frame_id,
           round(degrees(atan2(avg(sin(radians(head_pitch))) OVER w, avg(cos(radians(head_pitch))) OVER w)), 6)
             AS pitch_mean
    FROM frames
    WINDOW w AS (PARTITION BY subject_id ORDER BY ts, frame_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
    """,
)
def circular_angle_mean(spark, folder):
    rows = KeyedRows(event_frames(spark, folder), ["subject_id"], ["ts", "frame_id"], halo=29)
    rows.frame(lambda w: {"pitch_mean": windows.circular_mean(F.col("head_pitch"), w.rowsBetween(-29, 0))})
    return rounded(rows.rows().select("subject_id", "frame_id", "pitch_mean"))


@query(
    "full_windows",
    f"""
    WITH {EVENT_FRAMES}, n AS (
      SELECT subject_id, frame_id, count(*) OVER (PARTITION BY subject_id ORDER BY ts, frame_id
             ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS slots FROM frames)
    SELECT subject_id, frame_id, slots FROM n WHERE slots = 30
    """,
)
def full_windows(spark, folder):
    """Rows whose window is filled."""
    rows = KeyedRows(event_frames(spark, folder), ["subject_id"], ["ts", "frame_id"], halo=29)
    rows.frame(lambda w: {"slots": F.count(F.lit(1)).over(w.rowsBetween(-29, 0))})
    return rows.rows().filter("slots = 30").select("subject_id", "frame_id", "slots")


LIVE_WINDOWS = """
  slots AS (
    SELECT *, count(*) OVER w AS slots, max(CASE WHEN face THEN 1 ELSE 0 END) OVER w AS any_face,
      avg(CASE WHEN face THEN ear END) OVER w AS ear_mean, min(CASE WHEN face THEN ear END) OVER w AS ear_min,
      stddev_pop(CASE WHEN face THEN ear END) OVER w AS ear_std,
      avg(CASE WHEN face AND ear < 0.25 THEN 1.0 ELSE 0.0 END) OVER w AS perclos,
      avg(CASE WHEN face THEN mar END) OVER w AS mar_mean, max(CASE WHEN face THEN mar END) OVER w AS mar_max,
      avg(CASE WHEN face THEN head_pitch END) OVER w AS head_pitch_mean,
      avg(CASE WHEN face THEN head_yaw END) OVER w AS head_yaw_mean,
      avg(CASE WHEN face THEN head_roll END) OVER w AS head_roll_mean,
      last_value(CASE WHEN face THEN ear END IGNORE NULLS) OVER w AS last_ear,
      last_value(CASE WHEN face THEN mar END IGNORE NULLS) OVER w AS last_mar
    FROM {source}
    WINDOW w AS (PARTITION BY subject_id ORDER BY ts, frame_id ROWS BETWEEN {back} PRECEDING AND CURRENT ROW)),
  vectors AS (
    SELECT *, slots >= {window} AND any_face = 1 AS ready,
      round(ear_mean, 6) AS v1, round(ear_min, 6) AS v2, round(ear_std, 6) AS v3, round(perclos, 6) AS v4,
      round(mar_mean, 6) AS v5, round(mar_max, 6) AS v6, round(head_pitch_mean, 4) AS v7,
      round(head_yaw_mean, 4) AS v8, round(head_roll_mean, 4) AS v9
    FROM slots)
"""
VECTOR = """v1 AS ear_mean, v2 AS ear_min, v3 AS ear_std, v4 AS perclos, v5 AS mar_mean, v6 AS mar_max,
  v7 AS head_pitch_mean, v8 AS head_yaw_mean, v9 AS head_roll_mean"""


@query(
    "live_window_features",
    f"""
    WITH {EVENT_FRAMES}, {LIVE_WINDOWS.format(source="frames", back=9, window=10)}
    SELECT subject_id, frame_id, {VECTOR} FROM vectors WHERE ready
    """,
)
def live_window_features(spark, folder):
    """Live window of 10 slots: valid-frame statistics, PERCLOS over all slots."""
    out = windows.live_windows(event_frames(spark, folder), ["subject_id"], ["ts", "frame_id"], window=10)
    return out.filter("features IS NOT NULL").select("subject_id", "frame_id", "features.*")


@query(
    "last_valid_values",
    f"""
    WITH {EVENT_FRAMES}, {LIVE_WINDOWS.format(source="frames", back=9, window=10)}
    SELECT subject_id, frame_id, round(last_ear, 6) AS last_ear, round(last_mar, 6) AS last_mar,
           round(perclos, 4) AS now_perclos FROM vectors
    """,
)
def last_valid_values(spark, folder):
    """Most recent EAR and MAR with a face, current PERCLOS."""
    out = windows.live_windows(
        event_frames(spark, folder), ["subject_id"], ["ts", "frame_id"], window=10, rows_per_segment=50
    )
    return out.select(
        "subject_id", "frame_id", F.round("last_ear", 6).alias("last_ear"), F.round("last_mar", 6).alias("last_mar"),
        "now_perclos",
    )


@query(
    "live_emissions",
    f"""
    WITH {EVENT_FRAMES}, numbered AS (
      SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY ts, frame_id) AS seq FROM frames),
    picked AS (SELECT * FROM numbered WHERE seq % 7 = 0),
    {LIVE_WINDOWS.format(source="picked", back=4, window=5)}
    SELECT n.subject_id, n.frame_id, n.seq, {VECTOR}
    FROM numbered n JOIN vectors v ON n.subject_id = v.subject_id AND n.seq // 7 = v.seq // 7
    WHERE v.ready AND (n.seq % 7 <> 0 OR n.face)
    """,
)
def live_emissions(spark, folder):
    """One in seven frames is processed; skipped frames repeat the vector."""
    return windows.live_features(
        event_frames(spark, folder), ["subject_id"], ["ts", "frame_id"], window=5
    ).drop("ts")


@query(
    "decimated_frames",
    f"""
    WITH {EVENT_FRAMES}, numbered AS (
      SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY ts, frame_id) AS seq FROM frames)
    SELECT subject_id, frame_id, seq FROM numbered WHERE seq % 7 = 0
    """,
)
def decimated_frames(spark, folder):
    out = windows.decimate(event_frames(spark, folder), ["subject_id"], ["ts", "frame_id"], rows_per_segment=30)
    return out.filter("processed").select("subject_id", "frame_id", "seq")


@query(
    "latest_points",
    """
    WITH r AS (SELECT user_id, event_id, value,
               row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM events)
    SELECT user_id, event_id, value, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 20
    """,
)
def latest_points(spark, folder):
    """Bounded history: the last 20 points per series, newest first."""
    ev = table(spark, folder, "events").select("user_id", "ts", "event_id", "value")
    return windows.latest_rows(ev, ["user_id"], ["ts", "event_id"], 20).drop("ts")


@query(
    "rule_flags",
    f"""
    WITH {EVENT_FRAMES}
    SELECT subject_id, count(*) FILTER (ear < 0.25) AS closed, count(*) FILTER (mar > 0.6) AS yawns,
           count(*) FILTER (ear > 0.8) AS strong
    FROM frames GROUP BY subject_id
    """,
)
def rule_flags(spark, folder):
    """How often each threshold rule holds per subject."""
    flags = S.rule_flags(F.col("ear"), F.col("mar"), F.col("ear"))
    return (
        event_frames(spark, folder)
        .select("subject_id", *[c.alias(n) for n, c in flags.items()])
        .groupBy("subject_id")
        .agg(
            F.count_if("closed").alias("closed"),
            F.count_if("yawn").alias("yawns"),
            F.count_if("strong_perclos").alias("strong"),
        )
    )
