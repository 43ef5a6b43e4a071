"""Debounced state and sessions over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeframe.operators import sessions as N
from wakeframe.operators import state as ST
from wakeframe.suite.registry import query, table

DEBOUNCED = """
  rn AS (SELECT user_id, event_id, ts, value, event_type, value >= 40 AS hit,
      row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events),
  last AS (SELECT *, coalesce(max(CASE WHEN hit THEN seq END) OVER w, 0) AS lh,
      coalesce(max(CASE WHEN NOT hit THEN seq END) OVER w, 0) AS lm FROM rn
    WINDOW w AS (PARTITION BY user_id ORDER BY seq ROWS UNBOUNDED PRECEDING)),
  cmd AS (SELECT *, seq - lm AS hits, seq - lh AS misses,
      CASE WHEN seq - lm >= 3 THEN 'drowsy' WHEN seq - lh >= 2 THEN 'alert' END AS command FROM last),
  held AS (SELECT *, coalesce(last_value(command IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY seq
      ROWS UNBOUNDED PRECEDING), 'alert') AS state FROM cmd),
  deb AS (SELECT *, state = 'drowsy' AND lag(state, 1, 'alert') OVER (PARTITION BY user_id ORDER BY seq) = 'alert'
      AS new_alert FROM held)
"""


def hits(spark, folder):
    return table(spark, folder, "events").select(
        "user_id", "event_id", "ts", "value", "event_type", (F.col("value") >= 40).alias("hit")
    )


def debounced(spark, folder, **options):
    return ST.debounce(
        hits(spark, folder), ["user_id"], ["ts", "event_id"], to_drowsy=3, to_alert=2, **options
    )


STATE_SQL = f"WITH {DEBOUNCED} SELECT event_id, seq, hits, misses, state, new_alert FROM deb"
STATE_COLUMNS = ["event_id", "seq", "hits", "misses", "state", "new_alert"]


@query("debounced_state", STATE_SQL)
def debounced_state(spark, folder):
    """Three hits switch to drowsy, two misses switch back."""
    return debounced(spark, folder).select(*STATE_COLUMNS)


@query("debounced_state_split", STATE_SQL)
def debounced_state_split(spark, folder):
    """The same with runs crossing segment borders."""
    return debounced(spark, folder, rows_per_segment=20).select(*STATE_COLUMNS)


@query(
    "debounced_state_global",
    STATE_SQL.replace("PARTITION BY user_id ", ""),
)
def debounced_state_global(spark, folder):
    """One history for the whole table, in segments of 500 rows."""
    return ST.debounce(
        hits(spark, folder), [], ["ts", "event_id"], to_drowsy=3, to_alert=2, rows_per_segment=500
    ).select(*STATE_COLUMNS)


@query("alert_events", f"WITH {DEBOUNCED} SELECT user_id, event_id, seq FROM deb WHERE new_alert")
def alert_events(spark, folder):
    """One row per change from alert to drowsy."""
    return ST.alert_events(debounced(spark, folder)).select("user_id", "event_id", "seq")


@query(
    "alert_counts",
    f"WITH {DEBOUNCED} SELECT user_id, count(*) AS frames, count(*) FILTER (new_alert) AS alerts FROM deb GROUP BY user_id",
)
def alert_counts(spark, folder):
    return ST.alert_counts(debounced(spark, folder), ["user_id"])


@query(
    "periodic_rows",
    """
    WITH r AS (SELECT user_id, event_id, event_type,
      row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS frame_no FROM events)
    SELECT user_id, event_id, frame_no FROM r WHERE frame_no % 10 = 0 AND event_type <> 'signup'
    """,
)
def periodic_rows(spark, folder):
    """Every tenth frame of a session, if it has a prediction."""
    ev = table(spark, folder, "events").select(
        "user_id", "event_id", "ts", (F.col("event_type") != "signup").alias("predicted")
    )
    return ST.every_nth(ev, ["user_id"], ["ts", "event_id"], 10, "predicted").select("user_id", "event_id", "frame_no")


KINDS = """
  kinds AS (SELECT *, CASE WHEN event_type = 'signup' THEN 'open' WHEN event_type = 'purchase' THEN 'close'
      ELSE 'frame' END AS kind FROM deb)
"""


def session_events(spark, folder):
    kind = (
        F.when(F.col("event_type") == "signup", "open")
        .when(F.col("event_type") == "purchase", "close")
        .otherwise("frame")
    )
    return debounced(spark, folder).select(
        F.col("user_id").alias("session_id"),
        "event_id",
        "ts",
        kind.alias("kind"),
        (F.col("value") / 50.1).alias("ear"),
        (F.col("value") / 491.3).alias("confidence"),
        "state",
        "new_alert",
    )


#: Rows inside spans: from an opening to a close; ``gap``: or to so many silent microseconds.
def spans_sql(gap: int | None = None) -> str:
    silent = f" OR epoch_us(ts) - epoch_us(was_ts) > {gap}" if gap else ""
    return f"""
  lagged AS (SELECT *, lag(ts) OVER w AS was_ts, lag(kind) OVER w AS was FROM kinds
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  grouped AS (SELECT *, sum(CASE WHEN was = 'close'{silent} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id
      ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM lagged),
  opened AS (SELECT *, min(CASE WHEN kind = 'open' THEN (ts, event_id) END) OVER (PARTITION BY user_id, grp) AS start
      FROM grouped),
  inside AS (SELECT * FROM opened WHERE (ts, event_id) >= start)
"""


SUMMARY = """
  s AS (SELECT user_id AS session_id, grp, min(ts) AS a, max(ts) AS last, max(ts) FILTER (kind = 'close') AS b,
      count(*) FILTER (kind = 'frame') AS frames, count(*) FILTER (kind = 'frame' AND new_alert) AS alerts,
      round(avg(value / 50.1) FILTER (kind = 'frame'), 4) AS average_ear,
      round(avg(value / 491.3) FILTER (kind = 'frame'), 4) AS average_confidence FROM inside GROUP BY user_id, grp)
"""


@query(
    "session_summary",
    f"""
    WITH {DEBOUNCED}, {KINDS}, {spans_sql()}, {SUMMARY}
    SELECT session_id, epoch_us(a) AS started_us, epoch_us(coalesce(b, TIMESTAMP '2024-02-01')) AS ended_us,
      round((epoch_us(coalesce(b, TIMESTAMP '2024-02-01')) - epoch_us(a)) / 1000000, 2) AS duration_seconds,
      frames, alerts, average_ear, average_confidence,
      CASE WHEN b IS NULL THEN 'active' ELSE 'completed' END AS status
    FROM s
    """,
)
def session_summary(spark, folder):
    """One row per span, from an opening to its close."""
    out = N.session_summary(session_events(spark, folder), now=F.lit("2024-02-01").cast("timestamp_ntz"), tie="event_id")
    return out.select(
        "session_id",
        F.unix_micros(F.col("started_at").cast("timestamp")).alias("started_us"),
        F.unix_micros(F.col("ended_at").cast("timestamp")).alias("ended_us"),
        "duration_seconds", "frames", "alerts", "average_ear", "average_confidence", "status",
    )


SPANS_NOW = "TIMESTAMP '2024-01-30 12:00:00'"
SPANS_SQL = f"""
    WITH {DEBOUNCED}, {KINDS}, {spans_sql(86_400_000_000)}, {SUMMARY},
    seen AS (SELECT user_id AS session_id, greatest(max(ts), {SPANS_NOW}) AS seen FROM events GROUP BY user_id),
    e AS (SELECT s.*, CASE WHEN b IS NOT NULL THEN 'close' WHEN epoch_us(seen) - epoch_us(last) > 86400000000
        THEN 'timeout' ELSE 'active' END AS ended_by FROM s JOIN seen USING (session_id)),
    t AS (SELECT *, epoch_us(CASE ended_by WHEN 'close' THEN b WHEN 'timeout' THEN last ELSE {SPANS_NOW} END) AS ended_us
        FROM e)
    SELECT session_id, epoch_us(a) AS started_us, ended_us, round((ended_us - epoch_us(a)) / 1000000, 2) AS duration_seconds,
      frames, alerts, average_ear, average_confidence, ended_by
    FROM t
"""


def _spans(spark, folder, **options):
    events = session_events(spark, folder).withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    now = F.unix_micros(F.lit("2024-01-30 12:00:00").cast("timestamp"))
    return N.span_summary(events, order=["us", "event_id"], timeout_seconds=86_400, now_us=now, **options)


@query("session_spans", SPANS_SQL)
def session_spans(spark, folder):
    """Spans that a close, a silent day or nothing yet has ended."""
    return _spans(spark, folder)


@query("session_spans_split", SPANS_SQL)
def session_spans_split(spark, folder):
    """The same with spans crossing segment borders."""
    return _spans(spark, folder, rows_per_segment=20)


@query(
    "session_status",
    f"""
    WITH {DEBOUNCED}, {KINDS}
    SELECT user_id AS session_id, arg_max(state, seq) AS current_state,
      round(arg_max(value / 491.3, seq), 6) AS current_confidence,
      round(arg_max(value / 50.1, seq) FILTER (kind = 'frame'), 6) AS current_ear,
      count(*) AS frames, count(*) FILTER (new_alert) AS alerts
    FROM kinds GROUP BY user_id
    """,
)
def session_status(spark, folder):
    """Latest state and values that are not null, with counters."""
    rows = session_events(spark, folder).withColumn("ear", F.when(F.col("kind") == "frame", F.col("ear")))
    out = N.session_status(
        rows,
        ["session_id"],
        F.struct("ts", "event_id"),
        ["state", "confidence", "ear"],
        {"frames": F.count(F.lit(1)), "alerts": F.count_if("new_alert")},
    )
    return out.select(
        "session_id", "current_state", F.round("current_confidence", 6).alias("current_confidence"),
        F.round("current_ear", 6).alias("current_ear"), "frames", "alerts",
    )


ACTIVITY = """
  WITH ends AS (SELECT min(turn) AS first, max(turn) AS last FROM conversations GROUP BY conv_id),
  c AS (SELECT ts, sum(change) AS change FROM (SELECT first AS ts, 1 AS change FROM ends
      UNION ALL SELECT last, -1 FROM ends) GROUP BY ts)
  SELECT CAST(ts AS BIGINT) AS ts, CAST(change AS BIGINT) AS change,
         CAST(sum(change) OVER (ORDER BY ts) AS BIGINT) AS active FROM c
"""


def conversation_events(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn")
    ends = turns.groupBy("conv_id").agg(F.min("turn").alias("first"), F.max("turn").alias("last"))
    sides = F.array(
        F.struct(F.col("first").alias("ts"), F.lit("open").alias("kind")),
        F.struct(F.col("last").alias("ts"), F.lit("close").alias("kind")),
    )
    return ends.select(F.col("conv_id").alias("session_id"), F.inline(sides))


@query("active_sessions_over_time", ACTIVITY)
def active_sessions_over_time(spark, folder):
    """Open conversations after each turn number."""
    return N.activity(conversation_events(spark, folder))


@query(
    "activity_of_events",
    """
    WITH c AS (SELECT ts, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE -1 END) AS change FROM events
               WHERE event_type IN ('signup', 'purchase') GROUP BY ts)
    SELECT epoch_us(ts) AS us, CAST(change AS BIGINT) AS change,
           CAST(sum(change) OVER (ORDER BY ts) AS BIGINT) AS active FROM c
    """,
)
def activity_of_events(spark, folder):
    """Opens minus closes over all events, one global order in segments."""
    kind = F.when(F.col("event_type") == "signup", "open").when(F.col("event_type") == "purchase", "close")
    ev = table(spark, folder, "events").select("ts", kind.alias("kind"))
    out = N.activity(ev, rows_per_segment=500)
    return out.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "change", "active")


@query(
    "open_sessions",
    """
    SELECT user_id AS session_id FROM (SELECT user_id, bool_or(event_type = 'signup' AND value > 100) AS o,
      bool_or(event_type = 'purchase' AND value > 150) AS c FROM events GROUP BY user_id) WHERE o AND NOT c
    """,
)
def open_sessions(spark, folder):
    """Sessions opened and never closed."""
    kind = (
        F.when((F.col("event_type") == "signup") & (F.col("value") > 100), "open")
        .when((F.col("event_type") == "purchase") & (F.col("value") > 150), "close")
        .otherwise("frame")
    )
    ev = table(spark, folder, "events").select(F.col("user_id").alias("session_id"), kind.alias("kind"))
    return N.open_sessions(ev)


@query(
    "attached_messages",
    """
    SELECT e.event_id, e.user_id, c.c_name AS driver, c.c_custkey IS NOT NULL AS known
    FROM (SELECT event_id, user_id * 11 AS user_id FROM events) e LEFT JOIN customer c ON c.c_custkey = e.user_id
    """,
)
def attached_messages(spark, folder):
    """Messages of known sessions with the driver, orphans without."""
    messages = table(spark, folder, "events").select("event_id", (F.col("user_id") * 11).alias("user_id"))
    known = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("driver"))
    return N.attach(messages, known, "user_id")


LOST = """
  m AS (SELECT user_id, event_id, ts, CASE event_type WHEN 'signup' THEN 'init' WHEN 'purchase' THEN 'close'
      ELSE 'frame' END AS kind FROM events),
  last AS (SELECT *, last_value(CASE WHEN kind <> 'frame' THEN kind END IGNORE NULLS) OVER (PARTITION BY user_id
      ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS seen FROM m),
  lost AS (SELECT user_id, event_id, 'Send ''init'' message first' AS message FROM last
      WHERE kind = 'frame' AND coalesce(seen, 'close') <> 'init')
"""


def message_kinds(events):
    kind = (
        F.when(F.col("event_type") == "signup", "init")
        .when(F.col("event_type") == "purchase", "close")
        .otherwise("frame")
    )
    return events.withColumn("kind", kind)


def _lost(spark, folder, **options):
    messages = message_kinds(table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type"))
    out = N.frames_without_init(messages, ["user_id"], ["ts", "event_id"], **options)
    return out.select("user_id", "event_id", "message")


@query("frames_without_init", f"WITH {LOST} SELECT * FROM lost")
def frames_without_init(spark, folder):
    """Frames outside an open session are errors."""
    return _lost(spark, folder)


@query("frames_without_init_split", f"WITH {LOST} SELECT * FROM lost")
def frames_without_init_split(spark, folder):
    return _lost(spark, folder, rows_per_segment=20)
