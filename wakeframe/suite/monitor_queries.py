"""Service metrics over events: value as latency, 'error' events as failures."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeframe.constants import LATENCY_BUCKETS
from wakeframe.operators import monitor as M
from wakeframe.operators.drift import drift_score, with_baseline
from wakeframe.operators.registry import alert_triggers
from wakeframe.plans.ordered import KeyedRows
from wakeframe.session import cut_lineage
from wakeframe.suite.registry import query, table

BOUNDS = [1000 * b for b in LATENCY_BUCKETS]  # milliseconds
HOUR, DAY = 3600, 86400


def le_sql(value: str, keys: str = "") -> str:
    parts = [f"count(*) FILTER ({value} <= {b}) AS le_{i}" for i, b in enumerate(BOUNDS)]
    return ", ".join([*parts, f"count(*) AS le_{len(BOUNDS)}"])


def quantile_sql(q: float) -> str:
    n = len(BOUNDS)
    rank = f"({q} * le_{n})"
    out = f"CASE WHEN le_{n} = 0 THEN NULL "
    for i, b in enumerate(BOUNDS):
        low, below = (BOUNDS[i - 1], f"le_{i - 1}") if i else (0.0, "0")
        out += f"WHEN le_{i} >= {rank} THEN {low} + ({b} - {low}) * (({rank} - {below}) / (le_{i} - {below})) "
    return out + f"ELSE {BOUNDS[-1]} END"


def samples(spark, folder):
    ev = table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return ev.withColumn("t", M.epoch_seconds(F.col("ts")))


@query(
    "labelled_counters",
    """SELECT event_type, user_id, count(*) AS total FROM events GROUP BY event_type, user_id""",
)
def labelled_counters(spark, folder):
    return M.labelled_counts(table(spark, folder, "events"), ["event_type", "user_id"])


@query(
    "bucket_histogram",
    f"""
    WITH h AS (SELECT event_type, {le_sql('value')}, round(sum(value), 4) AS total_sum FROM events GROUP BY event_type)
    SELECT event_type, b.i::INT AS bucket, CASE b.i {' '.join(f'WHEN {i} THEN le_{i}' for i in range(len(BOUNDS) + 1))} END
      AS cumulative, total_sum FROM h, (SELECT unnest(range({len(BOUNDS) + 1})) AS i) b
    """,
)
def bucket_histogram(spark, folder):
    """Cumulative counts for fixed bounds and infinity, by event type."""
    ev = table(spark, folder, "events")
    counts = M.bucket_counts(ev, F.col("value"), BOUNDS, ["event_type"]).withColumn("total_sum", F.round("total_sum", 4))
    rows = M.bucket_rows(counts, BOUNDS, ["event_type", "total_sum"])
    edges = F.array(*[F.lit(float(b)) for b in BOUNDS], F.lit(float("inf")))
    return rows.select(
        "event_type", (F.array_position(edges, F.col("le")) - 1).cast("int").alias("bucket"), "cumulative", "total_sum"
    )


@query(
    "bucket_quantiles",
    f"""
    WITH h AS (SELECT user_id, {le_sql('value')} FROM events GROUP BY user_id)
    SELECT user_id, round({quantile_sql(0.5)}, 6) AS p50, round({quantile_sql(0.95)}, 6) AS p95,
           round({quantile_sql(0.99)}, 6) AS p99 FROM h
    """,
)
def bucket_quantiles(spark, folder):
    """p50, p95 and p99 interpolated from the buckets."""
    counts = M.bucket_counts(table(spark, folder, "events"), F.col("value"), BOUNDS, ["user_id"])
    return counts.select(
        "user_id",
        *[F.round(M.bucket_quantile(BOUNDS, q), 6).alias(n) for n, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))],
    )


RANGE_SQL = f"""
  steps AS (SELECT CAST(ceil((epoch_us(ts) // 1000000) / {6 * HOUR}.0) * {6 * HOUR} AS BIGINT) AS s, value FROM events),
  evals AS (SELECT unnest(range(s, s + {DAY}, {6 * HOUR})) AS eval_at, value FROM steps),
  h AS (SELECT eval_at, {le_sql('value')} FROM evals GROUP BY eval_at)
"""


@query("range_quantiles", f"WITH {RANGE_SQL} SELECT eval_at, round({quantile_sql(0.95)}, 6) AS p95 FROM h")
def range_quantiles(spark, folder):
    """p95 over the last day, evaluated every six hours."""
    h = M.range_histogram(samples(spark, folder), F.col("t"), F.col("value"), BOUNDS, 6 * HOUR, DAY)
    return h.select("eval_at", F.round(M.bucket_quantile(BOUNDS, 0.95), 6).alias("p95"))


INCREASE = f"""
  inc AS (SELECT user_id, epoch_us(ts) // 1000000 AS t, value,
      lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
  grown AS (SELECT user_id, CAST(ceil(t / {6 * HOUR}.0) * {6 * HOUR} AS BIGINT) AS s,
      CASE WHEN value < prev THEN value ELSE value - prev END AS g FROM inc WHERE prev IS NOT NULL),
  up AS (SELECT user_id, unnest(range(s, s + {DAY}, {6 * HOUR})) AS eval_at, g FROM grown)
"""
INCREASE_SQL = f"""
  WITH {INCREASE} SELECT user_id, eval_at, round(sum(g), 6) AS increase, round(sum(g) / {DAY}, 9) AS rate
  FROM up GROUP BY user_id, eval_at
"""


def _increase(spark, folder, **options):
    out = M.counter_increase(
        samples(spark, folder), ["user_id"], "t", "value", 6 * HOUR, DAY, order=["ts", "event_id"], **options
    )
    return out.select(
        "user_id", "eval_at", F.round("increase", 6).alias("increase"), F.round("rate", 9).alias("rate")
    )


@query("counter_increase", INCREASE_SQL)
def counter_increase(spark, folder):
    """Increase of a counter that restarts, over the last day."""
    return _increase(spark, folder)


@query("counter_increase_split", INCREASE_SQL)
def counter_increase_split(spark, folder):
    return _increase(spark, folder, rows_per_segment=30)


def _counter(spark, folder, failed: bool, whole: bool):
    """Running totals per endpoint, or of the service as a whole, as counter samples."""
    ev = samples(spark, folder).filter((F.col("event_type") == "error") == F.lit(failed))
    ev = ev.withColumn("user_id", F.lit("all")) if whole else ev
    rows = KeyedRows(ev, ["user_id"], ["ts", "event_id"]).running(total=("sum", F.lit(1)))
    return rows.rows().withColumnRenamed("user_id", "endpoint"), rows.small_keys


def _ratio(spark, folder, step, window, whole=False):
    rates = []
    for failed in (True, False):
        counter, small = _counter(spark, folder, failed, whole)
        rates.append(
            M.counter_increase(
                counter, ["endpoint"], "t", "total", step, window, ["ts", "event_id"], derived=True, small_keys=small
            )
        )
    return M.error_ratio(*rates, limit=0.05)


RATIO = f"""
  c AS (SELECT user_id AS endpoint, event_type = 'error' AS failed, epoch_us(ts) // 1000000 AS t,
      row_number() OVER (PARTITION BY user_id, event_type = 'error' ORDER BY ts, event_id) AS total FROM events),
  s AS (SELECT endpoint, failed, CAST(ceil(t / {6 * HOUR}.0) * {6 * HOUR} AS BIGINT) AS s FROM c WHERE total > 1),
  ev AS (SELECT endpoint, failed, unnest(range(s, s + {DAY}, {6 * HOUR})) AS eval_at FROM s),
  r AS (SELECT endpoint, eval_at, count(*) FILTER (failed) / {DAY} AS e, count(*) FILTER (NOT failed) / {DAY} AS q
      FROM ev GROUP BY endpoint, eval_at HAVING count(*) FILTER (failed) > 0 AND count(*) FILTER (NOT failed) > 0),
  ratio AS (SELECT endpoint, eval_at, e / (q + 0.001) AS ratio FROM r)
"""


@query(
    "error_ratio",
    f"WITH {RATIO} SELECT endpoint, eval_at, round(ratio, 6) AS ratio, ratio > 0.05 AS high FROM ratio",
)
def error_ratio(spark, folder):
    """Failure rate over request rate per endpoint and evaluation."""
    return _ratio(spark, folder, 6 * HOUR, DAY).select("endpoint", "eval_at", F.round("ratio", 6).alias("ratio"), "high")


HOLD = f"""
  d AS (SELECT user_id, CAST(ceil((epoch_us(ts) // 1000000) / {6 * HOUR}.0) * {6 * HOUR} AS BIGINT) AS eval_at,
      max(value) AS value FROM events GROUP BY ALL),
  m AS (SELECT *, value > 40 AS met, lag(value > 40) OVER w AS pm, lag(eval_at) OVER w AS pt FROM d
      WINDOW w AS (PARTITION BY user_id ORDER BY eval_at)),
  i AS (SELECT *, CASE WHEN met AND NOT coalesce(pm AND eval_at - pt <= {6 * HOUR}, false) THEN eval_at END AS start
      FROM m),
  held AS (SELECT user_id, eval_at, met, CASE WHEN met THEN max(start) OVER (PARTITION BY user_id ORDER BY eval_at
      ROWS UNBOUNDED PRECEDING) END AS since FROM i)
"""
HOLD_SQL = f"""
  WITH {HOLD} SELECT user_id, eval_at, met, since, CASE WHEN NOT met THEN 'inactive'
    WHEN eval_at - since >= {12 * HOUR} THEN 'firing' ELSE 'pending' END AS status FROM held
"""


def _held(spark, folder, **options):
    at = (F.ceil(F.col("t") / (6 * HOUR)) * (6 * HOUR)).cast("long")
    evaluated = (
        samples(spark, folder)
        .groupBy("user_id", at.alias("eval_at"))
        .agg(F.max("value").alias("value"))
        .select("user_id", "eval_at", (F.col("value") > 40).alias("met"))
    )
    return M.hold(evaluated, ["user_id"], "eval_at", "met", 12 * HOUR, 6 * HOUR, derived=True, **options)


@query("alert_hold", HOLD_SQL)
def alert_hold(spark, folder):
    """Conditions that must hold for twelve hours before they fire."""
    return _held(spark, folder)


@query("alert_hold_split", HOLD_SQL)
def alert_hold_split(spark, folder):
    return _held(spark, folder, rows_per_segment=15)


STEP = 6 * HOUR
CUT_S = 1705363200  # end of the reference period
# One stand-in per monitored quantity; the signal strays further from its reference day by day.
RULE_SERIES = f"""
  seen AS (SELECT epoch_us(ts) // 1000000 AS t, event_type, value FROM events),
  dayed AS (SELECT *, CAST(ceil(t / {STEP}.0) * {STEP} AS BIGINT) AS s, (t // {DAY}) % 10 AS day FROM seen),
  grid AS (SELECT unnest(range(lo, hi + 1, {STEP})) AS eval_at
      FROM (SELECT CAST(ceil(min(t) / {STEP}.0) * {STEP} AS BIGINT) AS lo, max(t) AS hi FROM seen)),
  scrapes AS (SELECT 'backend' AS job, t, CASE WHEN (t // {DAY}) % 7 = 3 THEN 0.0 ELSE 1.0 END AS value FROM seen
      WHERE event_type = 'click'
    UNION ALL SELECT 'model_server', t, 1.0 FROM seen WHERE event_type = 'view' AND (t // {DAY}) % 9 <> 4),
  heard AS (SELECT job, eval_at, arg_max(value, t * 2 + value) AS value FROM scrapes JOIN grid
      ON t <= eval_at AND t >= eval_at - {STEP} GROUP BY job, eval_at),
  up AS (SELECT g.eval_at, j.job, coalesce(h.value, 0.0) AS value
      FROM grid g CROSS JOIN (VALUES ('backend'), ('model_server'), ('gateway')) j(job)
      LEFT JOIN heard h ON h.job = j.job AND h.eval_at = g.eval_at),
  slow AS (SELECT eval_at, {le_sql('value')} FROM (SELECT unnest(range(s, s + {DAY}, {STEP})) AS eval_at,
      value * (1 + day / 5) AS value FROM dayed) GROUP BY eval_at),
  whole AS (SELECT eval_at, (count(*) FILTER (event_type = 'error') / {DAY})
        / (count(*) FILTER (event_type <> 'error') / {DAY} + 0.001) AS ratio
      FROM (SELECT unnest(range(s, s + {DAY}, {STEP})) AS eval_at, event_type FROM dayed
            WHERE (t, event_type = 'error') NOT IN (SELECT (min(t), event_type = 'error') FROM dayed GROUP BY event_type = 'error'))
      GROUP BY eval_at HAVING count(*) FILTER (event_type = 'error') > 0 AND count(*) FILTER (event_type <> 'error') > 0),
  signal AS (SELECT t, s, 'ear_mean' AS feature, value / 100.9 * (1 + day / 4) AS v FROM dayed
      UNION ALL SELECT t, s, 'perclos', value / 491.3 * (1 + (day % 5) / 2) FROM dayed
      UNION ALL SELECT t, s, 'mar_max', value / 202.6 FROM dayed),
  usual AS (SELECT feature, round(avg(v), 6) AS bm, round(var_samp(v), 6) AS bv FROM signal WHERE t < {CUT_S} GROUP BY feature),
  moments AS (SELECT feature, eval_at, sum(n) AS n, sum(s1) / sum(n) AS m, greatest(sum(s2) / sum(n)
        - (sum(s1) / sum(n)) * (sum(s1) / sum(n)), 0.0) AS var
      FROM (SELECT feature, unnest(range(s, s + {DAY}, {STEP})) AS eval_at, count(*) AS n, sum(v) AS s1, sum(v * v) AS s2
        FROM signal GROUP BY feature, s) GROUP BY feature, eval_at),
  drift AS (SELECT feature, eval_at, CASE WHEN n >= 30 THEN greatest(0, round(ln(sqrt(bv + 1e-9) / sqrt(var + 1e-9))
        + ((var + 1e-9) + (m - bm) * (m - bm)) / (2 * (bv + 1e-9)) - 0.5, 6)) ELSE 0.0 END AS value
      FROM moments JOIN usual USING (feature)),
  evald AS (
    SELECT 'HighInferenceLatency' AS alert, '' AS series, eval_at, {quantile_sql(0.95)} / 1000 > 0.2 AS met, 120 AS hold FROM slow
    UNION ALL SELECT 'HighErrorRate', CAST(endpoint AS VARCHAR), eval_at, ratio > 0.05, 120 FROM ratio
    UNION ALL SELECT 'HighErrorRate', 'all', eval_at, ratio > 0.05, 120 FROM whole
    UNION ALL SELECT 'DataDriftDetected', '', eval_at, max(value) > 0.15, 120 FROM drift GROUP BY eval_at
    UNION ALL SELECT 'ModelServerDown', job, eval_at, value = 0, 60 FROM up WHERE job = 'model_server'
    UNION ALL SELECT 'BackendDown', job, eval_at, value = 0, 60 FROM up WHERE job = 'backend'
    UNION ALL SELECT 'EARFeatureDrift', feature, eval_at, value > 0.2, 120 FROM drift WHERE feature = 'ear_mean'
    UNION ALL SELECT 'PERCLOSFeatureDrift', feature, eval_at, value > 0.2, 120 FROM drift WHERE feature = 'perclos'),
  l AS (SELECT *, lag(met) OVER w AS pm, lag(eval_at) OVER w AS pt FROM evald
    WINDOW w AS (PARTITION BY alert, series ORDER BY eval_at)),
  st AS (SELECT *, max(CASE WHEN met AND NOT coalesce(pm AND eval_at - pt <= {STEP}, false) THEN eval_at END)
    OVER (PARTITION BY alert, series ORDER BY eval_at ROWS UNBOUNDED PRECEDING) AS since FROM l)
"""


def monitored(spark, folder):
    """The series that the rules look at: eval_at, metric, labels, value."""
    seen = samples(spark, folder)
    lo, hi = seen.agg(F.min("t"), F.max("t")).first()
    day = F.floor(F.col("t") / DAY)

    def series(df, metric, **labels):
        pairs = [x for k, v in labels.items() for x in (F.lit(k), v)]
        return df.select("eval_at", F.lit(metric).alias("metric"), F.create_map(*pairs).alias("labels"), "value")

    latency = F.col("value") * (1 + day % 10 / 5)
    histogram = M.range_histogram(seen, F.col("t"), latency, BOUNDS, STEP, DAY)
    p95 = histogram.withColumn("value", M.bucket_quantile(BOUNDS, 0.95) / 1000)
    ratios = [_ratio(spark, folder, STEP, DAY, whole).withColumn("value", F.col("ratio")) for whole in (False, True)]

    scrapes = seen.select(
        F.when(F.col("event_type") == "click", "backend").when(F.col("event_type") == "view", "model_server").alias("job"),
        "t",
        F.when((F.col("event_type") == "click") & (day % 7 == 3), 0.0).otherwise(1.0).alias("value"),
        ((F.col("event_type") == "view") & (day % 9 == 4)).alias("silent"),
    ).filter("job is not null and not silent")
    grid = M.evaluation_grid(spark, lo, hi, STEP)
    up = M.availability(scrapes, ["backend", "model_server", "gateway"], grid, "job", "t", "value", STEP, STEP)

    v = F.col("value")
    pairs = F.array(
        F.struct(F.lit("ear_mean").alias("feature"), (v / 100.9 * (1 + day % 10 / 4)).alias("v")),
        F.struct(F.lit("perclos").alias("feature"), (v / 491.3 * (1 + day % 10 % 5 / 2)).alias("v")),
        F.struct(F.lit("mar_max").alias("feature"), (v / 202.6).alias("v")),
    )
    signal = seen.select("t", F.inline(pairs))
    past = F.when(F.col("t") < CUT_S, F.col("v"))
    usual = signal.groupBy("feature").agg(F.round(F.avg(past), 6).alias("mean"), F.round(F.var_samp(past), 6).alias("variance"))
    moments = M.range_moments(signal, ["feature"], "t", "v", STEP, DAY)
    score = drift_score(F.col("n"), F.col("mean"), F.col("variance"), F.col("base_mean"), F.col("base_var"))
    drift = cut_lineage(with_baseline(moments, usual).select("feature", "eval_at", score.alias("value")), "drift")
    overall = drift.groupBy("eval_at").agg(F.max("value").alias("value"))

    none = F.lit("")
    parts = [
        series(p95, "latency_p95", name=none),
        *[series(ratio, "error_ratio", name=F.col("endpoint").cast("string")) for ratio in ratios],
        series(overall, "overall_drift", name=none),
        series(up, "up", name=F.col("job"), job=F.col("job")),
        series(drift, "feature_drift", name=F.col("feature"), feature=F.col("feature")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "alert_rules",
    f"""
    WITH {RANGE_SQL}, {RATIO}, {RULE_SERIES}
    SELECT alert, series, eval_at, CASE WHEN NOT met THEN 'inactive' WHEN eval_at - since >= hold THEN 'firing'
      ELSE 'pending' END AS status,
      CASE WHEN alert IN ('BackendDown', 'ModelServerDown', 'DataDriftDetected') THEN 'critical' ELSE 'warning' END AS severity
    FROM st
    """,
)
def alert_rules(spark, folder):
    """All seven rules of the service; a target without samples is down."""
    out = M.apply_rules(monitored(spark, folder), step=STEP)
    labels = F.from_json("series", "array<struct<key: string, value: string>>")
    name = F.filter(labels, lambda e: e["key"] == "name")
    return out.select("alert", F.get(name, F.lit(0))["value"].alias("series"), "eval_at", "status", "severity")


@query(
    "target_availability",
    f"WITH {RANGE_SQL}, {RULE_SERIES.split('  signal AS')[0].rstrip().rstrip(',')} SELECT job, eval_at, value FROM up",
)
def target_availability(spark, folder):
    """Whether each configured target was heard of; one of them never is."""
    return monitored(spark, folder).filter("metric = 'up'").select(F.col("labels")["job"].alias("job"), "eval_at", "value")


@query(
    "alert_to_retrain",
    """
    WITH a AS (SELECT event_id, 0 AS pos, CASE WHEN event_type = 'error' THEN 'HighErrorRate' ELSE 'BackendDown' END
        AS name, CASE WHEN value > 20 THEN 'firing' ELSE 'resolved' END AS status FROM events
      UNION ALL SELECT event_id, 1, CASE WHEN value > 60 THEN 'DataDriftDetected' ELSE 'ModelServerDown' END,
        'firing' FROM events),
    f AS (SELECT event_id, count(*) AS received, arg_min(name, pos) FILTER (status = 'firing' AND name IN
        ('DataDriftDetected', 'HighErrorRate', 'EARFeatureDrift', 'PERCLOSFeatureDrift')) AS first
      FROM a GROUP BY event_id)
    SELECT event_id AS batch_id, received, 'prometheus_alert:' || first AS reason, first IS NOT NULL AS triggered FROM f
    """,
)
def alert_to_retrain(spark, folder):
    """Webhook batches in JSON: the first firing alert that retrains."""
    from wakeframe.schemas import ALERTS

    def alert(name, status):
        return F.struct(F.create_map(F.lit("alertname"), name).alias("labels"), status.alias("status"))

    v = F.col("value")
    body = F.to_json(
        F.struct(
            F.array(
                alert(
                    F.when(F.col("event_type") == "error", "HighErrorRate").otherwise("BackendDown"),
                    F.when(v > 20, "firing").otherwise("resolved"),
                ),
                alert(F.when(v > 60, "DataDriftDetected").otherwise("ModelServerDown"), F.lit("firing")),
            ).alias("alerts")
        )
    )
    posted = table(spark, folder, "events").select(F.col("event_id").alias("batch_id"), body.alias("body"))
    batches = posted.select("batch_id", F.from_json("body", ALERTS)["alerts"].alias("alerts"))
    return alert_triggers(batches)
