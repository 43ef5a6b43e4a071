"""Baselines and drift: the first half of the events is the reference period."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeframe.operators import baseline as B
from wakeframe.operators import drift as D
from wakeframe.session import fresh_path
from wakeframe.sources import tables
from wakeframe.suite.frames import EVENT_FRAMES, event_frames
from wakeframe.suite.registry import placed, query, table

MEASURES = ["l_quantity", "price", "l_discount", "l_tax"]
LINE_LONG = """
  wide AS (SELECT l_quantity, l_extendedprice / 1000.3 AS price, l_discount, l_tax FROM lineitem),
  long AS (UNPIVOT wide ON l_quantity, price, l_discount, l_tax INTO NAME feature VALUE value)
"""


def measures(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_quantity", (F.col("l_extendedprice") / 1000.3).alias("price"), "l_discount", "l_tax"
    )


BASELINE_SQL = f"""
WITH {LINE_LONG}
SELECT feature, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(var_samp(value), 6) AS variance, round(min(value), 6) AS min, round(max(value), 6) AS max,
  round(quantile_cont(value, 0.05), 6) AS p5, round(quantile_cont(value, 0.25), 6) AS p25,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
  round(quantile_cont(value, 0.95), 6) AS p95
FROM long GROUP BY feature
"""


@query("baseline_statistics", BASELINE_SQL)
def baseline_statistics(spark, folder):
    """Mean, deviation, bounds and quantiles per feature."""
    return B.baseline(measures(spark, folder), MEASURES).drop("histogram_density", "histogram_bins")


@query("baseline_statistics_split", BASELINE_SQL)
def baseline_statistics_split(spark, folder):
    """The same with quantiles selected by rank from segments of 2,000 rows."""
    return B.baseline(measures(spark, folder), MEASURES, rows_per_segment=2000).drop(
        "histogram_density", "histogram_bins"
    )


@query(
    "baseline_histogram",
    f"""
    WITH {LINE_LONG}, r AS (SELECT feature, min(value) AS low, max(value) AS high, count(*) AS n,
        (max(value) - min(value)) / 20 AS width FROM long GROUP BY feature),
    place AS (SELECT feature, value, low, width, n,
        least(19, floor((value - low) / (high - low) * 20))::INT AS i FROM long JOIN r USING (feature)),
    fixed AS (SELECT feature, low, width, n, i - CASE WHEN value < low + i * width THEN 1 ELSE 0 END
        + CASE WHEN value >= low + (i + 1) * width AND i < 19 THEN 1 ELSE 0 END AS bin FROM place),
    c AS (SELECT feature, bin, count(*) AS k FROM fixed GROUP BY feature, bin)
    SELECT r.feature, b.bin::INT AS bin, round(coalesce(k, 0) / (n * width), 6) AS density,
        round(low + width * b.bin, 6) AS edge
    FROM r CROSS JOIN (SELECT unnest(range(20)) AS bin) b LEFT JOIN c ON c.feature = r.feature AND c.bin = b.bin
    """,
)
def baseline_histogram(spark, folder):
    """Twenty density bins per feature."""
    wide = measures(spark, folder)
    hist = B.density_histogram(B.to_long(wide, MEASURES), B.gathered(B.summary_stats(wide, MEASURES)))
    return hist.select("feature", F.posexplode("histogram_density").alias("bin", "density"), "histogram_bins").select(
        "feature", "bin", "density", F.get("histogram_bins", F.col("bin")).alias("edge")
    )


@query(
    "baseline_document",
    f"""
    WITH wide AS (SELECT l_quantity, l_tax FROM lineitem),
    long AS (UNPIVOT wide ON l_quantity, l_tax INTO NAME feature VALUE value),
    s AS (SELECT feature, count(*) AS n, round(avg(value), 6) AS mean, round(var_samp(value), 6) AS variance,
        {', '.join(f'round(quantile_cont(value, {q}), 6) AS {p}' for p, q in (('p5', 0.05), ('p25', 0.25), ('p50', 0.5), ('p95', 0.95)))},
        min(value) AS low, (max(value) - min(value)) / 20 AS width FROM long GROUP BY feature),
    place AS (SELECT feature, value, low, width, least(19, floor((value - low) / (width * 20) * 20))::INT AS i
        FROM long JOIN s USING (feature)),
    c AS (SELECT feature, i - CASE WHEN value < low + i * width THEN 1 ELSE 0 END
        + CASE WHEN value >= low + (i + 1) * width AND i < 19 THEN 1 ELSE 0 END AS bin, count(*) AS k FROM place GROUP BY ALL)
    SELECT s.feature, n, mean, variance, p5, p25, p50, p95, b.bin::INT AS bin, round(coalesce(k, 0) / (n * width), 6) AS density,
      round(low + width * b.bin, 6) AS edge
    FROM s CROSS JOIN (SELECT unnest(range(20)) AS bin) b LEFT JOIN c ON c.feature = s.feature AND c.bin = b.bin
    """,
)
def baseline_document(spark, folder):
    """The baseline written as a JSON document and read back, quantiles and bins included."""
    path = fresh_path(spark, "baseline")
    wanted = table(spark, folder, "lineitem").select("l_quantity", "l_tax")
    tables.write_document(B.baseline_document(B.baseline(wanted, ["l_quantity", "l_tax"]), 30), path)
    told = ["feature", "n", "mean", "variance", "p5", "p25", "p50", "p95"]
    read = tables.read_baseline(spark, path).select(*told, "histogram_bins", F.posexplode("histogram_density").alias("bin", "density"))
    return read.select(*told, "bin", "density", F.get("histogram_bins", F.col("bin")).alias("edge"))


SIGNALS = ["ear", "mar", "head_pitch", "head_yaw", "head_roll"]
CUT = "2024-01-16 00:00:00"
PERIODS = f"""
  {EVENT_FRAMES},
  long AS (UNPIVOT frames ON ear, mar, head_pitch, head_yaw, head_roll INTO NAME feature VALUE value),
  base AS (SELECT feature, round(avg(value), 6) AS bm, round(var_samp(value), 6) AS bv FROM long
           WHERE ts < TIMESTAMP '{CUT}' GROUP BY feature)
"""
KL = """greatest(0, round(ln(sqrt(bv + 1e-9) / sqrt(v + 1e-9)) + ((v + 1e-9) + (m - bm) * (m - bm))
        / (2 * (bv + 1e-9)) - 0.5, 6))"""
SCORES = f"""
  scores AS (SELECT subject_id, feature, n, CASE WHEN n >= 30 THEN {KL} ELSE 0.0 END AS score
    FROM (SELECT subject_id, feature, count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM long
          WHERE ts >= TIMESTAMP '{CUT}' GROUP BY subject_id, feature) JOIN base USING (feature))
"""


def periods(spark, folder):
    frames = event_frames(spark, folder)
    cut = F.lit(CUT).cast("timestamp_ntz")
    base = B.summary_stats(frames.filter(F.col("ts") < cut), SIGNALS)
    return base, frames.filter(F.col("ts") >= cut)


def subject_scores(spark, folder):
    base, live = periods(spark, folder)
    return D.drift_scores(live, base, SIGNALS, ["subject_id"])


@query("drift_scores", f"WITH {PERIODS}, {SCORES} SELECT * FROM scores")
def drift_scores(spark, folder):
    """Drift of each subject's live period against the common baseline."""
    return subject_scores(spark, folder)


@query(
    "drift_overall",
    f"""
    WITH {PERIODS}, {SCORES}
    SELECT subject_id, max(score) AS overall, max(score) > 0.15 AS drifting FROM scores GROUP BY subject_id
    """,
)
def drift_overall(spark, folder):
    return D.overall_drift(subject_scores(spark, folder), ["subject_id"])


@query(
    "drift_top_features",
    f"""
    WITH {PERIODS}, {SCORES}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY subject_id
      ORDER BY score DESC, feature) AS INT) AS rank FROM scores)
    SELECT subject_id, feature, score, rank FROM r WHERE rank <= 3
    """,
)
def drift_top_features(spark, folder):
    """The three most drifted features per subject."""
    return D.top_drifted(subject_scores(spark, folder), ["subject_id"]).drop("n")


@query(
    "drift_ranked",
    f"""
    WITH {PERIODS}, one AS (SELECT feature, count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM long
      WHERE ts >= TIMESTAMP '{CUT}' GROUP BY feature)
    SELECT replace(replace(feature, '_mean', ''), 'head_', '') AS feature, round({KL}, 4) AS score,
      row_number() OVER (ORDER BY round({KL}, 4) DESC, replace(replace(feature, '_mean', ''), 'head_', '')) AS place
    FROM one JOIN base USING (feature)
    """,
)
def drift_ranked(spark, folder):
    """All features by drift over the whole live period, short names."""
    base, live = periods(spark, folder)
    return placed(D.ranked_drift(D.drift_scores(live, base, SIGNALS)))


@query("drift_without_baseline", f"WITH {PERIODS}, {SCORES} SELECT * FROM scores WHERE false")
def drift_without_baseline(spark, folder):
    """No baseline: scoring is off and the result is empty."""
    base, live = periods(spark, folder)
    return D.drift_scores(live, base.filter("feature = 'none'"), SIGNALS, ["subject_id"])


BUFFERED = f"""
  {EVENT_FRAMES},
  numbered AS (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY ts, frame_id) AS seq FROM frames),
  shown AS (SELECT subject_id, seq, CASE WHEN face THEN ear END AS ear, mar FROM numbered),
  long AS (UNPIVOT shown ON ear, mar INTO NAME feature VALUE value),
  base AS (SELECT feature, round(avg(value), 6) AS bm, round(var_samp(value), 6) AS bv FROM (
             UNPIVOT (SELECT * FROM frames WHERE ts < TIMESTAMP '{CUT}') ON ear, mar INTO NAME feature VALUE value)
           GROUP BY feature),
  state AS (SELECT subject_id, feature, seq, count(*) OVER w AS n, avg(value) OVER w AS m, var_pop(value) OVER w AS v,
      lead(seq) OVER (PARTITION BY subject_id, feature ORDER BY seq) AS nxt FROM long
    WINDOW w AS (PARTITION BY subject_id, feature ORDER BY seq ROWS BETWEEN 39 PRECEDING AND CURRENT ROW)),
  due AS (SELECT subject_id, seq, feature FROM numbered CROSS JOIN (VALUES ('ear'), ('mar')) f(feature)
          WHERE seq % 25 = 0),
  reports AS (SELECT due.subject_id, due.seq, due.feature, coalesce(n, 0) AS n,
      CASE WHEN coalesce(n, 0) >= 30 THEN {KL} ELSE 0.0 END AS score
    FROM due JOIN base USING (feature) LEFT JOIN state s ON s.subject_id = due.subject_id AND s.feature = due.feature
      AND s.seq <= due.seq AND (s.nxt IS NULL OR s.nxt > due.seq))
"""


def _buffered(spark, folder, **options):
    frames = event_frames(spark, folder)
    base = B.summary_stats(frames.filter(F.col("ts") < F.lit(CUT).cast("timestamp_ntz")), ["ear", "mar"])
    shown = frames.withColumn("ear", F.when(F.col("face"), F.col("ear")))
    return D.buffered_drift(
        shown, base, ["subject_id"], ["ts", "frame_id"], ["ear", "mar"], buffer=40, every=25, **options
    )


@query("drift_buffered", f"WITH {BUFFERED} SELECT * FROM reports")
def drift_buffered(spark, folder):
    """Every 25 frames, drift over the last 40 accepted values per feature."""
    return _buffered(spark, folder)


@query("drift_buffered_split", f"WITH {BUFFERED} SELECT * FROM reports")
def drift_buffered_split(spark, folder):
    """The same with subjects cut into segments."""
    return _buffered(spark, folder, rows_per_segment=50)
