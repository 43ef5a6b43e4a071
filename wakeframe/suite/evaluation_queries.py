"""Evaluation: document quality as truth, document length as score."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeframe.functions import scalars as S
from wakeframe.operators import evaluation as E
from wakeframe.suite.registry import query, table

SCORED = """
scored AS (SELECT d.lang, l.quality AS label, d.doc_id, d.n_chars / (d.n_chars + 600.0) AS score,
    CASE WHEN d.n_chars / (d.n_chars + 600.0) >= 0.5 THEN 1 ELSE 0 END AS prediction
  FROM labels l JOIN documents d USING (doc_id)),
conf AS (SELECT lang, label AS actual, prediction AS predicted, count(*) AS n FROM scored GROUP BY ALL)
"""


def scored(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    both = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label")).join(docs, "doc_id")
    s = F.col("n_chars") / (F.col("n_chars") + 600.0)
    return both.select("lang", "label", "doc_id", s.alias("score"), (s >= 0.5).cast("int").alias("prediction"))


@query(
    "confusion_matrix",
    f"""
    WITH {SCORED}
    SELECT lang, actual, CAST(coalesce(sum(n) FILTER (predicted = 0), 0) AS BIGINT) AS predicted_0,
           CAST(coalesce(sum(n) FILTER (predicted = 1), 0) AS BIGINT) AS predicted_1
    FROM conf GROUP BY lang, actual
    """,
)
def confusion_matrix(spark, folder):
    return E.confusion_matrix(E.confusion(scored(spark, folder), keys=["lang"]), [0, 1], ["lang"])


PER_CLASS = """
per AS (SELECT lang, c AS class, sum(CASE WHEN actual = c THEN n ELSE 0 END) AS support,
    sum(CASE WHEN actual = c AND predicted = c THEN n ELSE 0 END) AS tp,
    sum(CASE WHEN predicted = c THEN n ELSE 0 END) AS predicted
  FROM conf, (VALUES (0), (1)) v(c) GROUP BY lang, c),
m AS (SELECT lang, class, support, tp, coalesce(tp / nullif(predicted, 0), 0) AS precision,
    coalesce(tp / nullif(support, 0), 0) AS recall, coalesce(2.0 * tp / nullif(predicted + support, 0), 0) AS f1
  FROM per WHERE support > 0 OR predicted > 0)
"""


@query(
    "classification_scores",
    f"""
    WITH {SCORED}, {PER_CLASS}
    SELECT lang, round(sum(tp) / sum(support), 4) AS accuracy,
      round(sum(precision * support) / sum(support), 4) AS precision_weighted,
      round(sum(recall * support) / sum(support), 4) AS recall_weighted,
      round(sum(f1 * support) / sum(support), 4) AS f1_weighted,
      round(coalesce(max(f1) FILTER (class = 1), 0.0), 4) AS f1_positive, CAST(sum(support) AS BIGINT) AS n
    FROM m GROUP BY lang
    """,
)
def classification_scores(spark, folder):
    return E.classification_scores(E.confusion(scored(spark, folder), keys=["lang"]), ["lang"])


@query(
    "classification_report",
    f"""
    WITH {SCORED}, {PER_CLASS}
    SELECT lang, CAST(class AS VARCHAR) AS class, round(precision, 4) AS precision, round(recall, 4) AS recall,
           round(f1, 4) AS f1, CAST(support AS BIGINT) AS support FROM m
    UNION ALL SELECT lang, 'macro avg', round(avg(precision), 4), round(avg(recall), 4), round(avg(f1), 4),
           CAST(sum(support) AS BIGINT) FROM m GROUP BY lang
    UNION ALL SELECT lang, 'weighted avg', round(sum(precision * support) / sum(support), 4),
           round(sum(recall * support) / sum(support), 4), round(sum(f1 * support) / sum(support), 4),
           CAST(sum(support) AS BIGINT) FROM m GROUP BY lang
    """,
)
def classification_report(spark, folder):
    return E.classification_report(E.confusion(scored(spark, folder), keys=["lang"]), ["lang"])


AUC = """
ranked AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r
           FROM scored),
auc AS (SELECT round((sum(r) FILTER (label = 1) - p * (p + 1) / 2.0) / (p * q), 4) AS auc_roc
  FROM ranked, (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label <> 1) AS q FROM scored)
  GROUP BY p, q)
"""


@query("auc_roc", f"WITH {SCORED}, {AUC} SELECT auc_roc FROM auc")
def auc_roc(spark, folder):
    """Ranking quality from counts per score; ties count half."""
    return E.auc(scored(spark, folder))


@query("auc_roc_split", f"WITH {SCORED}, {AUC} SELECT auc_roc FROM auc")
def auc_roc_split(spark, folder):
    """The same with the score order cut into segments."""
    return E.auc(scored(spark, folder), rows_per_segment=40)


@query(
    "roc_curve",
    f"""
    WITH {SCORED}, c AS (SELECT lang, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg
      FROM scored GROUP BY lang, score),
    t AS (SELECT lang, sum(pos) AS p, sum(neg) AS q FROM c GROUP BY lang)
    SELECT lang, round(sum(neg) OVER w / nullif(q, 0), 6) AS fpr, round(sum(pos) OVER w / nullif(p, 0), 6) AS tpr,
           round(score, 6) AS threshold
    FROM c JOIN t USING (lang) WINDOW w AS (PARTITION BY lang ORDER BY score DESC)
    UNION ALL SELECT lang, CASE WHEN q > 0 THEN 0.0::DOUBLE END, CASE WHEN p > 0 THEN 0.0::DOUBLE END, 'inf'::DOUBLE FROM t
    """,
)
def roc_curve(spark, folder):
    """Every point of the curve per language."""
    out = E.roc_curve(scored(spark, folder), keys=["lang"])
    return out.select("lang", *[F.round(c, 6).alias(c) for c in ("fpr", "tpr", "threshold")])


LATENCY = """
  SELECT event_type, round(quantile_cont(value, 0.5), 3) AS p50, round(quantile_cont(value, 0.95), 3) AS p95,
         round(quantile_cont(value, 0.99), 3) AS p99, round(avg(value), 3) AS mean
  FROM (SELECT event_type, value / 1.0123 AS value FROM events) GROUP BY event_type
"""


def latencies(spark, folder):
    return table(spark, folder, "events").select("event_type", (F.col("value") / 1.0123).alias("value"))


@query("latency_percentiles", LATENCY)
def latency_percentiles(spark, folder):
    return E.latency_summary(latencies(spark, folder), "value", ["event_type"])


@query("latency_percentiles_split", LATENCY)
def latency_percentiles_split(spark, folder):
    """The same, selected by rank instead of one state per group."""
    return E.latency_summary(latencies(spark, folder), "value", ["event_type"], rows_per_segment=300)


@query(
    "acceptance_gates",
    f"""
    WITH {SCORED}, {PER_CLASS}, {AUC},
    s AS (SELECT round(sum(f1 * support) / sum(support), 4) AS f1_weighted FROM (
        SELECT class, sum(support) AS support, coalesce(2.0 * sum(tp) / nullif(sum(predicted) + sum(support), 0), 0) AS f1
        FROM per GROUP BY class)),
    l AS (SELECT round(quantile_cont(value / 1.0123, 0.95), 3) AS p95 FROM events)
    SELECT f1_weighted, auc_roc, p95, f1_weighted >= 0.85 AS meets_f1, auc_roc >= 0.9 AS meets_auc,
      p95 <= 200 AS meets_latency, f1_weighted >= 0.85 AND auc_roc >= 0.9 AND p95 <= 200 AS accepted,
      p95 < 200 AS within_sla
    FROM s, auc, l
    """,
)
def acceptance_gates(spark, folder):
    """F1, AUC and latency of one model against the limits."""
    rows = scored(spark, folder).withColumn("model", F.lit("length"))
    f1 = E.classification_scores(E.confusion(rows, keys=["model"]), ["model"]).select("model", "f1_weighted")
    area = E.auc(rows, keys=["model"])
    p95 = E.latency_summary(latencies(spark, folder).withColumn("model", F.lit("length")), "value", ["model"])
    joined = f1.join(area, "model").join(p95.select("model", "p95"), "model").drop("model")
    return E.acceptance(joined)


@query(
    "class_weights",
    """
    SELECT quality, count(*) AS n_class,
      round((SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * count(*)), 6) AS weight,
      (SELECT round(count(*) FILTER (quality = 0) / nullif(count(*) FILTER (quality = 1), 0), 3) FROM labels)
        AS positive_weight
    FROM labels GROUP BY quality
    """,
)
def class_weights(spark, folder):
    labels = table(spark, folder, "labels").select("quality")
    positive = E.positive_weight(labels, "quality").first()["positive_weight"]
    return E.balanced_weights(labels, "quality").select(
        "quality", "n_class", F.round("weight", 6).alias("weight"), F.lit(positive).alias("positive_weight")
    )


@query(
    "alert_decisions",
    f"""
    WITH {SCORED}
    SELECT doc_id, CASE WHEN score >= 0.5 THEN 'drowsy' ELSE 'alert' END AS state, score >= 0.7 AS alert_triggered
    FROM scored
    """,
)
def alert_decisions(spark, folder):
    """State at 0.5 and alert at 0.7."""
    state = S.predicted_state(F.col("score"))
    return scored(spark, folder).select(
        "doc_id", state.alias("state"), S.alert_decision(state, F.col("score")).alias("alert_triggered")
    )
