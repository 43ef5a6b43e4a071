"""Classification metrics from counts, ranking metrics, acceptance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeframe.constants import MAX_P95_MS, MIN_AUC, MIN_F1
from wakeframe.plans.ordered import KeyedRows
from wakeframe.plans.select_rank import quantiles


def confusion(
    df: DataFrame, label: str = "label", prediction: str = "prediction", keys: Sequence[str] = ()
) -> DataFrame:
    """Rows ``keys, actual, predicted, n``."""
    return df.groupBy(*keys, F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(counts: DataFrame, classes: Sequence, keys: Sequence[str] = ()) -> DataFrame:
    """One row per actual class, one column per predicted class."""
    wide = counts.groupBy(*keys, "actual").pivot("predicted", list(classes)).agg(F.sum("n"))
    return wide.select(
        *keys, "actual", *[F.coalesce(F.col(str(c)), F.lit(0)).alias(f"predicted_{c}") for c in classes]
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def class_scores(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class; a zero division gives 0."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("s"), hit.alias("t"), none.alias("p")),
        F.struct(F.col("predicted").alias("class"), none.alias("s"), none.alias("t"), F.col("n").alias("p")),
    )
    per = (
        counts.select(*keys, F.explode(sides).alias("e"))
        .groupBy(*keys, F.col("e.class").alias("class"))
        .agg(F.sum("e.s").alias("support"), F.sum("e.t").alias("tp"), F.sum("e.p").alias("predicted"))
    )
    return per.select(
        *keys,
        "class",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2.0 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "tp",
    )


def classification_scores(counts: DataFrame, keys: Sequence[str] = (), positive=1, places: int = 4) -> DataFrame:
    """Accuracy, weighted precision, recall and F1, F1 of the positive class."""
    per = class_scores(counts, keys)
    total = F.sum("support")

    def weighted(c):
        return F.round(F.sum(F.col(c) * F.col("support")) / total, places)

    return per.groupBy(*keys).agg(
        F.round(F.sum("tp") / total, places).alias("accuracy"),
        weighted("precision").alias("precision_weighted"),
        weighted("recall").alias("recall_weighted"),
        weighted("f1").alias("f1_weighted"),
        F.round(F.coalesce(F.max(F.when(F.col("class") == positive, F.col("f1"))), F.lit(0.0)), places).alias(
            "f1_positive"
        ),
        total.alias("n"),
    )


def classification_report(counts: DataFrame, keys: Sequence[str] = (), places: int = 4) -> DataFrame:
    """Scores per class plus macro and support-weighted averages."""
    per = class_scores(counts, keys)
    names = ["precision", "recall", "f1"]
    rows = per.select(
        *keys, F.col("class").cast("string").alias("class"), *[F.round(c, places).alias(c) for c in names], "support"
    )
    averages = per.groupBy(*keys).agg(
        *[F.round(F.avg(c), places).alias(f"m_{c}") for c in names],
        *[F.round(F.sum(F.col(c) * F.col("support")) / F.sum("support"), places).alias(f"w_{c}") for c in names],
        F.sum("support").alias("support"),
    )
    both = F.array(
        *[
            F.struct(F.lit(kind).alias("class"), *[F.col(f"{kind[0]}_{c}").alias(c) for c in names])
            for kind in ("macro avg", "weighted avg")
        ]
    )
    summary = averages.select(*keys, F.explode(both).alias("e"), "support").select(*keys, "e.*", "support")
    return rows.unionByName(summary)


def score_counts(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score, combined before the shuffle."""
    return df.groupBy(*keys, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )


def auc(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    keys: Sequence[str] = (),
    rows_per_segment: int | None = None,
    places: int = 4,
) -> DataFrame:
    """Probability that a positive outranks a negative; ties count half."""
    counts = score_counts(df, label, score, keys).withColumn("__down", -F.col("score"))
    rows = KeyedRows(counts, keys, ["__down"], rows_per_segment=rows_per_segment, derived=True)
    higher = rows.running(upto=-1, above=("sum", F.col("pos"))).rows()
    above = F.coalesce(F.col("above"), F.lit(0))
    won = F.sum(F.col("neg") * (above.cast("double") + 0.5 * F.col("pos")))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return higher.groupBy(*keys).agg(F.round(F.try_divide(won, pairs), places).alias("auc_roc"))


def roc_curve(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    keys: Sequence[str] = (),
    rows_per_segment: int | None = None,
) -> DataFrame:
    """Rows ``fpr, tpr, threshold`` for each distinct score, after a start at (0, 0).

    The start's threshold is infinite; no point is dropped.
    """
    counts = score_counts(df, label, score, keys).withColumn("__down", -F.col("score"))
    rows = KeyedRows(counts, keys, ["__down"], rows_per_segment=rows_per_segment, derived=True)
    cum = rows.running(tp=("sum", F.col("pos")), fp=("sum", F.col("neg"))).rows()
    cum = cum.withColumn("__all", F.lit(0))
    by = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)] + [F.lit(0).alias("__total")]
    totals = df.groupBy(*by).agg(
        F.count_if(F.col(label) == 1).alias("P"), F.count_if(F.col(label) != 1).alias("N")
    )
    on = cum["__all"] == totals["__total"]
    for i, k in enumerate(keys):
        on = on & cum[k].eqNullSafe(totals[f"__k{i}"])
    side = totals if keys else F.broadcast(totals)  # a single row without keys
    points = cum.join(side, on).select(
        *keys,
        F.try_divide("fp", "N").alias("fpr"),
        F.try_divide("tp", "P").alias("tpr"),
        F.col("score").cast("double").alias("threshold"),
    )
    zero, none = F.lit(0.0), F.lit(float("inf"))
    start = totals.select(
        *[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)],
        F.when(F.col("N") > 0, zero).alias("fpr"),
        F.when(F.col("P") > 0, zero).alias("tpr"),
        none.alias("threshold"),
    )
    return start.unionByName(points)


def latency_summary(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    approximate: bool = False,
    rows_per_segment: int | None = None,
    places: int = 3,
) -> DataFrame:
    """p50, p95, p99 and mean of a latency column."""
    by = [*keys, "__all"]
    df = df.withColumn("__all", F.lit(0))
    q = quantiles(df, by, value, [0.5, 0.95, 0.99], rows_per_segment, approximate)
    means = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.round(F.avg(value), places).alias("mean"))
    return q.join(means, by).select(
        *keys, *[F.round(F.get("q", F.lit(i)), places).alias(f"p{p}") for i, p in enumerate((50, 95, 99))], "mean"
    )


def acceptance(
    metrics: DataFrame, min_f1: float = MIN_F1, min_auc: float = MIN_AUC, max_p95: float = MAX_P95_MS
) -> DataFrame:
    """Gates on ``f1_weighted``, ``auc_roc`` and ``p95``, with details."""
    gates = {
        "meets_f1": F.col("f1_weighted") >= min_f1,
        "meets_auc": F.col("auc_roc") >= min_auc,
        "meets_latency": F.col("p95") <= max_p95,
    }
    out = metrics.withColumns({n: F.coalesce(c, F.lit(False)) for n, c in gates.items()})
    return out.withColumn(
        "accepted", F.col("meets_f1") & F.col("meets_auc") & F.col("meets_latency")
    ).withColumn("within_sla", F.coalesce(F.col("p95") < max_p95, F.lit(False)))


def positive_weight(df: DataFrame, label: str = "label", given: float | None = None) -> DataFrame:
    """Negatives per positive, to 3 places, unless a weight is given."""
    if given is not None and given != 1:
        return df.agg(F.lit(float(given)).alias("positive_weight"))
    return df.agg(
        F.round(F.try_divide(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)), 3).alias("positive_weight")
    )


def balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """n / (classes * n_class) for each class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    every = Window.partitionBy(F.lit(0))  # one row per class
    total, classes = F.sum("n_class").over(every), F.count(F.lit(1)).over(every)
    return counts.select(label, "n_class", (total / (classes * F.col("n_class"))).alias("weight"))
