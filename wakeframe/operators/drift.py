"""Gaussian drift scores of live values against a baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeframe.constants import (
    DRIFT_BUFFER,
    DRIFT_EVERY,
    DRIFT_LIMIT,
    DRIFT_MIN_VALUES,
    FEATURES,
    VARIANCE_FLOOR,
)
from wakeframe.functions.parsing import drop_first
from wakeframe.functions.scalars import finite_or_null, is_finite
from wakeframe.operators.baseline import column_stats, gathered, to_long
from wakeframe.plans.ordered import KeyedRows, top_rows


def gaussian_kl(live_mean: Column, live_var: Column, base_mean: Column, base_var: Column) -> Column:
    """KL divergence of the live normal distribution from the baseline one."""
    vl, vb = live_var + VARIANCE_FLOOR, base_var + VARIANCE_FLOOR
    shift = live_mean - base_mean
    return F.ln(F.sqrt(vb) / F.sqrt(vl)) + (vl + shift * shift) / (2 * vb) - 0.5


def drift_score(
    n: Column, live_mean: Column, live_var: Column, base_mean: Column, base_var: Column, least: int = DRIFT_MIN_VALUES
) -> Column:
    """Score rounded to 6 places; 0 without a baseline or with too few values."""
    kl = F.greatest(F.lit(0.0), F.round(gaussian_kl(live_mean, live_var, base_mean, base_var), 6))
    return F.when((n >= least) & base_mean.isNotNull(), kl).otherwise(F.lit(0.0))


def accepted_values(df: DataFrame, columns: Sequence[str] = FEATURES, keep: Sequence[str] = ()) -> DataFrame:
    """Long table of the finite values; others never enter a buffer."""
    return to_long(df, columns, keep).filter(is_finite(F.col("value")))


def with_baseline(scored: DataFrame, base: DataFrame) -> DataFrame:
    """Attach the baseline mean and variance of each feature.

    ``base`` has one row per feature column, bounded by the schema; it is
    computed once.
    """
    slim = gathered(base.select("feature", F.col("mean").alias("base_mean"), F.col("variance").alias("base_var")))
    return scored.join(F.broadcast(slim), "feature", "left")


def drift_scores(
    live: DataFrame,
    base: DataFrame,
    columns: Sequence[str] = FEATURES,
    keys: Sequence[str] = (),
    least: int = DRIFT_MIN_VALUES,
) -> DataFrame:
    """One score per key and feature over all given live rows.

    An empty baseline disables scoring: the result is then empty.
    """
    base = gathered(base.select("feature", "mean", "variance"))
    finite = live.withColumns({c: finite_or_null(F.col(c).cast("double")) for c in columns if c in live.columns})
    stats = column_stats(finite, columns, {"m": F.avg, "v": F.var_pop}, keys)
    score = drift_score(F.col("n"), F.col("m"), F.col("v"), F.col("base_mean"), F.col("base_var"), least)
    scored = with_baseline(stats, base).select(*keys, "feature", "n", score.alias("score"))
    return scored.limit(0) if base.isEmpty() else scored


def overall_drift(scores: DataFrame, keys: Sequence[str] = (), limit: float = DRIFT_LIMIT) -> DataFrame:
    return scores.groupBy(*keys).agg(F.max("score").alias("overall")).withColumn("drifting", F.col("overall") > limit)


def top_drifted(scores: DataFrame, keys: Sequence[str] = (), n: int = 3) -> DataFrame:
    """The ``n`` highest scores per key (ties by name), ranked."""
    return top_rows(scores, keys or [F.lit(0)], [F.col("score").desc(), F.col("feature")], n, "rank")


def ranked_drift(scores: DataFrame) -> DataFrame:
    """All features by score with short names, four places."""
    short = drop_first(drop_first(F.col("feature"), F.lit("_mean")), F.lit("head_"))
    return scores.select(short.alias("feature"), F.round("score", 4).alias("score")).orderBy(
        F.desc("score"), "feature"
    )


def buffered_drift(
    live: DataFrame,
    base: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str] = FEATURES,
    seq: str | None = None,
    buffer: int = DRIFT_BUFFER,
    every: int = DRIFT_EVERY,
    least: int = DRIFT_MIN_VALUES,
    rows_per_segment: int | None = None,
) -> DataFrame:
    """Drift scores at each ``every``-th frame: ``keys, seq, feature, n, score``.

    Each feature is scored over its last ``buffer`` accepted values up to that
    frame. ``seq`` names an existing frame counter; a report then needs a row
    at that frame. Without it the rows themselves are counted.
    """
    keys = list(keys)
    small, counted = False, seq is None
    if counted:
        seq = "seq"
        numbered = KeyedRows(live, keys, order, rows_per_segment=rows_per_segment).position(seq)
        ends = live.groupBy(*keys).agg((F.count(F.lit(1)) + 1).alias(seq))
        live, small = numbered.rows(), numbered.small_keys
    else:
        ends = live.groupBy(*keys).agg((F.max(seq) + 1).cast("long").alias(seq))
    present = [c for c in columns if c in live.columns]
    long = accepted_values(live, present, [*keys, seq])
    # a closing row per key and feature stands for the end of the data
    closing = ends.select(
        *keys, seq, F.explode(F.array(*[F.lit(c) for c in present])).alias("feature")
    ).withColumn("value", F.lit(None).cast("double"))

    def before(w):
        f = w.rowsBetween(-buffer, -1)
        return {
            "n": F.count("value").over(f),
            "m": F.avg("value").over(f),
            "v": F.var_pop("value").over(f),
            "__since": F.coalesce(F.lag(seq).over(w), F.lit(1).cast("long")),
        }

    states = KeyedRows(
        long.select(*keys, seq, "feature", "value").unionByName(closing),
        [*keys, "feature"],
        [seq],
        halo=buffer,
        rows_per_segment=rows_per_segment,
        derived=True,
        small_keys=small,
    ).frame(before)
    # the state before a value holds for the reports since the value before it
    first = (F.ceil(F.col("__since") / every) * every).cast("long")
    due = F.sequence(first, F.col(seq) - 1, F.lit(every).cast("long"))
    reports = (
        states.rows()
        .filter(first <= F.col(seq) - 1)
        .withColumn(seq, F.explode(due))
        .select(*keys, seq, "feature", "n", "m", "v")
    )
    if not counted:
        reports = reports.join(live.filter(F.col(seq) % every == 0).select(*keys, seq), [*keys, seq], "left_semi")
    score = drift_score(F.col("n"), F.col("m"), F.col("v"), F.col("base_mean"), F.col("base_var"), least)
    return with_baseline(reports, base).select(*keys, seq, "feature", "n", score.alias("score"))
