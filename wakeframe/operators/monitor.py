"""Service metrics: counters, histograms, rates, quantiles and alert rules.

Times are whole epoch seconds; ranges are evaluated on a fixed step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeframe.constants import DRIFT_LIMIT, FEATURE_DRIFT_LIMIT
from wakeframe.plans.ordered import KeyedRows


def epoch_seconds(ts: Column) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / 1_000_000).cast("long")


def labelled_counts(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Counter totals per label set."""
    return df.groupBy(*labels).agg(F.count(F.lit(1)).alias("total"))


def bucket_columns(value: Column, bounds: Sequence[float]) -> list[Column]:
    """Aggregates ``le_0 .. le_n`` (last = all), ``total_sum``: cumulative counts."""
    cumulative = [F.count_if(value <= b).alias(f"le_{i}") for i, b in enumerate(bounds)]
    return [*cumulative, F.count(value).alias(f"le_{len(bounds)}"), F.sum(value).alias("total_sum")]


def bucket_counts(df: DataFrame, value: Column, bounds: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(*bucket_columns(value, bounds))


def bucket_rows(counts: DataFrame, bounds: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """The histogram as rows ``le, cumulative``; the last bound is infinite."""
    edges = [*map(float, bounds), float("inf")]
    pairs = F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"le_{i}").alias("cumulative")) for i, b in enumerate(edges)])
    return counts.select(*keys, F.inline(pairs))


def bucket_quantile(bounds: Sequence[float], q: float, prefix: str = "le_") -> Column:
    """Quantile by linear interpolation inside the bucket that reaches it.

    The first bucket starts at 0; past the last finite bound the result is
    that bound. No observations give null.
    """
    total = F.col(f"{prefix}{len(bounds)}")
    rank = q * total
    out = F.when(total == 0, F.lit(None).cast("double"))
    for i, bound in enumerate(bounds):
        cum = F.col(f"{prefix}{i}")
        low, below = (float(bounds[i - 1]), F.col(f"{prefix}{i - 1}")) if i else (0.0, F.lit(0))
        inside = F.coalesce(F.try_divide((rank - below).cast("double"), (cum - below).cast("double")), F.lit(0.0))
        out = out.when(cum >= rank, low + (float(bound) - low) * inside)
    return out.otherwise(F.lit(float(bounds[-1])))


def over_steps(df: DataFrame, at: Column, step: int, window: int, name: str = "eval_at") -> DataFrame:
    """One copy of each row for each evaluation whose range (t - window, t] holds it.

    Aggregate to one row per step and series first, so that the copies do not
    grow with the number of samples.
    """
    if window % step:
        raise ValueError(f"window {window} is not a multiple of step {step}")
    first = (F.ceil(at / step) * step).cast("long")
    return df.withColumn(name, F.explode(F.sequence(first, first + (window - step), F.lit(step).cast("long"))))


def counter_increase(
    samples: DataFrame,
    series: Sequence[str],
    ts: str,
    value: str,
    step: int,
    window: int,
    order: Sequence[str] | None = None,
    rows_per_segment: int | None = None,
    derived: bool = False,
    small_keys: bool = False,
) -> DataFrame:
    """Reset-aware increase of counters: ``series, eval_at, increase, rate``.

    A drop in the value is a restart from zero. No extrapolation to the edges
    of the range is done.
    """
    rows = KeyedRows(
        samples,
        series,
        order or [ts],
        halo=1,
        rows_per_segment=rows_per_segment,
        derived=derived,
        small_keys=small_keys,
    ).frame(lambda w: {"__prev": F.lag(value).over(w)})
    cur, prev = F.col(value), F.col("__prev")
    grown = F.when(cur < prev, cur).otherwise(cur - prev)
    steps = (
        rows.rows()
        .filter(prev.isNotNull())
        .groupBy(*series, (F.ceil(F.col(ts) / step) * step).cast("long").alias("__step"))
        .agg(F.sum(grown).alias("__grown"))
    )
    out = over_steps(steps, F.col("__step"), step, window).groupBy(*series, "eval_at").agg(
        F.sum("__grown").alias("increase")
    )
    return out.withColumn("rate", F.col("increase") / window)


def error_ratio(
    errors: DataFrame, requests: DataFrame, endpoint: str = "endpoint", limit: float = 0.05
) -> DataFrame:
    """Error rate over request rate per endpoint and evaluation time."""
    e = errors.select(endpoint, "eval_at", F.col("rate").alias("error_rate"))
    r = requests.select(endpoint, "eval_at", F.col("rate").alias("request_rate"))
    ratio = F.col("error_rate") / (F.col("request_rate") + 0.001)
    return e.join(r, [endpoint, "eval_at"]).select(endpoint, "eval_at", ratio.alias("ratio"), (ratio > limit).alias("high"))


def range_histogram(
    df: DataFrame, ts: Column, value: Column, bounds: Sequence[float], step: int, window: int, keys: Sequence[str] = ()
) -> DataFrame:
    """Cumulative bucket counts over each evaluation range."""
    at = (F.ceil(ts / step) * step).cast("long")
    steps = df.groupBy(*keys, at.alias("__step")).agg(*bucket_columns(value, bounds))
    names = [f"le_{i}" for i in range(len(bounds) + 1)] + ["total_sum"]
    return (
        over_steps(steps, F.col("__step"), step, window)
        .groupBy(*keys, "eval_at")
        .agg(*[F.sum(n).alias(n) for n in names])
    )


def evaluation_grid(spark: SparkSession, start: int, end: int, step: int) -> DataFrame:
    """One row, ``eval_at``, for each multiple of ``step`` from ``start`` to ``end``."""
    first = -(-start // step) * step
    return spark.range(first, end + 1, step).select(F.col("id").alias("eval_at"))


def instant_values(
    samples: DataFrame, series: Sequence[str], ts: str, value: str, step: int, staleness: int
) -> DataFrame:
    """The latest sample of each series at each evaluation: ``series, eval_at, value``.

    A sample counts for ``staleness`` seconds; after that its series has no value until
    the next one. Only the last sample of a step is carried on, so the copies grow with
    steps and series and not with samples.
    """
    first = (F.ceil(F.col(ts) / step) * step).cast("long")
    newest = F.max(F.struct(F.col(ts).alias("at"), F.col(value).alias("value"))).alias("__s")
    last = samples.groupBy(*series, first.alias("__first")).agg(newest)
    until = (F.floor((F.col("__s.at") + staleness) / step) * step).cast("long")
    shown = last.filter(F.col("__first") <= until).select(
        *series, "__s", F.explode(F.sequence("__first", until, F.lit(step).cast("long"))).alias("eval_at")
    )
    return shown.groupBy(*series, "eval_at").agg(F.max("__s").alias("__s")).select(*series, "eval_at", F.col("__s.value").alias("value"))


def availability(
    scrapes: DataFrame, targets: Sequence[str], grid: DataFrame, target: str, ts: str, value: str, step: int, staleness: int
) -> DataFrame:
    """``target, eval_at, value`` for every configured target and evaluation.

    A target that wasn't heard of for ``staleness`` seconds, or never, counts as 0: a
    rule on it fires, although there are no samples. ``targets`` is the configuration,
    a handful of names.
    """
    wanted = grid.select("eval_at", F.explode(F.array(*[F.lit(t) for t in targets])).alias(target))
    known = instant_values(scrapes, [target], ts, value, step, staleness)
    joined = wanted.join(known, [target, "eval_at"], "left")
    return joined.select(target, "eval_at", F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"))


def range_moments(
    samples: DataFrame, keys: Sequence[str], ts: str, value: str, step: int, window: int
) -> DataFrame:
    """``keys, eval_at, n, mean, variance`` (population) of the values in each range, from sums per step."""
    at = (F.ceil(F.col(ts) / step) * step).cast("long")
    v = F.col(value)
    steps = samples.filter(v.isNotNull()).groupBy(*keys, at.alias("__step")).agg(
        F.count(v).alias("n"), F.sum(v).alias("__sum"), F.sum(v * v).alias("__squares")
    )
    sums = over_steps(steps, F.col("__step"), step, window).groupBy(*keys, "eval_at").agg(
        *[F.sum(c).alias(c) for c in ("n", "__sum", "__squares")]
    )
    mean = F.col("__sum") / F.col("n")
    spread = F.greatest(F.col("__squares") / F.col("n") - mean * mean, F.lit(0.0))
    return sums.select(*keys, "eval_at", "n", mean.alias("mean"), spread.alias("variance"))


def hold(
    evaluations: DataFrame,
    series: Sequence[str],
    ts: str,
    condition: str,
    hold_seconds: Column | int,
    step: int,
    rows_per_segment: int | None = None,
    derived: bool = False,
) -> DataFrame:
    """Adds ``since`` and ``status``: inactive, pending or firing.

    A condition fires once it has been true for ``hold_seconds`` without a
    false or missing evaluation in between.
    """
    rows = KeyedRows(evaluations, series, [ts], halo=1, rows_per_segment=rows_per_segment, derived=derived)
    cond = F.coalesce(F.col(condition), F.lit(False))
    rows.frame(lambda w: {"__ok": F.lag(cond).over(w), "__at": F.lag(ts).over(w)})
    goes_on = F.coalesce(F.col("__ok") & (F.col(ts) - F.col("__at") <= step), F.lit(False))
    rows.running(__since=("max", F.when(cond & ~goes_on, F.col(ts))))
    need = hold_seconds if isinstance(hold_seconds, Column) else F.lit(hold_seconds)
    age = F.col(ts) - F.col("__since")
    return (
        rows.rows()
        .withColumns(
            {
                "since": F.when(cond, F.col("__since")),
                "status": F.when(~cond, "inactive").when(age >= need, "firing").otherwise("pending"),
            }
        )
        .drop("__ok", "__at", "__since")
    )


@dataclass(frozen=True)
class Rule:
    """An alert rule over one evaluated metric."""

    alert: str
    metric: str
    op: str
    limit: float
    hold_seconds: int
    severity: str
    labels: dict[str, str] = field(default_factory=dict)


# The service's alert rules.
RULES = [
    Rule("HighErrorRate", "error_ratio", ">", 0.05, 120, "warning"),
    Rule("HighInferenceLatency", "latency_p95", ">", 0.2, 120, "warning"),
    Rule("DataDriftDetected", "overall_drift", ">", DRIFT_LIMIT, 120, "critical"),
    Rule("ModelServerDown", "up", "==", 0.0, 60, "critical", {"job": "model_server"}),
    Rule("BackendDown", "up", "==", 0.0, 60, "critical", {"job": "backend"}),
    Rule("EARFeatureDrift", "feature_drift", ">", FEATURE_DRIFT_LIMIT, 120, "warning", {"feature": "ear_mean"}),
    Rule("PERCLOSFeatureDrift", "feature_drift", ">", FEATURE_DRIFT_LIMIT, 120, "warning", {"feature": "perclos"}),
]


def rule_table(spark, rules: Sequence[Rule] = tuple(RULES)) -> DataFrame:
    """The rules as a table: one row per rule, a handful."""
    return spark.createDataFrame(
        [(r.alert, r.metric, r.op, float(r.limit), int(r.hold_seconds), r.severity, r.labels) for r in rules],
        "alert string, metric string, op string, limit double, hold_seconds int, severity string, "
        "want map<string,string>",
    )


def apply_rules(
    series: DataFrame,
    rules: Sequence[Rule] = tuple(RULES),
    step: int = 15,
    rows_per_segment: int | None = None,
) -> DataFrame:
    """Alert status per rule, series and evaluation time.

    ``series`` has ``eval_at, metric, labels MAP, value``; a rule's labels must
    all be present in the series.
    """
    table = rule_table(series.sparkSession, rules)
    met = (
        F.when(F.col("op") == ">", F.col("value") > F.col("limit"))
        .when(F.col("op") == ">=", F.col("value") >= F.col("limit"))
        .when(F.col("op") == "<", F.col("value") < F.col("limit"))
        .otherwise(F.col("value") == F.col("limit"))
    )
    matched = (
        series.join(F.broadcast(table), "metric")
        .filter(
            F.forall(
                F.map_entries("want"),
                lambda e: F.coalesce(F.try_element_at(F.col("labels"), e["key"]) == e["value"], F.lit(False)),
            )
        )
        .withColumn("series", F.to_json(F.array_sort(F.map_entries("labels"))))
        .select("alert", "severity", "hold_seconds", "series", "eval_at", "value", met.alias("met"))
    )
    return hold(
        matched, ["alert", "series"], "eval_at", "met", F.col("hold_seconds"), step, rows_per_segment, derived=True
    ).drop("hold_seconds")
