"""Runs, model versions, promotion and retraining decisions.

``keys`` names the registered model, so one call serves many of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeframe.constants import DRIFT_LIMIT, PROMOTE_GAIN, TRIGGER_ALERTS
from wakeframe.plans.ordered import top_rows

PRODUCTION, ARCHIVED = "Production", "Archived"
F1_PRODUCTION = 0.90

# Texts and keys other tools read.
FORCED, NO_PRODUCTION, CHECK_FAILED = "forced", "no_production_model", "mlflow_check_failed"
ALERT_REASON = "prometheus_alert:"
RUN_NAME_TAG = "mlflow.runName"


def pairs_to_map(pairs: Column) -> Column:
    """Array of key and value to a map; a repeated key keeps its last value."""
    last = F.filter(
        pairs,
        lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["key"] == p["key"]),
    )
    return F.map_from_entries(F.transform(F.coalesce(last, F.array()), lambda p: F.struct(p["key"], p["value"])))


def flatten_runs(runs: DataFrame) -> DataFrame:
    """Key/value arrays to maps, with model type and stage worked out.

    Runs without metrics are dropped. The type comes from the parameter, else
    from the name; the stage from the tag, else from the weighted F1.
    """
    maps = runs.withColumns({c: pairs_to_map(F.col(c)) for c in ("metrics", "params", "tags")})
    name = F.coalesce(
        F.nullif(F.try_element_at("tags", F.lit(RUN_NAME_TAG)), F.lit("")),
        F.nullif(F.col("run_name"), F.lit("")),
        F.lit("unnamed"),
    )
    out = maps.withColumn("run_name", name)
    given = F.coalesce(F.nullif(F.try_element_at("params", F.lit("model_type")), F.lit("")), F.lit("Unknown"))
    low = F.lower("run_name")
    kind = (
        F.when(given != "Unknown", given)
        .when(low.contains("xgb"), "XGBoost")
        .when(low.contains("svm"), "SVM")
        .otherwise("Unknown")
    )
    f1 = F.try_element_at("metrics", F.lit("f1_weighted"))
    stage = F.coalesce(
        F.nullif(F.try_element_at("tags", F.lit("stage")), F.lit("")),
        F.when(f1 > F1_PRODUCTION, PRODUCTION).otherwise(ARCHIVED),
    )
    return out.withColumns({"model_type": kind, "stage": stage}).filter(F.size("metrics") > 0)


def compare_models(
    runs: DataFrame, models: Sequence[str], metrics: dict[str, str], order: Column
) -> DataFrame:
    """Metric rows by model columns; the last run of a model counts, missing is 0."""
    values = [F.coalesce(F.try_element_at("metrics", F.lit(m)), F.lit(0.0)).alias(n) for n, m in metrics.items()]
    latest = runs.select("model_type", order.alias("__o"), F.struct(*values).alias("v")).groupBy("model_type").agg(
        F.max_by("v", "__o").alias("v")
    )
    long = latest.select("model_type", "v.*").unpivot(["model_type"], list(metrics), "metric", "value")
    wide = long.groupBy("metric").pivot("model_type", list(models)).agg(F.max("value"))
    return wide.select("metric", *[F.coalesce(F.col(f"`{m}`"), F.lit(0.0)).alias(m) for m in models])


def latest_runs(runs: DataFrame, order: Sequence[Column], n: int = 10) -> DataFrame:
    """The ``n`` newest runs."""
    return runs.orderBy(*order).limit(n)


def best_model(
    candidates: DataFrame, keys: Sequence[str] = (), f1: str = "f1_weighted", priority: str = "priority"
) -> DataFrame:
    """The candidate with the highest F1; a tie goes to the one listed first."""
    best = F.max_by(F.struct(*candidates.columns), F.struct(F.col(f1), -F.col(priority)))
    return candidates.groupBy(*keys).agg(best.alias("b")).filter("b IS NOT NULL").select("b.*")


def current_production(
    runs: DataFrame, keys: Sequence[str] = (), stage: str = "stage", order: str = "position"
) -> DataFrame:
    """The first run in production, else the first run."""
    first = F.min_by(F.struct(*runs.columns), F.struct(F.when(F.col(stage) == PRODUCTION, 0).otherwise(1), F.col(order)))
    return runs.groupBy(*keys).agg(first.alias("b")).filter("b IS NOT NULL").select("b.*")


def promotion(winner_f1: Column, production_f1: Column, gain: float = PROMOTE_GAIN) -> dict[str, Column]:
    """Promote without a production model or with a gain of at least ``gain``."""
    improvement = winner_f1 - F.coalesce(production_f1, F.lit(0.0))
    return {
        "improvement": F.round(improvement, 4),
        "should_promote": production_f1.isNull() | (improvement >= gain),
    }


def match_versions(versions: DataFrame, runs: DataFrame, run_id: str = "run_id") -> DataFrame:
    """Each version with the columns of its run; ``matched`` tells if there is one."""
    found = runs.withColumn("matched", F.lit(True))
    return versions.join(found, run_id, "left").withColumn("matched", F.coalesce("matched", F.lit(False)))


def promote_versions(
    versions: DataFrame, winners: DataFrame, keys: Sequence[str] = ("name",), note: str = "promoted"
) -> DataFrame:
    """A new snapshot of the version table after promotion.

    ``winners`` has ``keys, run_id``, one row per model to promote. The winner's
    version becomes Production and any other Production version is archived; a
    winner without a version changes nothing.
    """
    keys = list(keys)
    slim = winners.select(*keys, F.col("run_id").alias("__winner"))
    # first matching version per model, so the flag needs one small aggregate
    found = (
        versions.join(slim, keys)
        .filter(F.col("run_id") == F.col("__winner"))
        .groupBy(*keys)
        .agg(F.max("version").alias("__target"))
    )
    joined = versions.join(found, keys, "left")
    chosen = F.coalesce(F.col("version") == F.col("__target"), F.lit(False))
    retired = F.col("__target").isNotNull() & ~chosen & (F.col("stage") == PRODUCTION)
    return joined.withColumns(
        {
            "stage": F.when(chosen, PRODUCTION).when(retired, ARCHIVED).otherwise(F.col("stage")),
            "description": F.when(chosen, F.lit(note)).otherwise(F.col("description")),
        }
    ).drop("__target")


def production_versions(
    versions: DataFrame, runs: DataFrame, keys: Sequence[str] = ("name",), stage: str = PRODUCTION
) -> DataFrame:
    """The newest version in a stage per model, with its run's columns."""
    newest = top_rows(versions.filter(F.col("stage") == stage), list(keys), [F.col("version").desc()], 1)
    return match_versions(newest, runs)


def retrain_decision(
    df: DataFrame,
    forced: Column,
    drift: Column,
    has_production: Column,
    check_failed: Column,
    limit: float = DRIFT_LIMIT,
) -> DataFrame:
    """Adds ``reason`` and ``retrain``: forced, drift, no model, failed check."""
    reasons = F.array_compact(
        F.array(
            F.when(drift > limit, F.format_string("drift_score=%.4f", drift)),
            F.when(~check_failed & ~has_production, F.lit(NO_PRODUCTION)),
            F.when(check_failed, F.lit(CHECK_FAILED)),
        )
    )
    reason = F.when(forced, F.lit(FORCED)).otherwise(F.array_join(reasons, ", "))
    return df.withColumn("reason", reason).withColumn("retrain", F.col("reason") != "")


def alert_triggers(
    batches: DataFrame, batch: str = "batch_id", alerts: str = "alerts", triggers: Sequence[str] = tuple(TRIGGER_ALERTS)
) -> DataFrame:
    """Per webhook batch: alerts received and the first firing one that retrains."""
    rows = batches.select(batch, F.posexplode_outer(alerts).alias("pos", "alert"))
    name = F.try_element_at("alert.labels", F.lit("alertname"))
    starts = (F.col("alert.status") == "firing") & name.isin(*triggers)
    return rows.groupBy(batch).agg(
        F.count("alert").alias("received"),
        F.min_by(F.when(starts, F.concat(F.lit(ALERT_REASON), name)), F.when(starts, F.col("pos"))).alias("reason"),
    ).withColumn("triggered", F.col("reason").isNotNull())


def stage_status(runs: DataFrame, tasks: DataFrame, stages: Sequence[str], run: str = "run_id") -> DataFrame:
    """Every configured stage of every run, with its task's status if any."""
    listed = runs.select(
        run, F.posexplode(F.array(*[F.lit(s) for s in stages])).alias("position", "stage")
    )
    return listed.join(tasks, [run, "stage"], "left")
