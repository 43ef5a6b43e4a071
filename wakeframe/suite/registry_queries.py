"""Model registry over orders: a customer is a registered model, an order a run."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeframe.operators import registry as R
from wakeframe.session import fresh_path
from wakeframe.sources import tables
from wakeframe.suite.registry import placed, query, table

RUNS = """
  runs AS (SELECT o_custkey AS name, o_orderkey AS run_id, o_orderkey AS version, o_orderdate AS start_time,
      floor(o_totalprice / 50000) / 10 AS f1_weighted,
      CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Archived' ELSE 'None' END AS stage FROM orders)
"""


def runs(spark, folder):
    stage = (
        F.when(F.col("o_orderstatus") == "F", "Production")
        .when(F.col("o_orderstatus") == "O", "Archived")
        .otherwise("None")
    )
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("name"),
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderkey").alias("version"),
        F.col("o_orderdate").alias("start_time"),
        (F.floor(F.col("o_totalprice") / 50000) / 10).alias("f1_weighted"),
        stage.alias("stage"),
    )


@query(
    "latest_runs",
    """SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
    FROM orders QUALIFY place <= 10""",
)
def latest_runs(spark, folder):
    """The ten newest runs."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return placed(R.latest_runs(orders, [F.desc("o_orderdate"), F.desc("o_orderkey")], 10).drop("o_orderdate"))


BEST = """
  best AS (SELECT name, run_id, f1_weighted FROM (SELECT *, row_number() OVER (PARTITION BY name
      ORDER BY f1_weighted DESC, run_id) AS r FROM runs) WHERE r = 1)
"""


def best(spark, folder):
    return R.best_model(runs(spark, folder).withColumn("priority", F.col("run_id")), ["name"])


@query("best_model", f"WITH {RUNS}, {BEST} SELECT name, run_id, f1_weighted FROM best")
def best_model(spark, folder):
    """Highest F1 per model; the first listed wins a tie."""
    return best(spark, folder).select("name", "run_id", "f1_weighted")


@query(
    "current_production",
    f"""
    WITH {RUNS} SELECT name, run_id, stage FROM (SELECT *, row_number() OVER (PARTITION BY name
      ORDER BY CASE WHEN stage = 'Production' THEN 0 ELSE 1 END, run_id) AS r FROM runs) WHERE r = 1
    """,
)
def current_production(spark, folder):
    """First production run per model, else its first run."""
    return R.current_production(runs(spark, folder), ["name"], order="run_id").select("name", "run_id", "stage")


PRODUCTION = """
  prod AS (SELECT name, version, f1_weighted FROM (SELECT *, row_number() OVER (PARTITION BY name
      ORDER BY version DESC) AS r FROM runs WHERE stage = 'Production') WHERE r = 1)
"""


def production(spark, folder):
    every = runs(spark, folder)
    versions = every.select("name", "version", "run_id", "stage")
    return R.production_versions(versions, every.select("run_id", "f1_weighted"))


@query("production_lookup", f"WITH {RUNS}, {PRODUCTION} SELECT name, version, f1_weighted FROM prod")
def production_lookup(spark, folder):
    """Newest production version per model with its run's metric."""
    return production(spark, folder).select("name", "version", "f1_weighted")


@query(
    "version_runs",
    """
    SELECT o_orderkey AS run_id, round(max(l_discount), 4) AS top, count(l_orderkey) > 0 AS matched
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
    """,
)
def version_runs(spark, folder):
    """Versions with their run; without a run they are unmatched."""
    versions = table(spark, folder, "orders").select(F.col("o_orderkey").alias("run_id"))
    found = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("run_id")).agg(
        F.round(F.max("l_discount"), 4).alias("top")
    )
    return R.match_versions(versions, found)


DECISION = f"""
  {RUNS}, {BEST}, {PRODUCTION},
  decision AS (SELECT best.name, best.run_id, best.f1_weighted, prod.f1_weighted AS prod_f1,
      round(best.f1_weighted - coalesce(prod.f1_weighted, 0), 4) AS improvement,
      prod.f1_weighted IS NULL OR best.f1_weighted - coalesce(prod.f1_weighted, 0) >= 0.02 AS should_promote
    FROM best LEFT JOIN prod USING (name))
"""


def decisions(spark, folder):
    prod = production(spark, folder).select("name", F.col("f1_weighted").alias("prod_f1"))
    joined = best(spark, folder).join(prod, "name", "left")
    return joined.select(
        "name", "run_id", "f1_weighted", "prod_f1",
        *[c.alias(n) for n, c in R.promotion(F.col("f1_weighted"), F.col("prod_f1")).items()],
    )


@query("promotion_decision", f"WITH {DECISION} SELECT name, run_id, improvement, should_promote FROM decision")
def promotion_decision(spark, folder):
    return decisions(spark, folder).select("name", "run_id", "improvement", "should_promote")


@query(
    "registry_transition",
    f"""
    WITH {DECISION}
    SELECT r.name, r.version, CASE WHEN d.run_id = r.run_id THEN 'Production' WHEN d.run_id IS NOT NULL
        AND r.stage = 'Production' THEN 'Archived' ELSE r.stage END AS stage,
      CASE WHEN d.run_id = r.run_id THEN 'promoted' ELSE '' END AS description
    FROM runs r LEFT JOIN (SELECT * FROM decision WHERE should_promote) d ON d.name = r.name
    """,
)
def registry_transition(spark, folder):
    """Winners go to production, their predecessors to the archive."""
    versions = runs(spark, folder).select("name", "version", "run_id", "stage").withColumn("description", F.lit(""))
    winners = decisions(spark, folder).filter("should_promote")
    return R.promote_versions(versions, winners).select("name", "version", "stage", "description")


@query(
    "retrain_decision",
    f"""
    WITH {RUNS}, {PRODUCTION}, c AS (SELECT c_custkey, c_mktsegment = 'MACHINERY' AS forced, c_acctbal / 20011 AS drift,
        prod.name IS NOT NULL AS has_production, c_nationkey = 3 AS failed
      FROM customer LEFT JOIN prod ON prod.name = c_custkey),
    r AS (SELECT c_custkey, CASE WHEN forced THEN 'forced' ELSE concat_ws(', ',
        CASE WHEN drift > 0.15 THEN 'drift_score=' || printf('%.4f', drift) END,
        CASE WHEN NOT failed AND NOT has_production THEN 'no_production_model' END,
        CASE WHEN failed THEN 'mlflow_check_failed' END) END AS reason FROM c)
    SELECT c_custkey, reason, reason <> '' AS retrain FROM r
    """,
)
def retrain_decision(spark, folder):
    """Why each model is retrained, if it is."""
    prod = production(spark, folder).select(F.col("name").alias("c_custkey"), F.lit(True).alias("has"))
    df = table(spark, folder, "customer").join(prod, "c_custkey", "left")
    out = R.retrain_decision(
        df,
        F.col("c_mktsegment") == "MACHINERY",
        F.col("c_acctbal") / 20011,
        F.coalesce("has", F.lit(False)),
        F.col("c_nationkey") == 3,
    )
    return out.select("c_custkey", "reason", "retrain")


FLAT = """
  flat AS (SELECT o_orderkey AS run_id,
      CASE WHEN o_custkey % 4 = 0 THEN 'tag-' || o_orderkey ELSE 'Run_' || CASE o_orderpriority
        WHEN '1-URGENT' THEN 'XGB' WHEN '5-LOW' THEN 'svm' ELSE 'other' END END AS run_name,
      o_orderdate AS start_time,
      CASE WHEN o_orderstatus = 'P' THEN 'Forest' WHEN o_custkey % 4 <> 0 AND o_orderpriority = '1-URGENT' THEN 'XGBoost'
        WHEN o_custkey % 4 <> 0 AND o_orderpriority = '5-LOW' THEN 'SVM' ELSE 'Unknown' END AS model_type,
      CASE WHEN o_custkey % 5 = 0 THEN 'Staging' WHEN o_totalprice / 500009 > 0.9 THEN 'Production'
        ELSE 'Archived' END AS stage,
      o_totalprice / 500009 AS f1_weighted, o_totalprice / 600011 AS accuracy
    FROM orders WHERE o_totalprice > 50000)
"""


def nested_runs(spark, folder):
    def pair(key, value):
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    o = table(spark, folder, "orders")
    price = F.col("o_totalprice")
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "XGB")
        .when(F.col("o_orderpriority") == "5-LOW", "svm")
        .otherwise("other")
    )
    metrics = F.array(pair("f1_weighted", price / 500009), pair("accuracy", price / 600011))
    no_text = F.array().cast("array<struct<key:string,value:string>>")
    named = F.array(pair("mlflow.runName", F.concat(F.lit("tag-"), F.col("o_orderkey").cast("string"))))
    staged = F.array(pair("stage", F.lit("Staging")))
    return o.select(
        F.col("o_orderkey").alias("run_id"),
        F.concat(F.lit("Run_"), kind).alias("run_name"),
        F.col("o_orderdate").alias("start_time"),
        F.when(price > 50000, metrics).otherwise(F.slice(metrics, 1, 0)).alias("metrics"),
        F.when(F.col("o_orderstatus") == "P", F.array(pair("model_type", F.lit("Forest")))).otherwise(no_text).alias("params"),
        F.concat(
            F.when(F.col("o_custkey") % 4 == 0, named).otherwise(no_text),
            F.when(F.col("o_custkey") % 5 == 0, staged).otherwise(no_text),
        ).alias("tags"),
    )


@query(
    "flattened_runs",
    f"WITH {FLAT} SELECT run_id, run_name, model_type, stage, round(f1_weighted, 6) AS f1 FROM flat",
)
def flattened_runs(spark, folder):
    """Key/value arrays to columns; type and stage worked out."""
    flat = R.flatten_runs(nested_runs(spark, folder))
    return flat.select(
        "run_id", "run_name", "model_type", "stage",
        F.round(F.try_element_at("metrics", F.lit("f1_weighted")), 6).alias("f1"),
    )


@query(
    "run_files",
    f"""WITH {FLAT} SELECT run_id::VARCHAR AS run_id, run_name, model_type, stage, epoch_ms(start_time) AS start_ms,
    round(f1_weighted, 6) AS f1 FROM flat""",
)
def run_files(spark, folder):
    """Runs written as JSON documents and read back with the tracking server's schema."""
    path = fresh_path(spark, "runs")
    told = nested_runs(spark, folder).withColumns(
        {
            "run_id": F.col("run_id").cast("string"),
            "status": F.lit("FINISHED"),
            "start_time": F.unix_millis(F.col("start_time").cast("timestamp")),
        }
    )
    told.write.json(path)
    flat = R.flatten_runs(tables.read_runs(spark, path))
    return flat.select(
        "run_id", "run_name", "model_type", "stage", F.col("start_time").alias("start_ms"),
        F.round(F.try_element_at("metrics", F.lit("f1_weighted")), 6).alias("f1"),
    )


@query(
    "model_comparison",
    f"""
    WITH {FLAT}, l AS (SELECT model_type, arg_max(f1_weighted, (start_time, run_id)) AS f1,
        arg_max(accuracy, (start_time, run_id)) AS acc FROM flat GROUP BY model_type),
    long AS (SELECT 'F1' AS metric, model_type, f1 AS v FROM l UNION ALL SELECT 'Accuracy', model_type, acc FROM l
      UNION ALL SELECT 'AUC', model_type, 0.0 FROM l)
    SELECT metric, round(coalesce(max(v) FILTER (model_type = 'XGBoost'), 0.0), 6) AS "XGBoost",
      round(coalesce(max(v) FILTER (model_type = 'SVM'), 0.0), 6) AS "SVM",
      round(coalesce(max(v) FILTER (model_type = 'Forest'), 0.0), 6) AS "Forest"
    FROM long GROUP BY metric
    """,
)
def model_comparison(spark, folder):
    """Metrics by model type, from the newest run of each type."""
    models = ["XGBoost", "SVM", "Forest"]
    out = R.compare_models(
        R.flatten_runs(nested_runs(spark, folder)),
        models,
        {"F1": "f1_weighted", "Accuracy": "accuracy", "AUC": "auc_roc"},
        F.struct("start_time", "run_id"),
    )
    return out.select("metric", *[F.round(m, 6).alias(m) for m in models])


STAGES = ["validate", "extract", "landmarks", "features", "split", "train", "summary"]


@query(
    "stage_status",
    f"""
    WITH t AS (SELECT l_orderkey AS run_id, l_linenumber - 1 AS position, max(l_linestatus) AS status FROM lineitem
      GROUP BY ALL), s AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{s}')" for i, s in enumerate(STAGES))})
      v(position, stage))
    SELECT o.o_orderkey AS run_id, s.position, s.stage, t.status FROM orders o CROSS JOIN s
    LEFT JOIN t ON t.run_id = o.o_orderkey AND t.position = s.position
    """,
)
def stage_status(spark, folder):
    """Every stage of every run, with or without a task."""
    names = F.array(*[F.lit(s) for s in STAGES])
    tasks = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("run_id"), F.get(names, F.col("l_linenumber") - 1).alias("stage"))
        .agg(F.max("l_linestatus").alias("status"))
    )
    return R.stage_status(table(spark, folder, "orders").select(F.col("o_orderkey").alias("run_id")), tasks, STAGES)
