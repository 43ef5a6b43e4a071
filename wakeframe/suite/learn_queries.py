"""Training and scoring on line items: is the discounted price high?"""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeframe.functions.scalars import alert_decision
from wakeframe.operators import evaluation as E
from wakeframe.operators import learn as L
from wakeframe.operators.split import stratified_split
from wakeframe.suite.registry import query, table

INPUTS = ["l_quantity", "unit", "l_discount", "l_tax"]
IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def rows(spark, folder):
    li = table(spark, folder, "lineitem")
    high = F.col("l_extendedprice") * (1 - F.col("l_discount")) > 45000
    labelled = li.select(
        *IDS, "l_quantity", "l_discount", "l_tax",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"),
        high.cast("int").alias("label"),
    )
    return stratified_split(labelled, "label", IDS)


def cores(spark):
    """The test table is one file with one row group, so one task would read it."""
    return spark.sparkContext.defaultParallelism


def gates(model, test):
    scored = model.score(test).withColumn("model", F.lit("m"))
    scores = E.classification_scores(E.confusion(scored, keys=["model"]), ["model"])
    area = E.auc(scored, score="confidence", keys=["model"])
    times = E.latency_summary(L.single_row_latency(model, test), "ms").select(F.lit("m").alias("model"), "p95")
    checked = E.acceptance(scores.join(area, "model").join(times, "model"))
    return checked.select("n", "meets_f1", "meets_auc", "meets_latency", "accepted")


GATES = """
    SELECT CAST(ceil(count(*) * 0.2) AS BIGINT) AS n, true AS meets_f1, true AS meets_auc, true AS meets_latency,
      true AS accepted FROM lineitem
"""


@query("boosted_trees", GATES)
def boosted_trees(spark, folder):
    """Boosted trees pass the F1, AUC and single-row latency gates on a fifth of the rows."""
    both = rows(spark, folder)
    model = L.train_boosted(both.filter("NOT is_test"), INPUTS, partitions=cores(spark))
    return gates(model, both.filter("is_test"))


@query("kernel_machine", GATES)
def kernel_machine(spark, folder):
    """The kernel machine passes the same gates."""
    both = rows(spark, folder)
    model = L.train_kernel(both.filter("NOT is_test"), INPUTS, partitions=cores(spark))
    return gates(model, both.filter("is_test"))


@query(
    "feature_importance",
    """
    SELECT * FROM (VALUES ('l_quantity', true, true), ('unit', true, true), ('l_discount', true, true),
      ('l_tax', false, true)) t(feature, tells_more_than_tax, is_share)
    WHERE (SELECT count(*) FROM lineitem) > 0
    """,
)
def feature_importance(spark, folder):
    """Gain per input of the boosted trees: the label doesn't depend on the tax, but on all others."""
    both = rows(spark, folder)
    gain = L.train_boosted(both.filter("NOT is_test"), INPUTS, partitions=cores(spark)).importance(spark)
    tax = gain.filter("feature = 'l_tax'").select(F.col("importance").alias("tax"))
    total = gain.agg(F.sum("importance").alias("total"))  # one row, as the one of the tax
    shares = gain.join(F.broadcast(tax)).join(F.broadcast(total))
    whole = (F.abs(F.col("total") - 1) < 1e-9) & F.col("importance").between(0, 1)
    return shares.select("feature", (F.col("importance") > F.col("tax")).alias("tells_more_than_tax"), whole.alias("is_share"))


@query(
    "batch_scores",
    f"""
    SELECT {', '.join(IDS)}, true AS in_range, true AS state_follows, true AS alert_follows, count(*) AS rows
    FROM lineitem GROUP BY ALL
    """,
)
def batch_scores(spark, folder):
    """Every row gets a confidence; state and alert follow from it."""
    both = rows(spark, folder)
    model = L.train_boosted(both.filter("NOT is_test"), INPUTS, partitions=cores(spark))
    scored = model.score(both).withColumn("alert", alert_decision(F.col("state"), F.col("confidence")))
    rules = scoring_rules(F.col("confidence"), F.col("state"), F.col("alert"))
    told = scored.groupBy(*IDS).agg(*[F.every(c).alias(n) for n, c in rules.items()], F.count(F.lit(1)).alias("rows"))
    return told


def scoring_rules(confidence, state, alert):
    """What holds for every scored row, whatever the model."""
    return {
        "in_range": F.coalesce(confidence.between(0, 1), F.lit(False)),
        "state_follows": state == F.when(confidence >= 0.5, "drowsy").otherwise("alert"),
        "alert_follows": alert == (confidence >= 0.7),
    }
