"""Evaluation, monitoring, gates, splits, registry, sources and learning."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeframe.constants import FEATURES
from wakeframe.functions import scalars as S
from wakeframe.operators import baseline as B
from wakeframe.operators import evaluation as E
from wakeframe.operators import learn as L
from wakeframe.operators import monitor as M
from wakeframe.operators import quality as Q
from wakeframe.operators import registry as R
from wakeframe.operators import reports as RP
from wakeframe.operators import split as SP
from wakeframe.schemas import wide_landmarks
from wakeframe.sources import tables


# evaluation


@pytest.mark.parametrize("size", [None, 7])
def test_auc_is_the_area_under_the_curve(spark, size):
    rng = random.Random(2)
    data = [(int(rng.random() < 0.4), round(rng.random(), 1 if i % 2 else 3)) for i in range(300)]
    df = spark.createDataFrame(data, "label int, score double")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert E.auc(df, rows_per_segment=size, places=9).first()[0] == pytest.approx(want, abs=1e-8)
    pts = sorted((r["fpr"], r["tpr"]) for r in E.roc_curve(df, rows_per_segment=size).collect())
    assert len(pts) == len({s for _, s in data}) + 1 and pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)
    x, y = zip(*pts)
    assert np.trapezoid(y, x) == pytest.approx(want, abs=1e-9)


def test_scores_with_an_empty_class(spark):
    df = spark.createDataFrame([(0, 0)] * 3 + [(1, 0)], "label int, prediction int")
    counts = E.confusion(df)
    s = E.classification_scores(counts).first()
    assert (s["accuracy"], s["precision_weighted"], s["recall_weighted"], s["f1_positive"]) == (0.75, 0.5625, 0.75, 0.0)
    assert s["f1_weighted"] == pytest.approx(0.6429)
    rep = {r["class"]: r for r in E.classification_report(counts).collect()}
    assert rep["0"]["support"] == 3 and rep["1"]["f1"] == 0.0 and rep["macro avg"]["recall"] == 0.5
    assert [tuple(r) for r in E.confusion_matrix(counts, [0, 1]).orderBy("actual").collect()] == [(0, 3, 0), (1, 1, 0)]


def test_gates_and_weights(spark):
    df = spark.createDataFrame([(0.85, 0.9, 200.0), (0.8499, 0.95, 10.0)], "f1_weighted double, auc_roc double, p95 double")
    a, b = E.acceptance(df).collect()
    assert a["accepted"] and not a["within_sla"] and not b["accepted"] and b["within_sla"]
    labels = spark.createDataFrame([(0,)] * 5 + [(1,)] * 3, "label int")
    assert E.positive_weight(labels).first()[0] == 1.667 and E.positive_weight(labels, given=2.5).first()[0] == 2.5
    assert {r["label"]: r["weight"] for r in E.balanced_weights(labels).collect()} == pytest.approx({0: 0.8, 1: 4 / 3})


# monitoring


def test_bucket_quantile(spark):
    bounds = [0.1, 0.2, 0.5]
    df = spark.createDataFrame([(v,) for v in [0.05, 0.05, 0.15, 0.3, 0.4, 0.4, 0.45, 0.5, 0.2, 2.0]], "v double")
    h = M.bucket_counts(df, F.col("v"), bounds)
    row = h.select(*[M.bucket_quantile(bounds, q).alias(f"q{int(q * 100)}") for q in (0.1, 0.3, 0.5, 0.95)]).first()
    assert row["q10"] == pytest.approx(0.05) and row["q30"] == pytest.approx(0.15)
    assert row["q50"] == pytest.approx(0.2 + 0.3 / 5) and row["q95"] == 0.5
    assert [r["cumulative"] for r in M.bucket_rows(h, bounds).orderBy("le").collect()] == [2, 4, 9, 10]
    none = M.bucket_counts(df.limit(0), F.col("v"), bounds).select(M.bucket_quantile(bounds, 0.5)).first()[0]
    assert none is None


def test_counter_restart(spark):
    df = spark.createDataFrame([("a", t, v) for t, v in [(0, 5.0), (10, 9.0), (20, 2.0), (30, 6.0)]], "s string, t long, v double")
    got = {r["eval_at"]: r["increase"] for r in M.counter_increase(df, ["s"], "t", "v", 15, 30).collect()}
    assert got == {15: 4.0, 30: 4.0 + 2.0 + 4.0, 45: 6.0}
    with pytest.raises(ValueError):
        M.counter_increase(df, ["s"], "t", "v", 20, 30)


@pytest.mark.parametrize("size", [None, 3])
def test_alert_hold(spark, size):
    met = {0: True, 15: True, 30: True, 45: False, 60: True, 75: True, 105: True, 120: True, 135: True}
    df = spark.createDataFrame([("r", t, m) for t, m in met.items()], "s string, t long, m boolean")
    got = {r["t"]: r["status"] for r in M.hold(df, ["s"], "t", "m", 30, 15, rows_per_segment=size).collect()}
    assert got == {0: "pending", 15: "pending", 30: "firing", 45: "inactive", 60: "pending", 75: "pending",
                   105: "pending", 120: "pending", 135: "firing"}


def test_rules_match_labels(spark):
    rows = [(t, m, lab, v) for t in (0, 15, 30, 45, 60, 75, 90, 105, 120) for m, lab, v in [
        ("overall_drift", {"session": "s"}, 0.2), ("up", {"job": "backend"}, 0.0), ("up", {"job": "other"}, 0.0),
        ("feature_drift", {"feature": "ear_mean"}, 0.2), ("feature_drift", {"feature": "perclos"}, 0.21)]]
    df = spark.createDataFrame(rows, "eval_at long, metric string, labels map<string,string>, value double")
    last = {r["alert"]: r["status"] for r in M.apply_rules(df).filter("eval_at = 120").collect()}
    assert last == {"DataDriftDetected": "firing", "BackendDown": "firing", "EARFeatureDrift": "inactive",
                    "PERCLOSFeatureDrift": "firing"}
    early = M.apply_rules(df).filter("eval_at = 105 AND alert = 'DataDriftDetected'").first()
    assert early["status"] == "pending"


# gates and splits


def test_checks(spark, tmp_path):
    df = spark.createDataFrame([(1.0, None, 0), (2.0, 3.0, 0)], "ear_mean double, perclos double, label int")
    rows = {r["check"]: r for r in Q.run_checks(df).collect()}
    assert rows["not_empty"]["passed"] and not rows["has_both_labels"]["passed"]
    assert rows["no_nulls_in_features"]["message"] == "missing values: perclos: 1"
    assert "ear_min" in rows["schema"]["message"]
    with pytest.raises(ValueError, match="no such checks"):
        Q.run_checks(df, ["exists", "size"])
    with pytest.raises(Q.QualityError, match="3 check"):
        Q.require(Q.run_checks(df))
    assert not Q.run_checks(df.limit(0), ["not_empty"]).first()["passed"]
    with pytest.raises(ValueError, match="use check_path"):
        Q.run_checks(df, ["exists"])
    gone = Q.check_path(spark, str(tmp_path / "none")).collect()
    assert len(gone) == 5 and not any(r["passed"] for r in gone)
    full = spark.range(4).select(*[F.rand(1).alias(f) for f in FEATURES], (F.col("id") % 2).alias("label"))
    tables.write_table(full, str(tmp_path / "f"))
    Q.require(Q.check_path(spark, str(tmp_path / "f"), Q.CHECKS))
    Q.require(Q.check_features(full, B.summary_stats(full)))
    with pytest.raises(Q.QualityError, match="missing: perclos"):
        Q.require(Q.check_features(full, B.summary_stats(full.drop("perclos"))))


def test_checks_while_writing_equal_checks_of_the_table(spark, tmp_path):
    df = spark.createDataFrame(
        [(1.0, None, 0), (2.0, 3.0, 1), (float("nan"), 1.0, 2)] * 50, "ear_mean double, perclos double, label int"
    ).repartition(5)
    told = [Q.write_checked(part, str(tmp_path / f"{n}"), features=["ear_mean", "perclos", "mar_max"]) for n, part in enumerate(
        [df, df.filter("label = 1"), df.filter("label > 7"), df.drop("label")])]
    for n, verdicts in enumerate(told):
        read = Q.check_path(spark, str(tmp_path / f"{n}"), features=["ear_mean", "perclos", "mar_max"])
        a, b = ({r["check"]: (r["passed"], r["message"].replace("2 or more", "3")) for r in x.collect()} for x in (verdicts, read))
        assert a == b and len(a) == 5
    assert spark.read.parquet(str(tmp_path / "0")).count() == 150
    with pytest.raises(ValueError, match="no such checks"):
        Q.write_checked(df, str(tmp_path / "x"), ["size"])
    assert not (tmp_path / "x").exists()


def test_range_reasons(spark):
    good = dict.fromkeys(FEATURES, 0.5)
    bad = {**good, "ear_mean": 1.5, "mar_max": -0.1, "perclos": float("nan"), "head_pitch_mean": -170.0}
    df = spark.createDataFrame([tuple(r[f] for f in FEATURES) for r in (good, bad)], ", ".join(f"{f} double" for f in FEATURES))
    ok, rejected = S.split_valid(df)
    assert ok.count() == 1
    assert rejected.first()["problems"] == ["ear_mean: above 1", "perclos: missing or not a number", "mar_max: below 0"]
    text = df.withColumn("ear_std", F.lit("wide"))
    assert "ear_std: missing or not a number" in S.split_valid(text)[1].first()["problems"]


def test_published_split_sizes(spark):
    classes = spark.createDataFrame([(1, 13947), (0, 13836)], "label int, __total long")
    assert {r[0]: r[1] for r in SP.quotas(classes, "label", 0.2).collect()} == {1: 2790, 0: 2767}
    df = spark.range(27783).select("id", (F.col("id") < 13947).cast("int").alias("label"))
    got = {(r["label"], r["is_test"]): r["n"] for r in SP.split_summary(SP.stratified_split(df, "label", ["id"])).collect()}
    assert got == {(1, True): 2790, (0, True): 2767, (1, False): 11157, (0, False): 11069}


def test_split_is_the_same_in_segments_and_with_null_labels(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 10 < 7, F.col("id") % 2).alias("label")).repartition(5)
    a = SP.stratified_split(df, "label", ["id"]).filter("is_test")
    b = SP.stratified_split(df, "label", ["id"], rows_per_segment=100).filter("is_test")
    assert a.count() == 600 and sorted(a.select("id").collect()) == sorted(b.select("id").collect())
    assert SP.stratified_split(df, "label", ["id"], seed=1).filter("is_test").join(a, "id").count() < 600


def test_split_with_repeated_ids_and_many_classes(spark):
    same = spark.range(1000).select(F.lit("unknown").alias("subject_id"), F.lit(0).alias("frame_id"), F.lit(1).alias("label"))
    assert SP.stratified_split(same).filter("is_test").count() == 200
    some = spark.range(1000).select((F.col("id") % 7).alias("id"), (F.col("id") % 3).alias("label"))
    assert SP.stratified_split(some, "label", ["id"]).filter("is_test").count() == 200
    many = spark.range(60_000).select("id", (F.col("id") % 12_000).alias("label"))
    sides = SP.stratified_split(many, "label", ["id"]).groupBy("label").agg(F.count_if("is_test").alias("n"))
    assert [tuple(r) for r in sides.groupBy("n").count().collect()] == [(1, 12_000)]


def test_fingerprint_of_many_equal_rows(spark):
    one = RP.fingerprint(spark.range(3_000_000).select(F.lit(1).alias("a"))).first()
    assert one["rows"] == 3_000_000 and abs(int(one["hash_sum"])) > 2**63


def test_checks_of_a_text_feature(spark):
    df = spark.createDataFrame([("x", 1.0, 0), (None, float("nan"), 1)], "a string, b double, label int")
    got = {r["check"]: r["message"] for r in Q.run_checks(df, ["not_empty", "no_nulls_in_features"], ["a", "b"]).collect()}
    assert "a: 1" in got["no_nulls_in_features"] and "b: 1" in got["no_nulls_in_features"]


def test_group_split(spark):
    df = spark.range(500).select("id", (F.col("id") % 21).alias("subject_id"))
    sides = SP.group_split(df).groupBy("subject_id").agg(F.count_distinct("is_test").alias("n"), F.max("is_test").alias("t"))
    rows = sides.collect()
    assert all(r["n"] == 1 for r in rows) and sum(r["t"] for r in rows) == 5


def test_fingerprint_tells_values_apart(spark):
    schema = "a string, b string, c double, d array<int>"
    rows = [("x", "", 1.0, [1]), ("", "x", 1.0, [1]), (None, "x", 1.0, [1]), ("-", "x", 1.0, [1]), ("x", "", float("nan"), [1]),
            ("x", "", None, [1]), ("x", "", 1e300, [1]), ("x", "", 1.0, None), ("x", "", 1.0, []), ("1:x", "", 1.0, [1])]
    prints = {tuple(RP.fingerprint(spark.createDataFrame([r], schema)).first()) for r in rows}
    assert len(prints) == len(rows)


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = spark.range(1000).select("id", (F.col("id") * 2).alias("v"))
    a = RP.fingerprint(df).first()
    assert a == RP.fingerprint(df.orderBy(F.desc("id")).repartition(7)).first()
    assert a != RP.fingerprint(df.withColumn("v", F.when(F.col("id") == 5, 0).otherwise(F.col("v")))).first()
    assert a != RP.fingerprint(df.union(df.limit(2)).union(df.limit(2))).first()


def test_report_is_one_document(spark):
    one = spark.createDataFrame([(3, 'say "hi": [x]')], "n int, t string")
    doc = json.loads(RP.run_report([RP.section("b", one), RP.section("a", one.drop("t"))]).first()[0])
    assert doc == {"a": {"n": 3}, "b": {"n": 3, "t": 'say "hi": [x]'}}


# registry


def test_promotion_cases(spark):
    df = spark.createDataFrame([(0.92, 0.89), (0.900, 0.895), (0.91, 0.89), (0.5, None)], "w double, p double")
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in R.promotion(F.col("w"), F.col("p")).items()]).collect()]
    assert got[0] == (0.03, True) and got[1] == (0.005, False) and got[3] == (0.5, True)
    assert got[2][1] == (0.91 - 0.89 >= 0.02)


def test_tie_goes_to_the_first_and_transition(spark):
    c = spark.createDataFrame([("XGBoost", 0.9, 0, "r1"), ("SVM", 0.9, 1, "r2")], "model string, f1_weighted double, priority int, run_id string")
    best = R.best_model(c)
    assert best.first()["model"] == "XGBoost"
    v = spark.createDataFrame([("m", 1, "r0", "Production", "old"), ("m", 2, "r1", "None", ""), ("m", 3, "r9", "Staging", "")],
                              "name string, version long, run_id string, stage string, description string")
    after = R.promote_versions(v, best.withColumn("name", F.lit("m")), note="new").orderBy("version")
    assert [(r["stage"], r["description"]) for r in after.collect()] == [("Archived", "old"), ("Production", "new"), ("Staging", "")]
    missing = spark.createDataFrame([("m", "r7")], "name string, run_id string")
    assert sorted(map(tuple, R.promote_versions(v, missing).select(*v.columns).collect())) == sorted(map(tuple, v.collect()))


def test_flattened_runs(spark):
    rows = spark.createDataFrame(
        [
            ("r1", "xgb_run", "FINISHED", 1, [("f1_weighted", 0.5), ("f1_weighted", 0.95)], [], []),
            ("r2", None, "FINISHED", 2, [("f1_weighted", 0.9)], [("model_type", "Unknown")], [("mlflow.runName", "my SVM")]),
            ("r3", "x", "FAILED", 3, [], [], []),
            ("r4", "x", "FINISHED", 4, [("accuracy", 0.7)], [("model_type", "Net")], [("stage", "Staging")]),
        ],
        "run_id string, run_name string, status string, start_time long, metrics array<struct<key string, value double>>, "
        "params array<struct<key string, value string>>, tags array<struct<key string, value string>>",
    )
    flat = R.flatten_runs(rows)
    got = {r["run_id"]: (r["run_name"], r["model_type"], r["stage"]) for r in flat.collect()}
    assert got == {"r1": ("xgb_run", "XGBoost", "Production"), "r2": ("my SVM", "SVM", "Archived"), "r4": ("x", "Net", "Staging")}
    table = R.compare_models(flat, ["XGBoost", "SVM", "Net"], {"F1": "f1_weighted", "Acc": "accuracy"}, F.col("start_time"))
    assert {r["metric"]: tuple(r)[1:] for r in table.collect()} == {"F1": (0.95, 0.9, 0.0), "Acc": (0.0, 0.0, 0.7)}


def test_retrain_reasons(spark):
    df = spark.createDataFrame([(True, 0.0, True, False), (False, 0.151, False, False), (False, 0.15, True, False),
                                (False, None, False, True)], "f boolean, d double, p boolean, c boolean")
    out = R.retrain_decision(df, F.col("f"), F.col("d"), F.col("p"), F.col("c")).collect()
    assert [r["reason"] for r in out] == ["forced", "drift_score=0.1510, no_production_model", "", "mlflow_check_failed"]
    assert [r["retrain"] for r in out] == [True, True, False, True]


def test_alert_batches(spark):
    df = spark.createDataFrame(
        [(1, [({"alertname": "DataDriftDetected"}, "resolved"), ({"alertname": "BackendDown"}, "firing"),
              ({"alertname": "HighErrorRate"}, "firing"), ({"alertname": "DataDriftDetected"}, "firing")]),
         (2, []), (3, [({"x": "y"}, "firing")])],
        "batch_id long, alerts array<struct<labels map<string,string>, status string>>",
    )
    got = {r["batch_id"]: tuple(r)[1:] for r in R.alert_triggers(df).collect()}
    assert got == {1: (4, "prometheus_alert:HighErrorRate", True), 2: (0, None, False), 3: (1, None, False)}


# sources


def test_manifest_lists_files_without_reading_them(spark, tmp_path):
    for label, names in {"drowsy": ["drowsy_v_f000003.jpg", "x.txt"], "alert": ["alert_w_f000001.JPG"]}.items():
        (tmp_path / label).mkdir()
        for n in names:
            (tmp_path / label / n).write_bytes(b"not an image")
    files = tables.list_files(spark, str(tmp_path), [".jpg"])
    got = {(r["label"], r["subject_id"], r["frame_id"], r["label_code"]) for r in tables.frame_manifest(files).collect()}
    assert got == {("drowsy", "v", 3, 1), ("alert", "w", 0, 0)}
    assert "content" not in files._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


def test_wide_landmark_file(spark, tmp_path):
    schema = wide_landmarks(2)
    row = ("p.jpg", 1, "s", 4, *[float(i) for i in range(6)])
    tables.write_table(spark.createDataFrame([row], schema), str(tmp_path / "lm"), "csv")
    assert tuple(tables.read_csv(spark, str(tmp_path / "lm"), schema).first()) == row


def test_missing_baseline_file_is_empty(spark, tmp_path):
    assert tables.read_baseline(spark, str(tmp_path / "none")).count() == 0
    df = spark.range(50).select(F.col("id").cast("double").alias("ear_mean"))
    tables.write_document(B.baseline_document(B.baseline(df), 30), str(tmp_path / "doc"))
    doc = json.loads(next((tmp_path / "doc").glob("part-*")).read_text())
    assert doc["window_size"] == 30 and doc["n_samples"] == 50 and len(doc["features"]["ear_mean"]["histogram_bins"]) == 21
    assert tables.read_baseline(spark, str(tmp_path / "doc")).first()["mean"] == 24.5


def test_runs_file(spark, tmp_path):
    (tmp_path / "runs.json").write_text('{"run_id":"r","run_name":"svm","metrics":[{"key":"f1_weighted","value":0.91}]}\n')
    flat = R.flatten_runs(tables.read_runs(spark, str(tmp_path / "runs.json"))).first()
    assert (flat["model_type"], flat["stage"]) == ("SVM", "Production")


# learning


@pytest.fixture(scope="module")
def rings(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 2))
    y = (np.hypot(x[:, 0], x[:, 1]) < 1.0).astype(int)
    return spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)], "ear_mean double, mar_max double, label int")


@pytest.mark.parametrize("train", [lambda d, f: L.train_boosted(d, f, trees=15, depth=4), lambda d, f: L.train_kernel(d, f, size=120)])
def test_both_learners_find_a_ring(spark, rings, train):
    model = train(rings, ["ear_mean", "mar_max"])
    scored = model.score(rings)
    s = E.classification_scores(E.confusion(scored)).first()
    assert s["f1_weighted"] > 0.9 and E.auc(scored, score="confidence").first()[0] > 0.95
    odd = model.score(spark.createDataFrame([(float("nan"), 0.0), (None, 0.0)], "ear_mean double, mar_max double"))
    assert [(r["confidence"], r["state"]) for r in odd.collect()] == [(0.0, "alert")] * 2
    if isinstance(model, L.BoostedTrees):
        rows = model.importance(spark).collect()
        assert math.isclose(sum(r["importance"] for r in rows), 1.0, abs_tol=1e-6)


def test_instant_values_and_silent_targets(spark):
    rng = random.Random(6)
    rows = [(rng.choice("ab"), rng.randrange(0, 2000), float(rng.randrange(3))) for _ in range(40)]
    rows = [r for r in rows if not 600 <= r[1] < 1300]
    df = spark.createDataFrame(rows, "job string, t long, up double").repartition(3)
    grid = M.evaluation_grid(spark, 7, 2100, 30)
    times = [r[0] for r in grid.collect()]
    assert times == list(range(30, 2101, 30))

    def latest(job, at, stale):
        seen = [(t, v) for j, t, v in rows if j == job and at - stale <= t <= at]
        return max(seen)[1] if seen else None

    for stale in (10, 100, 300):
        got = {(r["job"], r["eval_at"]): r["value"] for r in M.instant_values(df, ["job"], "t", "up", 30, stale).collect()}
        assert {k: v for k, v in got.items() if 30 <= k[1] <= 2100} == {
            (j, at): latest(j, at, stale) for j in "ab" for at in times if latest(j, at, stale) is not None
        }
        up = M.availability(df, ["a", "b", "never"], grid, "job", "t", "up", 30, stale).collect()
        assert {(r["job"], r["eval_at"]): r["value"] for r in up} == {
            (j, at): latest(j, at, stale) or 0.0 for j in ("a", "b", "never") for at in times
        }
    rule = [M.Rule("Down", "up", "==", 0.0, 60, "critical", {"job": "never"})]
    series = M.availability(df, ["never"], grid, "job", "t", "up", 30, 100).select(
        "eval_at", F.lit("up").alias("metric"), F.create_map(F.lit("job"), "job").alias("labels"), "value"
    )
    status = [r["status"] for r in M.apply_rules(series, rule, 30).orderBy("eval_at").collect()]
    assert status == ["pending"] * 2 + ["firing"] * (len(times) - 2)


def test_range_moments_by_hand(spark):
    rng = random.Random(7)
    rows = [("x", rng.randrange(1000), rng.random()) for _ in range(200)] + [("x", 5, None)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    got = {r["eval_at"]: r for r in M.range_moments(df, ["k"], "t", "v", 20, 100).collect()}
    for at, r in got.items():
        mine = [v for _, t, v in rows if v is not None and at - 100 < t <= at]
        mean = sum(mine) / len(mine)
        assert r["n"] == len(mine) and r["mean"] == pytest.approx(mean)
        assert r["variance"] == pytest.approx(sum((v - mean) ** 2 for v in mine) / len(mine), abs=1e-12)


@pytest.mark.parametrize("kind", ["trees", "kernel"])
def test_a_single_row_gets_the_score_of_the_table(spark, tmp_path, kind):
    df = spark.range(400).select(
        "id", (F.rand(1) * 4).alias("a"), F.rand(2).alias("b"), (F.col("id") % 2).cast("int").alias("label")
    ).withColumn("a", F.col("a") + F.col("label"))
    if kind == "trees":
        fitted = L.train_boosted(df, ["a", "b"], trees=4, depth=3)
        fitted.save(str(tmp_path / "m"))
        model = L.BoostedTrees.load(spark, str(tmp_path / "m"))
        assert model.features == ["a", "b"]
        again = {r["id"]: r["confidence"] for r in fitted.score(df).collect()}
        assert again == {r["id"]: r["confidence"] for r in model.score(df).collect()}
    else:
        model = L.train_kernel(df, ["a", "b"], size=32, iterations=20)
    rows = model.score(df).select("a", "b", "confidence").limit(50).collect()
    assert [model.one([r["a"], r["b"]]) for r in rows] == pytest.approx([r["confidence"] for r in rows], abs=1e-4)
    odd = df.limit(30).unionByName(df.limit(5).withColumn("a", F.lit(None).cast("double")))
    times = [r["ms"] for r in L.single_row_latency(model, odd, calls=100).collect()]
    assert len(times) == 30 and all(t > 0 for t in times)


def test_trees_grow_on_counted_bins(spark, monkeypatch):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 4, 9000), rng.integers(0, 3, 9000)
    rows = [(float(x), float(y), int(x * y >= 3)) for x, y in zip(a, b)]
    df = spark.createDataFrame([*rows, (None, 1.0, 1), (float("inf"), 1.0, 0)], "a double, b double, label int")
    seen = []
    fit = L.GBTClassifier.fit
    monkeypatch.setattr(L.GBTClassifier, "fit", lambda self, d: seen.append(d) or fit(self, d))
    model = L.train_boosted(df, ["a", "b"], trees=5, depth=3, weight=2.0)
    given = seen[0].agg(F.count("*"), F.sum("__weight")).first()
    assert given[0] <= 4 * 3 * L.PARTS < len(rows)
    assert given[1] == sum(2.0 if r[2] else 1.0 for r in rows)
    assert model.cuts == [[0.5, 1.5, 2.5], [0.5, 1.5]]
    wrong = model.score(df.filter("a < 5")).filter("prediction <> label").count()
    assert wrong == 0


def test_features_are_cut_at_quantiles_of_all_rows(spark):
    df = spark.range(0, 20000, 1, 5).select((F.col("id") * F.col("id")).cast("double").alias("a"), F.lit(7.0).alias("b"))
    a, b = L._cuts(df, ["a", "b"])
    assert b == [] and len(a) == L.BINS - 1
    assert [math.sqrt(x) / 20000 for x in a] == pytest.approx([i / L.BINS for i in range(1, L.BINS)], abs=0.002)


def test_hinge_loss_and_gradient_by_hand(spark):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(700, 2)) * [3.0, 0.1] + [100.0, 0.0], rng.integers(0, 2, 700).astype(float)
    df = spark.createDataFrame([(float(c), *map(float, v)) for c, v in zip(y, x)], "label double, v0 double, v1 double").repartition(3)
    lift = L.Lift(x.mean(axis=0), 1 / x.std(axis=0), rng.normal(size=(16, 2)), rng.uniform(0, 6, 16))
    at, weights = rng.normal(size=17), {0.0: 0.5, 1.0: 2.0}
    w = np.where(y == 1, 2.0, 0.5)
    value, gradient = L._hinge(df, lift, weights, w.sum(), 0.25)(at)
    waves = np.sqrt(2) * np.cos((x - lift.mean) * lift.factor @ lift.directions.T + lift.phases)
    short = 1 - (2 * y - 1) * (waves @ at[:-1] + at[-1])
    push = np.where(short > 0, w * (1 - 2 * y), 0)
    assert value == pytest.approx((w * np.maximum(short, 0)).sum() / w.sum() + 0.125 * (at[:-1] ** 2).sum(), rel=1e-5)
    assert gradient[:-1] == pytest.approx(push @ waves / w.sum() + 0.25 * at[:-1], abs=1e-5)
    assert gradient[-1] == pytest.approx(push.sum() / w.sum(), abs=1e-5)


def test_no_waves_of_training_rows_are_stored(spark, rings, monkeypatch):
    written, cached = [], []
    keep, descend = L.cut_lineage, L._descended
    monkeypatch.setattr(L, "cut_lineage", lambda d, name: written.append(len(d.columns)) or keep(d, name))

    def watched(loss, *given):
        def call(at):
            cached.append(len(spark.sparkContext._jsc.getPersistentRDDs()) - before)
            return loss(at)

        return descend(call, *given)

    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    monkeypatch.setattr(L, "_descended", watched)
    model = L.train_kernel(rings, ["ear_mean", "mar_max"], size=64, iterations=10)
    assert written == [3, 3] and len(cached) > 5 and max(cached) <= 0
    assert len(model.model[0].coefficients) == 64


def test_few_passes_of_a_kernel_machine_are_over_all_rows(spark, rings, monkeypatch):
    calls, losses = [], []
    hinge = L._hinge

    def watched(rows, *given):
        n, loss = rows.count(), hinge(rows, *given)

        def call(at):
            calls.append(n)
            losses.append(loss(at))
            return losses[-1]

        return call

    n = rings.count()
    monkeypatch.setattr(L, "_hinge", watched)
    L.train_kernel(rings, ["ear_mean", "mar_max"], size=32, iterations=40)
    assert set(calls) == {n}
    whole, passes = min(v for v, _ in losses), len(calls)
    calls.clear(), losses.clear()
    monkeypatch.setattr(L, "FIRST_ROWS", n // 20)
    L.train_kernel(rings, ["ear_mean", "mar_max"], size=32, iterations=40)
    assert calls == sorted(calls) and len(set(calls)) == 3 and calls[-1] == n
    assert calls.count(n) < passes
    assert min(v for (v, _), k in zip(losses, calls, strict=True) if k == n) <= 1.02 * whole


def test_waves_of_far_values_are_as_exact_as_of_near_ones():
    rng = np.random.default_rng(3)
    lift = L.Lift(np.zeros(2), np.ones(2), rng.normal(size=(16, 2)), rng.uniform(0, 6, 16))
    for scale in (1.0, 20.0, 1e6):
        x = rng.normal(size=(50, 2)) * scale
        exact = np.sqrt(2) * np.cos(x @ lift.directions.T + lift.phases)
        assert lift.waves(x) == pytest.approx(exact, abs=5e-5)
