"""Sliding features, live windows, baselines and drift against plain Python."""

import math
import random
import statistics as st

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeframe.constants import FEATURES
from wakeframe.operators import baseline as B
from wakeframe.operators import drift as D
from wakeframe.operators import windows as W

SCHEMA = (
    "subject_id string, frame_id long, face boolean, ear double, mar double, head_pitch double, head_yaw double, "
    "head_roll double, label int"
)


def make(spark, n=200, subjects=("a", "b"), seed=1):
    rng = random.Random(seed)
    data = []
    for s in subjects:
        for i in range(n):
            data.append((s, i, rng.random() > 0.2, *[rng.random() for _ in range(5)], int(rng.random() > 0.5)))
    rng.shuffle(data)
    return spark.createDataFrame(data, SCHEMA).repartition(4), data


@pytest.mark.parametrize("size", [None, 25])
def test_sliding_features(spark, size):
    df, data = make(spark)
    got = {(r["subject_id"], r["frame_id"]): r for r in W.sliding_features(df, window=30, rows_per_segment=size).collect()}
    assert len(got) == len(data) - 2
    for s in "ab":
        rows = sorted(r for r in data if r[0] == s)
        for i in range(1, len(rows)):
            part = rows[max(0, i - 29) : i + 1]
            ear = [r[3] for r in part]
            want = [st.fmean(ear), min(ear), st.stdev(ear), sum(e < 0.25 for e in ear) / len(part),
                    st.fmean(r[4] for r in part), max(r[4] for r in part), *[st.fmean(r[k] for r in part) for k in (5, 6, 7)]]
            row = got[(s, i)]
            assert [row[f] for f in FEATURES] == pytest.approx(want, abs=1e-9)
            assert row["label"] == int(2 * sum(r[8] for r in part) >= len(part))


def test_label_tie_counts_as_one_and_one_row_per_subject_goes(spark):
    df = spark.createDataFrame(
        [("a", 0, True, 0.1, 0.1, 0.0, 0.0, 0.0, 0), ("a", 1, True, 0.2, 0.1, 0.0, 0.0, 0.0, 1), ("b", 5, True, *[0.0] * 5, 1)],
        SCHEMA,
    )
    rows = W.sliding_features(df, window=2).collect()
    assert [(r["subject_id"], r["frame_id"], r["label"]) for r in rows] == [("a", 1, 1)]


def live_reference(rows, window, every, repeat):
    slots, out = [], []

    def vector():
        valid = [r for r in slots if r[2]]
        if len(slots) < window or not valid:
            return None
        ear = np.array([r[3] for r in valid])
        closed = [r[2] and r[3] < 0.25 for r in slots]
        mar = [r[4] for r in valid]
        head = [ear.mean(), ear.min(), ear.std(), np.mean(closed), np.mean(mar), max(mar)]
        return head + [np.mean([r[k] for r in valid]) for k in (5, 6, 7)]

    for i, r in enumerate(rows, 1):
        if i % every:
            if repeat and vector() is not None:
                out.append((r[1], vector()))
            continue
        slots = (slots + [r])[-window:]
        if r[2] and vector() is not None:
            out.append((r[1], vector()))
    return out


@pytest.mark.parametrize("repeat, size", [(True, None), (False, None), (True, 20)])
def test_live_features(spark, repeat, size):
    df, data = make(spark, seed=4)
    got = W.live_features(
        df, ["subject_id"], ["frame_id"], window=4, every=3, repeat_skipped=repeat, rows_per_segment=size
    ).collect()
    for s in "ab":
        want = live_reference(sorted(r for r in data if r[0] == s), 4, 3, repeat)
        mine = sorted((r["frame_id"], [r[f] for f in FEATURES]) for r in got if r["subject_id"] == s)
        assert [i for i, _ in mine] == [i for i, _ in want]
        for (_, a), (_, b) in zip(mine, want):
            assert a == pytest.approx(b, abs=6e-5)


def test_circular_mean_crosses_the_seam(spark):
    df, _ = make(spark, 10, ("a",))
    df = df.withColumn("head_pitch", F.when(F.col("frame_id") % 2 == 0, 179.0).otherwise(-179.0))
    row = W.sliding_features(df, window=2, circular=True).first()
    assert abs(row["head_pitch_mean"]) == pytest.approx(180, abs=1e-9)
    assert W.sliding_features(df, window=2).first()["head_pitch_mean"] == pytest.approx(0, abs=1e-9)


@pytest.mark.parametrize("size", [None, 50])
def test_baseline_matches_numpy(spark, size):
    rng = np.random.default_rng(5)
    x = rng.normal(size=777).round(3)
    df = spark.createDataFrame([(float(v), None if i % 50 == 0 else float("nan") if i % 51 == 0 else 2.0) for i, v in enumerate(x)],
                               "ear_mean double, mar_max double")
    rows = {r["feature"]: r for r in B.baseline(df, rows_per_segment=size).collect()}
    assert set(rows) == {"ear_mean", "mar_max"}
    r = rows["ear_mean"]
    assert r["mean"] == pytest.approx(x.mean(), abs=1e-6) and r["std"] == pytest.approx(x.std(ddof=1), abs=1e-6)
    for p in (5, 25, 50, 75, 95):
        assert r[f"p{p}"] == pytest.approx(np.percentile(x, p), abs=1e-6)
    density, edges = np.histogram(x, bins=20, density=True)
    assert r["histogram_density"] == pytest.approx(density.tolist(), abs=1e-6)
    assert r["histogram_bins"] == pytest.approx(edges.tolist(), abs=1e-6)
    flat = rows["mar_max"]
    density, edges = np.histogram([2.0] * 10, bins=20, density=True)
    assert flat["n"] < 777 and flat["histogram_density"] == pytest.approx(density.tolist(), abs=1e-6)
    assert flat["histogram_bins"] == pytest.approx(edges.tolist(), abs=1e-6)


def test_histogram_integrates_to_one(spark):
    df = spark.range(1000).select((F.sin("id") * 3).alias("ear_mean"))
    r = B.baseline(df, places=12).first()
    width = r["histogram_bins"][1] - r["histogram_bins"][0]
    assert sum(r["histogram_density"]) * width == pytest.approx(1, abs=1e-9)


def base(spark, mean=0.3, variance=0.01):
    return spark.createDataFrame([("ear_mean", mean, variance)], "feature string, mean double, variance double")


def test_kl_by_hand(spark):
    k = spark.range(1).select(
        D.gaussian_kl(F.lit(0.0), F.lit(1.0), F.lit(0.0), F.lit(1.0)).alias("same"),
        D.gaussian_kl(F.lit(0.0), F.lit(4.0), F.lit(0.0), F.lit(1.0)).alias("wide"),
    ).first()
    assert k["same"] == pytest.approx(0, abs=1e-12)
    assert k["wide"] == pytest.approx(math.log(0.5) + 2 - 0.5, abs=1e-6) == pytest.approx(0.806853, abs=1e-6)


@pytest.mark.parametrize("n, scored", [(29, False), (30, True)])
def test_thirty_values_are_needed(spark, n, scored):
    live = spark.range(n).select((F.col("id") * 0.01 + 5).alias("ear_mean"))
    row = D.drift_scores(live, base(spark)).first()
    assert row["n"] == n and (row["score"] > 0) == scored


def test_missing_values_and_missing_baseline(spark):
    live = spark.range(60).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("double"))
        .when(F.col("id") % 3 == 1, F.lit(float("inf")))
        .otherwise(F.col("id") * 1.0)
        .alias("ear_mean"),
        F.lit(1.0).alias("mar_max"),
    )
    got = {r["feature"]: r for r in D.drift_scores(live, base(spark), least=10).collect()}
    assert got["ear_mean"]["n"] == 20 and got["ear_mean"]["score"] > 0
    assert got["mar_max"]["score"] == 0.0
    assert D.drift_scores(live, base(spark).limit(0)).count() == 0


@pytest.mark.parametrize("size", [None, 30])
def test_buffered_drift(spark, size):
    rng = random.Random(9)
    data = [("s", i, None if rng.random() < 0.3 else rng.gauss(0.3, 0.1)) for i in range(260)]
    data += [("t", i, None) for i in range(45)]
    df = spark.createDataFrame(data, "k string, t long, ear_mean double").repartition(3)
    got = D.buffered_drift(df, base(spark), ["k"], ["t"], buffer=50, every=20, least=10, rows_per_segment=size)
    rows = {(r["k"], r["seq"]): r for r in got.collect()}
    assert len(rows) == 13 + 2
    for seq in range(20, 261, 20):
        held = [v for _, _, v in data[:seq] if v is not None][-50:]
        assert rows[("s", seq)]["n"] == len(held)
        m, v = np.mean(held), np.var(held) + 1e-9
        kl = math.log(math.sqrt(0.01 + 1e-9) / math.sqrt(v)) + (v + (m - 0.3) ** 2) / (2 * (0.01 + 1e-9)) - 0.5
        assert rows[("s", seq)]["score"] == pytest.approx(max(0, kl) if len(held) >= 10 else 0, abs=2e-6)
    assert rows[("t", 40)]["n"] == 0 and rows[("t", 40)]["score"] == 0.0


def test_ranking_of_scores(spark):
    scores = spark.createDataFrame([("ear_mean", 0.2), ("head_pitch_mean", 0.5), ("perclos", 0.5), ("mar_max", 0.1)],
                                   "feature string, score double")
    assert [r["feature"] for r in D.ranked_drift(scores).collect()] == ["perclos", "pitch", "ear", "mar_max"]
    assert [r["feature"] for r in D.top_drifted(scores, n=2).orderBy("rank").collect()] == ["head_pitch_mean", "perclos"]
    row = D.overall_drift(scores).first()
    assert row["overall"] == 0.5 and row["drifting"]
