"""Hot keys: split results must equal those of one window per key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wakeframe.plans.ordered import KeyedRows, top_rows
from wakeframe.plans.select_rank import quantiles, ranked_counts, running_counts

HALO = 4


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(900):
        key = None if i % 9 == 0 else ("hot" if i % 3 else f"k{i % 5}")
        data.append((key, rng.randrange(10**6), i, rng.choice([None, *map(float, range(50))])))
    return spark.createDataFrame(data, "k string, t long, id long, v double").repartition(5).cache()


def added(k: KeyedRows):
    k.frame(
        lambda w: {
            "s": F.sum("v").over(w.rowsBetween(-HALO, 0)),
            "before": F.lag("id", HALO).over(w),
        }
    ).position("pos")
    k.running(total=("sum", F.col("v")), top=("max", F.when(F.col("v") < 25, F.col("pos"))))
    k.running(upto=-1, past=("max", F.col("v")))
    return {r["id"]: tuple(r) for r in k.rows().select("id", "s", "before", "pos", "total", "top", "past").collect()}


@pytest.mark.parametrize("size", [5, 17, 60, 250])
@pytest.mark.parametrize("keys", [["k"], []])
def test_split_equals_plain(rows, keys, size):
    plain = KeyedRows(rows, keys, ["t", "id"], halo=HALO)
    split = KeyedRows(rows, keys, ["t", "id"], halo=HALO, rows_per_segment=size)
    assert plain.layout is None and split.layout is not None
    assert added(split) == added(plain)


def test_row_numbers_by_hand(spark):
    df = spark.range(100).select((F.col("id") * 7 % 100).alias("t"))
    got = KeyedRows(df, [], ["t"], rows_per_segment=9).position("pos").rows().collect()
    assert all(r["pos"] == r["t"] + 1 for r in got) and len(got) == 100


def test_segments_cover_every_row_and_hold_the_halo(rows):
    split = KeyedRows(rows, ["k"], ["t", "id"], halo=30, rows_per_segment=50)
    placed = split.df.collect()
    assert sum(not r["__is_halo"] for r in placed) == rows.count()
    by_segment = {}
    for r in placed:
        by_segment.setdefault((r["k"], r["__segment"]), []).append(r["__is_halo"])
    firsts = {(r["__k0"], r["__s"]): r["__first"] for r in split.layout.collect()}
    assert any(first for first in firsts.values())
    for place, halos in by_segment.items():
        assert sum(halos) == min(30, firsts[place])
        assert len(halos) - sum(halos) <= 200  # of one key, a few times the wanted size at most


def test_more_hot_keys_than_partitions(spark):
    df = spark.range(9000).select((F.col("id") % 900).alias("k"), "id")
    got = KeyedRows(df, ["k"], ["id"], halo=3, rows_per_segment=4)
    got = got.frame(lambda w: {"b": F.lag("id", 3).over(w)}).position("pos").running(upto=0, total=("sum", F.lit(1)))
    for r in got.rows().collect():
        place = r["id"] // 900
        assert (r["pos"], r["total"]) == (place + 1, place + 1)
        assert r["b"] == (r["id"] - 2700 if place >= 3 else None)


def test_small_segments_do_not_make_more_tasks(spark):
    df = spark.range(1200).select((F.col("id") % 3).alias("k"), F.floor(F.col("id") / 6).alias("t"), "id")
    split = KeyedRows(df, ["k"], ["t"], rows_per_segment=3)
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(split.df.select(*df.columns, "__segment").inputFiles()) <= 2 * spread  # rows and segments
    assert split.layout.count() > 10 * spread
    parts = split.df.groupBy("k", "t").agg(F.countDistinct("__segment").alias("n"))
    assert parts.filter("n > 1").isEmpty()  # equal rows stay together
    got = KeyedRows(df, ["k"], ["t", "id"], rows_per_segment=3).position("pos").rows()
    assert got.filter("pos <> floor(id / 3) + 1").isEmpty() and got.count() == 1200


def test_small_ranges_of_counts_do_not_make_more_tasks(spark):
    counts = spark.range(1000).select(F.lit("a").alias("g"), F.col("id").alias("v"), F.lit(2).cast("long").alias("__n"))
    got = ranked_counts(counts, ["g"], ["v"], 3)
    assert len(got.inputFiles()) <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert got.filter("__end <> 2 * (v + 1) or __total <> 2000").isEmpty() and got.count() == 1000


def test_timestamps_order_segments(spark):
    df = spark.range(300).select(
        F.timestamp_seconds(F.col("id") * 1800 + 1_711_800_000).alias("ts"), F.col("id")
    )  # spans a change of summer time
    got = KeyedRows(df, [], ["ts"], halo=2, rows_per_segment=20).frame(lambda w: {"b": F.lag("id", 2).over(w)})
    for r in got.rows().collect():
        assert r["b"] == (r["id"] - 2 if r["id"] >= 2 else None)


def test_derived_input_is_written_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def count(x):
        seen.add(1)
        return x

    df = spark.range(200).select(count("id").alias("id"))
    KeyedRows(df, [], ["id"], rows_per_segment=10, derived=True).position("pos").rows().collect()
    assert seen.value == 200


def test_top_rows(rows):
    got = top_rows(rows, ["k"], [F.col("t").desc(), F.col("id")], 3, "rank")
    want = rows.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("t"), "id"))).filter(
        "rank <= 3"
    )
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert "WindowGroupLimit" in got._jdf.queryExecution().toString()


def test_quantiles_with_a_frequent_value(spark):
    rng = random.Random(3)
    values = [5.0] * 400 + [rng.uniform(0, 10) for _ in range(600)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0)], "g string, v double").repartition(6)
    got = {r["g"]: r for r in quantiles(df, ["g"], "v", [0, 0.05, 0.5, 0.95, 1], rows_per_segment=40).collect()}
    ordered = sorted(values)
    for p, q in zip([0, 0.05, 0.5, 0.95, 1], got["a"]["q"]):
        h = p * 999
        low = int(h)
        high = min(low + 1, 999)
        assert abs(q - (ordered[low] + (h - low) * (ordered[high] - ordered[low]))) < 1e-9
    assert got["b"]["q"] == [1.0] * 5 and got["a"]["n"] == 1000


def test_running_counts(spark):
    df = spark.range(500).select(F.when(F.col("id") < 300, "x").alias("g"), (F.col("id") % 40).alias("v"))
    got = {(r["g"], r["v"]): (r["__n"], r["__end"], r["__total"]) for r in running_counts(df, ["g"], ["v"], 7).collect()}
    rows = [("x" if i < 300 else None, i % 40) for i in range(500)]
    for g, v in set(rows):
        same = [w for h, w in rows if h == g]
        assert got[g, v] == (same.count(v), sum(w <= v for w in same), len(same))


def test_many_groups_have_quantiles(spark):
    df = spark.range(60_000).select((F.col("id") % 12_000).alias("g"), F.floor(F.col("id") / 12_000).alias("v"))
    got = quantiles(df, ["g"], "v", [0.0, 0.5, 0.9, 1.0]).select("n", "q").distinct().collect()
    assert [(r["n"], [round(x, 9) for x in r["q"]]) for r in got] == [(5, [0.0, 2.0, 3.6, 4.0])]
