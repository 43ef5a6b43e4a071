"""Shape of the physical plans: shuffles, pruning, partial limits."""

import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wakeframe.operators import baseline as B
from wakeframe.operators import state as ST
from wakeframe.operators import windows as W
from wakeframe.operators.quality import TABLE_CHECKS, run_checks
from wakeframe.session import ARROW_BYTES, BATCH_BYTES, Stages


@pytest.fixture(scope="module")
def frames(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("frames") / "t")
    names = ["ear", "mar", "head_pitch", "head_yaw", "head_roll"]
    spark.range(2000).select(
        (F.col("id") % 7).alias("subject_id"),
        F.col("id").alias("frame_id"),
        (F.col("id") % 3 == 0).alias("face"),
        *[F.rand(i).alias(n) for i, n in enumerate(names)],
        (F.col("id") % 2).cast("int").alias("label"),
        F.lit("unused").alias("note"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"\bExchange (hash|range|Single|Round)", plan(df)))


def test_sliding_features_shuffle_once_and_read_what_they_need(frames):
    df = W.sliding_features(frames)
    assert shuffles(df) == 1 and plan(df).count("Sort [") == 1
    assert "note" not in plan(df) and "face" not in plan(df)


def test_live_features_shuffle_once(frames):
    assert shuffles(W.live_features(frames, ["subject_id"], ["frame_id"])) == 1


def test_debounce_shuffles_and_sorts_once(frames):
    df = ST.debounce(frames.select("subject_id", "frame_id", F.col("face").alias("hit")), ["subject_id"], ["frame_id"])
    assert shuffles(df) == 1 and plan(df).count("Sort [") == 1


def test_split_searches_no_cuts(frames):
    df = W.sliding_features(frames, rows_per_segment=100)
    text = plan(df)
    assert "NestedLoop" not in text and "aggregate(" not in text and "__cuts" not in text
    assert "__segment" in text


def test_statistics_are_one_aggregation(frames):
    df = B.summary_stats(frames, ["ear", "mar"])
    assert shuffles(df) == 1 and "Expand" not in plan(df) and "head_yaw" not in plan(df)


def test_checks_share_one_scan(frames):
    assert plan(run_checks(frames, TABLE_CHECKS, ["ear", "mar"])).count("FileScan") == 1


def test_filters_and_columns_reach_the_scan(frames):
    text = plan(frames.select("subject_id", "ear").filter("ear > 0.5"))
    assert "PushedFilters: [IsNotNull(ear), GreaterThan(ear,0.5)]" in text
    assert "ReadSchema: struct<subject_id:bigint,ear:double>" in text


def test_latest_rows_limit_before_the_shuffle(frames):
    text = plan(W.latest_rows(frames.select("subject_id", "frame_id"), ["subject_id"], ["frame_id"], 5))
    assert text.count("WindowGroupLimit") == 2


def _batch_bytes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])


def test_python_gets_few_bytes_at_a_time_whatever_the_rows(spark):
    rows = spark.range(4000, numPartitions=1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    before = spark.conf.get(ARROW_BYTES)
    kept = Stages(spark).keep(rows.mapInArrow(_batch_bytes, "rows long, bytes long")).collect()
    assert sum(x["rows"] for x in kept) == 4000
    assert max(x["bytes"] for x in kept) < 2 * BATCH_BYTES  # 40 MB in one batch otherwise
    assert spark.conf.get(ARROW_BYTES) == before
