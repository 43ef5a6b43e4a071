"""Debounced state in batch and stream, under any cut into batches."""

import random
from unittest.mock import MagicMock

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wakeframe.operators import sessions as N
from wakeframe.operators import state as ST
from wakeframe.operators import windows as W
from wakeframe.operators import drift as D
from wakeframe.constants import FEATURES
from wakeframe.sources import messages
from wakeframe.streaming import live


def loop(hits, up, down):
    state, h, m, out = "alert", 0, 0, []
    for x in hits:
        h, m = (h + 1, 0) if x else (0, m + 1)
        new = False
        if h >= up and state != "drowsy":
            state, new = "drowsy", True
        elif m >= down and state != "alert":
            state = "alert"
        out.append((state, new))
    return out


def run(spark, hits, size=None, **limits):
    df = spark.createDataFrame([("s", i, bool(x)) for i, x in enumerate(hits)], "k string, t long, hit boolean")
    rows = ST.debounce(df.repartition(3), ["k"], ["t"], rows_per_segment=size, **limits).orderBy("t").collect()
    return [(r["state"], r["new_alert"]) for r in rows]


def test_limits_by_hand(spark):
    got = run(spark, [1] * 14 + [0] + [1] * 15 + [0] * 9 + [1] + [0] * 10)
    assert got[13] == ("alert", False)
    assert got[28] == ("alert", False) and got[29] == ("drowsy", True)
    assert got[38] == ("drowsy", False) and got[48] == ("drowsy", False) and got[49] == ("alert", False)
    assert sum(new for _, new in got) == 1


@pytest.mark.parametrize("size", [None, 11, 40])
def test_random_sequences(spark, size):
    rng = random.Random(size or 0)
    hits, x = [], 0
    for _ in range(400):
        x = x if rng.random() < 0.75 else 1 - x
        hits.append(x)
    assert run(spark, hits, size, to_drowsy=4, to_alert=3) == loop(hits, 4, 3)


def test_hits_need_state_and_confidence(spark):
    df = spark.createDataFrame([("drowsy", 0.7), ("drowsy", 0.69), ("alert", 0.9), (None, None)], "s string, c double")
    assert [r[0] for r in df.select(ST.is_hit(F.col("s"), F.col("c"))).collect()] == [True, False, False, False]


def test_session_summary_open_and_closed(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        ('a', TIMESTAMP '2024-01-01 00:00:00', 'open', null, null, false),
        ('a', TIMESTAMP '2024-01-01 00:00:01', 'frame', 0.3D, 0.9D, true),
        ('a', TIMESTAMP '2024-01-01 00:00:02.5', 'close', null, null, false),
        ('b', TIMESTAMP '2024-01-01 00:00:05', 'open', null, null, false)
        AS t(session_id, ts, kind, ear, confidence, new_alert)"""
    )
    rows = {r["session_id"]: r for r in N.session_summary(df, now=F.lit("2024-01-01 00:00:10").cast("timestamp")).collect()}
    a, b = rows["a"], rows["b"]
    assert (a["duration_seconds"], a["frames"], a["alerts"], a["average_ear"], a["status"]) == (2.5, 1, 1, 0.3, "completed")
    assert (b["duration_seconds"], b["frames"], b["average_ear"], b["status"]) == (5.0, 0, None, "active")
    assert [r[0] for r in N.open_sessions(df).collect()] == ["b"]
    assert [r["active"] for r in N.activity(df).orderBy("ts").collect()] == [1, 0, 1]


SECOND = 1_000_000


def spans_of(rows, timeout):
    """Plain loop over (session, us, id, kind, ear, confidence, new_alert): ended spans and open ones."""
    ended, open_ = [], {}
    place = {}

    def end(key, at, how):
        s = open_.pop(key)
        mean = [round(sum(v) / len(v), 4) if v else None for v in (s["ear"], s["conf"])]
        ended.append((key, s["start"], at, round((at - s["start"]) / SECOND, 2), s["frames"], s["alerts"], *mean, how))

    for key, us, _, kind, ear, conf, alert in sorted(rows, key=lambda r: (r[1], r[2])):
        if key in open_ and us - place[key] > timeout * SECOND:
            end(key, place[key], "timeout")
        place[key] = us
        if key not in open_ and kind == "init":
            open_[key] = {"start": us, "frames": 0, "alerts": 0, "ear": [], "conf": []}
        if key in open_ and kind == "frame":
            s = open_[key]
            s["frames"] += 1
            s["alerts"] += bool(alert)
            s["ear"] += [ear] if ear is not None else []
            s["conf"] += [conf] if conf is not None else []
        if key in open_ and kind == "close":
            end(key, us, "close")
    return ended, {k: place[k] for k in open_}


def random_messages(seed, n=240):
    rng = random.Random(seed)
    t, rows = 1_700_000_000, []
    for i in range(n):
        t += rng.choice([1, 1, 2, 3, 400])
        kind = rng.choice(["init", "frame", "frame", "frame", "frame", "close", "ping"])
        rows.append((rng.choice("ab"), t * SECOND, i, kind, rng.choice([None, rng.random()]), rng.random(), rng.random() < 0.3))
    return rows


MESSAGE_ROW = "session_id string, us long, frame_id long, kind string, ear double, confidence double, new_alert boolean"


@pytest.mark.parametrize("size", [None, 7])
def test_span_summary_equals_a_loop(spark, size):
    rows = random_messages(3)
    ended, left = spans_of(rows, 600)
    now = max(r[1] for r in rows) + 100 * SECOND
    df = spark.createDataFrame(rows, MESSAGE_ROW).repartition(4)
    got = N.span_summary(df, timeout_seconds=600, now_us=now, rows_per_segment=size).collect()
    silent = {k for k, at in left.items() if now - at > 600 * SECOND}
    assert sorted(tuple(r) for r in got if r["ended_by"] != "active" and not (r["session_id"] in silent and r["ended_us"] == left[r["session_id"]])) == sorted(ended)
    assert {r["session_id"] for r in got if r["ended_by"] == "active"} == set(left) - silent


@pytest.fixture(scope="module")
def live_rows():
    rng = random.Random(11)
    data = []
    for s in ("a", "b", "c"):
        x = 0
        for i in range(240):
            x = x if rng.random() < 0.8 else 1 - x
            data.append((s, 1_700_000_000_000_000 + i * 1000 + ord(s), i, rng.random() > 0.2, *[rng.random() for _ in range(5)], bool(x)))
    return pd.DataFrame(data, columns=[*live.LIVE_INPUT, "hit"])


def in_batches(spark, rows, folder, cuts):
    """Write the rows as one file per batch and read them as a stream."""
    live.use_rocksdb(spark)
    rows = rows.sort_values(["us", "frame_id"]).reset_index(drop=True)
    bounds = [0, *cuts, len(rows)]
    for n, (a, b) in enumerate(zip(bounds, bounds[1:])):
        part = rows.iloc[a:b].sample(frac=1, random_state=n)
        part.to_parquet(folder / f"part-{n:03d}.parquet", index=False)
        # files are taken in the order of their times
        import os

        os.utime(folder / f"part-{n:03d}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))
    schema = spark.read.parquet(str(folder)).schema
    return live.read_files(spark, str(folder), schema, files_per_batch=1)


@pytest.mark.parametrize("cuts", [[], [100, 101, 350], list(range(60, 720, 60))])
def test_stream_equals_batch(spark, live_rows, tmp_path, cuts):
    stream = in_batches(spark, live_rows, tmp_path, cuts)
    batch = spark.createDataFrame(live_rows)

    got = live.run_to_table(live.debounced_state(stream, 4, 3), "t").select("session_id", "frame_id", "state", "new_alert")
    want = ST.debounce(batch, ["session_id"], ["us", "frame_id"], to_drowsy=4, to_alert=3)
    assert sorted(map(tuple, got.collect())) == sorted(
        map(tuple, want.select("session_id", "frame_id", "state", "new_alert").collect())
    )

    got = live.run_to_table(live.live_features(stream, window=5, every=3), "t").select("session_id", "frame_id", *FEATURES)
    want = W.live_features(batch, ["session_id"], ["us", "frame_id"], window=5, every=3)
    assert sorted(map(tuple, got.collect())) == sorted(
        map(tuple, want.select("session_id", "frame_id", *FEATURES).collect())
    )

    base = {"ear": (0.5, 0.08), "mar": (0.4, 0.02)}
    table = spark.createDataFrame([(k, *v) for k, v in base.items()], "feature string, mean double, variance double")
    got = live.run_to_table(live.live_drift(stream, base, ["ear", "mar"], buffer=40, every=25), "t")
    want = D.buffered_drift(batch, table, ["session_id"], ["us", "frame_id"], ["ear", "mar"], buffer=40, every=25)
    a, b = (sorted(map(tuple, x.select("session_id", "seq", "feature", "n", "score").collect())) for x in (got, want))
    assert a == b


def test_late_and_repeated_rows_are_ignored(spark, live_rows, tmp_path):
    rows = live_rows[live_rows["session_id"] == "a"].sort_values("us")
    again = pd.concat([rows.iloc[:100], rows.iloc[40:160], rows.iloc[10:20], rows.iloc[160:]])
    for n, (a, b) in enumerate([(0, 100), (100, 220), (220, 230), (230, len(again))]):
        import os

        path = tmp_path / f"p{n}.parquet"
        again.iloc[a:b].to_parquet(path, index=False)
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    schema = spark.read.parquet(str(tmp_path)).schema
    live.use_rocksdb(spark)
    out = live.run_to_table(live.debounced_state(live.read_files(spark, str(tmp_path), schema, files_per_batch=1)), "t")
    assert sorted(r["frame_id"] for r in out.collect()) == list(range(240))


def stream_of(spark, batches, folder, schema):
    """One file per batch, in order."""
    import os

    live.use_rocksdb(spark)
    for n, rows in enumerate(batches):
        path = folder / f"batch-{n:03d}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(path))
        for file in path.glob("*.parquet"):
            file.rename(folder / f"{n:03d}.parquet")
        os.utime(folder / f"{n:03d}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))
    return live.read_files(spark, str(folder), schema, glob="*.parquet", files_per_batch=1)


def ending(us):
    return [("~", us, 0, "tick", None, None, None)]


@pytest.mark.parametrize("parts", [1, 3, 12])
def test_lifecycle_equals_a_loop_under_any_cut(spark, tmp_path, parts):
    rows = random_messages(8)
    ended, left = spans_of(rows, 600)
    far = max(r[1] for r in rows) + 10**6 * SECOND
    step = -(-len(rows) // parts)
    batches = [rows[i : i + step] for i in range(0, len(rows), step)]
    # what came is sent once more with the next batch
    batches = [b + (batches[i - 1] if i else []) for i, b in enumerate(batches)] + [ending(far)]
    out = live.session_lifecycle(stream_of(spark, batches, tmp_path, MESSAGE_ROW), 600, "1 hour")
    table, said = live.run_counted(out, "t")
    want = ended + [r for r in closing(rows, left)]
    assert sorted(map(tuple, table.collect())) == sorted(want)
    assert said["state_rows"] == 0 and said["batches"] == len(batches)


def closing(rows, left):
    """The spans still open, ended by silence."""
    last = max(r[1] for r in rows)
    more = [(k, last + 5 * 10**5 * SECOND, 10**6, "frame", None, None, False) for k in left]
    return [r for r in spans_of(rows + more, 600)[0] if (r[0], r[2]) in {(k, at) for k, at in left.items()}]


def test_messages_repeated_after_a_close_change_nothing(spark, tmp_path):
    t0 = 1_700_000_000
    once = [("a", (t0 + i) * SECOND, i, k, 0.25 * i, 0.5, i == 1) for i, k in enumerate(["init", "frame", "frame", "frame", "close"])]
    again = [("a", (t0 + 20 + i) * SECOND, 20 + i, k, 0.5, None, False) for i, k in enumerate(["frame", "init", "frame", "close"])]
    far = [ending((t0 + k * 10**6) * SECOND) for k in (1, 2, 3)]
    # first the place left behind keeps them out, once the watermark has passed it Spark drops them
    batches = [once, once, once[2:] + again, once + again, far[0], once, far[1], once, far[2]]
    out = live.session_lifecycle(stream_of(spark, batches, tmp_path, MESSAGE_ROW), 600, "1 minute")
    table, said = live.run_counted(out, "t")
    rows = sorted(map(tuple, table.collect()))
    assert rows == sorted(spans_of(once + again, 600)[0]) and [r[4:6] for r in rows] == [(3, 1), (1, 0)]
    assert said["dropped_late"] == len(once) and said["state_rows"] == 0


def test_sessions_that_fall_silent(spark, tmp_path):
    t0 = 1_700_000_000

    def m(session, t, i, kind):
        return (session, (t0 + t) * SECOND, i, kind, 0.25 * i, 0.5, i == 1)

    batches = [
        [m("a", 0, 0, "init"), m("a", 1, 1, "frame"), m("x", 1, 0, "frame"), m("b", 2, 0, "init")],
        [m("a", 3, 2, "frame"), m("a", 4, 3, "close"), m("b", 5, 1, "frame")],
        [m("c", 5000, 0, "init")],
        [m("c", 5001, 1, "frame")],
    ]
    out = live.session_lifecycle(stream_of(spark, batches, tmp_path, MESSAGE_ROW), 600, "1 minute")
    table, said = live.run_counted(out, "t")
    rows = {r["session_id"]: r for r in table.collect()}
    assert set(rows) == {"a", "b"} and said["state_rows"] == 1  # c is still open
    assert (rows["a"]["frames"], rows["a"]["alerts"], rows["a"]["ended_by"], rows["a"]["duration_seconds"]) == (2, 1, "close", 4.0)
    assert rows["a"]["average_ear"] == pytest.approx(0.375)
    assert (rows["b"]["frames"], rows["b"]["ended_by"], rows["b"]["duration_seconds"]) == (1, "timeout", 3.0)


def test_state_store_is_empty_in_the_end(spark, tmp_path):
    """The state itself, read by Spark's own reader, and not what the run says of it."""
    from wakeframe.session import fresh_path

    rows = [(f"s{i % 40}", 1_700_000_000 * SECOND + i, i, "frame" if i >= 40 else "init", i % 3 == 0) for i in range(400)]
    schema = "session_id string, us long, frame_id long, kind string, hit boolean"
    batches = [rows[:150], rows[150:], [("~", 1_800_000_000 * SECOND, 0, "tick", None)]]
    stream = live.debounced_state(stream_of(spark, batches[:2], tmp_path, schema), 3, 2)
    place = fresh_path(spark, "state")

    def run(stream):
        query = stream.writeStream.format("noop").option("checkpointLocation", place).trigger(availableNow=True).start()
        query.awaitTermination()
        return spark.read.format("statestore").load(place).count()

    assert run(stream) == 40
    spark.createDataFrame(batches[2], schema).coalesce(1).write.parquet(str(tmp_path / "end"))
    for file in (tmp_path / "end").glob("*.parquet"):
        file.rename(tmp_path / "zzz.parquet")
    assert run(stream) == 0


def test_late_rows_are_told_apart(spark, tmp_path):
    t0 = 1_700_000_000

    def m(session, t):
        return (session, (t0 + t) * SECOND, t)

    batches = [
        [m("a", 0), m("a", 10), m("b", 5)],
        [m("a", 4), m("a", 10), m("a", 12), m("b", 6)],  # 4 is late, 10 repeated
        [m("a", 5000), m("b", 5)],
        [m("a", 11), m("c", 5001)],  # the watermark that counts is still the one of the batch before
        [m("a", 13), m("b", 7), m("c", 6000)],  # far behind it: dropped
    ]
    stream = stream_of(spark, batches, tmp_path, "session_id string, us long, frame_id long")
    table, said = live.run_counted(live.in_arrival_order(stream, "1 minute"), "t")
    got = sorted((r["session_id"], r["frame_id"], r["late"]) for r in table.collect())
    kept = [("a", 0, False), ("a", 4, True), ("a", 10, False), ("a", 11, True), ("a", 12, False), ("a", 5000, False)]
    assert got == kept + [("b", 5, False), ("b", 6, False), ("c", 5001, False), ("c", 6000, False)]
    assert said["dropped_late"] == 2 and said["batches"] == 5


def test_window_size_comes_with_the_session(spark, tmp_path):
    rng = random.Random(2)
    rows, t = [], 1_700_000_000 * SECOND
    for s, size in (("a", 2), ("b", None), ("c", 0)):
        rows.append((s, t, 0, "init", size, None, *[None] * 5))
        rows += [(s, t + i, i, "frame", None, i % 4 != 0, *[rng.random() for _ in range(5)]) for i in range(1, 30)]
    schema = "session_id string, us long, frame_id long, kind string, window_size int, face boolean, " + ", ".join(
        f"{c} double" for c in live.SLOT[1:]
    )
    stream = stream_of(spark, [rows[:40], rows[40:]], tmp_path, schema)
    got = live.run_to_table(live.live_features(stream, window=5, every=1, buffering=True), "t").collect()
    batch = spark.createDataFrame([r for r in rows if r[3] == "frame"], schema)
    for s, size in (("a", 2), ("b", 5), ("c", 5)):
        want = W.live_features(batch.filter(F.col("session_id") == s), ["session_id"], ["us", "frame_id"], window=size, every=1)
        want = {r["frame_id"]: tuple(r[f] for f in FEATURES) for r in want.collect()}
        mine = [r for r in got if r["session_id"] == s]
        assert {r["frame_id"]: tuple(r[f] for f in FEATURES) for r in mine if r["ready"]} == want
        assert sorted(r["frame_id"] for r in mine) == list(range(1, 30))
        assert all(r["ear_mean"] is None for r in mine if not r["ready"])


def test_orphans_of_a_stream_equal_batch(spark, tmp_path):
    rng = random.Random(4)
    t0 = 1_700_000_000
    rows = [(rng.choice("abc"), (t0 + 50 * i + rng.randrange(40)) * SECOND, i, rng.choice(["init", "frame", "frame", "close"])) for i in range(150)]
    want = [r[2] for r in rows if r[3] == "frame" and not any(
        o[3] == "init" and o[0] == r[0] and 0 <= r[1] - o[1] <= 200 * SECOND for o in rows)]
    schema = "session_id string, us long, frame_id long, kind string"
    batches = [rows[i : i + 50] for i in (0, 50, 100)] + [[(None, (t0 + 10**6) * SECOND, 0, "tick"), ("a", (t0 + 10**6) * SECOND, 0, "tick")]]
    out = live.orphan_frames(stream_of(spark, batches, tmp_path, schema), 200, "1 hour")
    assert sorted(r["frame_id"] for r in live.run_to_table(out, "t").collect()) == want


def test_messages_in_text_files_go_to_three_tables(spark, tmp_path):
    import os

    lines = [
        ['{"type":"init","session_id":"s","window_size":"7"}', "{oops", '{"type":"frame","session_id":"s","frame_id":1}'],
        ['{"type":"zoom"}', "", '{"type":"close","session_id":"s"}', '[1, 2]'],
        ['{"type":"frame","session_id":"s","frame_id":"2"}'],
    ]
    for n, part in enumerate(lines):
        (tmp_path / f"{n}.txt").write_text("\n".join(part) + "\n")
        os.utime(tmp_path / f"{n}.txt", (1_700_000_000 + n, 1_700_000_000 + n))
    parsed = messages.parse_messages(live.read_lines(spark, str(tmp_path), files_per_batch=1))
    got = live.run_to_sinks(parsed, messages.sinks(), "t")
    assert sorted((r["frame_id"], r["batch"]) for r in got["frames"].collect()) == [(1, 0), (2, 2)]
    assert sorted((r["route"], r["window_size"], r["batch"]) for r in got["sessions"].collect()) == [("close", None, 1), ("init", 7, 0)]
    errors = sorted((r["line"], r["message"], r["batch"]) for r in got["errors"].collect())
    assert [e[:2] for e in errors if e[0]] == [
        ("[1, 2]", "Invalid JSON message"), ('{"type":"zoom"}', "Unknown message type: zoom"), ("{oops", "Invalid JSON message"),
    ]


def test_a_batch_repeated_after_a_failure_is_written_once(spark, tmp_path):
    from wakeframe.session import fresh_path

    (tmp_path / "0.txt").write_text("".join(f'{{"type":"frame","session_id":"s","frame_id":{i}}}\n' for i in range(9)))
    place, calls = fresh_path(spark, "sinks"), []

    def fails_once(rows):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("executor lost")
        return rows.select("frame_id")

    sinks = {"frames": lambda rows: rows.select("frame_id"), "again": fails_once}

    def run():
        parsed = messages.parse_messages(live.read_lines(spark, str(tmp_path)))
        return live.run_to_sinks(parsed, sinks, "t", place)

    with pytest.raises(Exception, match="executor lost"):
        run()
    for _ in range(2):  # the second run finds nothing new
        got = run()
        assert all(sorted(r["frame_id"] for r in got[s].collect()) == list(range(9)) for s in sinks)


def test_metric_windows_in_two_steps(spark, tmp_path):
    rng = random.Random(9)
    t0 = 1_700_000_000
    rows = [((t0 + rng.randrange(3000)) * SECOND, rng.random() * 40, rng.random() < 0.2) for _ in range(500)]
    rows.sort()
    schema = "us long, value double, failed boolean"
    stream = stream_of(spark, [rows[:200], rows[200:], [((t0 + 10**6) * SECOND, None, False)]], tmp_path, schema)
    events = stream.withColumn("ts", F.timestamp_micros("us"))
    out = live.metric_windows(events, "value", [10, 20, 30], "10 minutes", "1 minute", "1 minute", error="failed", quantiles=(0.5, 0.95))
    got = {r["start"].timestamp(): r for r in live.run_to_table(out, "t").withColumn("start", F.col("start")).collect()}
    starts = {t // SECOND // 60 * 60 - 60 * k for t, _, _ in rows for k in range(10)}
    assert set(got) == set(map(float, starts))
    for start, r in got.items():
        mine = [(v, f) for t, v, f in rows if start <= t / SECOND < start + 600]
        assert (r["requests"], r["errors"], r["le_0"], r["le_3"]) == (len(mine), sum(f for _, f in mine), sum(v <= 10 for v, _ in mine), len(mine))
        assert r["total_sum"] == pytest.approx(sum(v for v, _ in mine))
        assert r["request_rate"] == pytest.approx(len(mine) / 600) and r["error_rate"] == pytest.approx(r["errors"] / 600)
        assert r["error_ratio"] == pytest.approx(r["error_rate"] / (r["request_rate"] + 0.001))


def test_messages(spark):
    raw = spark.createDataFrame(
        [('{"type":"init","session_id":"s"}',), ('{"type":"frame","frame_id":3}',), ("{oops",), ('{"type":"zoom"}',), ("{}",)],
        "value string",
    )
    routed = messages.parse_messages(raw)
    assert [r["route"] for r in routed.collect()] == ["init", "frame", "invalid", "unknown", "unknown"]
    assert [r["message"] for r in messages.errors(routed).collect()] == [
        "Invalid JSON message", "Unknown message type: zoom", "Unknown message type: null",
    ]


@pytest.mark.parametrize("cuts", [[], [7, 8, 31], list(range(5, 60, 5))])
def test_frames_without_init(spark, tmp_path, cuts):
    rng = random.Random(5)
    kinds = [rng.choice(["init", "close", "frame", "frame", "frame"]) for _ in range(60)]
    rows = pd.DataFrame(
        [("s" if i % 3 else "t", 1_700_000_000_000_000 + i, i, k) for i, k in enumerate(kinds)],
        columns=["session_id", "us", "frame_id", "kind"],
    )
    want, is_open = [], {}
    for r in rows.itertuples():
        if r.kind == "frame" and not is_open.get(r.session_id, False):
            want.append(r.frame_id)
        is_open[r.session_id] = {"init": True, "close": False}.get(r.kind, is_open.get(r.session_id, False))
    stream = in_batches(spark, rows, tmp_path, cuts)
    got = live.run_to_table(live.frames_without_init(stream), "t")
    assert sorted(r["frame_id"] for r in got.collect()) == want
    batch = N.frames_without_init(spark.createDataFrame(rows), order=["us", "frame_id"])
    assert sorted(r["frame_id"] for r in batch.collect()) == want


def test_stream_scores_equal_batch_scores(spark, live_rows, tmp_path):
    from wakeframe.operators import learn as L

    batch = spark.createDataFrame(live_rows).withColumn("label", F.col("hit").cast("int"))
    model = L.train_boosted(batch, ["ear", "mar"], trees=3, depth=3)
    stream = in_batches(spark, live_rows, tmp_path, [200, 500])
    out = live.run_to_table(model.score(stream).select("session_id", "frame_id", "confidence", "state"), "t")
    want = model.score(batch).select("session_id", "frame_id", "confidence", "state")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))


def test_numbers_written_as_text(spark):
    raw = spark.createDataFrame(
        [('{"type":"frame","frame_id":"7"}',), ('{"type":"frame","frame_id":8}',), ('{"type":"frame","frame_id":"x"}',), ("{bad",)],
        "value string",
    )
    got = [(r["route"], r["frame_id"]) for r in messages.parse_messages(raw).collect()]
    assert got == [("frame", 7), ("frame", 8), ("frame", None), ("invalid", None)]


def test_a_promotion_takes_effect_with_the_next_batch(spark, tmp_path):
    schema = "session_id string, value double"
    batches = [[("a", float(10 * n + i)) for i in range(3)] for n in range(4)]
    stream = stream_of(spark, batches, tmp_path, schema)
    asked = []

    def current():
        asked.append(1)
        version = 1 if len(asked) <= 2 else 2
        return version, lambda df: df.withColumn("confidence", F.col("value") * version)

    table, place = live.run_scored(stream, current, "t")
    got = sorted((r["batch"], r["value"], r["model_version"], r["confidence"]) for r in table.collect())
    assert got == [(n, v, 1 if n < 2 else 2, v * (1 if n < 2 else 2)) for n, rows in enumerate(batches) for _, v in rows]
    again, _ = live.run_scored(stream, current, "t", place)
    assert again.count() == 12


def test_a_session_makes_one_frame_however_many_spans_end(spark, monkeypatch):
    caught = MagicMock()
    caught.columns = ["session_id", "kind"]
    grouped = caught.filter().select().withWatermark().groupBy()
    live.by_session(caught, live._Lifecycle(), 1, "1 hour")
    step = grouped.applyInPandasWithState.call_args[0][0]
    us = np.arange(30) * 10_000_000  # a gap before each message
    given = pd.DataFrame(
        {"session_id": "s", "us": us, "frame_id": np.arange(30), "kind": "init", "ear": 0.5, "confidence": 0.5, "new_alert": False}
    )
    state = MagicMock(exists=False, hasTimedOut=False, getCurrentWatermarkMs=lambda: 0)
    made, build = [], pd.DataFrame

    def counted(*args, **named):
        made.append(1)
        return build(*args, **named)

    monkeypatch.setattr(live.pd, "DataFrame", counted)
    (out,) = step(("s",), iter([given]), state)
    assert len(made) == 1
    assert out["started_us"].tolist() == us[:-1].tolist() and set(out["session_id"]) == {"s"}
