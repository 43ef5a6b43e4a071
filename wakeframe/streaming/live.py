"""Live sessions on Structured Streaming.

Messages of a session arrive in any number of micro-batches. The rules that make the
result independent of how the stream is cut:

* The rows of a session and batch are sorted by (us, frame_id); rows not after the last
  one seen are ignored.
* ``init`` opens a session, ``close`` ends it, and so does a gap of more than
  ``timeout_seconds`` between two messages. What stands between two such ends is a span;
  each span starts from fresh state. Messages before a span's ``init`` belong to none.
* Event-time timers end spans that fall silent. A closed span leaves its last place
  behind until the watermark has passed it, so that repeated messages don't reopen it;
  after that Spark itself drops them as late. A stream whose sessions have all ended
  holds no state.
* A row of kind ``tick`` belongs to no session and only moves the time on.

Inputs have ``session_id, us, frame_id`` (microseconds; a null frame_id is 0) and, if
sessions are opened and closed, ``kind``. Without ``kind`` every row is a frame, and the
first one opens. Rows without a session or time are left out. The operators set the
watermark themselves. The source's admission control (files or offsets per trigger)
bounds what one session can bring at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wakeframe.constants import (
    ALERT_FRAMES,
    DECIMATION,
    DRIFT_BUFFER,
    DRIFT_EVERY,
    DRIFT_MIN_VALUES,
    DROWSY_FRAMES,
    EAR_CLOSED,
    FEATURES,
    VARIANCE_FLOOR,
    WINDOW,
)
from wakeframe.operators.monitor import bucket_columns, bucket_quantile
from wakeframe.operators.sessions import NO_INIT
from wakeframe.session import exists, fresh_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TIMEOUT_SECONDS = 600
WATERMARK = "10 minutes"
FIRST = -(2**62)


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB: it may exceed an executor's memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def read_files(
    spark: SparkSession, folder: str, schema: T.StructType | str, glob: str = "*.parquet", files_per_batch: int = 100
) -> DataFrame:
    """A stream over the Parquet files of a folder."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def read_lines(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """A stream over the lines of a folder's text files: one column, ``value``."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Process what is available into a Parquet table in the shared folder."""
    return run_counted(stream, name)[0]


def run_counted(stream: DataFrame, name: str) -> tuple[DataFrame, dict[str, int]]:
    """``run_to_table``, and what the run says of itself.

    ``dropped_late``: rows that stateful operators dropped as older than the watermark;
    ``state_rows``: entries of all their states at the end.
    """
    spark = stream.sparkSession
    out, state = fresh_path(spark, name), fresh_path(spark, f"{name}-state")
    started = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out), said_of(started.recentProgress)


def said_of(progress: Sequence) -> dict[str, int]:
    """Sums over a run's batches, and the last batch's state sizes."""
    last = progress[-1].stateOperators if progress else []
    return {
        "batches": len({p.batchId for p in progress if p.numInputRows}),
        "dropped_late": sum(s.numRowsDroppedByWatermark for p in progress for s in p.stateOperators),
        "state_rows": sum(s.numRowsTotal for s in last),
    }


def run_to_sinks(
    stream: DataFrame, sinks: dict[str, Callable[[DataFrame], DataFrame]], name: str, place: str | None = None
) -> dict[str, DataFrame]:
    """Feed several tables from one reading of the stream.

    Each micro-batch is computed once and goes through every sink's function. A sink's
    rows of a batch are a folder of their own, written anew if the batch is repeated
    after a failure; so every row stands in its table exactly once. ``place``: the folder
    of an earlier run, which this one goes on with.
    """
    spark = stream.sparkSession
    place = place or fresh_path(spark, name)
    out = {sink: f"{place}/{sink}" for sink in sinks}

    def put(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for sink, shape in sinks.items():
                shape(batch).write.mode("overwrite").parquet(f"{out[sink]}/batch={number}")
        finally:
            batch.unpersist()

    started = (
        stream.writeStream.foreachBatch(put)
        .option("checkpointLocation", f"{place}/state")
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    like = spark.createDataFrame([], stream.schema)
    read = {}
    for sink, shape in sinks.items():
        schema = T.StructType([*shape(like).schema.fields, T.StructField("batch", T.LongType())])
        read[sink] = spark.createDataFrame([], schema)
        if exists(spark, out[sink]):  # a stream without data has no batch
            read[sink] = spark.read.schema(schema).option("basePath", out[sink]).parquet(out[sink])
    return read


def run_scored(
    stream: DataFrame,
    current: Callable[[], tuple[object, Callable[[DataFrame], DataFrame]]],
    name: str,
    place: str | None = None,
) -> tuple[DataFrame, str]:
    """Score a stream by whatever model is in production when a micro-batch is taken.

    ``current`` gives the version and the function that scores a table; it is asked once a
    batch, so a promotion takes effect with the next one, without a restart. Rows get
    ``model_version`` and ``batch``. Returns the table and the folder, which a later run
    can go on with. A batch repeated after a failure is written anew, by the version of
    that time.
    """
    spark = stream.sparkSession
    place = place or fresh_path(spark, name)

    def put(batch: DataFrame, number: int) -> None:
        version, score = current()
        out = score(batch).withColumn("model_version", F.lit(version).cast("long"))
        out.write.mode("overwrite").parquet(f"{place}/scores/batch={number}")

    started = (
        stream.writeStream.foreachBatch(put)
        .option("checkpointLocation", f"{place}/state")
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    like = current()[1](spark.createDataFrame([], stream.schema)).withColumn("model_version", F.lit(0).cast("long"))
    schema = T.StructType([*like.schema.fields, T.StructField("batch", T.LongType())])
    if not exists(spark, f"{place}/scores"):
        return spark.createDataFrame([], schema), place
    return spark.read.schema(schema).option("basePath", f"{place}/scores").parquet(f"{place}/scores"), place


Rows = dict[str, np.ndarray]


class SessionFold:
    """What an operator does with the spans of a session.

    ``columns``: inputs besides session, time, number and kind; ``output`` and
    ``fields``: schemas of the result and of the state kept within a span.

    Rows come and go as arrays by column name: a session brings a few rows to a batch, and
    a data frame for each of its spans would take longer than the work on it. Given rows
    leave the session out.
    """

    columns: Sequence[str] = ()
    output = ""
    fields = ""

    def fresh(self, opened: dict[str, object]) -> tuple:
        """The state of a span that ``opened`` begins."""
        raise NotImplementedError

    def advance(self, state: tuple, rows: Rows) -> tuple[tuple, Rows | None]:
        """The state after a span's next rows, and what these rows give."""
        return state, None

    def ended(self, state: tuple, started_us: int, ended_us: int, how: str) -> Rows | None:
        """What a span gives when it ends by ``close`` or ``timeout``."""

    def lost(self, rows: Rows) -> Rows | None:
        """What messages outside any span give."""


_HEAD = "is_open boolean, started_us long, last_us long, last_id long"


def _in_order(batches: Iterator[pd.DataFrame], last_us: int, last_id: int, columns: Sequence[str]) -> Rows:
    """The batch's rows after the last one seen, each (us, frame_id) once."""
    parts = list(batches)
    frame = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    rows = {c: frame[c].to_numpy() for c in columns}
    us, number = rows["us"], rows["frame_id"]
    new = np.flatnonzero(((us > last_us) | ((us == last_us) & (number > last_id))) & (rows["kind"] != "tick"))
    new = new[np.lexsort((number[new], us[new]))]
    first = np.ones(len(new), bool)
    first[1:] = (np.diff(us[new]) != 0) | (np.diff(number[new]) != 0)
    return {c: v[new[first]] for c, v in rows.items()}


def _cut(rows: Rows, first: int, end: int) -> Rows:
    return {c: v[first:end] for c, v in rows.items()}


def _frames(rows: Rows) -> Rows:
    is_frame = rows["kind"] == "frame"
    return rows if is_frame.all() else {c: v[is_frame] for c, v in rows.items()}


def _true(values: np.ndarray) -> np.ndarray:
    """Booleans, null being false."""
    return values if values.dtype == bool else pd.Series(values).fillna(False).to_numpy(dtype=bool)


def by_session(
    messages: DataFrame, fold: SessionFold, timeout_seconds: int = TIMEOUT_SECONDS, watermark: str = WATERMARK
) -> DataFrame:
    """Run ``fold`` over the spans of every session; see the module for the rules."""
    implicit = "kind" not in messages.columns
    timeout = timeout_seconds * 1_000_000
    names = [f.split()[0] for f in fold.output.split(", ")]
    read = ["us", "frame_id", "kind", *fold.columns]
    nothing = pd.DataFrame([], columns=names)

    def pieces(us: np.ndarray, kinds: np.ndarray, is_open: bool, last_us: int) -> Iterator[tuple[int, int, bool]]:
        """(first, end, whether a gap stands before): a piece reaches to a close or a gap."""
        before = np.concatenate([[last_us if last_us > FIRST else us[0]], us[:-1]])
        gap = us - before > timeout
        starts = gap | np.concatenate([[True], kinds[:-1] == "close"])
        at = np.flatnonzero(starts)
        for first, end in zip(at.tolist(), [*at[1:].tolist(), len(us)], strict=True):
            yield first, end, bool(gap[first])

    def step(key, batches, state: GroupState):
        session = key[0]
        given = state.get if state.exists else (False, 0, FIRST, FIRST, *[None] * len(fold.fields.split(", ")))
        is_open, started, last_us, last_id, *held = given
        out: list[Rows | None] = []
        if state.hasTimedOut:
            state.remove()
            if is_open:
                out.append(fold.ended(tuple(held), started, last_us, "timeout"))
        else:
            rows = _in_order(batches, last_us, last_id, read)
            us, kinds = rows["us"], rows["kind"]
            for first, end, gap in pieces(us, kinds, is_open, last_us) if len(us) else ():
                if is_open and gap:
                    out.append(fold.ended(tuple(held), started, last_us, "timeout"))
                    is_open = False
                if not is_open:
                    opens = np.ones(end - first, bool) if implicit else kinds[first:end] == "init"
                    begin = first + int(opens.argmax()) if opens.any() else end
                    if begin > first:
                        out.append(fold.lost(_cut(rows, first, begin)))
                    if begin < end:
                        is_open, started = True, int(us[begin])
                        held = fold.fresh({c: v[begin] for c, v in rows.items()})
                    first = begin
                if is_open:
                    held, given_now = fold.advance(tuple(held), _cut(rows, first, end))
                    out.append(given_now)
                last_us, last_id = int(us[end - 1]), int(rows["frame_id"][end - 1])
                if is_open and kinds[end - 1] == "close":
                    out.append(fold.ended(tuple(held), started, last_us, "close"))
                    is_open = False
            if last_us > FIRST:
                state.update((is_open, started, last_us, last_id, *(held if is_open else [None] * len(held))))
                due = (last_us + (timeout if is_open else 0)) // 1000 + 1
                state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        whole = [x for x in out if x is not None and len(next(iter(x.values())))]
        if whole:
            joined = {n: np.concatenate([x[n] for x in whole]) for n in whole[0]} if len(whole) > 1 else whole[0]
            yield pd.DataFrame({n: session if n == "session_id" else joined[n] for n in names}, columns=names)
        else:
            yield nothing

    kind = F.lit("frame") if implicit else F.coalesce("kind", F.lit("unknown"))
    return (
        messages.filter("session_id is not null and us is not null")
        .select(
            "session_id", "us", F.coalesce("frame_id", F.lit(0)).cast("long").alias("frame_id"), kind.alias("kind"),
            *fold.columns, F.timestamp_micros("us").alias("__ts"),
        )
        .withWatermark("__ts", watermark)
        .groupBy("session_id")
        .applyInPandasWithState(step, fold.output, f"{_HEAD}, {fold.fields}", "append", GroupStateTimeout.EventTimeTimeout)
    )


SLOT = ["face", "ear", "mar", "head_pitch", "head_yaw", "head_roll"]
LIVE_INPUT = ["session_id", "us", "frame_id", *SLOT]
PLACES = dict.fromkeys(FEATURES, 6) | dict.fromkeys(FEATURES[-3:], 4)
_CHUNK = 20_000  # windows computed at a time


def window_vectors(slots: np.ndarray, window: int, ear_closed: float) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, whether any slot shows a face) of all full windows over the slots."""
    count = max(0, len(slots) - window + 1)
    out, seen = np.full((count, len(FEATURES)), np.nan), np.zeros(count, bool)
    for first in range(0, count, _CHUNK):
        last = min(first + _CHUNK, count)
        part = np.lib.stride_tricks.sliding_window_view(slots[first : last + window - 1], window, axis=0)
        face, values = part[:, 0] > 0, part[:, 1:]
        valid = face[:, None] & ~np.isnan(values)
        n = valid.sum(axis=2)
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = np.where(valid, values, 0).sum(axis=2) / n
            ear = valid[:, 0]
            spread = np.sqrt((np.where(ear, values[:, 0] - mean[:, :1], 0) ** 2).sum(axis=1) / n[:, 0])
            low = np.where(ear, values[:, 0], np.inf).min(axis=1)
            high = np.where(valid[:, 1], values[:, 1], -np.inf).max(axis=1)
            closed = (ear & (values[:, 0] < ear_closed)).sum(axis=1) / (ear | ~face).sum(axis=1)
        some = n > 0
        columns = [mean[:, 0], np.where(some[:, 0], low, np.nan), spread, closed, mean[:, 1], np.where(some[:, 1], high, np.nan)]
        out[first:last] = np.column_stack([*columns, mean[:, 2:]])
        seen[first:last] = face.any(axis=1)
    return out, seen


class _LiveFeatures(SessionFold):
    fields = "window int, seen long, slots array<double>"
    output = "session_id string, us long, frame_id long, seq long, ready boolean, " + ", ".join(f"{f} double" for f in FEATURES)

    def __init__(self, window: int, every: int, ear_closed: float, repeat_skipped: bool, sized: bool):
        self.window, self.every, self.ear_closed, self.repeat_skipped, self.sized = window, every, ear_closed, repeat_skipped, sized
        self.columns = [*SLOT, *(["window_size"] if sized else [])]

    def fresh(self, opened):
        asked = opened["window_size"] if self.sized else None
        return int(asked) if asked is not None and asked == asked and asked >= 1 else self.window, 0, []

    def advance(self, state, rows):
        window, seen, flat = state
        rows = _frames(rows)
        old = np.array(flat, dtype=float).reshape(-1, len(SLOT))
        seq = seen + 1 + np.arange(len(rows["us"]))
        processed = seq % self.every == 0
        face = _true(rows["face"])
        fresh = np.column_stack([face, *[rows[c].astype(float) for c in SLOT[1:]]])[processed]
        slots = np.concatenate([old, fresh])
        vectors, any_face = window_vectors(slots, window, self.ear_closed)
        at = len(old) + np.cumsum(processed) - window  # the window that ends with the last processed frame
        ready = at >= 0
        ready[ready] = any_face[at[ready]]
        ready &= np.where(processed, face, self.repeat_skipped)
        shown = np.full((len(seq), len(FEATURES)), np.nan)
        shown[ready] = vectors[at[ready]]
        out = {"us": rows["us"], "frame_id": rows["frame_id"], "seq": seq, "ready": ready}
        out |= dict(zip(FEATURES, shown.T, strict=True))
        return (window, seen + len(seq), slots[-window:].ravel().tolist()), out


def live_features(
    frames: DataFrame,
    window: int = WINDOW,
    every: int = DECIMATION,
    ear_closed: float = EAR_CLOSED,
    repeat_skipped: bool = True,
    buffering: bool = False,
    timeout_seconds: int = TIMEOUT_SECONDS,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Window features per session; ``frames`` has the LIVE_INPUT columns.

    Every frame gets a row; ``ready`` says whether it has a vector. Frames without one
    (the window isn't full, or shows no face) are given only with ``buffering``. A
    ``window_size`` in the message that opens the session replaces ``window``.
    State of a span: its window size, frames seen, and the last ``window`` processed slots.
    """
    fold = _LiveFeatures(window, every, ear_closed, repeat_skipped, "window_size" in frames.columns)
    out = by_session(frames, fold, timeout_seconds, watermark)
    rounded = {f: F.round(F.when(F.col("ready"), F.col(f)), p) for f, p in PLACES.items()}
    out = out.withColumns(rounded)
    return out if buffering else out.filter("ready").drop("ready")


class _Debounced(SessionFold):
    columns = ["hit"]
    fields = "seen long, hit_at long, miss_at long, drowsy_at long, alert_at long, alerts long"
    output = (
        "session_id string, us long, frame_id long, seq long, hits long, misses long, state string, new_alert boolean, "
        "alerts long"
    )

    def __init__(self, to_drowsy: int, to_alert: int):
        self.to_drowsy, self.to_alert = to_drowsy, to_alert

    def fresh(self, opened):
        return 0, 0, 0, 0, 0, 0

    def advance(self, state, rows):
        seen, hit_at, miss_at, drowsy_at, alert_at, alerts = state
        rows = _frames(rows)
        if not len(rows["us"]):
            return state, None
        hit = _true(rows["hit"])
        seq = seen + 1 + np.arange(len(hit))
        last_hit = np.maximum.accumulate(np.maximum(np.where(hit, seq, 0), hit_at))
        last_miss = np.maximum.accumulate(np.maximum(np.where(hit, 0, seq), miss_at))
        hits, misses = seq - last_miss, seq - last_hit
        drowsy = np.maximum.accumulate(np.maximum(np.where(hits >= self.to_drowsy, seq, 0), drowsy_at))
        alert = np.maximum.accumulate(np.maximum(np.where(misses >= self.to_alert, seq, 0), alert_at))
        now = drowsy > alert
        new = now & ~np.concatenate([[drowsy_at > alert_at], now[:-1]])
        total = alerts + np.cumsum(new)
        out = {
            "us": rows["us"], "frame_id": rows["frame_id"], "seq": seq, "hits": hits, "misses": misses,
            "state": np.where(now, "drowsy", "alert").astype(object), "new_alert": new, "alerts": total,
        }
        return tuple(int(x[-1]) for x in (seq, last_hit, last_miss, drowsy, alert, total)), out


def debounced_state(
    predictions: DataFrame,
    to_drowsy: int = DROWSY_FRAMES,
    to_alert: int = ALERT_FRAMES,
    timeout_seconds: int = TIMEOUT_SECONDS,
    watermark: str = WATERMARK,
) -> DataFrame:
    """State per prediction; input ``session_id, us, frame_id, hit``.

    State of a span: rows seen, rows at which the last hit, miss and commands were, and
    the number of alerts.
    """
    return by_session(predictions, _Debounced(to_drowsy, to_alert), timeout_seconds, watermark)


class _Drift(SessionFold):
    output = "session_id string, seq long, feature string, n long, score double"

    def __init__(self, base: dict, names: list[str], numbered: bool, buffer: int, every: int, least: int):
        self.base, self.names, self.numbered, self.buffer, self.every, self.least = base, names, numbered, buffer, every, least
        self.columns = [*(["seq"] if numbered else []), *names]
        self.fields = ", ".join(["seen long", *[f"ring_{i} array<double>" for i in range(len(names))]])

    def fresh(self, opened):
        return 0, *[[] for _ in self.names]

    def score(self, values: np.ndarray, feature: str) -> float:
        if len(values) < self.least or feature not in self.base:
            return 0.0
        m, v = self.base[feature]
        live, ref = values.var() + VARIANCE_FLOOR, v + VARIANCE_FLOOR
        return float(np.log(np.sqrt(ref) / np.sqrt(live)) + (live + (values.mean() - m) ** 2) / (2 * ref) - 0.5)

    def advance(self, state, rows):
        seen, *kept = state
        rows = _frames(rows)
        if not len(rows["us"]):
            return state, None
        seq = rows["seq"] if self.numbered else seen + 1 + np.arange(len(rows["us"]))
        due = np.flatnonzero(seq % self.every == 0)
        out, rings = [], []
        for name, old in zip(self.names, kept, strict=True):
            value = rows[name].astype(float)
            fine = np.isfinite(value)
            every_value = np.concatenate([np.array(old, dtype=float), value[fine]])
            upto = len(old) + np.cumsum(fine)
            for i in due:  # one in ``every`` frames
                ring = every_value[max(0, upto[i] - self.buffer) : upto[i]]
                out.append((int(seq[i]), name, len(ring), self.score(ring, name)))
            rings.append(every_value[-self.buffer :].tolist())
        if not out or not self.base:
            return (int(seq[-1]), *rings), None
        at, feature, n, score = zip(*out, strict=True)
        scores = {"seq": np.array(at), "feature": np.array(feature, dtype=object), "n": np.array(n), "score": np.array(score)}
        return (int(seq[-1]), *rings), scores


def live_drift(
    vectors: DataFrame,
    base: dict[str, tuple[float, float]],
    columns: Sequence[str] = FEATURES,
    buffer: int = DRIFT_BUFFER,
    every: int = DRIFT_EVERY,
    least: int = DRIFT_MIN_VALUES,
    timeout_seconds: int = TIMEOUT_SECONDS,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Drift scores at each ``every``-th frame of a session.

    ``vectors`` has ``session_id, us, frame_id`` and the feature columns, and
    ``seq`` if the frame number is not the row number. ``base`` holds mean and
    variance per feature (one entry per feature column).
    State of a span: the last ``buffer`` accepted values of each feature.
    """
    fold = _Drift(base, list(columns), "seq" in vectors.columns, buffer, every, least)
    out = by_session(vectors, fold, timeout_seconds, watermark)
    return out.withColumn("score", F.greatest(F.lit(0.0), F.round("score", 6)))


class _Orphans(SessionFold):
    fields = "nothing boolean"
    output = "session_id string, us long, frame_id long, message string"

    def fresh(self, opened):
        return (None,)

    def lost(self, rows):
        rows = _frames(rows)
        return {"us": rows["us"], "frame_id": rows["frame_id"], "message": np.full(len(rows["us"]), NO_INIT, dtype=object)}


def frames_without_init(
    messages: DataFrame, timeout_seconds: int = TIMEOUT_SECONDS, watermark: str = WATERMARK
) -> DataFrame:
    """Frames before an init, after a close or after a time-out, as error rows.

    Input: ``session_id, us, frame_id, kind``; ``frame_id`` numbers the messages of a
    session.
    """
    return by_session(messages, _Orphans(), timeout_seconds, watermark)


class _Lifecycle(SessionFold):
    columns = ["ear", "confidence", "new_alert"]
    fields = "frames long, alerts long, ear_sum double, ear_n long, conf_sum double, conf_n long"
    output = (
        "session_id string, started_us long, ended_us long, duration_seconds double, frames long, alerts long, "
        "average_ear double, average_confidence double, ended_by string"
    )

    def fresh(self, opened):
        return 0, 0, 0.0, 0, 0.0, 0

    def advance(self, state, rows):
        rows = _frames(rows)
        alerts = int(_true(rows["new_alert"]).sum())
        sums = []
        for c in ("ear", "confidence"):
            value = rows[c].astype(float)
            fine = np.isfinite(value)
            sums += [float(value[fine].sum()), int(fine.sum())]
        return tuple(a + b for a, b in zip(state, (len(rows["us"]), alerts, *sums), strict=True)), None

    def ended(self, state, started_us, ended_us, how):
        frames, alerts, ear_sum, ear_n, conf_sum, conf_n = state
        mean = [ear_sum / ear_n if ear_n else np.nan, conf_sum / conf_n if conf_n else np.nan]
        row = (started_us, ended_us, (ended_us - started_us) / 1e6, frames, alerts, *mean, how)
        names = [c.split()[0] for c in self.output.split(", ")][1:]
        return {n: np.array([v], dtype=object if n == "ended_by" else None) for n, v in zip(names, row, strict=True)}


def session_lifecycle(
    events: DataFrame, timeout_seconds: int = TIMEOUT_SECONDS, watermark: str = WATERMARK
) -> DataFrame:
    """One summary per span when it closes or falls silent.

    Input: ``session_id, us, frame_id, kind (init, frame, close), ear, confidence,
    new_alert``. A close message ends the span; event time passing ``timeout_seconds``
    without a message stands for a disconnect. ``frame_id`` numbers the messages of a
    session. Equal to ``operators.sessions.session_spans``, without the open ones.
    """
    out = by_session(events, _Lifecycle(), timeout_seconds, watermark)
    places = {"duration_seconds": 2, "average_ear": 4, "average_confidence": 4}
    return out.withColumns({c: F.round(F.when(~F.isnan(c), F.col(c)), p) for c, p in places.items()})


def in_arrival_order(
    messages: DataFrame, watermark: str = WATERMARK, keys: Sequence[str] = ("session_id", "us", "frame_id")
) -> DataFrame:
    """Each message once, with ``late``: whether a later one of its session came in an earlier batch.

    Repeated messages (equal ``keys``) within the watermark are dropped by Spark, and so
    are rows older than it, which the run counts. Late rows are what the other operators
    ignore; here they are kept as a side output. A session's place is forgotten once the
    watermark has passed it.
    """

    def step(key, batches, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([], columns=["session_id", "us", "frame_id", "late"])
            return
        last_us, last_id = state.get if state.exists else (FIRST, FIRST)
        parts = list(batches)
        us, number = (np.concatenate([p[c].to_numpy() for p in parts]) for c in ("us", "frame_id"))
        late = (us < last_us) | ((us == last_us) & (number <= last_id))
        top = int(us.max())
        last_us, last_id = max((last_us, last_id), (top, int(number[us == top].max())))
        state.update((last_us, last_id))
        state.setTimeoutTimestamp(max(last_us // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"session_id": key[0], "us": us, "frame_id": number, "late": late})

    once = (
        messages.filter("session_id is not null and us is not null")
        .select("session_id", "us", F.coalesce("frame_id", F.lit(0)).cast("long").alias("frame_id"), F.timestamp_micros("us").alias("__ts"))
        .withWatermark("__ts", watermark)
        .dropDuplicatesWithinWatermark(list(keys))
    )
    return once.groupBy("session_id").applyInPandasWithState(
        step,
        "session_id string, us long, frame_id long, late boolean",
        "last_us long, last_id long",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )


def orphan_frames(messages: DataFrame, attach_seconds: int = 3600, watermark: str = WATERMARK) -> DataFrame:
    """Frames whose session wasn't opened in the ``attach_seconds`` before them.

    A stream-stream left outer join of frames with openings: a frame stays in state
    until the watermark says that no opening can come any more, then it goes out as an
    orphan if none was there. Input: ``session_id, us, frame_id, kind``.
    """
    ts = F.timestamp_micros("us")
    frames = messages.filter("kind in ('frame', 'tick')").select("session_id", "us", "frame_id", "kind", ts.alias("frame_ts"))
    opened = messages.filter("kind in ('init', 'tick')").select(
        F.coalesce("session_id", F.lit("")).alias("opened_id"), F.col("kind").alias("opened_kind"), ts.alias("opened_ts")
    )
    # ticks move both watermarks and go afterwards: as these conditions name the time
    # too, they aren't pushed down in front of the watermark
    near = (
        (F.col("session_id") == F.col("opened_id"))
        & ((F.col("opened_kind") == "init") | F.col("opened_ts").isNull())
        & (F.col("opened_ts") <= F.col("frame_ts"))
        & (F.col("opened_ts") >= F.col("frame_ts") - F.expr(f"INTERVAL {attach_seconds} SECONDS"))
    )
    joined = frames.withWatermark("frame_ts", watermark).join(opened.withWatermark("opened_ts", watermark), near, "left_outer")
    lost = joined.filter("opened_id is null and (kind = 'frame' or frame_ts is null)")
    return lost.select("session_id", "us", "frame_id", F.lit(NO_INIT).alias("message"))


def metric_windows(
    events: DataFrame,
    value: str,
    bounds: Sequence[float],
    window: str = "5 minutes",
    slide: str = "15 seconds",
    watermark: str = "1 minute",
    keys: Sequence[str] = (),
    error: str | None = None,
    quantiles: Sequence[float] = (0.95,),
) -> DataFrame:
    """Counts, rates and quantiles over sliding event-time windows.

    ``events`` has ``ts`` as TIMESTAMP. Events are counted per ``slide`` first; sliding
    windows add these counts up, so an event is never copied, only a step's row is.
    Columns: start, end, keys, requests, errors, bucket counts, total_sum, request_rate
    and error_rate (per second), error_ratio (as in the alert rules), and a column per
    quantile (p95). Rows later than the watermark are dropped; a window is emitted once
    the watermark has passed its end.
    """
    failed = F.count_if(F.col(error)) if error else F.lit(0).cast("long")
    steps = (
        events.withWatermark("ts", watermark)
        .groupBy(F.window("ts", slide).alias("step"), *keys)
        .agg(F.count(F.lit(1)).alias("requests"), failed.alias("errors"), *bucket_columns(F.col(value), bounds))
    )
    counts = ["requests", "errors", *[f"le_{i}" for i in range(len(bounds) + 1)], "total_sum"]
    slid = steps.groupBy(F.window(F.window_time("step"), window, slide), *keys).agg(*[F.sum(c).alias(c) for c in counts])
    seconds = F.unix_seconds("window.end") - F.unix_seconds("window.start")
    rates = {"request_rate": F.col("requests") / seconds, "error_rate": F.col("errors") / seconds}
    ratio = {"error_ratio": rates["error_rate"] / (rates["request_rate"] + 0.001)}
    found = {f"p{round(100 * q)}": bucket_quantile(bounds, q) for q in quantiles}
    return slid.select("window.start", "window.end", *keys, *counts, *[c.alias(n) for n, c in (rates | ratio | found).items()])
