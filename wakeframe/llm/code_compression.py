"""Vectors as codes of their parts, by k-means with adaptive distance bounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeframe.llm.suite import query, table
from wakeframe.session import Stages

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LARGEST = 1 << 27  # components are held within this, so that sums of squares fit into 64 bits
EXACT = 1 << 20  # up to here products of components are exact in double precision
NEAREST = 8  # of k entries, a NEAREST-th get a lower bound of their own at first
SLACK = 1e-9  # relative rounding of square roots, on the safe side
LABEL_SALTS = 16


class Compressed(NamedTuple):
    """``rows``: id, label, code (one byte a part), error; ``books``: part x entry x position;
    ``kept``: for each round's assignment, the number of bounds kept per part."""

    rows: DataFrame
    books: np.ndarray
    kept: list[list[int]]


def _integers(scale: int, size: int):
    """(id, label, vector) -> (id, label, integers of 32 bits); others than finite ones of ``size`` are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            length = pa.compute.fill_null(pa.compute.list_value_length(column), -1).to_numpy()
            at = np.flatnonzero(length == size)
            values = column.take(pa.array(at)).flatten()
            x = values.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, size)  # a null is nan
            fine = np.isfinite(x).all(axis=1)
            at, x = at[fine], x[fine]
            whole = np.clip(np.floor(x * scale), -LARGEST, LARGEST).astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array([v.tobytes() for v in whole], pa.binary())],
                names=["id", "label", "x"],
            )

    return run


def squared(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows x entries, as integers."""
    if max(np.abs(x).max(initial=0), np.abs(book).max(initial=0)) <= EXACT:
        a, b = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)
    return ((x[:, None, :].astype(np.int64) - book[None, :, :]) ** 2).sum(axis=2)


def _below(values: np.ndarray) -> np.ndarray:
    """Half-precision numbers not above the values; infinity stays."""
    held = np.where(np.isinf(values), values, np.minimum(values, float(np.finfo("<f2").max)))
    out = held.astype("<f2")
    return np.where(out > held, np.nextafter(out, np.float16(0)), out)


class Bounds:
    """One part position's state of a block of rows.

    ``code``: nearest entry. ``near``: the next closest entries, ``low`` a lower bound of
    the distance to each. ``outer``: a lower bound of the distance to all other entries.
    """

    def __init__(self, code: np.ndarray, near: np.ndarray, low: np.ndarray, outer: np.ndarray):
        self.code, self.near, self.low, self.outer = code, near, low, outer

    @classmethod
    def of(cls, x: np.ndarray, book: np.ndarray, b: int) -> tuple[Bounds, np.ndarray]:
        """From all distances; ties go to the lower entry. Also the squared distances to the nearest."""
        d = squared(x, book)
        n, k = d.shape
        code, row = d.argmin(axis=1), np.arange(n)
        error = d[row, code]
        d[row, code] = -1  # first, whatever ties with it
        some = np.argpartition(d, b + 1, axis=1)[:, : b + 2] if k > b + 2 else np.tile(np.arange(k), (n, 1))
        value = np.take_along_axis(d, some, axis=1)
        order = np.argsort(value, axis=1, kind="stable")
        near, low = np.take_along_axis(some, order, axis=1)[:, 1:], np.take_along_axis(value, order, axis=1)[:, 1:]
        low = _below(np.sqrt(low.astype(np.float64)) * (1 - SLACK))
        outer = low[:, b] if k > b + 1 else np.full(n, np.inf, "<f2")
        return cls(code.astype(np.uint8), near[:, :b].astype(np.uint8), low[:, :b], outer), error

    def narrowed(self, b: int) -> Bounds:
        """With the ``b`` closest entries only; the others' bounds go into the outer one."""
        if b >= self.near.shape[1]:
            return self
        outer = np.minimum(self.outer, self.low[:, b:].min(axis=1))
        return Bounds(self.code, self.near[:, :b], self.low[:, :b], outer)

    def moved(self, x: np.ndarray, book: np.ndarray, drift: np.ndarray) -> tuple[Bounds, np.ndarray, np.ndarray]:
        """The state after the entries moved by ``drift``, squared distances, and the depths needed.

        The own distance is computed exactly. Bounds shrink by what their entries moved.
        Entries before the first bound that surely exceeds the own distance are verified
        with integers; where not even the outer bound does, all entries are.
        """
        b = self.near.shape[1]
        n = len(x)
        own = ((x - book[self.code]) ** 2).sum(axis=1)
        reach = np.sqrt(own.astype(np.float64)) * (1 + SLACK)
        low = _below(np.maximum(self.low.astype(np.float64) - drift[self.near], 0))
        outer = _below(np.maximum(self.outer.astype(np.float64) - drift.max(), 0))
        # a place's bound holds for all behind it too
        behind = np.minimum.accumulate(np.concatenate([low, outer[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1]
        sure = behind > reach[:, None]
        depth = np.where(sure.any(axis=1), sure.argmax(axis=1), b + 1)
        code, near, error = self.code.copy(), self.near.copy(), own.copy()
        for z in np.unique(depth):
            if z == 0:
                continue
            at = np.flatnonzero(depth == z)
            if z == b + 1:
                fresh, error[at] = Bounds.of(x[at], book, b)
                code[at], near[at], low[at], outer[at] = fresh.code, fresh.near, fresh.low, fresh.outer
                continue
            some = np.concatenate([code[at, None], near[at, :z]], axis=1).astype(np.int64)
            d = ((x[at, None, :] - book[some]) ** 2).sum(axis=2)
            order = np.lexsort((some, d), axis=1)
            some, d = np.take_along_axis(some, order, axis=1), np.take_along_axis(d, order, axis=1)
            code[at], error[at] = some[:, 0], d[:, 0]
            near[at, :z], low[at, :z] = some[:, 1:], _below(np.sqrt(d[:, 1:].astype(np.float64)) * (1 - SLACK))
        return Bounds(code, near, low, outer), error, np.where(depth > b, 0, depth)


_STATE = "id long, label string, x binary, code binary, near binary, low binary, outer binary, depth binary, error long"
_NAMES = [f.split()[0] for f in _STATE.split(", ")]


def _block(column: pa.Array, kind: str, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    raw = b"".join(v.as_buffer() for v in column)
    return np.frombuffer(raw, dtype=kind).reshape(len(column), width)


def _binary(values: np.ndarray) -> pa.Array:
    values = np.ascontiguousarray(values)
    n, width = len(values), values.shape[1] * values.itemsize
    offsets = pa.py_buffer((np.arange(n + 1) * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(values.tobytes())])


def _assigned(books: np.ndarray, drift: np.ndarray | None, had: list[int], keep: list[int]):
    """Rows -> rows with their state for ``books``; without ``drift`` from scratch.

    ``had`` and ``keep``: bounds per part in the state read and in the one written.
    """
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        had_at, last = np.cumsum([0, *had]), len(had)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _block(batch.column(2), "<i4", parts * width).astype(np.int64)
            if drift is not None:
                code, near = _block(batch.column(3), "u1", parts), _block(batch.column(4), "u1", had_at[last])
                low, outer = _block(batch.column(5), "<f2", had_at[last]), _block(batch.column(6), "<f2", parts)
            states, depths, error = [], [], np.zeros(n, dtype=np.int64)
            for p in range(parts):
                part = x[:, p * width : (p + 1) * width]
                if drift is None:
                    state, off = Bounds.of(part, books[p], keep[p])
                    depth = np.zeros(n, dtype=np.int64)
                else:
                    mine = slice(had_at[p], had_at[p + 1])
                    state = Bounds(code[:, p], near[:, mine], low[:, mine], outer[:, p]).narrowed(keep[p])
                    state, off, depth = state.moved(part, books[p], drift[p])
                states.append(state)
                depths.append(depth)
                error += off
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    _binary(np.stack([s.code for s in states], axis=1)),
                    _binary(np.concatenate([s.near for s in states], axis=1)),
                    _binary(np.concatenate([s.low for s in states], axis=1).astype("<f2")),
                    _binary(np.stack([s.outer for s in states], axis=1).astype("<f2")),
                    _binary(np.stack(depths, axis=1).astype(np.uint8)),
                    pa.array(error),
                ],
                names=_NAMES,
            )

    return run


def _sums(parts: int, entries: int, width: int):
    """(x, code, depth) -> per task and (part, entry): rows, sums of components, greatest depth of the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), dtype=np.int64)
        total = np.zeros((parts, entries, width), dtype=np.int64)
        deepest = np.zeros(parts, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _block(batch.column(0), "<i4", parts * width).astype(np.int64)
            code = _block(batch.column(1), "u1", parts)
            deepest = np.maximum(deepest, _block(batch.column(2), "u1", parts).max(axis=0))
            for p in range(parts):
                np.add.at(count[p], code[:, p], 1)
                np.add.at(total[p], code[:, p], x[:, p * width : (p + 1) * width])
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]),
                pa.array(deepest[part]),
                *[pa.array(total[part, entry, w]) for w in range(width)],
            ],
            names=["part", "entry", "n", "depth", *[f"s{w}" for w in range(width)]],
        )

    return run


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    stages: Stages | None = None,
) -> Compressed:
    """Codes of vectors by a codebook per part position.

    A component x becomes floor(scale * x); vectors are cut into ``parts`` equal parts.
    Codebooks start as the parts of the ``entries`` smallest ids' vectors (fewer if there
    are fewer), then ``rounds`` times every part goes to its nearest entry (squared
    Euclidean distance, ties to the lower index) and an entry becomes floor(sum / count) of
    its parts; an unused entry stays. At the end parts are assigned once more.

    Only the first assignment measures all distances. A row keeps, for each part, its entry,
    the closest other entries with a lower bound each, and one outer bound for all the rest;
    entries' movements loosen the bounds, and only entries that the bounds can't exclude are
    measured again, with integers. The number of bounds kept starts at an eighth of the
    entries (at 64, a vector's state takes 450 bytes) and follows the greatest depth that
    any row needed. All is exact: the bounds only spare work.

    Left out: vectors that are null, empty, or hold null or non-finite components, and
    vectors of another length than that of the smallest id's usable vector whose length is
    a multiple of ``parts``. Integers beyond +-2**27 are held there. Null ids come after all
    others; a repeated id makes a row each (ordered by the integers' bytes). Labels are compared
    as text, null with null. Other columns are not read. No usable rows give no rows and no
    codebook. At most 256 entries; what the driver holds are codebooks and their sums.
    """
    if not 1 <= entries <= 256 or parts < 1:
        raise ValueError("1 to 256 entries, at least one part")
    spark = vectors.sparkSession
    stages = stages or Stages(spark)
    label = F.col(label_col).cast("string") if label_col else F.lit(None).cast("string")
    source = vectors.select(
        F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda c: c.isNotNull() & (c > float("-inf")) & (c < float("inf")))  # nan is above all
    usable = source.filter((F.size("vector") > 0) & (F.size("vector") % parts == 0) & finite)
    first = usable.orderBy(F.asc_nulls_last("id"), "vector").limit(1).select(F.size("vector")).first()
    if first is None:
        empty = spark.createDataFrame([], "id long, label string, code binary, error long")
        return Compressed(empty, np.zeros((parts, 0, 0), np.int64), [])
    size = first[0]
    width = size // parts
    rows = stages.keep(source.mapInArrow(_integers(scale, size), "id long, label string, x binary"), "integers")
    seeds = rows.select("id", "x").orderBy(F.asc_nulls_last("id"), "x").limit(entries).collect()
    books = np.stack([np.frombuffer(r["x"], "<i4").astype(np.int64) for r in seeds])
    books = books.reshape(len(seeds), parts, width).transpose(1, 0, 2).copy()
    k = len(seeds)
    keep = [min(-(-k // NEAREST), k - 1)] * parts
    kept = [keep]
    drift = None
    state = rows.mapInArrow(_assigned(books, None, keep, keep), _STATE)
    before_it = rows
    for _ in range(rounds):
        state = stages.keep(state, "assigned")
        stages.drop(before_it)
        before_it = state
        sums = state.select("x", "code", "depth").mapInArrow(
            _sums(parts, k, width), "part int, entry int, n long, depth long, " + ", ".join(f"s{w} long" for w in range(width))
        )
        found = sums.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.max("depth").alias("depth"), *[F.sum(f"s{w}").alias(f"s{w}") for w in range(width)]
        )
        before, books = books, books.copy()
        deepest = [0] * parts
        for r in found.collect():  # parts x entries rows
            books[r["part"], r["entry"]] = [r[f"s{w}"] // r["n"] for w in range(width)]
            deepest[r["part"]] = max(deepest[r["part"]], r["depth"])
        had = keep
        if drift is not None:  # depths are known from the second assignment on
            keep = [min(h, max(1, d)) for h, d in zip(had, deepest, strict=True)]
        drift = np.sqrt(((books - before).astype(np.float64) ** 2).sum(axis=2)) * (1 + SLACK)
        kept.append(keep)
        state = state.mapInArrow(_assigned(books, drift, had, keep), _STATE)
    return Compressed(state.select("id", "label", "code", "error"), books, kept)


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def with_label_error(rows: DataFrame) -> DataFrame:
    """Adds ``label_error``, the error summed over the rows with the same label.

    Sums are joined back; each is repeated ``LABEL_SALTS`` times, so that a label with
    most of the rows is spread.
    """
    salt = F.pmod(F.xxhash64("id", "code"), F.lit(LABEL_SALTS)).cast("int")
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = sums.select(
        F.col("label").alias("__label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))).alias("__salt")
    )
    salted = rows.withColumn("__at", salt)
    on = salted["label"].eqNullSafe(sums["__label"]) & (salted["__at"] == sums["__salt"])
    return salted.join(sums, on).drop("__at", "__label", "__salt")


_ASSIGN = """a{n} AS (
      SELECT vec_id, label, p.part, y, min({{
               'd': list_sum([(y[i] - c[i]) * (y[i] - c[i]) FOR i IN range(1, len(y) + 1)])::BIGINT, 'e': entry}}) AS near
      FROM p JOIN b{n} AS b ON b.part = p.part GROUP BY ALL)"""

_UPDATE = """s{n} AS (
      SELECT part, near.e AS entry, i, sum(y[i])::BIGINT AS s, count(*) AS n
      FROM a{n}, unnest(range(1, len(y) + 1)) AS u(i) GROUP BY ALL),
    m{n} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{n} GROUP BY ALL),
    b{m} AS (SELECT o.part, o.entry, coalesce(m{n}.c, o.c) AS c
             FROM b{n} AS o LEFT JOIN m{n} ON m{n}.part = o.part AND m{n}.entry = o.entry)"""


@query(
    "op12_code_compression",
    f"""
    WITH v AS (
      SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS x FROM embeddings
      WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    p AS (SELECT vec_id, label, part, x[part * (len(x) // 16) + 1 : (part + 1) * (len(x) // 16)] AS y
          FROM v, range(16) AS t(part)),
    seed AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v QUALIFY entry < 64),
    b0 AS (SELECT part, entry, y AS c FROM p JOIN seed USING (vec_id)),
    {_ASSIGN.format(n=0)}, {_UPDATE.format(n=0, m=1)},
    {_ASSIGN.format(n=1)}, {_UPDATE.format(n=1, m=2)},
    {_ASSIGN.format(n=2)},
    book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2),
    r AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', near.e), '' ORDER BY part) AS code,
                 sum(near.d)::BIGINT AS error FROM a2 GROUP BY vec_id)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM r, book
    """,
)
def op12_code_compression(spark: SparkSession, folder: str) -> DataFrame:
    done = compress(table(spark, folder, "embeddings"))
    return with_label_error(done.rows).select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books_digest(done.books)).alias("codebooks_sha256"),
    )
