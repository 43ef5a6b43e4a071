"""Near-duplicate vectors by randomly rotated binary codes with correction factors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeframe.llm.linking import components
from wakeframe.llm.suite import query, table
from wakeframe.llm.words import mixed, seeds
from wakeframe.session import Stages

COSINE = 0.95
MISS = 0.01
EPSILON = 4.0
CROWD = 64

_CODED = "vec_id long, vector binary, code binary, scale double, factor double, keys array<long>"


@lru_cache(maxsize=256)
def rotation(size: int, number: int) -> np.ndarray:
    """A random rotation of ``size`` dimensions; the same in every process."""
    made = np.linalg.qr(np.random.default_rng([size, number]).standard_normal((size, size)))
    return made[0] * np.sign(np.diag(made[1]))


def table_sizes(rows: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(bits per key, keys per vector) for a table of ``rows``.

    Keys get as many bits as it takes for a bucket to hold about one unrelated vector,
    so that work grows with the rows; the number of keys is what a pair just at
    ``cosine`` needs to share one with a probability of 1 - ``miss``.
    """
    bits = max(8, math.ceil(math.log2(max(rows, 2))))
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-same)))


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows, and which rows have a direction (finite and not zero)."""
    ok = np.isfinite(x).all(axis=1)
    x = np.where(ok[:, None], x, 0.0)
    top = np.abs(x).max(axis=1, initial=0.0)
    ok &= top > 0
    x = x / np.where(top > 0, top, 1.0)[:, None]
    return x / np.where(ok, np.linalg.norm(x, axis=1), 1.0)[:, None], ok


def _coded(bits: int, count: int):
    """(id, vector) -> rotated code of one byte a dimension, its correction factor, bucket keys.

    The code's signs are the binary code; its magnitudes serve as the other side of an
    estimate. ``factor`` is the inner product of the unit vector with its binary code.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            lengths = np.array([-1 if v is None else v for v in pa.compute.list_value_length(column).to_pylist()], int)
            for size in sorted(set(lengths.tolist()) - {-1, 0}):
                at = np.flatnonzero(lengths == size)
                values = column.take(pa.array(at)).flatten()
                x = values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
                unit, ok = _unit(x)  # Arrow gives nulls as nan
                at, unit = at[ok], unit[ok]
                if not len(at):
                    continue
                turned = unit @ rotation(size, 0).T
                top = np.abs(turned).max(axis=1)
                code = np.rint(turned * (127 / top)[:, None]).astype(np.int8)
                sign = np.where(code >= 0, 1.0, -1.0) / math.sqrt(size)
                factor = (sign * turned).sum(axis=1)
                need = -(-bits * count // size)
                planes = np.hstack([unit @ rotation(size, 1 + r).T >= 0 for r in range(need)])[:, : bits * count]
                keys = np.empty((len(at), count), dtype=np.uint64)
                powers = np.uint64(1) << np.arange(min(bits, 63), dtype=np.uint64)
                for k in range(count):
                    number = planes[:, k * bits : k * bits + len(powers)].astype(np.uint64) @ powers
                    keys[:, k] = mixed(mixed(number + seeds(1, 31 * k + 7)[0]) ^ seeds(1, size)[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at)),
                        pa.array([v.tobytes() for v in unit], pa.binary()),
                        pa.array([v.tobytes() for v in code], pa.binary()),
                        pa.array(top / 127),
                        pa.array(factor),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(at) + 1, dtype=np.int32) * count),
                            pa.array(keys.reshape(-1).view(np.int64)),
                        ),
                    ],
                    names=["vec_id", "vector", "code", "scale", "factor", "keys"],
                )

    return run


def estimate(x: np.ndarray, x_factor: np.ndarray, y: np.ndarray, y_scale: np.ndarray):
    """Unbiased estimates of inner products of unit vectors, and their standard bounds.

    ``x``: codes of which the signs count; ``y``: codes of which the values count. Over
    random rotations the binary code's inner product with y, divided by its own factor,
    has the mean x . y and a deviation of at most ``bound``.
    """
    size = x.shape[1]
    sign = np.where(x >= 0, 1.0, -1.0) / math.sqrt(size)
    raw = (sign * y).sum(axis=1) * y_scale
    bound = np.sqrt(np.maximum(1 - x_factor**2, 0)) / x_factor / math.sqrt(max(size - 1, 1))
    return raw / x_factor, bound


def _promising(cosine: float, epsilon: float):
    """Pairs whose estimate plus ``epsilon`` bounds reaches ``cosine``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.array([len(v.as_buffer()) for v in batch.column(2)], dtype=int)
            keep = np.zeros(batch.num_rows, dtype=bool)
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                part = batch.take(pa.array(at))
                x, y = (
                    np.frombuffer(b"".join(v.as_py() for v in part.column(c)), np.int8).reshape(-1, n).astype(float)
                    for c in (2, 3)
                )
                xs, ys, xf, yf = (part.column(c).to_numpy() for c in (4, 5, 6, 7))
                one, one_off = estimate(x, xf, y, ys)
                two, two_off = estimate(y, yf, x, xs)
                keep[at] = (one + epsilon * one_off >= cosine) & (two + epsilon * two_off >= cosine)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return run


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, x, y) -> (a, b, cosine), in double precision."""
    for batch in batches:
        out = [
            float(np.dot(np.frombuffer(x.as_buffer()), np.frombuffer(y.as_buffer())))
            for x, y in zip(batch.column(2), batch.column(3), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out, pa.float64())], ["a", "b", "cosine"]
        )


def vector_links(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    miss: float = MISS,
    epsilon: float = EPSILON,
) -> DataFrame:
    """One row per id: ``n_links``, ``component_id`` (smallest id reachable) and ``kept``.

    Candidates share a bucket of sign bits (see ``table_sizes``); of these, pairs whose
    estimated inner product may reach ``cosine`` within ``epsilon`` bounds are computed
    exactly in double precision. No pair below ``cosine`` is linked, and the share of
    missed links is at most about ``miss``, far less above the threshold.

    Crowds never meet pairwise: in buckets of ``CROWD`` rows or more, rows within half
    the linking angle of the bucket's first row form a clique, whose members all link
    by the triangle inequality. Only pairs of different cliques are candidates.

    Null, zero, empty and non-finite vectors, and vectors with a null or non-finite
    component, link with nothing; vectors of different lengths don't link. A repeated
    id counts once, with its smallest vector. A null id links with nothing: its row has
    component_id null and is kept. Other columns are not read; no rows give no rows.
    """
    stages = Stages(vectors.sparkSession)
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    ids = stages.keep(source.filter("vec_id is not null").groupBy("vec_id").agg(F.min("vector").alias("vector")), "ids")
    bits, count = table_sizes(ids.count(), cosine, miss)
    coded = stages.keep(ids.mapInArrow(_coded(bits, count), _CODED), "coded")
    keyed = coded.select(F.explode("keys").alias("bucket"), "vec_id")
    sizes = stages.keep(keyed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("vec_id").alias("first")).filter("n > 1"), "sizes")
    exact = coded.select("vec_id", "vector")

    def measured(pairs: DataFrame) -> DataFrame:
        x, y = exact.toDF("a", "x"), exact.toDF("b", "y")
        both = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
        return both.mapInArrow(_cosines, "a long, b long, cosine double")

    crowds = keyed.join(sizes.filter(F.col("n") >= CROWD), "bucket").filter("vec_id <> first")
    pairs = crowds.select(F.col("vec_id").alias("a"), F.col("first").alias("b")).distinct()
    tight = math.cos(math.acos(cosine) / 2) + 1e-12
    cliques = measured(pairs).filter(F.col("cosine") >= tight).groupBy(F.col("a").alias("vec_id"))
    cliques = stages.keep(cliques.agg(F.min("b").alias("clique")), "cliques")
    member = coded.select("vec_id").join(cliques, "vec_id", "left")
    member = stages.keep(member.select("vec_id", F.coalesce("clique", "vec_id").alias("clique")), "member")

    shared = keyed.join(sizes.select("bucket"), "bucket").join(member, "vec_id")
    shared = stages.keep(shared, "shared")
    held = shared.groupBy("bucket", "clique").agg(F.count("*").alias("k"))
    main = held.groupBy("bucket").agg(F.max(F.struct("k", "clique")).alias("most"), F.count("*").alias("parts"))
    main = stages.keep(main.filter("parts > 1").select("bucket", F.col("most.clique").alias("main")), "main")
    rest = stages.keep(shared.join(main, "bucket"), "rest")
    one, other = rest.filter("clique <> main").alias("x"), rest.alias("y")
    met = one.join(other, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.clique") != F.col("y.clique")))
    met = met.select(
        F.greatest("x.vec_id", "y.vec_id").alias("a"), F.least("x.vec_id", "y.vec_id").alias("b")
    ).distinct()
    light = coded.select("vec_id", "code", "scale", "factor")
    x, y = light.toDF("a", "x", "xs", "xf"), light.toDF("b", "y", "ys", "yf")
    near = met.join(x, "a").join(y, "b").select("a", "b", "x", "y", "xs", "ys", "xf", "yf")
    near = stages.keep(near.mapInArrow(_promising(cosine, epsilon), "a long, b long"), "near")
    links = stages.keep(measured(near).filter(F.col("cosine") >= cosine).select("a", "b"), "links")

    ends = links.select(F.col("a").alias("vec_id")).unionByName(links.select(F.col("b").alias("vec_id")))
    across = ends.groupBy("vec_id").agg(F.count("*").alias("across"))
    within = member.groupBy("clique").agg((F.count("*") - 1).alias("within"))
    stars = cliques.select(F.col("vec_id").alias("a"), F.col("clique").alias("b"))
    root = components(links.unionByName(stars), stages)
    within = stages.keep(within, "within")
    joined = member.join(within, "clique").join(across, "vec_id", "left").join(
        root.withColumnRenamed("node", "vec_id"), "vec_id", "left"
    )
    found = joined.select(
        "vec_id", (F.col("within") + F.coalesce("across", F.lit(0))).alias("n_links"), F.coalesce("root", "vec_id").alias("component_id")
    )
    known = ids.select("vec_id").join(found, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    unnamed = source.filter("vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = known.unionByName(unnamed)
    return out.select(F.col("vec_id").alias(id_col), "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query(
    "op3_vector_dedup",
    """
    WITH RECURSIVE v AS (
      SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
      WHERE embedding IS NOT NULL AND list_sum([c * c FOR c IN embedding::DOUBLE[]]) > 0),
    e AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q
          ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x) AND list_cosine_similarity(p.x, q.x) >= 0.95),
    r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
          UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
    c AS (SELECT a, min(b) AS low FROM r GROUP BY a),
    n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
    SELECT c.a AS vec_id, coalesce(n.n, 0) AS n_links, low AS component_id, c.a = low AS kept
    FROM c LEFT JOIN n ON n.a = c.a
    """,
)
def op3_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_links(table(spark, folder, "embeddings"))
