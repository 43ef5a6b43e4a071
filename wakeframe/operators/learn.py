"""Classifier training and scoring on Spark ML."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LinearSVC, LogisticRegression
from pyspark.ml.feature import Bucketizer, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeframe.constants import CONFIDENCE_STATE, FEATURES, SEED
from wakeframe.functions.scalars import is_finite, predicted_state
from wakeframe.operators.evaluation import balanced_weights, positive_weight
from wakeframe.session import cut_lineage, shared_dir

BINS = 32  # of a feature, as many as Spark's trees tell apart
ROWS_AT_ONCE = 256  # whose waves are in memory
FAR = 4.0  # of a scaled number over a full turn, from where its waves need double precision
PARTS = 8  # of the rows that share all bins, drawn apart for each tree
FIRST_ROWS = 100_000  # that a descent on a part of the rows has at least
LEAST_STEPS = 20  # of a descent that goes on from a smaller part of the rows
DRAWN = 1 << 14  # values of the number by which parts of the rows are told


def usable(features: Sequence[str]) -> Column:
    """Every feature is a finite number."""
    ok = F.lit(True)
    for c in features:
        ok = ok & is_finite(F.col(c))
    return ok


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumn("__vector", array_to_vector(F.array(*_filled(features))))


def _filled(features: Sequence[str]) -> list[Column]:
    """The features as numbers; 0 for what isn't finite."""
    return [F.when(is_finite(F.col(c)), F.col(c)).otherwise(F.lit(0.0)).cast("double") for c in features]


def _cuts(rows: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """Where each feature is cut into at most ``BINS`` bins, over all rows.

    Between neighbouring values where these are few, else at quantiles.
    """
    names = [f"v{i}" for i in range(len(features))]
    values = rows.select(*[F.col(c).cast("double").alias(n) for c, n in zip(features, names, strict=True)])
    many = values.agg(*[F.approx_count_distinct(n).alias(n) for n in names]).first()
    few = [n for n in names if many[n] <= 2 * BINS]
    found: dict[str, list[float]] = {n: [] for n in few}
    if few:
        each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in few]))
        for r in values.select(each.alias("e")).select("e.*").distinct().collect():
            found[r["name"]].append(r["value"])
    found = {n: sorted(v) for n, v in found.items() if len(v) <= BINS}
    cuts = {n: [a / 2 + b / 2 for a, b in zip(v, v[1:])] for n, v in found.items()}
    rest = [n for n in names if n not in cuts]
    if rest:
        cuts |= dict(zip(rest, values.approxQuantile(rest, [i / BINS for i in range(1, BINS)], 0.001), strict=True))
    return [sorted(set(cuts[n])) for n in names]


def _binned(df: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]]) -> DataFrame:
    """Adds ``__vector``: the number of each feature's bin."""
    ins, outs = ([f"__{kind}{i}" for i in range(len(features))] for kind in ("in", "bin"))
    splits = [[-math.inf, *(c or [0.0]), math.inf] for c in cuts]
    binner = Bucketizer(splitsArray=splits, inputCols=ins, outputCols=outs)
    out = binner.transform(df.withColumns(dict(zip(ins, _filled(features), strict=True))))
    return out.withColumn("__vector", array_to_vector(F.array(*outs)))


@dataclass
class Classifier:
    """A fitted model that adds the probability of the positive class."""

    features: list[str]
    model: object

    def probability(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def one(self, values: Sequence[float]) -> float:
        """The probability of a single row, without a job: what a server answers with."""
        raise NotImplementedError

    def score(self, df: DataFrame, cut: float = CONFIDENCE_STATE) -> DataFrame:
        """Adds ``confidence`` (4 places), ``prediction`` and ``state``.

        Rows that cannot be scored get confidence 0. Works on streams too.
        """
        out = self.probability(df.withColumn("__usable", usable(self.features)))
        p = F.round(F.when(F.col("__usable"), F.col("__p")).otherwise(F.lit(0.0)), 4)
        out = out.withColumn("confidence", p)
        out = out.withColumns(
            {
                "prediction": (F.col("confidence") >= cut).cast("int"),
                "state": predicted_state(F.col("confidence"), cut),
            }
        )
        return out.drop(*[c for c in out.columns if c.startswith("__")])


_INPUTS = "features array<string>, cuts array<array<double>>"


@dataclass
class BoostedTrees(Classifier):
    """Trees over the numbers of the features' bins, which end at ``cuts``."""

    cuts: list[list[float]]

    def probability(self, df):
        scored = self.model.transform(_binned(df, self.features, self.cuts))
        return scored.withColumn("__p", F.get(vector_to_array("__probability"), F.lit(1)))

    def one(self, values):
        bins = [float(np.searchsorted(c or [0.0], v, side="right")) for v, c in zip(values, self.cuts, strict=True)]
        return float(self.model.predictProbability(Vectors.dense(bins))[1])

    def save(self, path: str) -> None:
        """The model and its inputs below ``path``, on any file system that Spark writes."""
        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.getActiveSession()
        inputs = spark.createDataFrame([(self.features, self.cuts)], _INPUTS)
        inputs.coalesce(1).write.mode("overwrite").parquet(f"{path}/inputs")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        inputs = spark.read.schema(_INPUTS).parquet(f"{path}/inputs").first()
        cuts = [list(c) for c in inputs["cuts"]]
        return cls(list(inputs["features"]), GBTClassificationModel.load(f"{path}/model"), cuts)

    def importance(self, spark) -> DataFrame:
        """Rows ``feature, importance``, highest first; one row per feature."""
        rows = [(f, float(v)) for f, v in zip(self.features, self.model.featureImportances.toArray())]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def train_boosted(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = "label",
    trees: int = 200,
    depth: int = 6,
    rate: float = 0.1,
    row_share: float = 0.8,
    column_share: float = 0.8,
    weight: float | None = None,
    seed: int = SEED,
    partitions: int | None = None,
) -> BoostedTrees:
    """Gradient-boosted trees with the positive class weighted.

    All rows are cut into bins once and counted by label, bins and one of ``PARTS`` random
    parts, and the trees are grown on these counts: rows in the same bins are alike to a
    tree. So a tree's passes grow with the bins that occur, not with the rows, unless
    the features are so many that hardly two rows share their bins. A tree draws
    ``row_share`` of the counted parts, which are single rows while rows are few.
    ``partitions`` spreads a training table that comes in too few pieces.
    """
    shared_dir(train.sparkSession)  # boosting cuts its lineage there
    given = weight if weight is not None else positive_weight(train, label).first()["positive_weight"] or 1.0
    rows = train.filter(usable(features)).select(F.col(label).cast("double").alias(label), *features)
    cuts = _cuts(rows, features)
    part = F.floor(F.rand(seed) * PARTS).alias("__part")
    bins = [f"__bin{i}" for i in range(len(features))]
    counted = _binned(rows, features, cuts).groupBy(label, *bins, part).agg(F.count(F.lit(1)).alias("__n"))
    counted = cut_lineage(counted, "counted")
    learner = GBTClassifier(
        featuresCol="__vector",
        labelCol=label,
        predictionCol="__prediction",
        weightCol="__weight",
        maxIter=trees,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=row_share,
        featureSubsetStrategy=str(column_share),
        checkpointInterval=10,
        seed=seed,
    )
    learner.setProbabilityCol("__probability").setRawPredictionCol("__raw")
    weight = F.col("__n") * F.when(F.col(label) == 1, F.lit(float(given))).otherwise(F.lit(1.0))
    ready = counted.select(label, array_to_vector(F.array(*bins)).alias("__vector"), weight.alias("__weight"))
    model = learner.fit(ready.repartition(partitions) if partitions else ready)
    return BoostedTrees(list(features), model, cuts)


@dataclass
class Lift:
    """Random Fourier features of the kernel exp(-gamma |x - y|^2) (Rahimi, Recht 2007) of scaled numbers.

    A wave is worked out where it is needed and never stored: ``size`` numbers a row
    are many times as long as the row.
    """

    mean: np.ndarray
    factor: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    def waves(self, values: np.ndarray) -> np.ndarray:
        """rows x size, of variance 1 about, in single precision: the angle is reduced to a turn before it is cut."""
        scaled = (values - self.mean) * (self.factor / (2.0 * np.pi))
        if np.abs(scaled).max(initial=0.0) > FAR:
            turns = scaled @ self.directions.T
            turns += self.phases / (2.0 * np.pi)
            turns -= np.rint(turns)
            angle = turns.astype(np.float32)
        else:  # some turns at most, which single precision tells apart well enough
            angle = scaled.astype(np.float32) @ self.directions.T.astype(np.float32)
            angle += (self.phases / (2.0 * np.pi)).astype(np.float32)
            angle -= np.rint(angle)
        angle *= np.float32(2.0 * np.pi)
        np.cos(angle, out=angle)
        angle *= np.float32(math.sqrt(2.0))
        return angle


def fourier_features(scaler, gamma: float, size: int, seed: int) -> Lift:
    """``size`` features of the numbers that ``scaler`` was fitted on."""
    mean, std = scaler.mean.toArray(), scaler.std.toArray()
    draw = np.random.default_rng(seed)
    directions = draw.normal(scale=np.sqrt(2.0 * gamma), size=(size, len(mean)))
    phases = draw.uniform(0.0, 2.0 * np.pi, size=size)
    return Lift(mean, np.divide(1.0, std, out=np.zeros_like(std), where=std > 0), directions, phases)


def single_row_latency(model: Classifier, rows: DataFrame, calls: int = 100, warm_up: int = 10) -> DataFrame:
    """Milliseconds that a single row takes, one row per call.

    ``calls`` rows are scored one after the other, as by a server that holds the model.
    """
    taken = rows.filter(usable(model.features)).select(*[F.col(c).cast("double") for c in model.features]).limit(calls).collect()
    values = [list(r) for r in taken]
    for v in values[:warm_up]:
        model.one(v)
    times = []
    for v in values:
        start = time.perf_counter()
        model.one(v)
        times.append(((time.perf_counter() - start) * 1000,))
    return rows.sparkSession.createDataFrame(times, "ms double")


@dataclass
class Linear:
    """A linear machine over waves."""

    lift: Lift
    coefficients: np.ndarray
    intercept: float

    def margins(self, values: np.ndarray) -> np.ndarray:
        out, along = np.empty(len(values)), self.coefficients.astype(np.float32)
        for low in range(0, len(values), ROWS_AT_ONCE):
            some = slice(low, low + ROWS_AT_ONCE)
            out[some] = self.lift.waves(values[some]) @ along + self.intercept
        return out


class KernelMachine(Classifier):
    def one(self, values):
        svc, platt = self.model
        margin = float(svc.margins(np.asarray([values], dtype=float))[0])
        return float(platt.predictProbability(Vectors.dense([margin]))[1])

    def probability(self, df):
        svc, platt = self.model
        return platt.transform(_margin(df, _filled(self.features), svc)).withColumn(
            "__p", F.get(vector_to_array("__probability"), F.lit(1))
        )


def _margin(df: DataFrame, values: Sequence[Column], svc: Linear) -> DataFrame:
    """Adds ``__margin``, a vector of one number."""

    @F.pandas_udf("double")
    def margin(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in parts:
            yield pd.Series(svc.margins(np.column_stack(columns)))

    return df.withColumn("__side", margin(*values)).withColumn("__margin", array_to_vector(F.array("__side")))


def _hinge(rows: DataFrame, lift: Lift, weights: dict[float, float], total: float, penalty: float) -> Callable:
    """The mean weighted hinge loss with its penalty, and the gradient, as a function of (coefficients, intercept).

    ``rows``: the label and the features; ``total``: the sum of their weights. A call is a
    pass over them; a task sends back its sums.
    """

    def loss(at: np.ndarray) -> tuple[float, np.ndarray]:
        along = at[:-1].astype(np.float32)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            value, gradient = 0.0, np.zeros_like(at)
            for batch in batches:
                label, *columns = (c.to_numpy() for c in batch.columns)
                values, side = np.column_stack(columns), 2.0 * label - 1.0
                weight = np.where(label == 1.0, weights.get(1.0, 0.0), weights.get(0.0, 0.0))
                for low in range(0, len(values), ROWS_AT_ONCE):
                    some = slice(low, low + ROWS_AT_ONCE)
                    waves = lift.waves(values[some])
                    short = 1.0 - side[some] * (waves @ along + at[-1])
                    push = np.where(short > 0.0, weight[some], 0.0)
                    value += float(push @ short)
                    push *= -side[some]
                    gradient[:-1] += push.astype(np.float32) @ waves
                    gradient[-1] += push.sum()
            yield pa.RecordBatch.from_arrays([pa.array([value]), pa.array([gradient])], names=["value", "gradient"])

        parts = rows.mapInArrow(sums, "value double, gradient array<double>").collect()
        value, gradient = sum(p["value"] for p in parts), np.sum([p["gradient"] for p in parts], axis=0)
        inner = np.append(at[:-1], 0.0) * penalty
        return value / total + 0.5 * float(inner @ at), gradient / total + inner

    return loss


def _descended(
    loss: Callable, at: np.ndarray, iterations: int, steps: Sequence = (), history: int = 10, tolerance: float = 1e-6
) -> tuple[np.ndarray, list]:
    """L-BFGS with backtracking (Nocedal, Wright 2006), until the last ``history`` steps gain next to nothing.

    Also returns the last steps and changes of the gradient, which a further descent can begin with.
    """
    value, gradient = loss(at)
    values, steps = [value], list(steps)
    for _ in range(iterations):
        direction, used = -gradient, []
        for s, y in reversed(steps):
            used.append(float(s @ direction) / float(s @ y))
            direction = direction - used[-1] * y
        if steps:
            s, y = steps[-1]
            direction = direction * (float(s @ y) / float(y @ y))
        for (s, y), share in zip(steps, reversed(used), strict=True):
            direction = direction + s * (share - float(y @ direction) / float(s @ y))
        slope = float(gradient @ direction)
        step = 1.0 if steps else 1.0 / max(float(np.linalg.norm(gradient)), 1e-12)
        for _ in range(20):
            there, (new, new_gradient) = at + step * direction, loss(at + step * direction)
            if new <= value + 1e-4 * step * slope:
                break
            step /= 2 if steps else 10
        else:  # no way down that floating point or a kink of the loss allows
            if not steps:
                return at, steps
            steps = []
            continue
        s, y = there - at, new_gradient - gradient
        if float(s @ y) > 1e-10 * float(y @ y):
            steps = [*steps[1 - history :], (s, y)]
        at, value, gradient = there, new, new_gradient
        values.append(value)
        if len(values) > history and values[-1 - history] - value <= tolerance * max(values[0], 1e-12):
            break
    return at, steps


def _shares(rows: int) -> list[float]:
    """Parts of the rows to descend on in turn, each four times the one before, and at last all."""
    out = [1.0]
    while rows * out[0] / 4 >= FIRST_ROWS and out[0] * DRAWN >= 64:
        out.insert(0, out[0] / 4)
    return out


def train_kernel(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = "label",
    cost: float = 1.0,
    size: int = 256,
    iterations: int = 100,
    seed: int = SEED,
    partitions: int | None = None,
) -> KernelMachine:
    """Scaled RBF-kernel support vector machine with probabilities.

    The kernel is approximated by random features, so training is a linear
    machine over a table instead of a kernel matrix. The features of a row are worked
    out anew in each pass; what is written is the label and the inputs. Large tables are first
    descended on random parts of growing size, each from where the last one ended (Byrd, Chin,
    Nocedal, Wu 2012), so that few passes over all rows are left. The first descent, which is the
    only one on small tables, takes ``iterations`` steps at most, each further one half as many as
    the one before but ``LEAST_STEPS``; the last is over all rows. Classes are balanced by weight and margins become probabilities by a logistic fit (Platt 1999).
    ``partitions`` spreads a training table that comes in too few pieces.
    """
    rows = train.filter(usable(features))
    classes = balanced_weights(rows, label).collect()  # one row per class
    given = {float(r[label]): float(r["weight"]) for r in classes if r[label] is not None}
    n = {float(r[label]): r["n_class"] for r in classes if r[label] is not None}
    if not set(n) <= {0.0, 1.0} or len(n) < len(classes):
        raise ValueError(f"labels must be 0 or 1, found {sorted(str(r[label]) for r in classes)}")
    names = [f"v{i}" for i in range(len(features))]
    rows = rows.select(
        F.col(label).cast("double").alias(label), *[F.col(c).cast("double").alias(v) for c, v in zip(features, names, strict=True)]
    )
    shares = _shares(sum(n.values()))
    inputs = [label, *names]
    if len(shares) > 1:
        rows = rows.withColumn("__drawn", F.floor(F.rand(seed) * DRAWN).cast("short"))
    drawn = cut_lineage(rows.repartition(partitions) if partitions else rows, "training")
    rows = drawn.select(*inputs)
    scaler = StandardScaler(inputCol="__vector", outputCol="__scaled", withMean=True, withStd=True).fit(_assembled(rows, names))
    gamma = 1.0 / len(features)  # 1 / (n * variance), variance 1 after scaling
    lift = fourier_features(scaler, gamma, size, seed)
    # the penalty is on the coefficients of features of norm 1, which waves are sqrt(size) times as long as
    total, penalty = sum(given[c] * n[c] for c in n), size / (cost * max(1, sum(n.values())))
    at, steps = np.zeros(size + 1), []
    for i, share in enumerate(shares):
        some = rows if share == 1.0 else drawn.filter(F.col("__drawn") < int(share * DRAWN)).select(*inputs)
        loss = _hinge(some, lift, given, total * share, penalty)
        at, steps = _descended(loss, at, min(iterations, max(iterations >> i, LEAST_STEPS)), steps)
    svc = Linear(lift, at[:-1], float(at[-1]))
    weight = F.lit(1.0)
    for c, w in given.items():
        weight = F.when(F.col(label) == c, F.lit(w)).otherwise(weight)
    # one number per row, read in every iteration of the fit
    margins = _margin(rows, [F.col(v) for v in names], svc).select(label, weight.alias("__weight"), "__margin")
    margins = cut_lineage(margins, "margins")
    platt = LogisticRegression(
        featuresCol="__margin",
        labelCol=label,
        weightCol="__weight",
        probabilityCol="__probability",
        rawPredictionCol="__platt_raw",
        predictionCol="__platt",
    ).fit(margins)
    return KernelMachine(list(features), (svc, platt))
