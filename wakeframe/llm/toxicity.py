"""Toxicity by ordinal regression: one weight vector, ordered thresholds, expected severity."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeframe.llm.rows import annotated
from wakeframe.llm.suite import query, table
from wakeframe.llm.words import Texts, Words, beginnings, blocks, grams, mixed, seeds, texts_of, words_of
from wakeframe.session import Stages

GRADES = 3  # severities above 0
LABELLED = 20_000  # labelled documents that the model is fitted on, at most
FEATURES = 2048  # words with a weight, at most
SKETCHES = 4  # minima by which near copies among them are found
STEMS = (4, 5)  # bytes of a word's beginning that are features too
LEAST_DOCS = 4  # labelled documents that a word with a weight is in
LEAST_ODDS = 1.0  # its log odds ratio
LEAST_Z = 5.0  # and its excess over chance, in standard deviations

# Letters in lower case; punctuation separates words.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[list(b".,;:!?\"'()[]{}*_~`<>|/\\-")] = 32


def _folded(texts: Texts, first: int, last: int) -> Texts:
    low, high = int(texts.start[first]), int(max(texts.end[last - 1], texts.start[first]))
    return Texts(_FOLD[texts.data[low:high]], texts.start[first:last] - low, texts.end[first:last] - low)


def _features(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each word and of its beginnings: stems that many forms share."""
    parts = [words, *[beginnings(texts, words, n) for n in STEMS]]
    return np.concatenate([p.row for p in parts]), np.concatenate([p.hash for p in parts])


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, toxic, text) -> (id, toxic, sketches, n_words, words, counts), words and stems as distinct hashes.

    ``sketches`` are the smallest five-word grams in several orders: near copies share some.
    """
    for batch in batches:
        texts = texts_of(batch.column(2))
        for first, last in blocks(texts):
            n = last - first
            folded = _folded(texts, first, last)
            words = words_of(folded)
            row, gram = grams(words, 5)
            sketch = np.zeros((n, SKETCHES), dtype=np.uint64)
            head = np.flatnonzero(np.diff(row, prepend=-1))
            for k in range(SKETCHES):
                ordered = mixed(gram ^ seeds(1, 611 + k)[0])
                sketch[row[head], k] = np.minimum.reduceat(ordered, head) if len(head) else 0
            r, h = _features(folded, words)
            order = np.lexsort((h, r))
            r, h = r[order], h[order]
            new = np.ones(len(r), dtype=bool)
            new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
            at = np.flatnonzero(new)
            count = np.diff(np.append(at, len(r)))
            offsets = np.searchsorted(r[at], np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, n),
                    batch.column(1).slice(first, n),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(n + 1, dtype=np.int32) * SKETCHES), pa.array(sketch.reshape(-1).view(np.int64))
                    ),
                    pa.array(np.bincount(words.row, minlength=n).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(h[at].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(count.astype(np.int64))),
                ],
                names=["long_id", "toxic", "sketches", "n_words", "words", "counts"],
            )


class Model(NamedTuple):
    """Weights of hashed words (sorted) and the thresholds of the grades above 0, rising."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def exceed(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k = 1.., which falls with k since the thresholds rise."""
    return _sigmoid(np.asarray(score)[:, None] - thresholds)


def fit_ordinal(
    row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, columns: int, grades: int,
    ridge: float = 0.02, rounds: int = 800, rate: float = 0.1,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the cumulative-link model by Adam on its likelihood.

    P(grade >= k) = logistic(w . x - t_k): all thresholds share the weights. The gaps
    between thresholds are exponentials, so their order holds while fitting.
    """
    n = len(grade)
    share = np.array([(np.sum(grade >= k) + 0.5) / (n + 1) for k in range(1, grades + 1)])
    level = np.log((1 - share) / share)
    theta = np.concatenate(([level[0]], np.log(np.maximum(np.diff(level), 0.05))))
    p = np.concatenate((np.zeros(columns), theta))
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, rounds + 1):
        w, gaps = p[:columns], np.exp(p[columns + 1 :])
        t = np.cumsum(np.concatenate(([p[columns]], gaps)))
        score = np.bincount(row, weights=w[column] * value, minlength=n)
        above = exceed(score, t)
        edge = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        slope = edge * (1 - edge)
        at = np.arange(n)
        own = np.maximum(edge[at, grade] - edge[at, grade + 1], 1e-12)
        # d log P / d score, and / d t_k
        by_score = (slope[at, grade] - slope[at, grade + 1]) / own
        by_t = np.zeros((n, grades + 2))
        by_t[at, grade] -= slope[at, grade] / own
        by_t[at, grade + 1] += slope[at, grade + 1] / own
        t_grad = by_t[:, 1:-1].sum(axis=0)
        tail = np.cumsum(t_grad[::-1])[::-1]
        grad = np.concatenate(
            (np.bincount(column, weights=by_score[row] * value, minlength=columns) - ridge * w, [tail[0]], tail[1:] * gaps)
        )
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        p = p + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return p[:columns], np.cumsum(np.concatenate(([p[columns]], np.exp(p[columns + 1 :]))))


def _telling(lists: DataFrame, features: int) -> list:
    """Words of the labelled documents that lean to one side beyond chance: at most ``features``."""
    toxic = F.col("toxic").cast("double")
    total = lists.agg(F.count("*").alias("n"), F.sum(toxic).alias("hits")).first()
    if not total["n"] or not total["hits"] or total["hits"] == total["n"]:
        return []
    rate = total["hits"] / total["n"]
    seen = lists.select("toxic", F.explode("words").alias("word")).groupBy("word")
    seen = seen.agg(F.count("*").alias("docs"), F.sum(toxic).alias("hits"))
    excess = (F.col("hits") - F.col("docs") * rate) / F.sqrt(F.col("docs") * rate * (1 - rate))
    odds = F.log((F.col("hits") + 0.5) / (F.col("docs") - F.col("hits") + 0.5)) - math.log(rate / (1 - rate))
    seen = seen.withColumns({"z": excess, "odds": odds})
    lean = seen.filter((F.abs("z") >= LEAST_Z) & (F.abs("odds") >= LEAST_ODDS) & (F.col("docs") >= LEAST_DOCS))
    return lean.orderBy(F.desc(F.abs("z")), "word").limit(features).collect()


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    labelled: int = LABELLED,
    features: int = FEATURES,
    grades: int = GRADES,
) -> Model | None:
    """Fit the model on at most ``labelled`` labelled documents, drawn by a hash of their id.

    Labels say only toxic or not. The grade of a toxic document is one plus the number
    of ``grades`` - 1 quantiles that its count of words found mostly in toxic documents
    exceeds; other documents have grade 0. Of texts that share a sketch and the label one
    is used, so that families of copies don't vote many times. Null ids, labels and texts are left out.
    Without labels of both kinds there is no model.
    """
    stages = Stages(docs.sparkSession)
    chosen = labels.select(F.col(id_col).cast("long").alias("long_id"), F.col(label_col).cast("int").alias("toxic"))
    chosen = chosen.filter("long_id is not null and toxic is not null").groupBy("long_id").agg(F.max("toxic").alias("toxic"))
    chosen = stages.keep(chosen.orderBy(F.xxhash64("long_id"), "long_id").limit(labelled), "labelled")
    texts = docs.select(F.col(id_col).cast("long").alias("long_id"), F.col(text_col).alias("text"))
    # at most ``labelled`` rows of two numbers are broadcast
    texts = texts.filter(F.length("text") > 0).join(F.broadcast(chosen), "long_id").select("long_id", "toxic", "text")
    lists = texts.mapInArrow(
        _word_lists, "long_id long, toxic int, sketches array<long>, n_words long, words array<long>, counts array<long>"
    )
    lists = stages.keep(lists.filter("n_words > 0"), "word_lists")
    single = lists.select("long_id", "toxic", "sketches")
    for k in range(SKETCHES):
        single = single.groupBy("toxic", F.col("sketches")[k]).agg(F.min(F.struct("long_id", "sketches")).alias("one"))
        single = single.select("one.long_id", "toxic", "one.sketches")
    lists = lists.join(F.broadcast(stages.keep(single.select("long_id"), "single")), "long_id", "left_semi")
    telling = _telling(lists, features)
    if not telling:
        return None
    known = docs.sparkSession.createDataFrame([(r["word"], i) for i, r in enumerate(telling)], "word long, at int")
    pairs = lists.select("long_id", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    pairs = pairs.select("long_id", F.col("w.words").alias("word"), F.col("w.counts").alias("k"))
    used = pairs.join(F.broadcast(known), "word").groupBy("long_id").agg(
        F.collect_list(F.struct("at", "k")).alias("used")
    )
    rows = lists.select("long_id", "toxic", "n_words").join(used, "long_id", "left").collect()
    rows.sort(key=lambda r: r["long_id"])
    leans = np.array([2 * r["hits"] >= r["docs"] for r in telling])
    row, column, value, toxic, signs = [], [], [], [], []
    for i, r in enumerate(rows):
        hits = 0
        for at, k in sorted((u["at"], u["k"]) for u in r["used"] or []):
            row.append(i)
            column.append(at)
            value.append(math.log1p(k))
            hits += k * leans[at]
        toxic.append(r["toxic"] > 0)
        signs.append(hits)
    toxic, signs = np.array(toxic), np.array(signs)
    cuts = np.quantile(signs[toxic], np.arange(1, grades) / grades)
    grade = np.where(toxic, 1 + (signs[:, None] > cuts).sum(axis=1), 0)
    weights, thresholds = fit_ordinal(
        np.array(row, dtype=np.int64), np.array(column, dtype=np.int64), np.array(value), grade, len(telling), grades
    )
    words = np.array([r["word"] for r in telling], dtype=np.int64).view(np.uint64)
    order = np.argsort(words)
    return Model(words[order], weights[order], thresholds)


def _judged(model: Model | None, grades: int):
    """Score, severity, P(grade >= 1) and likeliest grade of a range of texts."""

    def compute(texts: Texts, first: int, last: int) -> list[np.ndarray]:
        n = last - first
        score, above = np.zeros(n), np.zeros((n, grades))
        if model is not None:
            folded = _folded(texts, first, last)
            rows, found = _features(folded, words_of(folded))
            place = np.searchsorted(model.words, found)
            place[place == len(model.words)] = 0
            hit = model.words[place] == found
            key = np.sort(rows[hit] * len(model.words) + place[hit])
            at = np.flatnonzero(np.diff(key, prepend=-1))
            count = np.diff(np.append(at, len(key)))
            row, column = np.divmod(key[at], len(model.words))
            score = np.bincount(row, weights=model.weights[column] * np.log1p(count), minlength=n)
            above = exceed(score, model.thresholds)
        chance = np.hstack([1 - above[:, :1], above[:, :-1] - above[:, 1:], above[:, -1:]])
        return [score, above.sum(axis=1), above[:, 0].copy(), chance.argmax(axis=1).astype(np.int32)]

    return compute


_JUDGED = [("score", "double"), ("severity", "double"), ("p_toxic", "double"), ("grade", "int")]


def toxicity(
    docs: DataFrame,
    model: Model | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    grades: int = GRADES,
    threshold: float = 0.5,
) -> DataFrame:
    """One row per document: score, expected ``severity`` (0..grades), p_toxic, grade, toxic.

    A text's features are the logarithms of the counts of its words and of their first
    four and five bytes, whole texts, letters of A-Z in lower case and punctuation apart. ``severity`` is the sum of P(grade >= k);
    ``toxic`` marks P(grade >= 1) >= ``threshold``. A null, empty or blank text has no
    feature and is judged by the thresholds alone. Without a model all is 0 and not
    toxic. Ids may be null or repeat: rows are judged one by one. Other columns are
    not read. No rows give no rows.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("long_id"), F.xxhash64(text_col).alias("tag"), F.col(text_col).alias("text")
    )
    out, _ = annotated(rows, "text", _judged(model, grades), _JUDGED)
    toxic = (F.col("p_toxic") >= threshold) if model is not None else F.lit(False)
    return out.drop("text").withColumn("toxic", toxic).withColumnRenamed("long_id", id_col)


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """The documents not marked toxic, with all their columns; the model is fitted on ``docs``.

    Cases are as in ``fit`` and ``toxicity``; without a model every document stays.
    """
    model = fit(docs, labels, id_col, text_col)
    if model is None:
        return docs
    judged, names = annotated(docs, text_col, _judged(model, len(model.thresholds)), _JUDGED)
    return judged.filter(F.col(names[2]) < threshold).select(*docs.columns)


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    judged = toxicity(docs, fit(docs, table(spark, folder, "labels")))
    return judged.select("doc_id", "score", "severity", "p_toxic", "grade", "toxic")
