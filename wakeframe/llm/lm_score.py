"""Language-model scores: a log-bilinear model fitted by noise-contrastive estimation.

P(w | a, b) is proportional to exp(r_w . (c1 * q_a + c2 * q_b) + bias_w) for the two
words before. The exponent is a sum of a part from a and a part from b, so the
normaliser of every context at once is a product of two matrices,
Z[a, b] = sum_w exp(r_w . c1 q_a) * exp(r_w . c2 q_b + bias_w), and each token's
normalised log-probability is three look-ups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeframe.llm.suite import query, table
from wakeframe.llm.words import Texts, blocks, texts_of, words_of
from wakeframe.session import Stages

VOCABULARY = 2048  # words of the neural model: UNKNOWN, END and the commonest
DIRECT = 1 << 18  # words whose counts are sent to every task (4 MB); the others are joined
SIZE = 16  # dimensions
NOISE = 32  # noise words per batch
BATCH = 1024
ROUNDS = 3  # every training document is used in one of them
RATE = 0.05
BLOCK = 4 << 20

UNKNOWN, END = 0, 1
_END_HASH = np.uint64(0x1F0E5CAFE0DD5EED)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def held_out(id_column: Column) -> Column:
    """Documents that the model doesn't learn from: crc32 of the id as text, modulo 5, is 1."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _tokens(texts: Texts, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(row from 0, hash) of the words of rows first..last, each row's END after them."""
    low, high = int(texts.start[first]), int(max(texts.end[last - 1], texts.start[first]))
    folded = Texts(_LOWER[texts.data[low:high]], texts.start[first:last] - low, texts.end[first:last] - low)
    words = words_of(folded)
    ends = np.searchsorted(words.row, np.arange(last - first), side="right")
    return np.insert(words.row, ends, np.arange(last - first)), np.insert(words.hash, ends, _END_HASH)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> (word, c): a block's distinct words with their counts"""
    for batch in batches:
        texts = texts_of(batch.column(0))
        for first, last in blocks(texts, BLOCK):
            word, count = np.unique(_tokens(texts, first, last)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(count)], names=["word", "c"])


class Lexicon(NamedTuple):
    """The commonest words by hash (sorted), their counts and ranks, and corpus totals."""

    word: np.ndarray
    count: np.ndarray
    index: np.ndarray  # place in the neural vocabulary, UNKNOWN for the rest
    size: int  # of the neural vocabulary
    unigram: np.ndarray  # counts by place in the neural vocabulary
    tokens: int
    distinct: int

    def find(self, found: np.ndarray) -> np.ndarray:
        """Places of hashes in ``word``, -1 where they aren't."""
        if not len(self.word):
            return np.full(len(found), -1)
        place = np.searchsorted(self.word, found)
        place[place == len(self.word)] = 0
        return np.where(self.word[place] == found, place, -1)


def lexicon_of(counts: DataFrame, vocabulary: int, direct: int) -> Lexicon:
    """Totals over all counts, and the commonest words: at most ``direct`` rows come here.

    Which counts are common enough follows from a histogram of their logarithms, 32
    bins to a doubling, so that no task sends more than its share of the words.
    """
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    level = F.floor(F.log2("c") * 32)
    room, least = direct, None
    for r in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        room -= r["count"]
        if room < 0:
            break
        least = r["level"]
    common = counts.filter(level >= least) if least is not None else counts.limit(0)
    rows = common.toPandas().sort_values(["c", "word"], ascending=[False, True])
    word = rows["word"].to_numpy(dtype=np.int64).view(np.uint64)
    count = rows["c"].to_numpy(dtype=np.int64)
    index = np.full(len(word), UNKNOWN)
    common = np.flatnonzero(word != _END_HASH)[: vocabulary - 2]
    index[common] = np.arange(2, 2 + len(common))
    index[word == _END_HASH] = END
    unigram = np.zeros(2 + len(common))
    unigram[index[index != UNKNOWN]] = count[index != UNKNOWN]
    unigram[UNKNOWN] = total["n"] - unigram[1:].sum()
    order = np.argsort(word)
    return Lexicon(word[order], count[order], index[order], len(unigram), unigram, int(total["n"]), int(total["v"]))


class Model(NamedTuple):
    """r, q: (words, size); c1, c2: (size); bias: (words)."""

    r: np.ndarray
    q: np.ndarray
    c1: np.ndarray
    c2: np.ndarray
    bias: np.ndarray

    def flat(self) -> np.ndarray:
        return np.concatenate([p.reshape(-1) for p in self]).astype(np.float64)


def _shaped(flat: np.ndarray, words: int, size: int) -> Model:
    cuts = np.cumsum([words * size, words * size, size, size])
    r, q, c1, c2, bias = np.split(flat.astype(np.float32), cuts)
    return Model(r.reshape(words, size), q.reshape(words, size), c1, c2, bias)


def start(unigram: np.ndarray, size: int, seed: int = 17) -> Model:
    """Small random vectors around the smoothed unigram model."""
    random = np.random.default_rng(seed)
    shape = (len(unigram), size)
    chance = (unigram + 0.5) / (unigram + 0.5).sum()
    ones = np.ones(size)
    return _shaped(
        np.concatenate([random.normal(0, 0.3, shape).ravel(), random.normal(0, 0.3, shape).ravel(), ones, 0.7 * ones, np.log(chance)]),
        len(unigram),
        size,
    )


def _summed(rows: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Sums of ``values`` by row number, as a dense (count, size) array."""
    order = np.argsort(rows, kind="stable")
    begin = np.flatnonzero(np.diff(rows[order], prepend=-1))
    out = np.zeros((count, values.shape[1]), dtype=np.float32)
    out[rows[order][begin]] = np.add.reduceat(values[order], begin, axis=0)
    return out


class Trainer:
    """Noise-contrastive estimation with AdaGrad, a batch of tokens at a time.

    Every token of a batch is told apart from ``noise`` words drawn from the unigram
    model, the same for the whole batch, so that all scores are matrix products.
    """

    def __init__(self, model: Model, unigram: np.ndarray, noise: int, rate: float, seed: int):
        self.p = [x.copy() for x in model]
        self.g = [np.full(x.shape, 1e-8, dtype=np.float32) for x in model]
        chance = (unigram + 0.5) / (unigram + 0.5).sum()
        self.log_noise = (np.log(chance) + math.log(noise)).astype(np.float32)
        self.cdf = np.cumsum(chance)
        self.noise, self.rate, self.random = noise, rate, np.random.default_rng(seed)
        self.seen = 0

    def step(self, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> None:
        r, q, c1, c2, bias = self.p
        n = np.minimum(np.searchsorted(self.cdf, self.random.random(self.noise)), len(self.cdf) - 1)
        qa, qb, rw, rn = q[a], q[b], r[w], r[n]
        h = qa * c1 + qb * c2
        own = np.einsum("ij,ij->i", h, rw) + bias[w] - self.log_noise[w]
        other = h @ rn.T + (bias[n] - self.log_noise[n])
        up = (1 / (1 + np.exp(np.clip(own, -30, 30)))).astype(np.float32)  # 1 - P(own is data)
        down = (-1 / (1 + np.exp(-np.clip(other, -30, 30)))).astype(np.float32)  # - P(other is data)
        dh = up[:, None] * rw + down @ rn
        words = len(bias)
        dr = _summed(w, up[:, None] * h, words)
        np.add.at(dr, n, down.T @ h)
        dbias = np.bincount(w, weights=up, minlength=words) + np.bincount(n, weights=down.sum(axis=0), minlength=words)
        dq = _summed(np.concatenate((a, b)), np.concatenate((dh * c1, dh * c2)), words)
        grads = [dr, dq, (dh * qa).sum(axis=0), (dh * qb).sum(axis=0), dbias.astype(np.float32)]
        for p, g, d in zip(self.p, self.g, grads, strict=True):
            d = d / len(w)
            g += d * d
            p += self.rate * d / np.sqrt(g)
        self.seen += len(w)


def contexts(row: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): the word before and the one before that, END where the row hasn't one."""
    a, b = np.full(len(index), END), np.full(len(index), END)
    a[1:] = np.where(row[1:] == row[:-1], index[:-1], END)
    b[2:] = np.where(row[2:] == row[:-2], index[:-2], END)
    return a, b


def _trained(lexicon: Lexicon, model: Model, noise: int, rate: float, batch_size: int):
    """(id, text) -> one row: the parameters after this task's documents, and its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(model, lexicon.unigram, noise, rate, 29)
        shuffle = np.random.default_rng(31)
        for batch in batches:
            texts = texts_of(batch.column(0))
            for first, last in blocks(texts, BLOCK):
                row, found = _tokens(texts, first, last)
                place = lexicon.find(found)
                index = np.where(place >= 0, lexicon.index[place] if len(lexicon.index) else UNKNOWN, UNKNOWN)
                a, b = contexts(row, index)
                order = shuffle.permutation(len(index))
                for at in range(0, len(order), batch_size):
                    pick = order[at : at + batch_size]
                    trainer.step(a[pick], b[pick], index[pick])
        if trainer.seen:
            flat = Model(*trainer.p).flat()
            yield pa.RecordBatch.from_arrays(
                [pa.array([trainer.seen], pa.float64()), pa.array([flat.tolist()], pa.list_(pa.float64()))],
                names=["weight", "values"],
            )

    return run


def train(
    docs: DataFrame,
    lexicon: Lexicon,
    id_col: str,
    text_col: str,
    size: int = SIZE,
    rounds: int = ROUNDS,
    noise: int = NOISE,
    rate: float = RATE,
    batch_size: int = BATCH,
) -> Model:
    """Fit the model on all documents of ``docs``, each used in one of ``rounds`` rounds.

    In a round, every task starts from the same parameters and goes once through its
    documents; the results are averaged by their numbers of tokens. Only one model's
    parameters come back to the driver.
    """
    model = start(lexicon.unigram, size)
    turn = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(rounds))
    for k in range(rounds):
        part = docs.filter(turn == k).select(F.col(text_col).alias("text"))
        fitted = part.mapInArrow(
            _trained(lexicon, model, noise, rate / (1 + k), batch_size), "weight double, values array<double>"
        )
        values = fitted.select("weight", F.posexplode("values").alias("at", "value")).groupBy("at")
        mean = values.agg((F.sum(F.col("weight") * F.col("value")) / F.sum("weight")).alias("value")).toPandas()
        if len(mean):
            flat = np.empty(len(mean))
            flat[mean["at"].to_numpy()] = mean["value"].to_numpy()
            model = _shaped(flat, lexicon.size, size)
    return model


@lru_cache(maxsize=1)
def _tables(key: bytes, words: int, size: int):
    """Exponents by a and by b, and the logarithm of every context's normaliser."""
    m = _shaped(np.frombuffer(key, dtype=np.float64), words, size)
    by_a = (m.q * m.c1) @ m.r.T
    by_b = (m.q * m.c2) @ m.r.T + m.bias
    top_a, top_b = by_a.max(axis=1, keepdims=True), by_b.max(axis=1, keepdims=True)
    by_a, by_b = by_a - top_a, by_b - top_b  # constants of a context cancel in the normaliser
    z = np.exp(by_a) @ np.exp(by_b).T
    return by_a, by_b, np.log(np.maximum(z, 1e-37))


def log_probabilities(model: Model, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Normalised natural log-probabilities of words w after contexts (a, b)."""
    by_a, by_b, log_z = _tables(model.flat().tobytes(), len(model.bias), model.r.shape[1])
    return by_a[a, w].astype(np.float64) + by_b[b, w] - log_z[a, b]


def _scored(lexicon: Lexicon, model: Model):
    """(id, held_out, text) -> the scores but for rare words, and these words with counts.

    A word outside the neural vocabulary is UNKNOWN to the model and gets UNKNOWN's
    probability times its share (c + 0.5) of such words, unseen ones being one more.
    """
    flat = model.flat().tobytes()
    rare_words = lexicon.distinct - int((lexicon.unigram[1:] > 0).sum())
    log_rest = math.log10(max(lexicon.unigram[UNKNOWN] + 0.5 * rare_words + 0.5, 0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_a, by_b, log_z = _tables(flat, len(model.bias), model.r.shape[1])
        for batch in batches:
            texts = texts_of(batch.column(2))
            for first, last in blocks(texts, BLOCK):
                n = last - first
                row, found = _tokens(texts, first, last)
                place = lexicon.find(found)
                known = place >= 0
                index = np.full(len(found), UNKNOWN)
                index[known] = lexicon.index[place[known]]
                logs = np.zeros(len(found))
                logs[known] = np.log10(lexicon.count[place[known]] + 0.5)
                a, b = contexts(row, index)
                score = (by_a[a, index].astype(np.float64) + by_b[b, index] - log_z[a, b]) / math.log(10)
                score += np.where(index == UNKNOWN, logs - log_rest, 0.0)
                rare_row, rare = row[~known], found[~known]
                order = np.lexsort((rare, rare_row))
                rr, rw = rare_row[order], rare[order]
                new = np.ones(len(rr), dtype=bool)
                new[1:] = (rr[1:] != rr[:-1]) | (rw[1:] != rw[:-1])
                at = np.flatnonzero(new)
                offsets = pa.array(np.searchsorted(rr[at], np.arange(n + 1)).astype(np.int32))
                times = np.diff(np.append(at, len(rr)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        batch.column(1).slice(first, n),
                        pa.array(np.bincount(row, minlength=n).astype(np.int64)),
                        pa.array(np.bincount(row, weights=known, minlength=n).astype(np.int64)),
                        pa.array(np.bincount(row, weights=logs, minlength=n)),
                        pa.array(np.bincount(row, weights=score, minlength=n)),
                        pa.ListArray.from_arrays(offsets, pa.array(rw[at].view(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                    ],
                    names=["long_id", "held_out", "n_tokens", "n_known", "logs", "score", "rare", "times"],
                )

    return run


_SCORED = (
    "long_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, "
    "rare array<long>, times array<int>"
)


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: int = VOCABULARY,
    direct: int = DIRECT,
    stages: Stages | None = None,
    **training,
) -> DataFrame:
    """One row per document: held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, then one END. The
    model learns from documents that aren't held out (see ``held_out``; a null id is
    not). ``base_score`` is the sum over tokens of log10((c + 0.5) / (N + 0.5 (V + 1)));
    ``score`` the log-bilinear model's log10 probability, normalised over all words.

    Counts of all training words are kept in a table; the ``direct`` commonest go to
    every task, the others are joined by word, which no word of them can make hot. A
    null or empty text is END alone. Ids may be null or repeat: every row is scored.
    Other columns are not read. No rows give no rows; without training documents the
    base is 0 and the model knows UNKNOWN and END only. Words are told apart by 64-bit
    hashes.
    """
    stages = stages or Stages(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("long_id"),
        held_out(F.col(id_col)).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    learnt = rows.filter("not held_out")
    counts = learnt.select("text").mapInArrow(_counted, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))
    counts = stages.keep(counts, "counts")
    lexicon = lexicon_of(counts, vocabulary, direct)
    model = train(learnt, lexicon, "long_id", "text", **training)
    scored = rows.mapInArrow(_scored(lexicon, model), _SCORED)
    scored = stages.keep(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w"))
    rare = rare.select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("k"))
    with_counts = rare.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    sums = with_counts.groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.col("c") + 0.5)).alias("rare_logs"),
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("rare_known"),
    )
    log_all = math.log10(lexicon.tokens + 0.5 * (lexicon.distinct + 1))
    more = F.coalesce("rare_logs", F.lit(0.0))
    # of the rare words, only the counts' logarithms are missing so far
    out = scored.drop("rare", "times").join(sums, "row", "left")
    return out.select(
        F.col("long_id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * log_all).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )


@query("op8_lm_score")
def op8_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return score(table(spark, folder, "documents"))
