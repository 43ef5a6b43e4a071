"""Quality of documents by weak supervision: rules vote, EM weighs them, posteriors decide."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeframe.llm.rows import annotated
from wakeframe.llm.suite import query, table
from wakeframe.llm.words import Texts, grams, words_of
from wakeframe.session import Stages

# Fixed values of the base counts.
SYMBOLS = b"#*$%&|<>"
REPEAT_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES += ["n_upper", "n_punct", "n_digits", "n_lines", "n_letters", "n_distinct"]

_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[list(SYMBOLS)] = 1
_CLASS[list(range(65, 91))] = 2
_CLASS[list(b"!?;:,.\"'()")] = 3
_CLASS[list(range(48, 58))] = 4
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]] = True
_LEAD = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point


def _per_row(mask: np.ndarray, texts: Texts, first: int, last: int) -> np.ndarray:
    """How many marked bytes each row first..last has."""
    low = int(texts.start[first])
    sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return sums[texts.end[first:last] - low] - sums[np.minimum(texts.start[first:last], texts.end[first:last]) - low]


def _dup_lines(texts: Texts, first: int, last: int) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row."""
    out = np.zeros(last - first, dtype=np.int64)
    for i in range(first, last):
        text = texts.data[texts.start[i] : texts.end[i]].tobytes()
        lines = [line for line in text.split(b"\n") if line.split()]
        out[i - first] = len(lines) - len(set(lines))
    return out


def _repeated(row: np.ndarray, gram: np.ndarray, words_row: np.ndarray, n: int) -> np.ndarray:
    """Marks the words inside windows of n words that their row has twice or more."""
    order = np.lexsort((gram, row))
    r, g = row[order], gram[order]
    same = (r[1:] == r[:-1]) & (g[1:] == g[:-1])
    twice = np.zeros(len(r), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros(len(row), dtype=bool)
    hit[order] = twice
    # window k of a row begins at that row's k-th word
    begin = np.searchsorted(words_row, row)
    place = np.arange(len(row)) - np.searchsorted(row, row)
    at = (begin + place)[hit]
    change = np.zeros(len(words_row) + 1, dtype=np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + n, -1)
    return np.cumsum(change[:-1]) > 0


def _measured(texts: Texts, first: int, last: int) -> list[np.ndarray]:
    """The measures of a range of texts."""
    n = last - first
    words = words_of(texts, first, last)
    at = words.row - first
    low, high = int(texts.start[first]), int(texts.end[last - 1])
    data = texts.data[low : max(low, high)]
    kind = _CLASS[data]
    n_words = np.bincount(at, minlength=n)
    inside = np.concatenate(([0], np.cumsum(_LEAD[data], dtype=np.int64)))
    chars = np.zeros(n, dtype=np.int64)
    np.add.at(chars, at, inside[words.end - low] - inside[words.start - low])
    row, gram = grams(words, REPEAT_WORDS)
    whole = n_words[row - first] >= REPEAT_WORDS
    marks = np.zeros(len(at), dtype=bool)
    if whole.any():
        marks = _repeated(row[whole], gram[whole], words.row, REPEAT_WORDS)
    order = np.lexsort((words.hash, at))
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[order][1:] != at[order][:-1]) | (words.hash[order][1:] != words.hash[order][:-1])
    values = [
        n_words,
        chars,
        _per_row(kind == 1, texts, first, last),
        _dup_lines(texts, first, last),
        np.bincount(at, weights=marks, minlength=n),
        _per_row(kind == 2, texts, first, last),
        _per_row(kind == 3, texts, first, last),
        _per_row(kind == 4, texts, first, last),
        _per_row(data == 10, texts, first, last) + (texts.end[first:last] > texts.start[first:last]),
        _per_row(_LETTER[data], texts, first, last),
        np.bincount(at[order][new], minlength=n),
    ]
    return [v.astype(np.int64) for v in values]


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(long_id, tag, counts) of every whole text; a null text counts as empty.

    A word is ``[^\\x20\\x09-\\x0D]+``. ``word_chars``: code points in words.
    ``n_symbols``: characters of ``#*$%&|<>``. ``n_dup_lines``: lines with a word that
    equal an earlier line. ``n_repeat_words``: words in windows of eight words that
    the text has twice or more, the first time included.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("long_id"), F.xxhash64(text_col).alias("tag"), F.col(text_col).alias("text")
    )
    return _annotated(rows, "text")[0].drop("text")


def _annotated(docs: DataFrame, text_col: str):
    return annotated(docs, text_col, _measured, [(name, "long") for name in MEASURES])


class Rule(NamedTuple):
    """A rule votes 'bad' where ``bad`` holds, 'good' where ``good`` holds, else abstains."""

    name: str
    bad: Column
    good: Column


def rules() -> list[Rule]:
    """The rules, on the measures of a document."""
    words = F.greatest("n_words", F.lit(1))
    letters = F.greatest("n_letters", F.lit(1))
    share = lambda c, of: F.col(c) / of
    mean = F.col("word_chars") / words
    never = F.lit(False)
    return [
        Rule("symbols", share("n_symbols", words) > 0.2, share("n_symbols", words) < 0.02),
        Rule("capitals", share("n_upper", letters) > 0.4, never),
        Rule("repeats", share("n_repeat_words", words) > 0.25, never),
        Rule("word_length", (mean < 2.5) | (mean > 12.0), never),
        Rule("punctuation", share("n_punct", words) > 0.6, never),
        Rule("digits", share("n_digits", F.greatest("word_chars", F.lit(1))) > 0.3, never),
        Rule("lines", share("n_dup_lines", F.greatest("n_lines", F.lit(1))) > 0.4, never),
        # the number of distinct words grows at least with the root of a text's length
        Rule("variety", F.col("n_distinct") < 2 * F.sqrt(words), never),
    ]


def votes(measured: DataFrame, which: list[Rule]) -> DataFrame:
    """Adds ``votes``, a string with b, g or - for each rule."""
    ballot = [F.when(r.bad, "b").when(r.good, "g").otherwise("-") for r in which]
    return measured.withColumn("votes", F.concat(*ballot))


def fit(
    patterns: dict[str, int],
    prior: float = 0.85,
    belief: float = 0.05,
    false_alarms: float = 0.005,
    rounds: int = 200,
) -> dict[str, float]:
    """Posterior probability of good for each vote pattern, by expectation-maximisation.

    The model: a document is good with an unknown probability, and given that, every
    rule votes bad, good or abstains independently with its own probabilities. The
    first guess is that each rule catches a quarter of the bad documents and is seldom
    wrong about them, and a share
    ``belief`` of the documents counts as evidence for that guess, so that the classes
    can't swap nor drift to some other trait. Rules are written to spare good
    documents: a bad vote is never believed to hit more than ``false_alarms`` of them. ``patterns`` holds at most 3 ** rules entries, whatever the corpus.
    """
    if not patterns:
        return {}
    keys = sorted(patterns)
    weight = np.array([patterns[k] for k in keys], dtype=float)
    ballot = np.array([["bg-".index(c) for c in k] for k in keys])
    hot = np.eye(3)[ballot]  # pattern, rule, vote
    # P(vote | class): class 0 bad, 1 good
    guess = np.array([[0.25, 0.10, 0.65], [0.005, 0.395, 0.60]])
    table_ = np.repeat(guess[:, None, :], ballot.shape[1], axis=1)
    good = prior
    for _ in range(rounds):
        log = np.einsum("prv,crv->pc", hot, np.log(table_)) + np.log([1 - good, good])
        post = np.exp(log - log.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
        mass = post * weight[:, None]
        seen = np.einsum("prv,pc->crv", hot, mass) + belief * weight.sum() * guess[:, None, :]
        table_ = seen / seen.sum(axis=2, keepdims=True)
        table_[1, :, 0] = np.minimum(table_[1, :, 0], false_alarms)
        table_[1] /= table_[1].sum(axis=1, keepdims=True)
        good = min(max(float(mass[:, 1].sum() / weight.sum()), 0.05), 0.95)
    return dict(zip(keys, post[:, 1].tolist(), strict=True))


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.5,
    stages: Stages | None = None,
) -> DataFrame:
    """One row per document: ``measures``, base_failed, votes, ``quality`` and kept.

    Fewer than 20 words, or more than 30 % of the words in repeated windows, fail the
    base (so do null, empty and blank texts). All other documents vote; vote patterns
    are counted over the whole table, EM runs on the counts, and a document is kept
    when its posterior probability of being good is at least ``threshold``. ``quality``
    is null where the base failed. Ids may be null or repeat: rows are judged one by
    one, equal texts alike. Other columns are not read. An empty table gives no rows.
    """
    stages = stages or Stages(docs.sparkSession)
    voted = stages.keep(_voted(measures(docs, id_col, text_col)), "votes")
    judged = _decided(voted, threshold)
    return judged.select(
        F.col("long_id").alias(id_col), "tag", *MEASURES, "base_failed", "votes", "quality", "kept"
    )


def _voted(measured: DataFrame) -> DataFrame:
    """Adds base_failed and votes to rows with measures."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return votes(measured.withColumn("base_failed", failed), rules())


def _decided(voted: DataFrame, threshold: float) -> DataFrame:
    """Adds quality and kept, from the vote patterns of all rows."""
    counted = voted.filter("not base_failed").groupBy("votes").count().collect()  # at most 3 ** rules rows
    posterior = fit({r["votes"]: r["count"] for r in counted})
    known = voted.sparkSession.createDataFrame(list(posterior.items()), "votes string, quality double")
    scored = voted.join(F.broadcast(known), "votes", "left")
    scored = scored.withColumn("quality", F.when(~F.col("base_failed"), F.col("quality")))
    return scored.withColumn("kept", F.coalesce(F.col("quality") >= threshold, F.lit(False)))


def keep_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns; cases are as there."""
    plain = [f"__c{i}" for i in range(len(docs.columns))]  # no measure has such a name
    measured, _ = _annotated(docs.toDF(*plain), plain[docs.columns.index(text_col)])
    voted = Stages(docs.sparkSession).keep(_voted(measured).select(*plain, "base_failed", "votes"), "votes")
    return _decided(voted, threshold).filter("kept").select(*plain).toDF(*docs.columns)


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge(table(spark, folder, "documents"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return judged.select(*base, "kept", "votes", "quality")
