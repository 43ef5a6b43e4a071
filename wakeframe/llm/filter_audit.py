"""How filters interact: who removes what in every order, by min-plus removal ranks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeframe.llm.suite import query, table
from wakeframe.llm.words import blocks, texts_of, words_of
from wakeframe.session import Stages

MIN_WORDS = 50
MIN_DISTINCT = 65  # per cent of the words
MAX_CAPITALS = 5  # per cent of the characters
SYMBOLS = b"#$%&*|"
MOST_FILTERS = 6  # 720 orders
SCATTERED = 1000  # rows that a task scatters at a time
NEVER = 99  # step of a removal that doesn't happen

_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[65:91] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_BEGINS = (np.arange(256) & 0xC0) != 0x80  # first byte of a character


def _per_row(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Number of set bytes in each row's range."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[end] - sums[start]


def text_failures(texts, first: int, last: int) -> np.ndarray:
    """Rows x 4: too few words, too few distinct ones, too many capitals, a symbol."""
    n = last - first
    words = words_of(texts, first, last)
    row = words.row - first
    count = np.bincount(row, minlength=n)
    order = np.lexsort((words.hash, row))
    new = np.ones(len(row), dtype=bool)
    new[1:] = (np.diff(row[order]) != 0) | (np.diff(words.hash[order]) != 0)
    distinct = np.bincount(row[order][new], minlength=n)
    low, high = int(texts.start[first]), int(texts.end[first:last].max())
    data = texts.data[low : max(low, high)]
    start, end = texts.start[first:last] - low, texts.end[first:last] - low
    capitals, points = _per_row(_CAPITAL[data], start, end), _per_row(_BEGINS[data], start, end)
    return np.stack(
        [
            count < MIN_WORDS,
            100 * distinct < MIN_DISTINCT * count,
            100 * capitals > MAX_CAPITALS * points,
            _per_row(_SYMBOL[data], start, end) > 0,
        ],
        axis=1,
    )


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, part, text, digest) -> (id, part, digest, bits): which of the first four filters fail."""
    for batch in batches:
        texts = texts_of(batch.column(2))
        for first, last in blocks(texts):
            fails = text_failures(texts, first, last) @ np.array([1, 2, 4, 8])
            kept = [batch.column(c).slice(first, last - first) for c in (0, 1, 3)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(fails.astype(np.int32))], ["id", "part", "digest", "bits"])


def document_failures(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
    stages: Stages | None = None,
) -> DataFrame:
    """Which of five filters documents fail: part, A..E, good, toxic, n (rows alike in all, id and text too).

    A: under 50 words; B: under 65 distinct of 100 words; C: over 5 ASCII capitals of
    100 characters; D: one of ``#$%&*|``; E: a smaller id has the same text, whatever
    the part. A null text is an empty one, a null part the empty string. Rows that
    repeat an id and a text are counted each; none of them is smaller than another. A
    null id is smaller than none, has no smaller one and no label. ``labels`` may repeat
    an id: one row that says so makes it good (quality 1) or toxic (toxic 1). Other
    columns are not read. No documents give no rows.

    Texts are known by SHA-256, words within a text by 64-bit hashes. After the scan
    only ids, digests and flags move; rows that agree in all are counted first, so that a
    text of any number of copies is a few rows a task.
    """
    stages = stages or Stages(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    ).mapInArrow(_bits, "id long, part string, digest binary, bits int")
    rows = stages.keep(rows.groupBy("id", "part", "digest", "bits").agg(F.count(F.lit(1)).alias("n")), "failures")
    firsts = rows.groupBy("digest").agg(F.min("id").alias("id")).filter("id is not null").withColumn("first", F.lit(True))
    said = labels.select(
        F.col("doc_id").cast("long").alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")
    )
    said = said.filter("id is not null and (good or toxic)").groupBy("id").agg(*[
        F.max(F.coalesce(c, F.lit(False))).alias(c) for c in ("good", "toxic")
    ])
    no = F.lit(False)
    named = rows.filter("id is not null").join(firsts, ["digest", "id"], "left").join(said, "id", "left")
    known = named.select(
        "part", "bits", F.col("first").isNull().alias("E"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"), "n"
    )
    unnamed = rows.filter("id is null").select("part", "bits", no.alias("E"), no.alias("good"), no.alias("toxic"), "n")
    four = [(F.col("bits").bitwiseAND(1 << i) != 0).alias(c) for i, c in enumerate("ABCD")]
    return known.unionByName(unnamed).select("part", *four, "E", "good", "toxic", "n")


@lru_cache(maxsize=4)
def orders_of(filters: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All orders, the filter at each step (orders x filters), and its inverse: the step of each filter."""
    at = np.array(list(permutations(range(len(filters)))), dtype=np.int64).reshape(-1, len(filters))
    step = np.argsort(at, axis=1) + 1
    return ["".join(filters[i] for i in row) for row in at], at, step


def removal_steps(fails: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Min-plus product of masks (rows x filters) and positions (orders x filters): rows x orders.

    A failed filter costs 0, a passed one infinity; the least sum of cost and position
    is the step that removes the row.
    """
    cost = np.where(fails, 0, NEVER)
    out = np.full((len(fails), len(step)), NEVER, dtype=np.int64)
    for f in range(fails.shape[1]):
        np.minimum(out, cost[:, f, None] + step[None, :, f], out=out)
    return np.minimum(out, NEVER)


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _scattered(filters: str):
    """(part, one flag a filter, good, toxic, n) -> partial counts per part, order and step."""
    size = len(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, at, step = orders_of(filters)
        orders = len(names)
        order_no = np.arange(orders)
        slices = (b.slice(at, SCATTERED) for b in batches for at in range(0, b.num_rows, SCATTERED))
        for batch in slices:
            coded = batch.column(0).dictionary_encode()
            part, parts = coded.indices.to_numpy(), len(coded.dictionary)
            fails = np.stack([batch.column(1 + f).to_numpy(zero_copy_only=False) for f in range(size)], axis=1).astype(bool)
            good, toxic = (batch.column(1 + size + k).to_numpy(zero_copy_only=False).astype(bool) for k in (0, 1))
            n = batch.column(3 + size).to_numpy()
            removal = removal_steps(fails, step)
            total = np.zeros(parts, dtype=np.int64)
            np.add.at(total, part, n)
            # removed rows by part, order and step, each with its weight
            row, order = np.nonzero(removal < NEVER)
            place = (part[row], order, removal[row, order] - 1)
            removed, good_lost, toxic_lost = (np.zeros((parts, orders, size), dtype=np.int64) for _ in range(3))
            for out, weight in ((removed, n), (good_lost, n * good), (toxic_lost, n * toxic)):
                np.add.at(out, place, weight[row])
            failing, unique = (np.zeros((parts, size), dtype=np.int64) for _ in range(2))
            alone = fails & (fails.sum(axis=1, keepdims=True) == 1)
            for f in range(size):
                np.add.at(failing[:, f], part, n * fails[:, f])
                np.add.at(unique[:, f], part, n * alone[:, f])
            kept = total[:, None, None] - np.cumsum(removed, axis=2)
            redundant = failing[:, at] - removed  # failing a filter, but not removed by it
            share = np.zeros((parts, size), dtype=np.int64)
            for f in range(size):
                share[:, f] = removed[:, order_no, step[:, f] - 1].sum(axis=1)
            columns = [kept, removed, redundant, unique[:, at], good_lost, toxic_lost, share[:, at]]
            yield pa.RecordBatch.from_arrays(
                [
                    coded.dictionary.take(pa.array(np.repeat(np.arange(parts), orders * size))),
                    pa.array(np.tile(np.repeat(np.array(names, dtype=object), size), parts), pa.string()),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), parts * orders)),
                    *[pa.array(c.reshape(-1)) for c in columns],
                ],
                names=["part", "filter_order", "step", *COUNTS],
            )

    return run


def interactions(failures: DataFrame, filters: Sequence[str]) -> DataFrame:
    """Per part, order of ``filters`` and step, what the filter of that step does.

    ``failures``: part (string), one boolean column per filter (one letter each, six
    at most; null: passes), good, toxic (boolean) and n (long), the number of documents
    with these values. Columns: part, filter_order, step, kept (after the step), removed
    (by it), redundant (fail its filter, gone before), unique_fails (fail it alone),
    good_lost, toxic_lost (removed by it), and shapley (removed by its filter, summed
    over all orders). Every part has a row for every order and step, zeros included.

    Rows are added up by part and flags first. That leaves at most 2 ** (filters + 2) rows
    a part, so a part can go to one task, whatever its share of the documents. Counts are
    sums over rows: what a task scatters in several goes is added up at the end.
    """
    if not 1 <= len(filters) <= MOST_FILTERS or any(len(f) != 1 for f in filters):
        raise ValueError(f"one to {MOST_FILTERS} filters of one letter each")
    flags = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in (*filters, "good", "toxic")]
    rows = failures.select(F.coalesce("part", F.lit("")).alias("part"), *flags, F.col("n").cast("long"))
    counts = rows.groupBy("part", *filters, "good", "toxic").agg(F.sum("n").alias("n")).repartition("part")
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)
    partial = counts.mapInArrow(_scattered("".join(filters)), schema)
    return partial.groupBy("part", "filter_order", "step").agg(*[F.sum(c).alias(c) for c in COUNTS])


@query(
    "op13_filter_audit",
    """
    WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
                 min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
    l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    f AS (SELECT part, map {
            'A': len(words) < 50,
            'B': 100 * len(list_distinct(words)) < 65 * len(words),
            'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
            'D': regexp_matches(t, '[#$%&*|]'),
            'E': coalesce(first_id < w.doc_id, false)} AS fails,
            coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
          FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
    m AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
    one AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
          FROM one a, one b, one c, one d, one e
          WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    r AS (SELECT part, filter_order, fails, good, toxic, n,
                 list_min([coalesce(nullif(fails[filter_order[i]]::INT * i, 0), 99) FOR i IN [1, 2, 3, 4, 5]]) AS gone
          FROM m, o),
    s AS (SELECT part, filter_order, step::INT AS step, filter_order[step] AS letter,
                 sum(n * (gone > step)::INT) AS kept, sum(n * (gone = step)::INT) AS removed,
                 sum(n * (fails[filter_order[step]] AND gone < step)::INT) AS redundant,
                 sum(n * (fails[filter_order[step]] AND list_sum([v::INT FOR v IN map_values(fails)]) = 1)::INT) AS unique_fails,
                 sum(n * (gone = step AND good)::INT) AS good_lost, sum(n * (gone = step AND toxic)::INT) AS toxic_lost
          FROM r, unnest([1, 2, 3, 4, 5]) AS u(step) GROUP BY ALL)
    SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
           unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
           (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
    FROM s
    """,
)
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return interactions(document_failures(table(spark, folder, "documents"), table(spark, folder, "labels")), "ABCDE")
