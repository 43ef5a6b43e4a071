"""Near-duplicate documents by BagMinHash over multisets of five-word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeframe.llm import bagminhash
from wakeframe.llm.linking import Compare, linked
from wakeframe.llm.suite import query, table
from wakeframe.llm.words import blocks, grams, mixed, seeds, texts_of, words_of
from wakeframe.session import Stages

WORDS = 5
SIMILARITY = 0.8
ROWS = 5
BANDS = 20

_CONTENT = "long_id long, tag long, node long, bands array<long>"


SIGNED_BLOCK = 2 << 20  # bytes of text signed together


def _bags(row: np.ndarray, gram: np.ndarray, first: int):
    """Distinct (bag, element) with their counts, sorted by bag and element.

    An element is the upper 48 bits of a gram's hash, so that it sorts as one integer
    with its bag; a block has fewer than 65,536 rows.
    """
    key = np.sort(((row - first).astype(np.uint64) << np.uint64(48)) | (gram >> np.uint64(16)))
    new = np.ones(len(key), dtype=bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    at = np.flatnonzero(new)
    key = key[at]
    bag = (key >> np.uint64(48)).astype(np.int64)
    return bag, key & np.uint64((1 << 48) - 1), np.diff(np.append(at, len(new)))


def _signed(rows: int, count: int, words: int):
    """(id, tag, text) -> (id, tag, node, bands); node is a 64-bit hash of the words in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(2))
            for first, last in blocks(texts, SIGNED_BLOCK):
                found = words_of(texts, first, last)
                row, gram = grams(found, words)
                bag, element, weight = _bags(row, gram, first)
                n = last - first
                keys = bagminhash.bands(bagminhash.signatures(bag, element, weight, n, rows * count), rows)
                has = np.bincount(bag, minlength=n) > 0
                # the node hashes the sequence: position times word, summed without order of evaluation
                start = np.searchsorted(found.row, np.arange(first, last))
                place = (np.arange(len(found.row)) - start[found.row - first]).astype(np.uint64)
                node = np.zeros(n, dtype=np.uint64)
                np.add.at(node, found.row - first, mixed(found.hash + mixed(place + seeds(1, 77)[0])))
                node = mixed(node + np.bincount(found.row - first, minlength=n).astype(np.uint64))
                offsets = np.concatenate(([0], np.cumsum(np.where(has, count, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        batch.column(1).slice(first, n),
                        pa.array(node.view(np.int64), mask=~has),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[has].reshape(-1).view(np.int64))),
                    ],
                    names=["long_id", "tag", "node", "bands"],
                )

    return run


def _gram_lists(words: int):
    """(node, text) -> (node, grams): the text's gram hashes, sorted, as bytes.

    The k-th repeat of a gram gets a hash of its own, so that the overlap of two
    multisets is that of two sets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for first, last in blocks(texts):
                row, gram = grams(words_of(texts, first, last), words)
                order = np.lexsort((gram, row))
                row, gram = row[order], gram[order]
                new = np.ones(len(row), dtype=bool)
                new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
                start = np.flatnonzero(new)
                repeat = np.arange(len(row)) - np.repeat(start, np.diff(np.append(start, len(row))))
                gram = np.where(repeat > 0, mixed(gram + repeat.astype(np.uint64)), gram)
                order = np.lexsort((gram, row))
                gram, cut = gram[order], np.searchsorted(row, np.arange(first, last + 1))
                lists = [gram[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(lists, pa.binary())], names=["node", "grams"]
                )

    return run


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Common values of two arrays of distinct values."""
    both = np.sort(np.concatenate((x, y)))
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _sets(column: pa.Array, i: int) -> np.ndarray:
    return np.frombuffer(column[i].as_buffer(), np.uint64)


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, x, y) -> (a, b, na, nb, both)"""
    for batch in batches:
        out = np.zeros((3, batch.num_rows), dtype=np.int64)
        for i in range(batch.num_rows):
            x, y = _sets(batch.column(2), i), _sets(batch.column(3), i)
            out[:, i] = len(x), len(y), overlap(x, y)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *map(pa.array, out)], names=["a", "b", "na", "nb", "both"]
        )


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, leader, root, x, y) -> (node, leader, root, member) for the members that only one of x and y has."""
    for batch in batches:
        found = [
            np.setxor1d(_sets(batch.column(3), i), _sets(batch.column(4), i), assume_unique=True) for i in range(batch.num_rows)
        ]
        times = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
        member = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
        columns = [batch.column(c).take(times) for c in range(3)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(member)], names=["node", "leader", "root", "member"])


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    words: int = WORDS,
    bands: int = BANDS,
    rows: int = ROWS,
    stages: Stages | None = None,
) -> DataFrame:
    """One row per document: its id, ``tag`` (hash of its text), ``class_id`` and ``kept``.

    Two texts are linked when the multisets of their ``words``-word shingles have a
    weighted Jaccard similarity of at least ``similarity``; candidates share one of
    ``bands`` bands of ``rows`` BagMinHash components (at the defaults, 99.96 % of the
    pairs just at 0.8 do), and each candidate's overlap is computed exactly. A class
    is a connected component; ``class_id`` is its smallest id and ``kept`` marks one
    row of it, the first that carries this id. Equal word sequences are one node from the start, so copies
    never meet pairwise.

    Texts of fewer than ``words`` words are one shingle of all their words. A null,
    empty or blank text has no shingle: it is its own class and kept. A null id takes
    part but never names a class that has another id; of a class whose ids are all null
    the first row is kept. Which of the rows that repeat an id comes first depends on
    the order in which they are read. Other columns of ``docs`` are not read. An empty
    table gives no rows. Nodes are 64-bit hashes: of ten billion distinct texts about
    three pairs would be taken for one.
    """
    stages = stages or Stages(docs.sparkSession)
    source = docs.select(
        F.col(id_col).cast("long").alias("long_id"), F.xxhash64(text_col).alias("tag"), F.col(text_col).alias("text")
    )
    signed = source.mapInArrow(_signed(rows, bands, words), _CONTENT)
    signed = stages.keep(signed.withColumn("row", F.monotonically_increasing_id()), "signed")
    texts = signed.filter("node is not null")
    # copies carry equal bands, so any of them will do
    one = texts.groupBy("node").agg(F.min(F.struct("tag", "long_id")).alias("of"), F.first("bands").alias("bands"))
    nodes = stages.keep(one.select("node", "of.tag", "of.long_id", "bands"), "nodes")
    members = nodes.select(F.explode("bands").alias("bucket"), "node")

    def ready(shared: DataFrame):
        where = stages.keep(nodes.select("node", "tag", "long_id").join(shared, "node"), "wanted")
        # what is wanted grows with the corpus: never a broadcast
        found = source.join(where.hint("merge"), (source.tag == where.tag) & source.long_id.eqNullSafe(where.long_id))
        lists = found.select("node", "text").mapInArrow(_gram_lists(words), "node long, grams binary")
        lists = stages.keep(lists.dropDuplicates(["node"]), "grams")

        def sets(rows: DataFrame, one: str, other: str) -> DataFrame:
            joined = rows.join(lists.toDF(one, "x"), one).join(lists.toDF(other, "y"), other)
            return joined.select(one, other, *[c for c in rows.columns if c not in (one, other)], "x", "y")

        return Compare(
            lambda pairs: sets(pairs, "a", "b").mapInArrow(_overlaps, "a long, b long, na long, nb long, both long"),
            lambda rows: sets(rows, "node", "leader").mapInArrow(_differences, "node long, leader long, root long, member long"),
        )

    root = linked(members, ready, similarity, stages)
    rooted = texts.select("long_id", "tag", "row", "node").join(root, "node", "left")
    rooted = stages.keep(
        rooted.select("long_id", "tag", "row", F.coalesce("root", "node").alias("root")), "rooted"
    )
    first = F.min(F.struct(F.col("long_id").isNull().alias("unnamed"), "long_id", "row")).alias("first")
    named = rooted.groupBy("root").agg(F.min("long_id").alias("class_id"), F.count("*").alias("n"), first)
    named = stages.keep(named.select("root", "class_id", "n", F.col("first.row").alias("first")), "named").filter("n > 1")
    joined = rooted.join(named, "root", "left").select(
        "long_id",
        "tag",
        F.coalesce("class_id", "long_id").alias("class_id"),
        F.coalesce(F.col("row") == F.col("first"), F.lit(True)).alias("kept"),
    )
    alone = signed.filter("node is null").select("long_id", "tag", F.col("long_id").alias("class_id"), F.lit(True).alias("kept"))
    return joined.unionByName(alone).withColumnRenamed("long_id", id_col)


def free(df: DataFrame, name: str) -> str:
    """A column name that ``df`` hasn't, in either case of letters."""
    taken = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(docs: DataFrame, dropped: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` whose id and text tag are not in ``dropped`` (id_col, tag)."""
    i, t = free(docs, "id"), free(docs, "tag")
    gone = dropped.select(F.col(id_col).alias(i), F.col("tag").alias(t)).distinct()
    hit: Column = F.xxhash64(F.col(text_col)).eqNullSafe(F.col(t)) & F.col(id_col).cast("long").eqNullSafe(F.col(i))
    return docs.join(gone, hit, "left_anti")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeats: bool = True, **options
) -> DataFrame:
    """``docs`` with one document of each class of near duplicates, all columns kept.

    Nulls, empty texts and ties are as in ``near_classes``. Rows that repeat the id and
    the text of the kept row stay with it; without ``repeats`` one of them stays.
    """
    stages = Stages(docs.sparkSession)
    classes = near_classes(docs, id_col, text_col, stages=stages, **options)
    kept = F.col("kept").cast("int")
    pairs = classes.groupBy(id_col, "tag").agg(F.sum(kept).alias("k"), F.sum(1 - kept).alias("d")).filter("d > 0")
    pairs = stages.keep(pairs, "dropped")
    again = pairs.filter("k > 0")
    if repeats or again.isEmpty():
        return without(docs, pairs.filter("k = 0"), id_col, text_col)
    marks = {free(docs, "id"): F.col(id_col).cast("long"), free(docs, "tag"): F.xxhash64(F.col(text_col))}
    marked, some = docs.withColumns(marks), again.select(F.col(id_col).alias("i"), F.col("tag").alias("t"))
    by_id, by_tag = (marked[c] for c in marks)
    some = some.toDF(*[free(marked, c) for c in ("i", "t")])
    hit = by_tag.eqNullSafe(some[some.columns[1]]) & by_id.eqNullSafe(some[some.columns[0]])
    one = marked.join(some, hit, "left_semi").dropDuplicates(list(marks)).select(*docs.columns)
    return without(docs, pairs, id_col, text_col).unionByName(one)


@query(
    "op1_near_dedup",
    """
    WITH RECURSIVE w AS (
      SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS l
      FROM documents),
    g AS (
      SELECT doc_id, CASE WHEN len(l) < 5 THEN array_to_string(l, ' ')
                          ELSE array_to_string(l[i:i + 4], ' ') END AS s
      FROM w, unnest(generate_series(1, greatest(len(l) - 4, 1))) AS t(i) WHERE len(l) > 0),
    c AS (SELECT doc_id, s, count(*) AS n FROM g GROUP BY ALL),
    t AS (SELECT doc_id, sum(n) AS total FROM c GROUP BY ALL),
    p AS (SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.n, y.n)) AS shared
          FROM c x JOIN c y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
    e AS (SELECT a, b FROM p JOIN t u ON u.doc_id = a JOIN t v ON v.doc_id = b
          WHERE shared >= 0.8 * (u.total + v.total - shared)),
    r AS (SELECT doc_id AS a, doc_id AS b FROM documents
          UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
    SELECT a AS doc_id, min(b) AS class_id, a = min(b) AS kept FROM r GROUP BY a
    """,
)
def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_classes(table(spark, folder, "documents")).select("doc_id", "class_id", "kept")
