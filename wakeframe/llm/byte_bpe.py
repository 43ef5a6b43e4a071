"""Byte-level BPE by overlapping chunks, and back.

The split pattern looks ahead but never back, so a match depends only on the text
from where it begins. Long texts are cut into overlapping chunks that are split
independently; a chunk's splits are right from the first place in the overlap where
both neighbours begin a match, since from there on both read the same text. The text
is cut at those places, behind a character that isn't white space, and the pieces are
encoded apart.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeframe.llm.suite import query, table
from wakeframe.llm.words import BLOCK, blocks, texts_of
from wakeframe.session import Stages

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
CHUNK = 1 << 16  # characters
OVERLAP = 1 << 10

_IDS = "array<int>"


def read_ranks(path: str) -> bytes:
    """The rank file's bytes, read where the query is planned and sent to the tasks (under 1 MB)."""
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=2)
def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


@lru_cache(maxsize=2)
def _splitter(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def _encoded(ranks: bytes, pattern: str, names: list[str]):
    """Replace the last column, a text, by its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks, pattern)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for first, last in blocks(texts_of(texts), BLOCK):
                part = batch.slice(first, last - first)
                found = [coder.encode_to_numpy(text.as_py() or "") for text in part.column(part.num_columns - 1)]
                offsets = np.concatenate(([0], np.cumsum([len(ids) for ids in found]))).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.uint32), *found]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids], names=names)

    return run


def _chunks(size: int, overlap: int):
    """(long_id, tag, text) -> a row per chunk with its neighbour's first characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(2)[i].as_py()
                for at in range(0, len(text), size):
                    part = text[at : at + size + overlap]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "long_id": batch.column(0).slice(i, 1),
                            "tag": batch.column(1).slice(i, 1),
                            "start": pa.array([at], pa.int64()),
                            "ends_text": pa.array([at + len(part) == len(text)]),
                            "part": pa.array([part]),
                        }
                    )

    return run


def _edges(pattern: str, size: int, overlap: int):
    """Chunk -> places where a match begins, in the overlap with the chunk before and after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _splitter(pattern)
        for batch in batches:
            heads, tails = [], []
            starts, ends, parts = (batch.column(c).to_pylist() for c in (2, 3, 4))
            for start, ends_text, part in zip(starts, ends, parts, strict=True):
                head, tail, trusted = [], [], True
                for match in split.finditer(part):
                    if match.end() == len(part) and not ends_text:
                        trusted = False  # the chunk's end may have cut this match
                    if match.start() and part[match.start() - 1].isspace():
                        continue  # white space before a cut would look for what follows it
                    if match.start() < overlap:
                        head.append(start + match.start())
                    if match.start() >= size and trusted:
                        tail.append(start + match.start())
                heads.append(head)
                tails.append(tail)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(heads, kind), pa.array(tails, kind)],
                names=["long_id", "tag", "start", "heads", "tails"],
            )

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(long_id, tag, cuts, text) -> a row per piece between cuts."""
    for batch in batches:
        for i in range(batch.num_rows):
            text = batch.column(3)[i].as_py()
            cuts = [0, *batch.column(2)[i].as_py(), len(text)]
            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                yield pa.RecordBatch.from_pydict(
                    {
                        "long_id": batch.column(0).slice(i, 1),
                        "tag": batch.column(1).slice(i, 1),
                        "piece": pa.array([k], pa.int64()),
                        "text": pa.array([text[a:b]]),
                    }
                )


def _cuts(long: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(long_id, tag, cuts): where each long text may be cut.

    A cut needs the cut before it, whose chunk vouches for it. After a chunk without
    one (a run longer than the overlap) the rest of the text stays in one piece.
    """
    parts = long.select("long_id", "tag", "text").mapInArrow(
        _chunks(chunk, overlap), "long_id long, tag long, start long, ends_text boolean, part string"
    )
    spread = parts.repartition("long_id", "tag", "start")
    edges = spread.mapInArrow(
        _edges(pattern, chunk, overlap), "long_id long, tag long, start long, heads array<long>, tails array<long>"
    )
    order = Window.partitionBy("long_id", "tag").orderBy("start")
    met = F.array_min(F.array_intersect(F.lag("tails").over(order), F.col("heads")))
    marked = edges.withColumn("cut", F.when(F.col("start") > 0, met))
    good = F.min(((F.col("start") == 0) | F.col("cut").isNotNull()).cast("int")).over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    sure = marked.withColumn("good", good).filter("good = 1")
    return sure.groupBy("long_id", "tag").agg(F.sort_array(F.collect_list("cut")).alias("cuts"))


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks_path: str = RANKS,
    pattern: str = PATTERN,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """(id, tag, ids): every whole text in byte-level BPE ids, without special tokens.

    The ids are those of encoding the text in one go. Texts of up to ``chunk``
    characters are one chunk and need no shuffle; longer ones are split over tasks. A
    null or empty text has no ids. Ids may be null or repeat: every row gets a row.
    Other columns are not read. No rows give no rows. ``tag`` is the text's hash.
    """
    ranks = read_ranks(ranks_path)
    rows = docs.select(
        F.col(id_col).cast("long").alias("long_id"), F.xxhash64(text_col).alias("tag"), F.col(text_col).alias("text")
    )
    is_long: Column = F.coalesce(F.length("text") > chunk, F.lit(False))
    short = rows.filter(~is_long).mapInArrow(
        _encoded(ranks, pattern, ["long_id", "tag", "ids"]), f"long_id long, tag long, ids {_IDS}"
    )
    stages = Stages(docs.sparkSession)
    long = rows.filter(is_long).groupBy("long_id", "tag").agg(F.min("text").alias("text"), F.count("*").alias("copies"))
    long = stages.keep(long, "long_texts")
    cuts = _cuts(long, pattern, chunk, overlap)
    same = long.long_id.eqNullSafe(cuts.long_id) & (long.tag == cuts.tag)
    cut = long.join(cuts, same).select(long.long_id, long.tag, "cuts", "text")
    pieces = cut.mapInArrow(_pieces, "long_id long, tag long, piece long, text string").repartition("long_id", "tag", "piece")
    parts = pieces.mapInArrow(
        _encoded(ranks, pattern, ["long_id", "tag", "piece", "ids"]), f"long_id long, tag long, piece long, ids {_IDS}"
    )
    whole = parts.groupBy("long_id", "tag").agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("parts"))
    whole = whole.select("long_id", "tag", F.flatten("parts.ids").alias("ids"))
    copies = long.select(F.col("long_id").alias("l"), F.col("tag").alias("t"), F.sequence(F.lit(1).cast("long"), "copies").alias("c"))
    again = whole.join(copies, whole.long_id.eqNullSafe(copies.l) & (whole.tag == copies.t))
    again = again.select("long_id", "tag", "ids", F.explode("c").alias("copy")).drop("copy")
    return short.unionByName(again).withColumnRenamed("long_id", id_col)


def _lists(column: pa.Array) -> Iterator[list[int]]:
    """Each row's ids, one row at a time: a batch of Python integers would be large."""
    values = column.values.to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    for i, gone in enumerate(column.is_null().to_pylist()):
        yield [] if gone else values[offsets[i] : offsets[i + 1]].tolist()


def _digests(ranks: bytes, pattern: str):
    """(id, ids) -> counts and digests of the ids and of the bytes that they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks, pattern)
        names = [str(i) for i in range(coder.n_vocab)]
        for batch in batches:
            out: list[list] = [[], [], []]
            for ids in _lists(batch.column(1)):
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest())
                out[2].append(hashlib.sha256(coder.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _decoded(ranks: bytes, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks, pattern)
        for batch in batches:
            data = [coder.decode_bytes(ids) for ids in _lists(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["id", "data"])

    return run


def decode(
    encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks_path: str = RANKS, pattern: str = PATTERN
) -> DataFrame:
    """(id, data): the bytes of each row's ids, end to end. Null ids give no bytes."""
    run = _decoded(read_ranks(ranks_path), pattern)
    rows = encoded.select(F.col(id_col).cast("long").alias("id"), ids_col)
    return rows.mapInArrow(run, "id long, data binary").withColumnRenamed("id", id_col)


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = encode(table(spark, folder, "documents")).select("doc_id", "ids")
    return encoded.mapInArrow(
        _digests(read_ranks(RANKS), PATTERN), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
