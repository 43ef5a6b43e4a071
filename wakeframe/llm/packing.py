"""Packing documents into sequences along a space-filling curve."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeframe.llm.suite import query, table
from wakeframe.llm.word_bpe import coder_of
from wakeframe.llm.words import blocks, mixed, seeds, texts_of
from wakeframe.session import Stages

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LENGTH = 4096
END_ID = 2
DIMENSIONS = 3
BITS = 10
TOKEN_BLOCK = 1 << 20  # bytes of text encoded together
CUT_TOKENS = 500_000  # tokens handed on at a time
PARTITION_TOKENS = 4_000_000  # tokens that one task packs

_PACKED = "long_id long, tag long, curve long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of integer points (n, d), each below 2 ** bits.

    The Gray-code transposition: undo the excess rotations from the highest bit down,
    Gray-encode across dimensions, then interleave the bits.
    """
    x = points.astype(np.int64).T.copy()
    d = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(d):
            up = (x[i] & bit) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where((x[-1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def projections(vocabulary: int, dimensions: int) -> np.ndarray:
    """Each token id's direction: independent normal coordinates from hashes of the id."""
    h = mixed(seeds(vocabulary * 2 * dimensions, 4242))
    u = ((h >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    u = u.reshape(2, vocabulary, dimensions)
    return (np.sqrt(-2 * np.log(u[0])) * np.cos(2 * np.pi * u[1])).astype(np.float32)


def curve_keys(ids: np.ndarray, offsets: np.ndarray, table_: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of documents: the mean direction of their tokens, squashed to a grid."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    mean = np.zeros((n, table_.shape[1]))
    full = np.flatnonzero(size)
    if len(full):
        for k in range(table_.shape[1]):
            mean[full, k] = np.add.reduceat(table_[ids, k], offsets[full]) / size[full]
    grid = (0.5 + 0.5 * np.tanh(mean / 0.2)) * (1 << bits)
    return hilbert(np.clip(grid.astype(np.int64), 0, (1 << bits) - 1), bits)


def _tokenized(data: str, end_id: int):
    """(id, tag, text) -> (id, tag, curve, n, ids), ids as little-endian unsigned 16-bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(data)
        directions = projections(1 << 16, DIMENSIONS)
        for batch in batches:
            texts = texts_of(batch.column(2))
            for first, last in blocks(texts, TOKEN_BLOCK):
                n = last - first
                ids, offsets = coder.encode(texts, first, last)
                keys = curve_keys(ids, offsets, directions)
                ended = np.insert(ids, offsets[1:], end_id).astype("<u2")
                cuts = offsets + np.arange(n + 1)
                whole = pa.Array.from_buffers(
                    pa.large_binary(), n, [None, pa.py_buffer((cuts * 2).astype(np.int64)), pa.py_buffer(ended)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        batch.column(1).slice(first, n),
                        pa.array(keys),
                        pa.array(np.diff(cuts)),
                        whole.cast(pa.binary()),
                    ],
                    names=["long_id", "tag", "curve", "n", "ids"],
                )

    return run


def _cut(length: int):
    """Rows in order -> pieces: end to end through sequences of ``length`` tokens."""
    names = [part.split()[0] for part in _PACKED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        position = 0
        part = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows: list[int] = []
            spans: list[list[int]] = [[], [], [], [], []]  # start, length, doc_tokens, sequence_id, offset
            data: list[bytes] = []

            def done(batch=batch, rows=rows, spans=spans, data=data) -> pa.RecordBatch:
                taken = pa.array(rows, pa.int64())
                columns = [batch.column(c).take(taken) for c in range(3)]
                columns += [pa.array(v, pa.int64()) for v in spans] + [pa.array(data, pa.binary())]
                for kept in (rows, *spans, data):
                    kept.clear()
                return pa.RecordBatch.from_arrays(columns, names=names)

            held = 0
            for i, value in enumerate(batch.column(3)):
                ids = np.frombuffer(value.as_buffer(), dtype="<u2").astype("<u4")
                start = 0
                while start < len(ids):
                    sequence, offset = divmod(position, length)
                    size = min(length - offset, len(ids) - start)
                    rows.append(i)
                    for kept, new in zip(spans, (start, size, len(ids), part + sequence, offset), strict=True):
                        kept.append(new)
                    data.append(ids[start : start + size].tobytes())
                    start += size
                    position += size
                held += len(ids)
                if held >= CUT_TOKENS:
                    held = 0
                    yield done()
            yield done()

    return run


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str = TOKENIZER,
    length: int = LENGTH,
    end_id: int = END_ID,
    partition_tokens: int = PARTITION_TOKENS,
    stages: Stages | None = None,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` tokens.

    A document is its text's ids (no special tokens) and ``end_id``; a null or empty
    text is ``end_id`` alone. Documents are ordered by the Hilbert key of the mean of
    their tokens' hashed directions (then by id, text hash and row), so that similar
    ones are neighbours, and are laid end to end; a sequence is full except the last
    one of each task's stretch of the curve, which holds ``partition_tokens`` tokens on
    average (rows are sampled, so that some hold over twice as many).
    Each id lies in exactly one piece.

    Columns: id, tag (hash of the text), curve, start and length of the piece within
    its document, doc_tokens, sequence_id, offset within the sequence, and ids as
    little-endian unsigned 32-bit integers. Ids may be null or repeat: every row is a
    document. Other columns are not read. No rows give no rows. Vocabularies of up to
    65,536 ids.
    """
    stages = stages or Stages(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as file:
        data = file.read()  # under 2 MB, sent to the tasks
    rows = docs.select(
        F.col(id_col).cast("long").alias("long_id"), F.xxhash64(text_col).alias("tag"), F.col(text_col).alias("text")
    )
    tokens = rows.mapInArrow(_tokenized(data, end_id), "long_id long, tag long, curve long, n long, ids binary")
    tokens = stages.keep(tokens.withColumn("row", F.monotonically_increasing_id()), "tokens")
    total = tokens.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(1, math.ceil(total / partition_tokens))
    order = ["curve", "long_id", "tag", "row"]
    laid = tokens.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    packed = laid.select("long_id", "tag", "curve", "ids").mapInArrow(_cut(length), _PACKED)
    return packed.withColumnRenamed("long_id", id_col)


@query("op4_packing")
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack(table(spark, folder, "documents"))
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "curve",
    )
