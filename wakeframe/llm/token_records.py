"""Token ids as length-delimited binary records with an offset index."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeframe.llm.crc32c import crc32c, masked
from wakeframe.llm.suite import query, table
from wakeframe.llm.word_bpe import coder_of
from wakeframe.llm.words import blocks, texts_of
from wakeframe.session import fresh_path, shuffles_released

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
TOKEN_BLOCK = 1 << 20  # bytes of text encoded together
FILE_BYTES = 32 << 20  # bytes of text that a file holds, about
SPAN_BYTES = 8 << 20  # bytes of a file that are read at once
HEAD = 12  # bytes before the payload: its length (8), the masked checksum of the length (4)
FIELDS = 12  # bytes of the payload before the ids: document id (8), width of an id, whether it is null, 0, 0
TAIL = 4  # masked checksum of the payload

_INDEX = "part int, file string, record int, offset long, bytes long, id long, first_token long, n_tokens long"


class BrokenRecord(ValueError):
    """A length or checksum in a record file is wrong."""


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def frames_of(ids: np.ndarray, offsets: np.ndarray, doc: np.ndarray, unnamed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, where each record starts) of documents ids[offsets[i]:offsets[i + 1]]."""
    width = ids.dtype.itemsize
    n, size = len(doc), np.diff(offsets)
    payload = FIELDS + width * size
    start = np.concatenate(([0], np.cumsum(HEAD + payload + TAIL)))
    out = np.zeros(int(start[-1]), dtype=np.uint8)

    def put(at: np.ndarray, values: np.ndarray) -> None:
        raw = values.view(np.uint8).reshape(len(values), -1)
        out[at[:, None] + np.arange(raw.shape[1])] = raw

    begin = start[:-1]
    put(begin, payload.astype("<u8"))
    lengths = payload.astype("<u8").view(np.uint8)
    put(begin + 8, masked(crc32c(lengths, np.arange(n) * 8, np.arange(n) * 8 + 8)).astype("<u4"))
    put(begin + HEAD, np.where(unnamed, 0, doc).astype("<i8"))
    out[begin + HEAD + 8] = width
    out[begin + HEAD + 9] = unnamed
    # records begin at multiples of the width, so ids can be laid as whole numbers
    cells = out.view(ids.dtype.newbyteorder("<"))
    to = (begin + HEAD + FIELDS) // width
    cells[np.arange(len(ids)) + np.repeat(to - offsets[:-1], size)] = ids
    check = masked(crc32c(out, begin + HEAD, begin + HEAD + payload))
    put(begin + HEAD + payload, check.astype("<u4"))
    return out, start


def parsed(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(id, is null, where ids start, where they end, width) of the whole records in ``data``, verified."""
    begin, at = [], 0
    raw = data.tobytes()
    while at < len(raw):
        begin.append(at)
        at += HEAD + int.from_bytes(raw[at : at + 8], "little") + TAIL
    if at != len(raw):
        raise BrokenRecord(f"records end at {at} of {len(raw)} bytes")
    at = np.array(begin, dtype=np.int64)
    end = np.append(at[1:], len(raw)) - TAIL

    def field(where: np.ndarray, kind: str) -> np.ndarray:
        return data[where[:, None] + np.arange(np.dtype(kind).itemsize)].copy().view(kind).reshape(-1)

    good = (field(at + 8, "<u4") == masked(crc32c(data, at, at + 8))) & (
        field(end, "<u4") == masked(crc32c(data, at + HEAD, end))
    )
    if not good.all():
        raise BrokenRecord(f"{int((~good).sum())} of {len(at)} checksums don't match")
    width = data[at + HEAD + 8]
    if len(at) and (width != width[0]).any():
        raise BrokenRecord("records of different widths in one file")
    doc, unnamed = field(at + HEAD, "<i8"), data[at + HEAD + 9].astype(bool)
    return doc, unnamed, at + HEAD + FIELDS, end, int(width[0]) if len(at) else 2


def _written(data: str, folder: str, end_id: int):
    """(id, text) in order -> a file per task, and an index row per record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(data)
        part = TaskContext.get().partitionId()
        # an attempt writes a file of its own; the index names that of the attempt that counts
        name = f"part-{part:06d}-{uuid.uuid4().hex}.rec"
        system, path = filesystem(folder)
        out = None
        offset = record = first_token = 0
        try:
            for batch in batches:
                texts = texts_of(batch.column(1))
                doc = batch.column(0)
                unnamed = doc.is_null().to_numpy(zero_copy_only=False)
                doc = doc.fill_null(0).to_numpy()
                for first, last in blocks(texts, TOKEN_BLOCK):
                    if out is None:
                        system.create_dir(path, recursive=True)
                        out = system.open_output_stream(f"{path}/{name}")
                    ids, cuts = coder.encode(texts, first, last)
                    ended = np.insert(ids, cuts[1:], end_id).astype("<u2")
                    cuts = cuts + np.arange(last - first + 1)
                    frames, start = frames_of(ended, cuts, doc[first:last], unnamed[first:last])
                    out.write(frames)
                    n = last - first
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, part, np.int32)),
                            pa.array([name] * n, pa.string()),
                            pa.array(np.arange(record, record + n, dtype=np.int32)),
                            pa.array(offset + start[:-1]),
                            pa.array(np.diff(start)),
                            pa.array(doc[first:last], mask=unnamed[first:last]),
                            pa.array(first_token + cuts[:-1]),
                            pa.array(np.diff(cuts)),
                        ],
                        names=[f.split()[0] for f in _INDEX.split(", ")],
                    )
                    offset, record, first_token = offset + int(start[-1]), record + n, first_token + int(cuts[-1])
        finally:
            if out is not None:
                out.close()

    return run


def write_records(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str = TOKENIZER,
    end_id: int = END_ID,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write documents' token ids below ``folder``, in ascending order of their ids; returns the index.

    A document is its text's ids (no special tokens) and ``end_id``; a null or empty text
    is ``end_id`` alone. ``folder/data`` gets a file per range of ids, of about
    ``file_bytes`` of text each. A file is records end to end, all numbers little-endian:
    the payload's length (8 bytes), the masked CRC-32C of these 8 bytes (4), the payload,
    its masked CRC-32C (4). The payload is the document id (8 bytes, 0 for null), the width
    of a token id in bytes (1), whether the document id is null (1), two zeros, and the
    token ids. ``folder/index`` is a table with a row per record: part (files in order),
    file, record (number in the file), offset, bytes, id, first_token (tokens of the file
    before it) and n_tokens.

    Null ids come first. Rows with one id are ordered by their text's hash; they may fill
    any number of files. A record is never cut: a very long text makes a large one. No rows
    give no files and an empty index. Other columns are not read. Vocabularies of up to
    65,536 ids.

    ``folder`` must be one that all executors reach (local mount, or a URI that PyArrow
    opens). A task that is run again writes a file of another name, and the index names
    those of the attempts that Spark counted.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        data = file.read()  # under 2 MB, sent to the tasks
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + F.lit(FIELDS)), F.lit(0))).first()[0]
    order = ["id", "tag", "row"]
    tagged = rows.withColumns({"tag": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    laid = tagged.repartitionByRange(max(1, math.ceil(size / file_bytes)), *order).sortWithinPartitions(*order)
    index = laid.select("id", "text").mapInArrow(_written(data, f"{folder}/data", end_id), _INDEX)
    with shuffles_released(spark):
        index.write.parquet(f"{folder}/index")
    return record_index(spark, folder)


def record_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(f"{folder}/index")


_READ = "id long, start long, n_tokens long, ids binary, place long"


def _span(system: fs.FileSystem, path: str, low: int, high: int) -> np.ndarray:
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read_at(high - low, low), dtype=np.uint8)


def _read(folder: str, span_bytes: int = SPAN_BYTES):
    """(place, file, low, high, first) -> the records there; ``first`` is the place of the first token."""
    names = [f.split()[0] for f in _READ.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        held, size_held = [], 0

        def done() -> pa.RecordBatch:
            columns = [pa.concat_arrays(c) for c in zip(*held, strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for span in batch.to_pylist():
                data = _span(system, f"{path}/{span['file']}", span["low"], span["high"])
                if len(data) != span["high"] - span["low"]:
                    raise BrokenRecord(f"{span['file']} ends before {span['high']}")
                doc, unnamed, low, high, width = parsed(data)
                size = (high - low) // width
                wide = [data[a:b].view(f"<u{width}").astype("<u4").tobytes() for a, b in zip(low, high, strict=True)]
                start = span["first"] + np.cumsum(size) - size
                place = pa.array([span["place"]] * len(doc), pa.int64())
                held.append([pa.array(doc, mask=unnamed), pa.array(start), pa.array(size), pa.array(wide, pa.binary()), place])
                size_held += len(data)
                if size_held >= span_bytes:
                    size_held = 0
                    yield done()
        if held:
            yield done()

    return run


def _with_starts(index: DataFrame) -> DataFrame:
    """The index with ``before``, the tokens of all earlier files: a running sum over one row per file."""
    files = index.groupBy("part", "file").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return index.join(files, ["part", "file"])


def read_records(spark: SparkSession, folder: str, span_bytes: int = SPAN_BYTES) -> DataFrame:
    """All records below ``folder``, checked: id, start, n_tokens, ids (little-endian, 32 bits each).

    ``start`` is the number of token ids of all records before. Tasks read stretches of
    about ``span_bytes`` at once and stop the job with BrokenRecord where a length or a
    checksum is wrong or a file is short.
    """
    index = _with_starts(record_index(spark, folder))
    stretch = F.floor(F.col("offset") / span_bytes)
    spans = index.groupBy("part", "file", stretch.alias("stretch")).agg(
        F.min("offset").alias("low"), F.max(F.col("offset") + F.col("bytes")).alias("high"),
        F.min(F.col("before") + F.col("first_token")).alias("first"),
    )
    # spans come out of the shuffle in as many partitions as it has, whatever their small size
    spread = spans.repartition(max(1, spans.count()), "part", "stretch")
    spread = spread.select(F.lit(0).cast("long").alias("place"), "file", "low", "high", "first")
    return spread.mapInArrow(_read(f"{folder}/data"), _READ).drop("place")


def read_shuffled(spark: SparkSession, folder: str, seed: int = 0, parts: int | None = None) -> DataFrame:
    """The same rows in an order shuffled by ``seed``, each record read at its offset.

    ``place`` gives the order: a hash of seed, part and record (ties by these).
    Partitions hold consecutive places.
    """
    index = _with_starts(record_index(spark, folder))
    shuffled = index.select(
        F.xxhash64(F.lit(seed), "part", "record").alias("place"), "part", "record", "file", F.col("offset").alias("low"),
        (F.col("offset") + F.col("bytes")).alias("high"), (F.col("before") + F.col("first_token")).alias("first"),
    )
    order = ["place", "part", "record"]
    laid = shuffled.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
    return laid.select("place", "file", "low", "high", "first").mapInArrow(_read(f"{folder}/data"), _READ)


@query("op11_token_records")
def op11_token_records(spark: SparkSession, folder: str) -> DataFrame:
    out = fresh_path(spark, "records")
    write_records(table(spark, folder, "documents"), out)
    read = read_records(spark, out)
    return read.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
