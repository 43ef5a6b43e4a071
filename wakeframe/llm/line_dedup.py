"""Near-duplicate lines by locality-sensitive hashing of character shingles.

The job is DataFrame functions only. ``shingle_sets``, ``signatures`` and ``band_keys``
are NumPy helpers for MinHash values of independent orders; the job doesn't call them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeframe.llm.linking import Compare, linked
from wakeframe.llm.suite import query, table
from wakeframe.llm.words import Texts, mixed, seeds
from wakeframe.session import Stages

SIMILARITY = 0.8
CHARS = 5
ROWS = 6
BANDS = 14
MIN_CHARS = 16
#: Sets of fewer shingles than the first number get bands from as many rings as the second says.
RINGS = ((104, 2), (40, 4))
TINY = 16  # sets of fewer shingles get bands of independent minima as well
PLACES = 1 << 26  # of the largest bitmap: 8 MB

_WEIGHT = seeds(CHARS * 16, 321) | np.uint64(1)


def _code_points(texts: Texts, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(code points end to end, number of them per row) of rows first..last."""
    rows = [texts.data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(texts.start[first:last], texts.end[first:last], strict=True)]
    size = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
    return np.frombuffer("".join(rows).encode("utf-32-le", "surrogatepass"), dtype="<u4"), size


def shingle_sets(texts: Texts, first: int, last: int, width: int = CHARS) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of rows first..last, sorted; hashes have 48 bits.

    A shingle is the ``width`` characters from a position; a shorter line is one shingle.
    """
    points, size = _code_points(texts, first, last)
    room = np.maximum(size, width)
    begin, start = np.cumsum(room) - room, np.cumsum(size) - size
    padded = np.zeros(int(room.sum()) + width, dtype=np.uint64)
    padded[np.arange(len(points)) + np.repeat(begin - start, size)] = mixed(points.astype(np.uint64) + np.uint64(1))
    total = padded[: len(padded) - width] * _WEIGHT[0]
    for k in range(1, width):
        total += padded[k : len(padded) - width + k] * _WEIGHT[k]
    count = room - width + 1
    at = np.arange(int(count.sum())) + np.repeat(begin - (np.cumsum(count) - count), count)
    row = np.repeat(np.arange(len(size), dtype=np.uint64), count)
    key = np.sort((row << np.uint64(48)) | (mixed(total[at]) >> np.uint64(16)))
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1)


def signatures(row: np.ndarray, shingle: np.ndarray, n: int, count: int, family: int = 0) -> np.ndarray:
    """n x count MinHash values: the least product of each shingle's hash with an odd number, per row."""
    low = (shingle >> np.uint64(16)).astype(np.uint32)
    start = np.searchsorted(row, np.arange(n))
    factor = (seeds(count, 654 + 5000 * family) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    shift = (seeds(count, 2987 + 5000 * family) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((n, count), dtype=np.uint32)
    for i in range(count):
        value = (low ^ shift[i]) * factor[i]
        out[:, i] = np.minimum.reduceat(value ^ (value >> np.uint32(15)), start)
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key per band of ``rows`` values."""
    n, count = signature.shape
    out = np.tile(seeds(count // rows, 55), (n, 1))
    for j in range(rows):
        out = mixed(out ^ signature[:, j::rows][:, : count // rows].astype(np.uint64) + seeds(1, 11 + j)[0])
    return out


def _set(text: str, width: int) -> Column:
    """The distinct hashes of the ``width`` characters from every position; a shorter line is one shingle."""

    def hashes(points: Column) -> Column:
        # four bytes a character, so that a shingle is found without counting characters
        at = F.sequence(F.lit(1), F.greatest(F.octet_length(points) - (4 * width - 1), F.lit(1)), F.lit(4))
        return F.transform(at, lambda i: F.xxhash64(F.substring(points, i, F.lit(4 * width))))

    # as the element of an array the bytes are one object; a column of bytes would be copied for every shingle
    return F.array_distinct(F.element_at(F.transform(F.array(F.encode(text, "UTF-32")), hashes), 1))


def _marks(bands: int) -> list[int]:
    """Places in the ring of 64-bit hashes, evenly spaced and in order."""
    return [(2 * j + 1) * (1 << 63) // bands - (1 << 63) for j in range(bands)]


def _windows(bands: int, rows: int) -> Column:
    """Keys of the ``rows`` hashes of ``ring`` that follow each mark; ``marked`` has hashes and marks in order."""
    # a mark's place among both, less the marks before it, is that of the first hash after it
    first = [F.array_position("marked", F.lit(t)).cast("int") - j for j, t in enumerate(_marks(bands))]
    return F.array(*[F.xxhash64(F.slice("ring", at, rows)) for at in first])


def signed_lines(lines: DataFrame, bands: int = BANDS, rows: int = ROWS, width: int = CHARS) -> DataFrame:
    """(line, text) -> (line, part, bands): keys that near lines share, each line and part once.

    Hashes of shingles lie on a ring. A band is the ``rows`` hashes that follow one of
    ``bands`` marks: two sets have it in common if none of the first ``rows`` of their
    union there is in one set only, which is as likely as that ``rows`` MinHash values agree.
    In large sets the windows hardly overlap. Smaller sets get more rings, of hashes of the
    hashes, and the smallest also bands of independent minima; so the parts of two
    sets of different sizes are those of the larger one at least.
    """
    sets = lines.select("line", _set("text", width).alias("shingles"))
    size = F.size("shingles")

    def ring(k: int) -> Column:
        return F.transform("shingles", lambda x: F.xxhash64(x, F.lit(k))) if k else F.col("shingles")

    rings = F.array(ring(0))
    for below, count in RINGS:
        rings = F.when(size < below, F.array(*map(ring, range(count)))).otherwise(rings)

    def least(j: Column) -> Column:
        one = F.transform(F.sequence(F.lit(1), F.lit(rows)), lambda i: F.array_min(F.transform("shingles", lambda x: F.xxhash64(x, j, i))))
        return F.xxhash64(one)

    none = F.array().cast("array<long>")
    minima = F.when(size < TINY, F.transform(F.sequence(F.lit(1), F.lit(bands)), least)).otherwise(none)
    parts = sets.select("line", minima.alias("minima"), F.posexplode(rings).alias("part", "hashes"))
    marks = F.array(*map(F.lit, _marks(bands)))
    parts = parts.select(
        "line",
        "part",
        F.when(F.col("part") == 0, F.col("minima")).otherwise(none).alias("minima"),
        F.sort_array("hashes").alias("hashes"),
        F.sort_array(F.concat("hashes", marks)).alias("marked"),
    )
    parts = parts.withColumn("ring", F.concat("hashes", F.slice("hashes", 1, rows)))
    keys = F.array_distinct(F.concat(_windows(bands, rows), F.col("minima")))
    # a line's keys are the same wherever it stands
    return parts.select("line", "part", keys.alias("bands")).groupBy("line", "part").agg(F.first("bands").alias("bands"))


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, tag, n, text, line): the lines that take part; ``line`` is the text's hash."""
    split = docs.select(
        F.col(id_col).cast("long").alias("long_id"),
        F.xxhash64(text_col).alias("tag"),
        F.posexplode(F.split(text_col, "\n")).alias("n", "text"),
    )
    return split.filter(F.length(F.trim("text")) >= min_chars).withColumn("line", F.xxhash64("text"))


def _among(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose ``key``, a hash, is one of ``wanted`` (a table of one column), and a few others.

    Keys are looked up in a bitmap of 16 to 32 places each, up to ``PLACES``, so that the rest
    of a table needn't travel to be left out by a join. A fuller bitmap lets more rows through.
    """
    places = min(max(1 << (16 * wanted.count()).bit_length(), 1 << 12), PLACES)
    at = lambda c: (F.shiftright(F.col(c).bitwiseAND(places - 1), 6), F.col(c).bitwiseAND(63).cast("int"))
    (word, bit), (here, there) = at(wanted.columns[0]), at(key)
    set_bits = wanted.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bits"))
    words = rows.sparkSession.range(places // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = words.unionByName(set_bits).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # one row of at most 8 MB
    bitmap = words.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
    bitmap = bitmap.select(F.transform("words", lambda w: w["bits"]).alias("__bitmap"))
    hit = F.call_function("shiftright", F.get("__bitmap", here.cast("int")), there).bitwiseAND(1) == 1
    return rows.join(F.broadcast(bitmap), hit).select(*rows.columns)


def _texts(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """(line, text) of the lines that are one of ``wanted`` (line), each once."""
    some = _among(lines.select("line", "text"), "line", wanted)
    # a semi-join would be moved before the look-up, and all texts dealt out for it
    return some.join(wanted, "line").dropDuplicates(["line"])


def line_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    min_chars: int = MIN_CHARS,
    stages: Stages | None = None,
) -> DataFrame:
    """Occurrences of lines to drop: (long_id, tag, n), n counting from 0.

    Lines are the parts between \\n of at least ``min_chars`` characters without outer
    blanks; shorter ones are no evidence of copying and stay. Equal lines are one
    node. Distinct lines are linked when the sets of their character shingles, taken at
    every position, have a Jaccard similarity of at least ``similarity``; candidates
    share one of ``bands`` bands of ``rows`` hashes (``signed_lines``; at the defaults,
    about 98 % of pairs just at 0.8 do, and 99.9 % at 0.87). Of a component the first occurrence by
    (id, place) stays.
    """
    stages = stages or Stages(docs.sparkSession)
    lines = _lines(docs, id_col, text_col, min_chars)
    signed = stages.keep(signed_lines(lines.select("line", "text"), bands, rows), "bands")
    members = signed.select(F.explode("bands").alias("bucket"), F.col("line").alias("node"))

    def ready(shared: DataFrame):
        wanted = shared.select(F.col("node").alias("line"))
        texts = stages.keep(_texts(lines, wanted), "line_texts")
        known = texts.count()

        def texts_of(nodes: DataFrame) -> DataFrame:
            """The texts, less what a few nodes leave out."""
            return _among(texts, "line", nodes) if 2 * nodes.count() < known else texts

        def sets(pairs: DataFrame, one: str, other: str) -> DataFrame:
            # texts travel, as sets of hashes are many times as long
            pairs = stages.keep(pairs, "compared")
            some = texts_of(pairs.select(one).union(pairs.select(other)).distinct())
            both = pairs.join(some.toDF(one, "x"), one).join(some.toDF(other, "y"), other)
            return both.select(*pairs.columns, _set("x", CHARS).alias("x"), _set("y", CHARS).alias("y"))

        def overlaps(pairs: DataFrame) -> DataFrame:
            shared = F.size(F.array_intersect("x", "y"))
            counts = {"na": F.size("x"), "nb": F.size("y"), "both": shared}
            return sets(pairs, "a", "b").select("a", "b", *[n.cast("long").alias(c) for c, n in counts.items()])

        def differences(rows: DataFrame) -> DataFrame:
            apart = F.concat(F.array_except("x", "y"), F.array_except("y", "x"))
            return sets(rows, "node", "leader").select("node", "leader", "root", F.explode(apart).alias("member"))

        def contents(nodes: DataFrame) -> DataFrame:
            nodes = stages.keep(nodes, "sketched")
            both = nodes.join(texts_of(nodes).toDF("node", "x"), "node")
            return both.select("node", F.explode(_set("x", CHARS)).alias("member"))

        return Compare(overlaps, differences, contents)

    root = linked(members, ready, similarity, stages)
    occurrences = lines.select("long_id", "tag", "n", "line")
    # only lines that occur again, or that have a near duplicate, can lose an occurrence
    again = occurrences.groupBy("line").agg(F.count("*").alias("k")).filter("k > 1").select("line")
    ends = root.select(F.col("node").alias("line")).unionByName(root.select(F.col("root").alias("line")))
    again = again.unionByName(ends).distinct()
    rooted = again.join(root.withColumnRenamed("node", "line"), "line", "left")
    rooted = stages.keep(rooted.select("line", F.coalesce("root", "line").alias("root")), "repeated")
    held = stages.keep(occurrences.join(rooted, "line").select("long_id", "tag", "n", "root"), "held")
    first = held.groupBy("root").agg(F.min(F.struct("long_id", "n", "tag")).alias("first")).select("first.*")
    first = stages.keep(first.distinct(), "first")
    same_row = held.tag.eqNullSafe(first.tag) & held.long_id.eqNullSafe(first.long_id) & (held.n == first.n)
    return held.join(first, same_row, "left_anti").select("long_id", "tag", "n").distinct()


def _without(lines: Column, edges: Column) -> Column:
    """The text of ``lines`` without those numbered in ``edges``, which are sorted from -1 to the lines' number."""
    kept = F.transform(
        F.sequence(F.lit(1), F.size(edges) - 1),
        lambda k: F.slice(
            lines, F.element_at(edges, k) + 2, F.element_at(edges, k + 1) - F.element_at(edges, k) - 1
        ),
    )
    return F.array_join(F.flatten(kept), "\n")


def _later(docs: DataFrame, stages: Stages) -> DataFrame:
    """``docs`` with ``later``: whether another row with the same id and tag (of a text) comes first."""
    again = docs.filter(F.length("text") > 0).groupBy("id", "tag").agg(F.count("*").alias("k")).filter("k > 1")
    again = stages.keep(again.select(F.col("id").alias("i"), F.col("tag").alias("t")), "rows_again")
    if again.isEmpty():
        return docs.withColumn("later", F.lit(False))
    hit = docs["tag"].eqNullSafe(again.t) & docs["id"].eqNullSafe(again.i)
    # the numbers hold only once they are written
    some = docs.join(again, hit, "left_semi").withColumn("row", F.monotonically_increasing_id())
    some = stages.keep(some, "rows_repeated")
    first = some.groupBy("id", "tag").agg(F.min("row").alias("first")).select("first")
    some = some.join(first, F.col("row") == F.col("first"), "left")
    some = some.select(*docs.columns, F.col("first").isNull().alias("later"))
    return docs.join(again, hit, "left_anti").select(*docs.columns, F.lit(False).alias("later")).unionByName(some)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated and near-repeated lines removed from their texts.

    Adds ``n_lines`` and ``n_dropped_lines`` unless ``docs`` has columns of these
    names, which stay as they are; other columns may have any names. A document that
    loses all its lines keeps an empty text. Null texts stay null; empty texts and lines
    too short to take part stay as they are. Null ids sort first. Of rows that repeat an id
    and a text one counts as the first, and the others lose every line that takes part.
    Lines compare with their case and blanks; nodes are 64-bit hashes of lines. A line of
    any length is one row. An empty table stays empty.
    """
    stages = Stages(docs.sparkSession)
    dropped = line_classes(docs, id_col, text_col, stages=stages, **options)
    lists = dropped.groupBy("long_id", "tag").agg(F.sort_array(F.collect_list("n")).alias("gone"))
    lists = stages.keep(lists, "dropped").withColumnsRenamed({"long_id": "gone_id", "tag": "gone_tag"})
    # the table's columns are c0, c1, .. meanwhile, so that no name clashes
    names = {f"c{i}": c for i, c in enumerate(docs.columns)}
    text_at = f"c{docs.columns.index(text_col)}"
    rows = docs.toDF(*names).withColumns(
        {
            "text": F.col(text_at),
            "id": F.col(f"c{docs.columns.index(id_col)}").cast("long"),
            "tag": F.xxhash64(text_at),
        }
    )
    here = F.col("tag").eqNullSafe(F.col("gone_tag")) & F.col("id").eqNullSafe(F.col("gone_id"))
    joined = _later(rows, stages).join(lists, here, "left")
    # columns of their own: within a lambda they would be worked out anew for every line
    joined = joined.withColumn("lines", F.split("text", "\n"))
    min_chars = options.get("min_chars", MIN_CHARS)
    numbers = F.transform("lines", lambda line, i: F.when(F.length(F.trim(line)) >= min_chars, i))
    joined = joined.withColumn("gone", F.when(F.col("later"), F.array_compact(numbers)).otherwise(F.col("gone")))
    edges = F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(F.size("lines")))
    joined = joined.withColumn("edges", edges)
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(_without(F.col("lines"), F.col("edges")))
    counts = {
        "n_lines": F.coalesce(F.size("lines"), F.lit(0)).cast("long"),
        "n_dropped_lines": F.coalesce(F.size("gone"), F.lit(0)).cast("long"),
    }
    return joined.select(
        *[(text if c == text_at else F.col(c)).alias(name) for c, name in names.items()],
        *[value.alias(name) for name, value in counts.items() if name not in docs.columns],
    )


@query("op5_line_dedup")
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = dedup_lines(table(spark, folder, "documents"))
    return cleaned.select(
        "doc_id", "n_lines", "n_dropped_lines", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )
