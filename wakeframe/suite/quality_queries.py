"""Quality gates, splits, parsing, sources and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeframe.functions import parsing as P
from wakeframe.functions import scalars as S
from wakeframe.functions import times as TM
from wakeframe.operators import quality as Q
from wakeframe.operators import reports as R
from wakeframe.operators import split as SP
from wakeframe.operators.baseline import summary_stats
from wakeframe.session import fresh_path
from wakeframe.sources import messages, tables
from wakeframe.suite.registry import query, table

RANGES = {"c_acctbal": (0.0, 9000.0), "c_nationkey": (None, 20.0)}


@query(
    "range_validation",
    """
    SELECT c_custkey, concat_ws('; ', CASE WHEN c_acctbal < 0 THEN 'c_acctbal: below 0' END,
      CASE WHEN c_acctbal > 9000 THEN 'c_acctbal: above 9000' END,
      CASE WHEN c_nationkey > 20 THEN 'c_nationkey: above 20' END) AS problems,
      c_acctbal BETWEEN 0 AND 9000 AND c_nationkey <= 20 AS valid
    FROM customer
    """,
)
def range_validation(spark, folder):
    """Accepted and rejected rows with reasons, in one pass."""
    checked = S.validated(table(spark, folder, "customer"), RANGES)
    return checked.select("c_custkey", F.array_join("problems", "; ").alias("problems"), "valid")


@query(
    "finite_values",
    """
    SELECT o_orderkey, round(sqrt(o_totalprice - 200000), 4) AS root FROM orders WHERE o_totalprice >= 200000
    """,
)
def finite_values(spark, folder):
    """Only finite values pass; the root of a negative number is not one."""
    df = table(spark, folder, "orders").select("o_orderkey", F.sqrt(F.col("o_totalprice") - 200000).alias("root"))
    return df.filter(S.is_finite(F.col("root"))).select("o_orderkey", F.round("root", 4).alias("root"))


@query(
    "clamp_and_scale",
    """
    SELECT c_custkey, greatest(0.0, least(5000.0, c_acctbal)) AS clamped,
      round(greatest(0.0, least(1.0, (c_acctbal + 999.99) / 10999.98)), 6) AS scaled FROM customer
    """,
)
def clamp_and_scale(spark, folder):
    v = F.col("c_acctbal")
    return table(spark, folder, "customer").select(
        "c_custkey", S.clamp(v, 0.0, 5000.0).alias("clamped"),
        F.round(S.scale(v, -999.99, 9999.99), 6).alias("scaled"),
    )


@query(
    "null_counts",
    """
    WITH w AS (SELECT nullif(o_orderstatus, 'F') AS o_orderstatus, o_custkey,
      CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS o_totalprice FROM orders)
    SELECT 'o_orderstatus' AS "column", count(*) - count(o_orderstatus) AS nulls FROM w
    UNION ALL SELECT 'o_custkey', count(*) - count(o_custkey) FROM w
    UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice) FROM w
    """,
)
def null_counts(spark, folder):
    df = table(spark, folder, "orders").select(
        F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"),
        "o_custkey",
        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("o_totalprice"),
    )
    return Q.null_counts(df, df.columns)


@query("label_distribution", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def label_distribution(spark, folder):
    return Q.label_distribution(table(spark, folder, "lineitem"), "l_returnflag")


@query("label_classes", "SELECT count(DISTINCT o_orderpriority) AS classes FROM orders")
def label_classes(spark, folder):
    return Q.label_classes(table(spark, folder, "orders"), "o_orderpriority")


LINE_CHECKS = """
    SELECT 'not_empty' AS "check", count(*) > 0 AS passed, 'rows = ' || count(*) AS message FROM lineitem
    UNION ALL SELECT 'has_both_labels', count(DISTINCT l_returnflag) >= 2,
      'unique labels = ' || count(DISTINCT l_returnflag) || ' (need >= 2)' FROM lineitem
    UNION ALL SELECT 'no_nulls_in_features', count(*) FILTER (l_discount = 0) = 0,
      'missing values: l_tax: ' || count(*) FILTER (l_discount = 0) FROM lineitem
    UNION ALL SELECT 'schema', false, 'absent: [''l_weight'']'
"""


def flawed_lines(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_quantity", F.when(F.col("l_discount") != 0, F.col("l_tax")).alias("l_tax"), "l_returnflag"
    )


FLAWED = {"features": ["l_quantity", "l_tax", "l_weight"], "label": "l_returnflag"}


@query("quality_checks", f"{LINE_CHECKS} UNION ALL SELECT 'exists', true, 'found'")
def quality_checks(spark, folder):
    """A table's path and its four other checks in one pass; two of them fail."""
    there = Q.check_path(spark, f"{folder}/lineitem.parquet", ["exists"])
    there = there.withColumn("message", F.substring_index("message", ":", 1))
    return there.unionByName(Q.run_checks(flawed_lines(spark, folder), **FLAWED))


@query(
    "checked_write",
    f"""
    WITH c AS ({LINE_CHECKS}),
    w AS (SELECT "check", passed, CASE "check" WHEN 'has_both_labels' THEN 'unique labels = 2 or more (need >= 2)'
        ELSE message END AS message FROM c)
    SELECT 'written' AS stage, * FROM w UNION ALL SELECT 'written', 'exists', true, 'found'
    UNION ALL SELECT 'read', * FROM c UNION ALL SELECT 'read', 'exists', true, 'found'
    UNION ALL SELECT 'absent', "check", false, 'NOT found' FROM w UNION ALL SELECT 'absent', 'exists', false, 'NOT found'
    UNION ALL SELECT 'rows', 'rows', true, 'rows = ' || count(*) FROM lineitem
    """,
)
def checked_write(spark, folder):
    """A stage's table checked while it is written, then at its path, and a path where none is."""
    path = fresh_path(spark, "stage")
    written = Q.write_checked(flawed_lines(spark, folder), path, **FLAWED)
    read = Q.check_path(spark, path, **FLAWED)
    absent = Q.check_path(spark, f"{path}-absent", **FLAWED)
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("rows").alias("check"), F.lit(True).alias("passed"), F.format_string("rows = %d", "n").alias("message")
    )
    out = None
    for name, told in (("written", written), ("read", read), ("absent", absent), ("rows", rows)):
        told = told.select(F.lit(name).alias("stage"), "check", "passed", F.regexp_replace("message", ": /.*|: [a-z0-9]+:/.*", "").alias("message"))
        out = told if out is None else out.unionByName(told)
    return out


@query(
    "landmark_checks",
    """
    SELECT 'whole' AS stage, 'not_empty' AS "check", count(*) > 0 AS passed, 'rows = ' || count(*) AS message FROM embeddings
    UNION ALL SELECT 'whole', 'has_both_labels', count(DISTINCT label) >= 2,
      'unique labels = ' || count(DISTINCT label) || ' (need >= 2)' FROM embeddings
    UNION ALL SELECT 'whole', 'schema', true, '4 columns as required'
    UNION ALL SELECT 'cut', 'not_empty', count(*) > 0, 'rows = ' || count(*) FROM embeddings WHERE label = 3
    UNION ALL SELECT 'cut', 'has_both_labels', count(DISTINCT label) >= 2,
      'unique labels = ' || count(DISTINCT label) || ' (need >= 2)' FROM embeddings WHERE label = 3
    UNION ALL SELECT 'cut', 'schema', false, 'absent: [''subject_id'']'
    """,
)
def landmark_checks(spark, folder):
    """A landmark table that is complete, and one of a single label without subjects."""
    points = table(spark, folder, "embeddings").select(
        F.col("embedding").alias("landmarks"), "label", F.col("vec_id").cast("string").alias("subject_id"), F.col("vec_id").alias("frame_id")
    )
    whole = Q.check_landmarks(points).withColumn("stage", F.lit("whole"))
    cut = Q.check_landmarks(points.filter("label = 3").drop("subject_id")).withColumn("stage", F.lit("cut"))
    return whole.unionByName(cut)


@query(
    "stage_output_checks",
    """
    SELECT 'not_empty' AS "check", count(*) > 0 AS passed, 'rows = ' || count(*) AS message FROM lineitem
    UNION ALL SELECT 'has_both_labels', count(DISTINCT l_returnflag) >= 2,
      'unique labels = ' || count(DISTINCT l_returnflag) || ' (need >= 2)' FROM lineitem
    UNION ALL SELECT 'no_nulls_in_features', true, 'complete: 2 columns'
    UNION ALL SELECT 'schema', true, '3 columns as required'
    UNION ALL SELECT 'baseline', true, 'missing: '
    UNION ALL SELECT 'frames_A', count(*) FILTER (l_returnflag = 'A') > 0, 'frames = ' ||
      count(*) FILTER (l_returnflag = 'A') FROM lineitem
    UNION ALL SELECT 'frames_X', false, 'frames = 0'
    """,
)
def stage_output_checks(spark, folder):
    """Feature table with its baseline, and frames per label."""
    names = ["l_quantity", "l_tax"]
    li = table(spark, folder, "lineitem").select(*names, "l_returnflag")
    base = summary_stats(li, names)
    checks = Q.check_features(li.withColumnRenamed("l_returnflag", "label"), base, names)
    return checks.unionByName(Q.check_frames(li.select(F.col("l_returnflag").alias("label")), ["A", "X"]))


SPLIT = """
  h AS (SELECT o_orderkey, o_orderpriority, md5(o_orderkey::VARCHAR || '|42') AS h FROM orders),
  c AS (SELECT o_orderpriority, count(*) AS n, sum(count(*)) OVER () AS total FROM orders GROUP BY o_orderpriority),
  w AS (SELECT *, n * ceil(0.2 * total) / total AS exact, floor(n * ceil(0.2 * total) / total) AS base FROM c),
  q AS (SELECT o_orderpriority, base + CASE WHEN row_number() OVER (ORDER BY exact - base DESC, o_orderpriority)
      <= ceil(0.2 * total) - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM w),
  s AS (SELECT h.o_orderkey, h.o_orderpriority, row_number() OVER (PARTITION BY h.o_orderpriority ORDER BY h, o_orderkey)
      <= quota AS is_test FROM h JOIN q ON h.o_orderpriority = q.o_orderpriority)
"""


def _split(spark, folder, **options):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return SP.stratified_split(orders, "o_orderpriority", ["o_orderkey"], **options)


@query("stratified_split", f"WITH {SPLIT} SELECT * FROM s")
def stratified_split(spark, folder):
    """Exactly a fifth of each class, drawn by seeded hash."""
    return _split(spark, folder)


@query("stratified_split_segments", f"WITH {SPLIT} SELECT * FROM s")
def stratified_split_segments(spark, folder):
    return _split(spark, folder, rows_per_segment=500)


@query(
    "split_summary",
    f"WITH {SPLIT} SELECT o_orderpriority, is_test, count(*) AS n FROM s GROUP BY o_orderpriority, is_test",
)
def split_summary(spark, folder):
    return SP.split_summary(_split(spark, folder), "o_orderpriority")


@query(
    "group_split",
    """
    WITH g AS (SELECT DISTINCT o_custkey, md5(o_custkey::VARCHAR || '|42') AS h FROM orders),
    r AS (SELECT o_custkey, row_number() OVER (ORDER BY h, o_custkey) <= ceil(0.2 * count(*) OVER ()) AS is_test FROM g)
    SELECT o_orderkey, o_custkey, is_test FROM orders JOIN r USING (o_custkey)
    """,
)
def group_split(spark, folder):
    """All orders of a customer on one side."""
    return SP.group_split(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_custkey")


@query(
    "seeded_order",
    """
    SELECT doc_id, md5(doc_id::VARCHAR || '|42') AS key FROM documents
    """,
)
def seeded_order(spark, folder):
    """Documents in a reproducible random order, with the sort key."""
    docs = SP.shuffled(table(spark, folder, "documents").select("doc_id"), ["doc_id"])
    return docs.withColumn("key", SP.seeded_hash(["doc_id"], 42))


@query(
    "parsed_names",
    r"""
    WITH n AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'en' ELSE 'de' END AS label,
      regexp_extract(url, '([^/]*)$', 1) || '_' || CASE WHEN page_id % 2 = 0 THEN 'en' ELSE 'de' END || '_f'
        || lpad(page_id::VARCHAR, 6, '0') || '.jpg' AS name FROM pages),
    s AS (SELECT *, regexp_replace(name, '\.jpg$', '') AS stem, label || '_' AS part FROM n),
    d AS (SELECT *, CASE WHEN instr(stem, part) > 0 THEN substr(stem, 1, instr(stem, part) - 1) ||
      substr(stem, instr(stem, part) + 3) ELSE stem END AS rest FROM s)
    SELECT page_id, name, coalesce(nullif(regexp_replace(rest, '_f[0-9]+$', ''), ''), 'unknown') AS subject_id,
      CAST(regexp_extract(name, '_f([0-9]+)\.jpg$', 1) AS BIGINT) AS frame_id,
      CASE WHEN label = 'en' THEN 1 ELSE 0 END AS label_code
    FROM d
    """,
)
def parsed_names(spark, folder):
    """Frame names built from page addresses and taken apart again."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    label = F.when(F.col("page_id") % 2 == 0, "en").otherwise("de")
    tail = F.concat_ws("_", P.file_name(F.col("url")), label)
    named = pages.select(
        "page_id", label.alias("label"), F.format_string("%s_f%06d.jpg", tail, F.col("page_id")).alias("path")
    )
    out = tables.frame_manifest(named)
    return out.select(
        "page_id", "name", "subject_id", "frame_id", P.label_code(F.col("label"), "en").alias("label_code")
    )


@query(
    "formatted_names",
    """
    SELECT o_orderkey, lower(o_orderpriority) || '_' || o_custkey || '_f' || lpad(o_orderkey::VARCHAR, 6, '0')
      || '.jpg' AS name FROM orders
    """,
)
def formatted_names(spark, folder):
    name = P.frame_name(F.lower("o_orderpriority"), F.col("o_custkey").cast("string"), F.col("o_orderkey"))
    return table(spark, folder, "orders").select("o_orderkey", name.alias("name"))


@query(
    "systematic_sample",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate::VARCHAR AS shipped FROM lineitem
    WHERE l_partkey % greatest(1, CAST(round_even(l_quantity / 10, 0) AS INT)) = 0
    """,
)
def systematic_sample(spark, folder):
    """Every n-th frame, n from a rate ratio rounded half to even."""
    li = table(spark, folder, "lineitem")
    kept = li.filter(P.sampled(F.col("l_partkey"), F.col("l_quantity"), 10.0))
    return kept.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped")
    )


@query(
    "detection_summary",
    """
    SELECT event_type AS label, count(*) AS attempted, count(*) FILTER (value > 20) AS succeeded,
      count(*) - count(*) FILTER (value > 20) AS no_face,
      round(100.0 * count(*) FILTER (value > 20) / count(*), 2) AS rate_pct FROM events GROUP BY event_type
    """,
)
def detection_summary(spark, folder):
    ev = table(spark, folder, "events").select(F.col("event_type").alias("label"), (F.col("value") > 20).alias("face"))
    return R.detection_summary(ev)


@query(
    "detection_totals",
    """
    SELECT count(*) AS attempted, count(*) FILTER (value > 20) AS succeeded, count(*) FILTER (value <= 20) AS no_face,
      round(100.0 * count(*) FILTER (value > 20) / count(*), 2) AS rate_pct, round(count(*) / 673.7, 1)
      AS throughput_fps FROM events
    """,
)
def detection_totals(spark, folder):
    return R.detection_totals(detection_summary(spark, folder), 673.7)


@query(
    "labels_without_files",
    """
    SELECT 'No videos in ' || w AS error FROM (VALUES ('click'), ('swipe'), ('view')) v(w)
    WHERE w NOT IN (SELECT event_type FROM events)
    """,
)
def labels_without_files(spark, folder):
    files = table(spark, folder, "events").select(F.col("event_type").alias("label"))
    return R.missing_labels(files, ["click", "swipe", "view"])


@query(
    "run_names",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS at,
      'webhook__' || strftime(ts, '%Y%m%dT%H%M%S') AS run, 'report_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS file
    FROM events
    """,
)
def run_names(spark, folder):
    """Instants as ISO text, run names and report names."""
    ts = F.col("ts")
    return table(spark, folder, "events").select(
        "event_id",
        TM.iso_text(ts).alias("at"),
        TM.run_name("webhook", ts).alias("run"),
        TM.report_name("report", ts).alias("file"),
    )


VIDEOS = """
  f AS (SELECT l_suppkey AS video, CASE WHEN l_linestatus = 'O' AND l_suppkey < l_partkey THEN 'success' ELSE 'failed' END
      AS status, l_orderkey, l_quantity, l_extendedprice FROM lineitem),
  v AS (SELECT video, count(*) FILTER (status = 'success') AS frames, max(l_orderkey) AS total, max(l_quantity) AS fps,
      max(l_extendedprice) AS s, CASE WHEN count(*) FILTER (status = 'success') > 0 THEN 'success' ELSE 'failed' END
      AS status FROM f GROUP BY video)
"""


def videos(spark, folder, video="l_suppkey"):
    li = table(spark, folder, "lineitem")
    good = (F.col("l_linestatus") == "O") & (F.col("l_suppkey") < F.col("l_partkey"))
    return R.video_summary(
        li.select(
            F.col(video).alias("video"),
            F.col("l_orderkey").alias("total_frames"),
            F.col("l_quantity").alias("source_fps"),
            F.col("l_extendedprice").alias("elapsed_sec"),
            F.when(good, "success").otherwise("failed").alias("status"),
        )
    )


@query(
    "video_summary",
    f"""
    WITH {VIDEOS} SELECT video, frames, round(total / fps, 2) AS duration_sec, round(frames / s, 1) AS throughput_fps,
      round(s, 2) AS elapsed_sec, status FROM v
    """,
)
def video_summary(spark, folder):
    return videos(spark, folder)


@query(
    "extraction_totals",
    f"""
    WITH {VIDEOS} SELECT CAST(sum(frames) FILTER (status = 'success') AS BIGINT) AS total_frames,
      count(*) FILTER (status = 'success') AS videos, round(sum(round(s, 2)) FILTER (status = 'success'), 2)
      AS total_elapsed_sec, round(sum(frames) FILTER (status = 'success') / sum(round(s, 2))
      FILTER (status = 'success'), 1) AS overall_fps, count(*) FILTER (status <> 'success') AS failed FROM v
    """,
)
def extraction_totals(spark, folder):
    return R.extraction_totals(videos(spark, folder))


@query(
    "extraction_errors",
    """
    SELECT 'Failed: ' || l_orderkey AS error FROM lineitem GROUP BY l_orderkey
    HAVING count(*) FILTER (l_linestatus = 'O' AND l_suppkey < l_partkey) = 0
    """,
)
def extraction_errors(spark, folder):
    """One row per video of which no frame was extracted."""
    return R.extraction_errors(videos(spark, folder, "l_orderkey"))


@query(
    "listed_files",
    """
    SELECT 'o_orderpriority=' || o_orderpriority AS label, 1 AS files, true AS some_bytes, count(*) AS rows
    FROM orders GROUP BY o_orderpriority
    """,
)
def listed_files(spark, folder):
    """Files of one kind below a folder with their labels; those of another kind are left out."""
    path = fresh_path(spark, "listed")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    tables.write_table(orders.repartition("o_orderpriority"), path, partition_by=["o_orderpriority"])
    tables.write_table(orders.limit(5), f"{path}/notes", "csv")
    files = tables.list_files(spark, path, [".PARQUET"])
    counted = files.groupBy("label").agg(F.count(F.lit(1)).cast("int").alias("files"), (F.min("length") > 0).alias("some_bytes"))
    rows = tables.read_table(spark, path + "/o_orderpriority=*").select("o_orderkey", F.col("_metadata.file_path").alias("path"))
    rows = rows.groupBy(F.replace(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1), F.lit("%20"), F.lit(" ")).alias("label"))
    return counted.join(rows.agg(F.count(F.lit(1)).alias("rows")), "label")


@query(
    "table_fingerprint",
    """
    WITH t AS (SELECT l_linestatus AS a, CAST(round(l_extendedprice, 6) AS DECIMAL(38, 6))::VARCHAR AS b,
        nullif(l_linenumber, 3)::VARCHAR AS c, l_orderkey::VARCHAR AS d, epoch_us(l_shipdate)::VARCHAR AS e FROM lineitem),
    h AS (SELECT ('0x' || substr(md5(coalesce(length(a) || ':' || a, '-') || coalesce(length(b) || ':' || b, '-')
        || coalesce(length(c) || ':' || c, '-') || coalesce(length(d) || ':' || d, '-')
        || coalesce(length(e) || ':' || e, '-')), 1, 15))::BIGINT AS h FROM t)
    SELECT count(*) AS rows, printf('%X', bit_xor(h)) AS hash_xor, sum(h)::VARCHAR AS hash_sum FROM h
    """,
)
def table_fingerprint(spark, folder):
    """Order-free content hash of columns of every kind."""
    return R.fingerprint(
        table(spark, folder, "lineitem").select(
            F.col("l_linestatus").alias("a"), F.col("l_extendedprice").alias("b"),
            F.nullif("l_linenumber", F.lit(3)).alias("c"), F.col("l_orderkey").alias("d"), F.col("l_shipdate").alias("e"),
        )
    )


@query(
    "run_report",
    """
    SELECT (SELECT count(*) FROM lineitem) AS n_frames, (SELECT count(*) FROM orders) AS n_windows,
           (SELECT count(DISTINCT l_returnflag) FROM lineitem) AS classes
    """,
)
def run_report(spark, folder):
    """Stage summaries in one JSON document, read back field by field."""
    frames = table(spark, folder, "lineitem").agg(
        F.count(F.lit(1)).alias("n_frames"), F.count_distinct("l_returnflag").alias("classes")
    )
    windows = table(spark, folder, "orders").agg(F.count(F.lit(1)).alias("n_windows"))
    doc = R.run_report([R.section("frames", frames), R.section("windows", windows)])
    return doc.select(
        F.get_json_object("value", "$.frames.n_frames").cast("long").alias("n_frames"),
        F.get_json_object("value", "$.windows.n_windows").cast("long").alias("n_windows"),
        F.get_json_object("value", "$.frames.classes").cast("long").alias("classes"),
    )


@query(
    "label_groups_union",
    """
    SELECT o_orderkey, o_totalprice, 'open' AS grp FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT o_orderkey, o_totalprice, 'done' FROM orders WHERE o_orderstatus <> 'O'
    """,
)
def label_groups_union(spark, folder):
    """Rows of both label groups appended."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    opened = orders.filter("o_orderstatus = 'O'").withColumn("grp", F.lit("open"))
    done = orders.filter("o_orderstatus <> 'O'").withColumn("grp", F.lit("done"))
    return opened.unionByName(done).drop("o_orderstatus")


@query("csv_table", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def csv_table(spark, folder):
    """A CSV table written without index and read with its schema."""
    path = fresh_path(spark, "customer")
    df = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    tables.write_table(df, path, "csv")
    return tables.read_csv(spark, path, df.schema)


@query("pruned_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def pruned_scan(spark, folder):
    """Two columns and a filter, both pushed into the scan."""
    return tables.read_table(spark, f"{folder}/orders.parquet", ["o_orderkey", "o_totalprice"]).filter(
        "o_totalprice > 250000"
    )


@query(
    "partitioned_sink",
    "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus",
)
def partitioned_sink(spark, folder):
    """A table written by partition column and read back."""
    path = fresh_path(spark, "orders")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    tables.write_table(orders, path, partition_by=["o_orderstatus"])
    back = tables.read_table(spark, path)
    return back.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


MESSAGES = """
  m AS (SELECT event_id, CASE event_type WHEN 'signup' THEN 'init' WHEN 'purchase' THEN 'close' WHEN 'error' THEN 'oops'
      ELSE 'frame' END AS type, user_id::VARCHAR AS session_id, value < 2 AS broken FROM events)
"""


def raw_messages(spark, folder):
    kind = (
        F.when(F.col("event_type") == "signup", "init")
        .when(F.col("event_type") == "purchase", "close")
        .when(F.col("event_type") == "error", "oops")
        .otherwise("frame")
    )
    body = F.to_json(
        F.struct(
            kind.alias("type"), F.col("user_id").cast("string").alias("session_id"), F.col("event_id").alias("frame_id")
        )
    )
    text = F.when(F.col("value") < 2, F.concat(F.lit("{"), body)).otherwise(body)
    return table(spark, folder, "events").select("event_id", text.alias("value"))


@query(
    "message_routing",
    f"""
    WITH {MESSAGES} SELECT event_id, CASE WHEN broken THEN 'invalid' WHEN type = 'oops' THEN 'unknown' ELSE type END
      AS route, CASE WHEN broken THEN NULL ELSE session_id END AS session_id FROM m
    """,
)
def message_routing(spark, folder):
    """JSON messages by type; broken and unknown ones are set aside."""
    out = messages.parse_messages(raw_messages(spark, folder))
    return out.select(
        "event_id", "route", F.when(F.col("route") != "invalid", F.col("session_id")).alias("session_id")
    )


@query(
    "message_errors",
    f"""
    WITH {MESSAGES} SELECT event_id, CASE WHEN broken THEN 'Invalid JSON message' ELSE 'Unknown message type: oops' END
      AS message FROM m WHERE broken OR type = 'oops'
    """,
)
def message_errors(spark, folder):
    return messages.errors(messages.parse_messages(raw_messages(spark, folder))).select("event_id", "message")
