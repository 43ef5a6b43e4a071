import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wakeframe.llm import code_compression as codes
from wakeframe.llm import filter_audit as audit
from wakeframe.llm import token_records as records
from wakeframe.llm.crc32c import crc32c, masked
from wakeframe.session import fresh_path

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (None, None, "a"), (None, "some words here", None), (1, "", "c"), (2, " \t\n\x0b", "c"), (3, "same same", "e"),
    (3, "same same", "f"), (3, "same same", "f"), (4, "wört é日本 don't <|endoftext|> \\<| 12,5", "g"), (-7, "same same", "f"),
    (5, "long " * 60_000 + "x" * 5000, "g"), (9, "same same", "e"), (10, "", "e"), (11, None, "e"), (12, "A b#", None),
]


@pytest.fixture(scope="module")
def odd(spark):
    extra = {c: F.lit(1) for c in ("id", "tag", "row", "part", "n", "digest", "start", "file", "A", "E", "good", "label", "x")}
    return spark.createDataFrame(ODD, "doc_id long, text string, source string").withColumns(extra)


# checksums


def plain_crc(data: bytes) -> int:
    value = 0xFFFFFFFF
    for byte in data:
        value ^= byte
        for _ in range(8):
            value = (value >> 1) ^ (0x82F63B78 if value & 1 else 0)
    return value ^ 0xFFFFFFFF


def test_checksums_are_the_castagnoli_ones():
    known = np.frombuffer(b"123456789", np.uint8)
    assert int(crc32c(known, [0], [9])[0]) == 0xE3069283
    sizes = [0, 1, 3, 63, 64, 65, 128, 4095, 4096, 4097, 20_000]
    data = np.random.default_rng(3).integers(0, 256, sum(sizes)).astype(np.uint8)
    end = np.cumsum(sizes)
    got = crc32c(data, end - sizes, end)
    assert got.tolist() == [plain_crc(data[e - n : e].tobytes()) for e, n in zip(end, sizes, strict=True)]
    assert len(crc32c(data, [], [])) == 0
    crc = 0xE3069283
    assert int(masked(np.array([crc], np.uint32))[0]) == (((crc >> 15) | (crc << 17)) + 0xA282EAD8) % (1 << 32)


# records


def expected_records(rows):
    """In order of id (null first) and any order of equal ids: (id, ids)."""
    coder = Tokenizer.from_file(records.TOKENIZER)
    coder.encode_special_tokens = True
    return [(i, tuple(coder.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in rows]


def read_rows(df):
    return [(r["id"], r["start"], r["n_tokens"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in df.collect()]


def test_records_round_trip_in_order(spark, odd):
    folder = fresh_path(spark, "records-test")
    index = records.write_records(odd, folder, file_bytes=200)
    want = expected_records([(r[0], r[1]) for r in ODD])
    rows = index.orderBy("part", "record").collect()
    ids = [r["id"] for r in rows]
    assert ids == [None, None] + sorted(i for i in ids if i is not None)
    assert len({r["part"] for r in rows}) > 2
    got = sorted(read_rows(records.read_records(spark, folder, span_bytes=64)), key=lambda r: r[1])
    assert Counter((r[0], r[3]) for r in got) == Counter(want)
    assert [r[0] for r in got] == ids
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    assert all(r[2] == len(r[3]) for r in got)


def test_records_are_framed_as_said(spark):
    folder = fresh_path(spark, "records-test")
    docs = spark.createDataFrame([(5, "one two"), (6, None)], "doc_id long, text string")
    index = records.write_records(docs, folder).orderBy("part", "record").collect()
    (first, second) = expected_records([(5, "one two"), (6, None)])
    raw = b""
    for part in dict.fromkeys(r["file"] for r in index):
        with open(folder.removeprefix("file://") + "/data/" + part, "rb") as file:
            raw += file.read()

    def mask(data):
        crc = plain_crc(data)
        return ((((crc >> 15) | (crc << 17)) + 0xA282EAD8) % (1 << 32)).to_bytes(4, "little")

    want = b""
    for doc, ids in (first, second):
        payload = doc.to_bytes(8, "little", signed=True) + bytes([2, 0, 0, 0]) + np.array(ids, "<u2").tobytes()
        length = len(payload).to_bytes(8, "little")
        want += length + mask(length) + payload + mask(payload)
    assert raw == want
    assert [(r["offset"], r["bytes"]) for r in index if r["file"] == index[0]["file"]][0] == (0, 12 + 12 + 2 * len(first[1]) + 4)


def test_damaged_records_are_found(spark):
    folder = fresh_path(spark, "records-test")
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(20)], "doc_id long, text string")
    index = records.write_records(docs, folder).first()
    path = folder.removeprefix("file://") + "/data/" + index["file"]
    with open(path, "r+b") as file:
        file.seek(index["offset"] + 26)
        byte = file.read(1)
        file.seek(index["offset"] + 26)
        file.write(bytes([byte[0] ^ 4]))
    with pytest.raises(Exception, match="checksums"):
        records.read_records(spark, folder).collect()


def test_shuffled_reads_give_every_record_once(spark):
    folder = fresh_path(spark, "records-test")
    docs = spark.createDataFrame([(i, f"text number {i} " * (i % 7)) for i in range(200)], "doc_id long, text string")
    records.write_records(docs, folder, file_bytes=1000)
    straight = read_rows(records.read_records(spark, folder))
    one, again, other = (
        records.read_shuffled(spark, folder, seed, 3).collect() for seed in (1, 1, 2)
    )
    order = [r["id"] for r in one]
    assert [r["place"] for r in one] == sorted(r["place"] for r in one)
    assert order == [r["id"] for r in again] != [r["id"] for r in other]
    assert sorted(order) == list(range(200)) and order != sorted(order)
    assert {(r["id"], r["start"], bytes(r["ids"])) for r in one} == {(r[0], r[1], np.array(r[3], "<u4").tobytes()) for r in straight}


def test_no_documents_give_no_records(spark):
    folder = fresh_path(spark, "records-test")
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert records.write_records(empty, folder).count() == 0
    assert records.read_records(spark, folder).count() == 0
    assert records.read_shuffled(spark, folder).count() == 0


def test_query_11_holds_against_the_tokenizer(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want, at = {}, 0
    for doc, ids in expected_records(sorted((r[0], r[1]) for r in rows)):
        want[doc] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    got = records.op11_token_records(spark, SMALL).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == want
    assert len(got) == len(rows)


# codes


def brute_codes(vectors, parts, entries, rounds, scale):
    """[(id, vector)] without odd ones -> {id: (code, error)}, books."""
    import math

    whole = sorted((i, [math.floor(scale * x) for x in v]) for i, v in vectors)
    width = len(whole[0][1]) // parts
    books = [[v[p * width : (p + 1) * width] for _, v in whole[:entries]] for p in range(parts)]

    def nearest(y, book):
        return min((sum((a - b) ** 2 for a, b in zip(y, c, strict=True)), e) for e, c in enumerate(book))

    for turn in range(rounds + 1):
        found = {i: [nearest(v[p * width : (p + 1) * width], books[p]) for p in range(parts)] for i, v in whole}
        if turn == rounds:
            return {i: (bytes(e for _, e in f), sum(d for d, _ in f)) for i, f in found.items()}, books
        for p in range(parts):
            held = defaultdict(list)
            for i, v in whole:
                held[found[i][p][1]].append(v[p * width : (p + 1) * width])
            for e, rows in held.items():
                books[p][e] = [sum(c) // len(rows) for c in zip(*rows, strict=True)]


@pytest.mark.parametrize(("entries", "rounds", "spread"), [(16, 4, 1.0), (5, 3, 0.02), (64, 2, 1.0), (1, 2, 1.0), (2, 2, 90_000.0)])
def test_codes_equal_plain_k_means(spark, entries, rounds, spread):
    rng = np.random.default_rng(entries)
    centres = rng.normal(size=(12, 8)) * spread
    vectors = [(int(i * 3 % 307), (centres[i % 12] + rng.normal(size=8) * spread / 9).tolist()) for i in range(300)]
    df = spark.createDataFrame([(i, v, None) for i, v in vectors], "vec_id long, embedding array<double>, label int").repartition(5)
    got = codes.compress(df, parts=4, entries=entries, rounds=rounds)
    want, books = brute_codes(vectors, 4, entries, rounds, 256)
    assert {r["id"]: (bytes(r["code"]), r["error"]) for r in got.rows.collect()} == want
    assert got.books.tolist() == books
    assert len(got.kept) == rounds + 1 and all(b <= max(1, -(-entries // 8)) for k in got.kept for b in k)


def test_bounds_hold_and_spare_work():
    rng = np.random.default_rng(5)
    book = rng.integers(-200, 200, (64, 4))
    x = rng.integers(-250, 250, (500, 4))
    state, error = codes.Bounds.of(x, book, 8)
    for step in range(4):
        moved = book + rng.integers(-3, 4, book.shape) * (step != 2)
        drift = np.sqrt(((moved - book) ** 2).sum(axis=1))
        keep = 8 if step < 2 else 5
        state, error, depth = state.narrowed(keep).moved(x, moved, drift)
        d = ((x[:, None, :] - moved[None]) ** 2).sum(axis=2)
        assert (state.code == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all()
        true = np.sqrt(np.take_along_axis(d, state.near.astype(int), axis=1))
        assert (state.low <= true).all()
        rest = np.ones(d.shape, bool)
        np.put_along_axis(rest, state.near.astype(int), False, axis=1)
        rest[np.arange(len(x)), state.code] = False
        assert (state.outer <= np.sqrt(np.where(rest, d, 1 << 40).min(axis=1))).all()
        if step == 2:  # nothing moved
            assert (depth == 0).mean() > 0.7
        book = moved


def test_ties_go_to_the_lower_entry(spark):
    same = [(i, [0.0, 0.0, 1.0, 1.0], 1) for i in range(40)] + [(100 + i, [float(i % 2), 0.0, 0.0, 0.0], None) for i in range(40)]
    df = spark.createDataFrame(same, "vec_id long, embedding array<double>, label int")
    got = codes.compress(df, parts=2, entries=32)
    want, books = brute_codes([r[:2] for r in same], 2, 32, 2, 256)
    assert {r["id"]: (bytes(r["code"]), r["error"]) for r in got.rows.collect()} == want
    assert got.books.tolist() == books


def test_odd_vectors_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [1.0, None], 1), (4, [1.0, nan], 1), (5, [inf, 1.0], 1), (6, [1.0, 2.0, 3.0], 1),
        (7, [1.0, 2.0], None), (7, [1.0, 2.0], None), (None, [0.5, 1e30], 2), (9, [1.0, 2.0, 3.0, 4.0], 2), (10, [-0.001, 0.0], 2),
    ]
    extra = {c: F.lit(1) for c in ("id", "x", "code", "error", "near", "__label", "__at", "__salt")}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns(extra)
    done = codes.compress(df, parts=2, entries=3, rounds=1)
    got = codes.with_label_error(done.rows).collect()
    assert Counter(r["id"] for r in got) == Counter({7: 2, 10: 1, None: 1})
    sums = defaultdict(int)
    for r in got:
        sums[r["label"]] += r["error"]
    assert all(r["label_error"] == sums[r["label"]] for r in got) and set(sums) == {None, "2"}
    assert done.books.shape == (2, 3, 1)
    none = codes.compress(df.filter("vec_id < 7"), parts=4)
    assert none.rows.count() == 0 and codes.with_label_error(none.rows).count() == 0
    assert codes.books_digest(none.books) == hashlib.sha256(b"").hexdigest()
    assert codes.compress(df.filter("false")).rows.count() == 0


# filter audit


def failures_of(text):
    words = WORD.findall(text)
    return [
        len(words) < 50,
        100 * len(set(words)) < 65 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
    ]


def brute_audit(docs, labels):
    """[(id, text, part)], {id: (good, toxic)} -> rows."""
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = defaultdict(list)
    for i, t, part in docs:
        t = t or ""
        fails = [*failures_of(t), i is not None and least[t] < i]
        parts[part or ""].append((fails, *labels.get(i, (False, False))))
    out = {}
    for part, rows in parts.items():
        shapley = Counter()
        for order in permutations(range(5)):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                shapley[f] += len(gone)
                out[part, "".join("ABCDE"[i] for i in order), step] = [
                    len(left), len(gone), sum(r[0][f] for r in rows) - len(gone), sum(r[0][f] and sum(r[0]) == 1 for r in rows),
                    sum(r[1] for r in gone), sum(r[2] for r in gone),
                ]
        for key in [k for k in out if k[0] == part]:
            out[key].append(shapley["ABCDE".index(key[1][key[2] - 1])])
    return out


def audited(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in audit.COUNTS] for r in df.collect()}


def test_audit_of_odd_rows_holds_against_brute_force(spark, odd):
    labels = spark.createDataFrame(
        [(3, 1, 0), (3, 0, 1), (4, None, 1), (5, 1, None), (None, 1, 1), (99, 1, 1), (12, 0, 0)], "doc_id long, quality int, toxic int"
    )
    got = audited(audit.interactions(audit.document_failures(odd, labels), "ABCDE"))
    want = brute_audit(ODD, {3: (True, True), 4: (False, True), 5: (True, False)})
    assert got == want
    assert len(want) == 600 * len({r[2] or "" for r in ODD})


def test_audit_of_random_texts_in_many_tasks(spark):
    rng = random.Random(4)
    pool = ["alpha", "Beta", "gamma#", "DELTA", "e", "zeta"] + [f"w{i}" for i in range(90)]
    docs = [(i, " ".join(rng.choices(pool[: rng.choice([3, 96])], k=rng.choice([0, 4, 49, 50, 51, 120]))), f"s{rng.randrange(3)}") for i in range(300)]
    docs += [(i + 1000, docs[i % 20][1], "s1") for i in range(200)]
    labels = {i: (rng.random() < 0.5, rng.random() < 0.3) for i in range(0, 1200, 2)}
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(7)
    said = spark.createDataFrame([(i, int(g), int(t)) for i, (g, t) in labels.items()], "doc_id long, quality int, toxic int")
    assert audited(audit.interactions(audit.document_failures(df, said), "ABCDE")) == brute_audit(docs, labels)


def test_removal_steps_are_the_first_failing_place():
    _, at, step = audit.orders_of("ABC")
    fails = np.array([[0, 0, 0], [1, 0, 0], [0, 1, 1], [1, 1, 1]], dtype=bool)
    got = audit.removal_steps(fails, step)
    for row, mask in enumerate(fails):
        for o, order in enumerate(at):
            first = [s for s, f in enumerate(order, 1) if mask[f]]
            assert got[row, o] == (first[0] if first else audit.NEVER)


def test_audit_of_other_filters_and_no_rows(spark):
    flags = spark.createDataFrame(
        [("p", True, None, True, False, 3), (None, False, True, False, True, 2)],
        "part string, x boolean, y boolean, good boolean, toxic boolean, n long",
    )
    got = audited(audit.interactions(flags, "xy"))
    assert got["p", "xy", 1] == [0, 3, 0, 3, 3, 0, 6] and got["", "yx", 1] == [0, 2, 0, 2, 0, 2, 4]
    assert got["p", "yx", 1] == [3, 0, 0, 0, 0, 0, 0] and len(got) == 8
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.interactions(audit.document_failures(empty, labels), "ABCDE").count() == 0
    with pytest.raises(ValueError):
        audit.interactions(flags, "ABCDEFG")
