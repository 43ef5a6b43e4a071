import random
import time
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeframe.llm import line_dedup, linking
from wakeframe.llm.line_dedup import band_keys, dedup_lines, line_classes, shingle_sets, signatures, signed_lines
from wakeframe.llm.linking import components
from wakeframe.llm.near_dedup import drop_near_duplicates, near_classes
from wakeframe.llm.vector_dedup import estimate, rotation, vector_links
from wakeframe.session import Stages


def closure(nodes, links):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    return {n: top(n) for n in nodes}


def bag(text):
    w = text.split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def alike(x, y):
    both = sum((x & y).values())
    return both >= 0.8 * (sum(x.values()) + sum(y.values()) - both) > 0


def family(r, base, n, edits):
    for _ in range(n):
        w = base.split()
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"w{r.randrange(10**6)}"
        yield " ".join(w)


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_closure(spark, seed):
    r = random.Random(seed)
    links = [(r.randrange(150), r.randrange(150)) for _ in range(110)] + [(i, i + 1) for i in range(200, 240)]
    found = components(spark.createDataFrame(links, "a long, b long"), Stages(spark)).collect()
    wanted = {n: t for n, t in closure({n for e in links for n in e}, links).items() if n != t}
    assert {x["node"]: x["root"] for x in found} == wanted
    assert len(found) == len(wanted)


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long"), Stages(spark)).count() == 0


def test_near_classes_equal_all_pairs(spark):
    r = random.Random(3)
    texts = []
    for _ in range(4):  # families whose members are near some others but not all
        base = " ".join(f"v{r.randrange(3000)}" for _ in range(150))
        texts += [*family(r, base, 40, 9)]
    texts += [" ".join(f"u{r.randrange(3000)}" for _ in range(r.randint(1, 80))) for _ in range(40)]
    texts += ["same here", "same here", "same here now"]
    got = near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    bags = [bag(t) for t in texts]
    wanted = closure(range(len(texts)), [(i, j) for i, j in combinations(range(len(texts)), 2) if alike(bags[i], bags[j])])
    assert {x["doc_id"]: x["class_id"] for x in got} == wanted


class Counting(Stages):
    """Keeps tables as others do, and the number of rows of each name."""

    def keep(self, df, name="stage"):
        kept = super().keep(df, name)
        self.rows = getattr(self, "rows", Counter())
        self.rows[name] += kept.count()
        return kept


def test_what_a_family_has_in_common_brings_nobody_together(spark):
    r = random.Random(21)
    base = [f"v{r.randrange(10**6)}" for _ in range(150)]
    texts = [" ".join(base)]
    for i in range(120):  # one edit that all share, and four that put each far from the others
        w = texts[r.randrange(1, i)].split() if i % 10 == 9 else [*base[:70], "common", *base[71:]]
        for _ in range(1 if i % 10 == 9 else 4):
            w[r.randrange(0, 60)] = f"w{r.randrange(10**6)}"
        texts.append(" ".join(w))
    stages = Counting(spark)
    got = near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), stages=stages).collect()
    bags = [bag(t) for t in texts]
    wanted = closure(range(len(texts)), [(i, j) for i, j in combinations(range(len(texts)), 2) if alike(bags[i], bags[j])])
    assert {x["doc_id"]: x["class_id"] for x in got} == wanted
    assert stages.rows["pairs"] < 1000  # of 7,260


def odd_rows():
    text = " ".join(f"w{i}" for i in range(60))
    return [
        (None, None, "a"),
        (None, text, "b"),
        (1, None, "c"),
        (2, "", "d"),
        (3, " \n ", "e"),
        (4, text, "f"),
        (4, text, "f"),
        (5, text + " more", "g"),
        (6, " ".join(f"x{i}" for i in range(200_000)), "h"),
    ]


ODD = "doc_id long, text string, node string"


def test_near_classes_on_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), ODD).withColumns({"tag": F.lit(1), "bands": F.lit("x"), "kept": F.lit(0)})
    got = Counter((x["doc_id"], x["class_id"]) for x in near_classes(docs).collect())
    assert got == Counter([(None, None), (None, 4), (1, 1), (2, 2), (3, 3), (4, 4), (4, 4), (5, 4), (6, 6)])
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(x["doc_id"]) for x in kept.collect()) == ["1", "2", "3", "4", "4", "6", "None"]


@pytest.mark.parametrize("run", [near_classes, drop_near_duplicates, dedup_lines])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], ODD)).count() == 0


def shingle_set(line, width=5):
    return {line[i : i + width] for i in range(max(1, len(line) - width + 1))}


def test_lines_equal_brute_force(spark):
    r = random.Random(8)
    base = [" ".join(f"{r.choice('abcd')}{r.randrange(500)}" for _ in range(30)) for _ in range(12)]
    docs = []
    for i in range(40):
        lines = []
        for _ in range(r.randint(1, 5)):
            w = r.choice(base).split(" ")
            if r.random() < 0.5:
                w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
            lines.append(" ".join(w))
            if r.random() < 0.3:
                lines.append("short")
        docs.append((i, "\n".join(lines)))
    lines = {line for _, t in docs for line in t.split("\n") if len(line) >= 16}
    sets = {line: shingle_set(line) for line in lines}
    links = [(a, b) for a, b in combinations(sorted(lines), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root, seen, wanted = closure(lines, links), set(), {}
    for i, t in docs:
        kept = []
        for line in t.split("\n"):
            if len(line) >= 16 and root[line] in seen:
                continue
            seen.add(root.get(line))
            kept.append(line)
        wanted[i] = "\n".join(kept)
    got = dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {x["doc_id"]: x["text"] for x in got} == wanted
    assert any(x["n_dropped_lines"] for x in got)


def test_lines_on_odd_rows(spark):
    long = "one line that comes again in others\n"
    rows = odd_rows() + [(7, long + "and some text of its own here", "i"), (8, long, "j"), (9, long * 3000, "k")]
    docs = spark.createDataFrame(rows, ODD).withColumns({"n_lines": F.lit("mine"), "line": F.lit(2), "bucket": F.lit(3)})
    got = dedup_lines(docs)
    assert got.columns == [*docs.columns, "n_dropped_lines"]
    found = {(str(x["doc_id"]), x["node"]): x["text"] for x in got.collect()}
    assert got.count() == len(rows)
    text = " ".join(f"w{i}" for i in range(60))
    assert found["None", "a"] is None and found["None", "b"] == text  # a null id comes first
    assert found["2", "d"] == "" and found["3", "e"] == " \n "
    assert found["4", "f"] == "" and found["5", "g"] == ""
    assert found["7", "i"] == rows[9][1] and found["8", "j"] == "" and found["9", "k"] == ""


def test_texts_of_many_lines_take_time_in_proportion(spark):
    """Each text is split once, not once a line: 30,000 lines, half of which repeat an earlier text's."""
    fresh = [f"line {i} of its own {i * 7919 % 100003} {i * 104729 % 1000003} {i * 15485863 % 10000019}" for i in range(30_000)]
    again = [fresh[i] if i % 2 else f"{fresh[i][::-1]} {i}" for i in range(30_000)]
    docs = spark.createDataFrame([(1, "\n".join(fresh)), (2, "\n".join(again)), (2, "\n".join(again))], "doc_id long, text string")
    plan = dedup_lines(docs, bands=1)
    began = time.perf_counter()
    got = sorted(map(tuple, plan.select("doc_id", "n_lines", "n_dropped_lines", "text").collect()))
    assert time.perf_counter() - began < 60
    assert got[0][1:] == (30_000, 0, "\n".join(fresh))
    assert sorted(x[2] for x in got[1:]) == [15_000, 30_000]
    assert {x[3] for x in got[1:]} == {"", "\n".join(again[::2])}


def test_lines_that_differ_late_in_long_words_stay(spark):
    apart = [
        ("2024-01-01,12.5,abc,99", "2024-01-01,77.1,xyz,33"),
        ("See https://en.wikipedia.org/wiki/Alpha", "See https://en.wikipedia.org/wiki/Zebrafish"),
        ("\u4e2d\u6587" * 5 + "\u6c34\u706b\u6728\u91d1\u571f\u65e5", "\u4e2d\u6587" * 5 + "\u5c71\u5ddd\u7530\u6797\u68ee\u77f3"),
    ]
    lines = [line for pair in apart for line in pair]
    got = dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    assert {x["doc_id"]: x["text"] for x in got} == dict(enumerate(lines))


def test_near_lines_equal_all_positions(spark):
    r = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    families = []
    for k in range(10):
        word = " ".join("".join(r.choices(letters, k=r.randint(3, 9))) for _ in range(10 if k % 2 else 25))
        solid = "".join(r.choices(letters, k=r.randint(60, 300)))
        for base in (word, solid):
            at = r.randrange(3, 9)
            families.append([base, base[:at] + "#" + base[at:], base[:-4] + "end" + base[-4:], base[::-1]])
    lines = [line for f in families for line in f]
    sets = [{line[i : i + 5] for i in range(len(line) - 4)} for line in lines]
    near = [(i, j) for i, j in combinations(range(len(lines)), 2) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    root = closure(range(len(lines)), near)
    got = dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    assert {x["doc_id"] for x in got if x["text"]} == set(root.values())
    assert len(near) >= 40


def test_one_of_repeated_rows_stays(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near = " ".join(f"v{i}" for i in range(60))
    rows = [(4, text)] * 5 + [(5, text + " more")] + [(None, near)] * 3 + [(None, near + " x")] + [(6, "tiny")] * 2 + [(7, None)]
    docs = spark.createDataFrame([(*row, len(row[1] or "")) for row in rows], "doc_id long, text string, n_chars long")
    kept = Counter((x["doc_id"], x["class_id"]) for x in near_classes(docs).filter("kept").collect())
    assert kept == Counter([(4, 4), (None, None), (6, 6), (7, 7)])
    once = drop_near_duplicates(docs, repeats=False)
    assert once.columns == docs.columns
    found = [(x["doc_id"], x["text"]) for x in once.collect()]
    assert Counter(i for i, _ in found) == Counter([4, None, 6, 7])
    assert (4, text) in found and (6, "tiny") in found and (7, None) in found
    lines = Counter((x["doc_id"], x["text"]) for x in dedup_lines(docs).collect())
    assert lines[4, text] == 1 and lines[4, ""] == 4 and lines[5, ""] == 1
    assert lines[6, "tiny"] == 2 and lines[7, None] == 1
    assert sum(n for (i, t), n in lines.items() if i is None and t) == 1


def brute_vectors(rows, cosine=0.95):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = [
        (a, b)
        for a, b in combinations(sorted(ok), 2)
        if len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / np.linalg.norm(ok[a]) / np.linalg.norm(ok[b]) >= cosine
    ]
    count = Counter(n for e in links for n in e)
    root = closure([i for i, _ in rows if i is not None], links)
    return {i: (count[i], root[i]) for i in root}


def test_vectors_equal_brute_force(spark):
    r = np.random.default_rng(2)
    rows = []
    for _ in range(6):
        base = r.normal(size=32)
        rows += [base + r.normal(size=32) * s for s in r.choice([0.02, 0.1, 0.2], 25)]
    tight = r.normal(size=32)
    rows += [tight + r.normal(size=32) * 0.03 for _ in range(150)] + list(r.normal(size=(80, 32)))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rows)]
    got = vector_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), miss=1e-6).collect()
    wanted = brute_vectors(rows)
    assert {x["vec_id"]: (x["n_links"], x["component_id"]) for x in got} == wanted
    assert all(x["kept"] == (x["vec_id"] == x["component_id"]) for x in got)


def test_vectors_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [0.0, 0.0, 0.0]), (4, None), (5, []), (6, [1.0, None, 0.0]),
        (7, [nan, 1.0, 0.0]), (8, [inf, 1.0, 0.0]), (9, [1.0, 0.0]), (10, [1e300, 1e300, 0.0]), (None, [1.0, 0.0, 0.0]),
        (2, [2.0, 0.0, 0.0]), (11, [-1.0, 0.0, 0.0]), (12, [1e-300, 1e-300, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("bucket", F.lit(1))
    got = {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in vector_links(table).collect()}
    lone = {i: (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 11)}
    assert got == lone | {1: (1, 1, True), 2: (1, 1, False), 10: (1, 10, True), 12: (1, 10, False), None: (0, None, True)}
    assert vector_links(table.limit(0)).count() == 0


def test_estimates_are_unbiased():
    r = np.random.default_rng(4)
    x, y = r.normal(size=(2, 48))
    x, y = x / np.linalg.norm(x), y / np.linalg.norm(y)
    found, bounds = [], []
    for k in range(400):
        turn = rotation(48, 1000 + k)
        a, b = turn @ x, turn @ y
        factor = (np.where(a >= 0, 1, -1) / np.sqrt(48)) @ a
        value, bound = estimate(a[None], np.array([factor]), b[None], np.array([1.0]))
        found.append(value[0])
        bounds.append(bound[0])
    assert abs(np.mean(found) - x @ y) < 4 * np.std(found) / 20
    assert np.std(found) < 1.2 * np.mean(bounds)
    assert np.mean(np.abs(np.array(found) - x @ y) > 4 * np.array(bounds)) < 0.01


def lines_as_texts(lines):
    import pyarrow as pa

    from wakeframe.llm.words import texts_of

    return texts_of(pa.array(lines, pa.large_string()))


def test_shingle_sets_are_those_of_characters():
    lines = ["abcdefg", "abcabcabc", "abc", "日本語テキスト日本語", "éa\U0001f600bcd", "x" * 300, "a", "abcd"]
    row, shingle = shingle_sets(lines_as_texts(lines), 0, len(lines))
    mine = [set(shingle[row == i].tolist()) for i in range(len(lines))]
    plain = [shingle_set(line) for line in lines]
    assert [len(s) for s in mine] == [len(s) for s in plain]
    for i, j in combinations(range(len(lines)), 2):
        assert len(mine[i] & mine[j]) == len(plain[i] & plain[j])


@pytest.mark.parametrize("size", [14, 40, 300])
def test_bands_find_near_lines(size):
    """Of pairs just at 0.8 and a little above, 96 in 100 share a band, of pairs at 0.3 few do."""
    r = random.Random(size)
    lines = []
    for near in (True, False):
        for _ in range(400):
            base = [r.randrange(1 << 48) for _ in range(size)]
            keep = -(-size * 8 // 9) if near else size * 6 // 13  # k of n in common: k / (2n - k)
            lines += [base, base[:keep] + [r.randrange(1 << 48) for _ in range(size - keep)]]
    row = np.repeat(np.arange(len(lines)), size)
    shingle = np.concatenate([np.sort(np.array(x, np.uint64)) for x in lines])
    keys = band_keys(signatures(row, shingle, len(lines), 84), 6)
    met = (keys[::2] == keys[1::2]).any(axis=1)
    assert met[:400].mean() > 0.95 and met[400:].mean() < 0.1


def test_near_lines_of_the_test_table_are_found(spark):
    """Against all pairs of lines that share a shingle few others have."""
    from collections import defaultdict

    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    lines = sorted({x for r in rows if r["text"] for x in r["text"].split("\n") if len(x.strip()) >= 16})
    sets = [shingle_set(x) for x in lines]
    places = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            places[x].append(i)
    # of two sets at 0.8 each has a shingle of the other among its rarest fifth and one more
    pairs = set()
    for i, s in enumerate(sets):
        rare = sorted(s, key=lambda x: (len(places[x]), x))[: len(s) - int(0.8 * len(s)) + 1]
        pairs |= {(min(i, j), max(i, j)) for x in rare for j in places[x] if j != i and 0.8 <= len(s) / len(sets[j]) <= 1.25}
    links = [(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    root = closure(range(len(lines)), links)
    kept = {x for r in dedup_lines(spark.createDataFrame(rows)).collect() if r["text"] for x in r["text"].split("\n") if len(x.strip()) >= 16}
    classes = {root[i] for i in range(len(lines))}
    got = {root[i] for i, x in enumerate(lines) if x in kept}
    assert len(links) > 150 and got == classes  # one line of every class stays
    extra = sum(x in kept for x in lines) - len(classes)
    assert extra <= 0.03 * len(links)


@pytest.mark.parametrize("run", [dedup_lines, drop_near_duplicates, lambda d: drop_near_duplicates(d, repeats=False)])
def test_columns_of_any_name(spark, run):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, text + " more"), (3, None)]
    names = ["__id", "__tag", "__gone", "__later", "__row", "__first", "id", "tag", "text2", "c0", "c1", "later", "gone", "row", "first", "i", "t", "__i", "__t", "N_lines2"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in names})
    got = run(docs).collect()
    assert all(r[c] == c for r in got for c in names) and len(got) >= 2


def test_line_dedup_runs_no_python_on_the_executors(spark):
    near = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(1, near), (2, near + " more"), (3, "a line of its own, unlike others")], "doc_id long, text string")
    plans = []

    class Seeing(Stages):
        def keep(self, df, name="stage"):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return super().keep(df, name)

    assert line_classes(docs, stages=Seeing(spark)).count() == 1
    assert plans and not [p for p in plans if "Python" in p or "Pandas" in p or "Arrow" in p]


@pytest.mark.parametrize("size", [4, 12, 20, 38, 45, 102, 110, 300])
def test_signed_lines_meet_when_near(spark, size):
    """Of pairs of sets just at 0.8, 95 in 100 share a key, whatever their size; of pairs at 0.3 few do."""
    r = random.Random(size)
    letters = [chr(c) for c in range(0x4E00, 0x9F00)]
    lines = []
    for near in (True, False):
        for _ in range(250):
            # characters of their own make n shingles of n + 4; an end cut off leaves a subset
            base = "".join(r.sample(letters, size + 4))
            other = base[: 4 + -(-size * 4 // 5)] if near else base[: 4 + -(-size * 3 // 10)]
            lines += [base, other]
    table = spark.createDataFrame(list(enumerate(lines)), "line long, text string")
    keys = {}
    for x in signed_lines(table).collect():
        keys.setdefault(x["line"], set()).update(x["bands"])
    met = [bool(keys[2 * i] & keys[2 * i + 1]) for i in range(500)]
    assert sum(met[:250]) >= 0.95 * 250
    assert sum(met[250:]) <= 0.25 * 250


def test_lines_of_few_shingles_meet(spark):
    rows = [(1, "=" * 30), (2, "=" * 90), (3, "ab" * 10), (4, "ab" * 40), (5, "-=" * 20 + "x"), (6, "\U0001f600" * 20)]
    got = {x["doc_id"]: x["text"] for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i, t in got.items() if not t] == [2, 4]


def _family(spark, told):
    """(members, ready) of one bucket: a leader with copies, and a pair far from it and near each other."""
    base = list(range(100))
    sets = {1: base, 2: base[5:] + [200], 3: base[:96]}
    sets |= {4: base[:40] + list(range(300, 360)), 5: base[:40] + list(range(300, 359)) + [400]}
    sets |= {6: base[60:] + list(range(500, 530)), 7: list(range(100, 190)), 8: base[30:] + list(range(100, 120))}
    scramble = 0x9E3779B97F4A7C15
    rows = [(n, [((x + 1) * scramble & (2**64 - 1)) - 2**63 for x in s]) for n, s in sets.items()]
    table = spark.createDataFrame(rows, "node long, members array<long>").cache()
    # node 1 shares two buckets with others, so it leads
    members = spark.createDataFrame([(1, n) for n in sets] + [(2, n) for n in (1, 2, 3)], "bucket long, node long")

    def overlaps(pairs):
        both = pairs.join(table.toDF("a", "x"), "a").join(table.toDF("b", "y"), "b")
        sizes = {"na": F.size("x"), "nb": F.size("y"), "both": F.size(F.array_intersect("x", "y"))}
        return both.select("a", "b", *[n.cast("long").alias(c) for c, n in sizes.items()])

    def differences(rows):
        told.append("differences")
        both = rows.join(table.toDF("node", "x"), "node").join(table.toDF("leader", "y"), "leader")
        apart = F.concat(F.array_except("x", "y"), F.array_except("y", "x"))
        return both.select("node", "leader", "root", F.explode(apart).alias("member"))

    def contents(nodes):
        return nodes.join(table, "node").select("node", F.explode("members").alias("member"))

    return sets, members, lambda shared: linking.Compare(overlaps, differences, contents)


@pytest.mark.parametrize("largest", [512, 0])
def test_small_families_are_compared_without_their_differences(spark, monkeypatch, largest):
    monkeypatch.setattr(linking, "SKETCHED", largest)
    monkeypatch.setattr(linking, "LEADERS", 1)
    told = []
    sets, members, ready = _family(spark, told)
    found = {r.node: r.root for r in linking.linked(members, ready, 0.8, Stages(spark)).collect()}
    near = [(a, b) for a in sets for b in sets if a < b and len(set(sets[a]) & set(sets[b])) >= 0.8 * len({*sets[a], *sets[b]})]
    assert (4, 5) in near
    assert found == {n: t for n, t in closure(sets, near).items() if n != t}
    assert bool(told) == (largest == 0)


def test_sketches_differ_in_no_more_bits_than_sets_in_members(spark):
    a, b = range(-5000, 5000, 7), range(-4000, 6000, 7)
    hashed = [(n, x * 0x632BE59BD9B4E019 % 2**64 - 2**63) for n, s in ((1, a), (2, b)) for x in s]
    one, other = linking._sketches(spark.createDataFrame(hashed, "node long, member long")).orderBy("node").collect()
    bits = sum(bin((one[f"s{w}"] ^ other[f"s{w}"]) & (2**64 - 1)).count("1") for w in range(linking.WORDS))
    assert 50 < bits <= len({x for _, x in hashed[: len(a)]} ^ {x for _, x in hashed[len(a) :]})


@pytest.mark.parametrize("places", [1 << 26, 1 << 12])
def test_a_bitmap_lets_all_wanted_rows_through_and_few_others(spark, monkeypatch, places):
    monkeypatch.setattr(line_dedup, "PLACES", places)
    rows = spark.range(20000).select(F.xxhash64("id").alias("line"), "id")
    wanted = rows.filter("id % 40 = 0").select("line")
    found = {r.id for r in line_dedup._among(rows, "line", wanted).collect()}
    assert set(range(0, 20000, 40)) <= found
    assert len(found) < 20000 * (0.1 if places > 1 << 12 else 0.2)
    assert line_dedup._among(rows, "line", wanted.limit(0)).count() == 0


def test_lines_without_a_shared_band_do_not_travel_to_be_compared(spark, monkeypatch):
    """Of the texts of all lines only those that can be linked are dealt out."""
    seen = []
    among = line_dedup._among

    def counted(rows, key, wanted):
        out = among(rows, key, wanted)
        seen.append((rows.count(), wanted.count(), out.count()))
        return out

    monkeypatch.setattr(line_dedup, "_among", counted)
    r = random.Random(5)
    lone = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(60)) for _ in range(300)]
    near = ["the quick brown fox jumps over the lazy dog and runs far away " + c for c in "abcdef"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(lone + near)], "doc_id long, text string")
    assert line_classes(docs).count() == 5
    assert seen[0][0] == 306 and seen[0][1] <= 20 and seen[0][2] <= 40


def test_texts_are_looked_up_before_they_are_joined(spark):
    lines = spark.range(300).select(F.xxhash64("id").alias("line"), F.col("id").cast("string").alias("text"))
    wanted = lines.filter("text < '2'").select("line")
    texts = line_dedup._texts(lines.unionByName(lines), wanted)
    assert sorted(r.text for r in texts.collect()) == sorted(str(i) for i in range(300) if str(i) < "2")
    plan = texts._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and 0 <= plan.index("Join Inner, (line#") < plan.index("Join Inner, ((shiftright(__bitmap")
