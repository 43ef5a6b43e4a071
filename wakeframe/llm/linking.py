"""Links between rows that share a bucket, and the components the links make.

Buckets are never expanded into all their pairs. Every member of a bucket is
compared with one leader; only members that the leader doesn't hold together are
compared further. Components, links and members stay in Spark tables.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeframe.session import Stages


def _ordered(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter(F.col("a") != F.col("b"))
        .distinct()
    )


def _flat(parents: DataFrame, stages: Stages) -> DataFrame:
    """Point every node of a forest at its root, in about log2(depth) passes."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("up"))
        new = parents.join(up, "root", "left").select(
            "node", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")
        )
        new = stages.keep(new, "parents")
        stages.drop(parents)
        parents = new.select("node", "root")
        if new.filter("moved").isEmpty():
            return parents


def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """(node, root): the smallest node reachable from each node that isn't it itself.

    ``edges`` has columns a and b. Each pass hangs every node below its smallest
    smaller neighbour, flattens that forest and carries on with the links between
    its roots only. A star, the usual shape here, is done after one pass. Nodes
    without a smaller reachable node get no row. No edges: no rows.
    """
    live = stages.keep(_ordered(edges), "edges")
    done: DataFrame | None = None
    while True:
        parents = stages.keep(live.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), "parents")
        parents = _flat(parents, stages)
        up = parents.select(F.col("node").alias("a"), F.col("root").alias("top"))
        first = live.join(up, "a").filter("top <> b").select(F.col("top").alias("a"), "b").distinct()
        down = parents.select(F.col("node").alias("b"), F.col("root").alias("low"))
        both = first.join(down, "b", "left").select("a", F.coalesce("low", "b").alias("b"))
        before, live = live, stages.keep(_ordered(both), "edges")
        stages.drop(before)
        last = live.isEmpty()
        if done is None and last:
            return parents
        done = parents if done is None else done.unionByName(parents)
        if last:
            return _flat(stages.keep(done, "forest"), stages)


class Compare(NamedTuple):
    """How to compare nodes, each of which is a set.

    ``overlaps`` takes distinct pairs (a, b) and adds the sizes ``na`` and ``nb`` and
    the number of common members, ``both``. ``differences`` takes (node, leader, root) and
    returns rows (node, leader, root, member), one for each member that only one of the
    node and the leader has. ``contents`` takes (node) and returns rows (node, member) of
    distinct 64-bit members; without it no family is compared by sketches.
    """

    overlaps: Callable[[DataFrame], DataFrame]
    differences: Callable[[DataFrame], DataFrame]
    contents: Callable[[DataFrame], DataFrame] | None = None


#: Leaders tried in turn before the rest of a family is compared member by member.
LEADERS = 2
#: Members of the largest family whose pairs are told apart by sketches.
SKETCHED = 512
#: 64-bit words of a sketch.
WORDS = 8


def linked(
    members: DataFrame, ready: Callable[[DataFrame], Compare], similarity: float, stages: Stages
) -> DataFrame:
    """Components (node, root) of members (bucket, node), given once each.

    Two nodes of a bucket are linked when the Jaccard similarity of their sets is at
    least ``similarity``. ``ready`` gets the distinct nodes that share a bucket, once.

    1. Every member is compared with its bucket's leader, the one that shares buckets
       most, so that the text others derive from leads its copies. The members of a
       leader's buckets are its family.
    2. In families that still hold several components, members outside the largest
       one are compared with further leaders from among themselves.
    3. Members still outside are compared with the rest of their family where that
       can succeed. In families of at most ``SKETCHED`` members that is told pair by pair
       from the sizes and from sketches (``_sketches``), which take no more room than a few
       members; most families are small, and what tells unlike sets apart is larger than they are.
       In larger families, what tells x from its leader is the set of members that only one of
       the two has. Two members x and y differ in what only one of their two such sets
       holds, and a link allows them few differences, so that far from the leader it needs
       many of them in common. Pairs that share one are found by an equal join on it. If r
       must be shared, a set can do without its r - 1 commonest: the rarest that two share
       has r - 1 commoner ones in both. So what much of a family has in common brings
       nobody together. A member of another component than its leader needs one at
       least, since it isn't linked with the leader.

    So the components are those of comparing all pairs of every bucket.
    """
    # members are dealt once, for the sizes of buckets and for those that are in one of several
    dealt = members.repartition("bucket")
    ends = F.min("node").alias("low"), F.max("node").alias("high")
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("n"), *ends).filter("low < high").select("bucket", "n")
    shared = stages.keep(dealt.join(sizes.hint("shuffle_hash"), "bucket"), "shared")
    scores = stages.keep(shared.groupBy("node").agg(F.sum("n").alias("score")), "scores")
    compare = ready(scores.select("node"))
    scored = stages.keep(shared.select("bucket", "node").join(scores, "node"), "scored")
    lead = stages.keep(_leaders(scored, "bucket"), "leaders")
    led = stages.keep(scored.join(lead, "bucket").filter("node <> leader").drop("bucket").distinct(), "led")
    stages.drop(shared, scored, lead)
    known, links = _compared(led, compare, similarity, stages)
    ends = led.withColumns({"a": F.greatest("node", "leader"), "b": F.least("node", "leader")})
    first = F.col("node") == F.col("a")
    size, lead_size = (F.when(first, F.col(x)).otherwise(F.col(y)) for x, y in (("na", "nb"), ("nb", "na")))
    family = ends.join(known, ["a", "b"]).select("leader", "node", "score", size.alias("n"), lead_size.alias("m"), "both")
    family = stages.keep(family, "family")
    known = known.select("a", "b")
    found = components(links, stages)
    rows, outside, settled = _unsettled(family, found, stages)
    for _ in range(LEADERS - 1):
        if settled:
            return found
        lead = _leaders(outside, "leader", "next")
        led = outside.join(lead, "leader").filter("node <> next").select("node", F.col("next").alias("leader"))
        tests, more = _compared(led, compare, similarity, stages)
        known = known.unionByName(tests.select("a", "b"))
        if not more.isEmpty():
            links = links.unionByName(more)
            found = components(links, stages)
            rows, outside, settled = _unsettled(family, found, stages)
    if settled:
        return found
    near, used = None, []
    if compare.contents:
        sizes = rows.groupBy("leader").agg(F.count("*").alias("k"))
        small = stages.keep(sizes.filter(F.col("k") <= SKETCHED).select("leader"), "small")
        few = stages.keep(rows.join(small, "leader").join(outside.select("leader").distinct(), "leader", "left_semi"), "few")
        near = stages.keep(_by_sketches(few, outside.select("node", "leader"), compare, similarity, stages), "near")
        stages.drop(few)
        rows = stages.keep(rows.join(small, "leader", "left_anti"), "large")
    if near is None or not rows.isEmpty():
        telling = stages.keep(_telling(rows, compare, similarity, stages), "telling")
        used.append(telling)
        one, other = outside.select("node", "leader").join(telling, ["node", "leader"]).alias("x"), telling.alias("y")
        need = (F.col("x.weight") + F.col("y.weight")) / 2 - 1e-6
        met = (F.col("x.leader") == F.col("y.leader")) & (F.col("x.member") == F.col("y.member"))
        able = (F.col("x.root") != F.col("y.root")) & (need <= F.least("x.apart", "y.apart"))
        able &= (F.col("x.rank") >= need) & (F.col("y.rank") >= need)
        more = one.join(other, met & able).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        near = near.unionByName(more) if near is not None else more
    new = _ordered(near).join(known, ["a", "b"], "left_anti")
    last = _linked_of(stages.keep(compare.overlaps(stages.keep(new, "pairs")), "tests"), similarity)
    stages.drop(*used)
    return components(links.unionByName(last), stages)


def _sketches(contents: DataFrame) -> DataFrame:
    """(node, s0, s1, ..): of each of 64 ``WORDS`` classes of members, whether a node has an odd number.

    A member that only one of two sets has changes one bit, so sketches differ in no more bits
    than the sets do in members.
    """
    word, bit = F.col("member").bitwiseAND(WORDS - 1), F.shiftright("member", 8).bitwiseAND(63).cast("int")
    flip = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = [F.bit_xor(F.when(word == w, flip).otherwise(F.lit(0).cast("long"))).alias(f"s{w}") for w in range(WORDS)]
    return contents.groupBy("node").agg(*words)


def _by_sketches(rows: DataFrame, outside: DataFrame, compare: Compare, similarity: float, stages: Stages) -> DataFrame:
    """(a, b): pairs of a family and different components, one of them ``outside``, that sizes and sketches let be linked."""
    sketches = stages.keep(_sketches(compare.contents(rows.select("node").distinct())), "sketches")
    marked = rows.select("node", "leader", "root", "n", (F.col("n") + F.col("m") - 2 * F.col("both")).alias("apart"))
    marked = marked.join(sketches, "node")
    one, other = marked.join(outside, ["node", "leader"], "left_semi").alias("x"), marked.alias("y")
    # the members that only one of the two may have
    most = (F.col("x.n") + F.col("y.n")) * ((1 - similarity) / (1 + similarity)) + 1e-6
    met = (F.col("x.leader") == F.col("y.leader")) & (F.col("x.root") != F.col("y.root"))
    able = (F.abs(F.col("x.n") - F.col("y.n")) <= most) & (F.abs(F.col("x.apart") - F.col("y.apart")) <= most)
    bits = sum(F.bit_count(F.col(f"x.s{w}").bitwiseXOR(F.col(f"y.s{w}"))) for w in range(WORDS))
    return one.join(other, met & able & (bits <= most)).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _telling(rows: DataFrame, compare: Compare, similarity: float, stages: Stages) -> DataFrame:
    """(node, leader, root, apart, weight, member, rank): the members that can bring two of a family together.

    A set of ``apart`` members tells the node from its leader. x and y are linked if they
    share (x.weight + y.weight) / 2 of these at least. Ranks count from the commonest of
    a family down, among members that several of its components have, and begin with
    the least number that the node shares with anyone it is linked with.
    """
    share = (1 - similarity) / (1 + similarity)
    rows = rows.withColumn("apart", F.col("n") + F.col("m") - 2 * F.col("both"))
    rows = rows.withColumn("weight", F.col("apart") - share * F.col("n"))
    most = rows.groupBy("leader").agg(F.min("weight").alias("lightest"), F.max("n").alias("largest"))
    # the other has as many as are shared at least, and no more members than the largest
    least = F.greatest((F.col("weight") + F.col("lightest")) / 2, F.col("weight") - share * F.col("largest"))
    needed = rows.join(most, "leader").withColumn("least", F.greatest(F.ceil(least - 1e-6), F.lit(1)))
    needed = needed.filter("least <= apart").select("node", "leader", "root", "apart", "weight", "least")
    needed = stages.keep(needed, "needed")
    told = stages.keep(compare.differences(needed.select("node", "leader", "root")), "differences")
    common = told.groupBy("leader", "member").agg(
        F.count("*").alias("k"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    common = common.filter("low < high").select("leader", "member", "k")
    rank = F.row_number().over(Window.partitionBy("leader", "node").orderBy(F.desc("k"), "member"))
    ranked = told.drop("root").join(common, ["leader", "member"]).withColumn("rank", rank).drop("k")
    return ranked.join(needed, ["leader", "node"]).filter("rank >= least").drop("least")


def _leaders(rows: DataFrame, group: str, name: str = "leader") -> DataFrame:
    lead = rows.groupBy(group).agg(F.max(F.struct("score", "node")).alias("lead"))
    return lead.select(group, F.col("lead.node").alias(name))


def _linked_of(tests: DataFrame, similarity: float) -> DataFrame:
    enough = F.col("both") >= similarity * (F.col("na") + F.col("nb") - F.col("both")) - 1e-9
    return tests.filter(enough).select("a", "b")


def _compared(led: DataFrame, compare: Compare, similarity: float, stages: Stages):
    pairs = _ordered(led.select(F.col("node").alias("a"), F.col("leader").alias("b")))
    tests = stages.keep(compare.overlaps(pairs), "tests")
    return tests, _linked_of(tests, similarity)


def _unsettled(family: DataFrame, found: DataFrame, stages: Stages):
    """Members of families that hold several components, those of them outside their
    family's largest one, and whether there are none."""
    rooted = family.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = stages.keep(rooted, "rooted")
    sizes = rooted.groupBy("leader", "root").agg(F.count("*").alias("k"))
    main = sizes.groupBy("leader").agg(F.max(F.struct("k", "root")).alias("most"), F.count("*").alias("parts"))
    main = stages.keep(main.filter("parts > 1").select("leader", F.col("most.root").alias("main")), "main")
    rows = rooted.join(main, "leader")
    return rows.drop("main"), rows.filter("root <> main").drop("main"), main.isEmpty()
