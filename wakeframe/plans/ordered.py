"""Ordered work per key that survives hot keys.

A window partition is one task. When a single key holds a large share of all
rows, that task decides the run time. Then the table is laid out once in range
partitions by key and order, and a key's part of a range partition, its segment,
becomes a window partition of its own:

* bounded row frames get the rows just before a segment as extra copies
  (the *halo*), dropped again after the window is computed;
* running sums and maxima get the totals of the earlier segments as a *carry*;
* row numbers get the exact number of earlier rows as an offset.

Segments are numbered by range partition and, where several small ones are wanted of
a partition, by rank in it. The number is written with the rows, so a recomputed task
finds the same ones. All that is kept about them is a small
table with one row per key and segment, joined on both; no array of cut points is
searched, nothing is gathered on the driver, and keys and segments may be as many as
they are. Tables whose keys are all small pay one count and an ordinary window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wakeframe.session import cut_lineage

ROWS_PER_SEGMENT = 4_000_000
ROWS_PER_RANGE = 1_000_000  # below it, more segments don't make more range partitions

SEG = "__segment"
BEFORE = "__before"
IS_HALO = "__is_halo"
ONE_KEY = "__one_key"


def same_key(left: Sequence[Column], right: Sequence[Column]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & a.eqNullSafe(b)
    return cond


def laid_out(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], total: int, limit: int, name: str = SEG
) -> DataFrame:
    """``df``, of ``total`` rows, with segments of about ``limit`` rows numbered in ``name``, written once.

    Segments are range partitions as long as these hold enough rows for a task. Smaller
    ones are cut off a key's part of a partition by rank, so that tasks, files and the
    rows sampled for the ranges follow the rows of the table, not its segments.
    """
    wanted = math.ceil(total / limit)
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(wanted, max(spread, math.ceil(total / ROWS_PER_RANGE)))
    laid = df.repartitionByRange(ranges, *dict.fromkeys([*keys, *order]))
    laid = laid.withColumn(name, F.spark_partition_id().cast("long"))
    if ranges < wanted:
        place = F.rank().over(Window.partitionBy(*keys, name).orderBy(*order)) - 1  # equal rows stay together
        laid = laid.withColumn(name, F.shiftleft(name, 32) + F.floor(place / limit))
    return cut_lineage(laid, "segmented")


def segments(laid: DataFrame, keys: Sequence[str], halo: int) -> DataFrame:
    """One row per key and segment of ``laid``: __k0.., __s, __rows, __first, __next.

    ``__first`` is the number of the key's rows before the segment. ``__next`` lists the
    later segments that look back into this one with their ``__first``: as a segment
    has a row at least, they are among the next ``halo``.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    sizes = laid.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(SEG).alias("__s"))
    order = Window.partitionBy(*names).orderBy("__s")
    out = sizes.agg(F.count(F.lit(1)).alias("__rows"))
    out = out.withColumn("__first", F.sum("__rows").over(order) - F.col("__rows"))
    later = F.array().cast("array<struct<s: bigint, first: bigint>>")
    if halo:
        after = F.collect_list(F.struct(F.col("__s").alias("s"), F.col("__first").alias("first")))
        after = after.over(order.rowsBetween(1, halo))
        end = F.col("__first") + F.col("__rows")
        out = out.withColumns({"__after": after, "__end": end})
        later = F.filter("__after", lambda n: n["first"] < F.col("__end") + halo)
    return cut_lineage(out.select(*names, "__s", "__rows", "__first", later.alias("__next")), "segments")


class KeyedRows:
    """The rows of each key in order, with the table cut into segments if a key is hot.

    ``halo`` is the largest number of preceding rows any bounded frame needs.
    ``order`` should be unique per key; rows that tie stay in one segment.
    ``derived`` says that ``df`` is expensive to recompute: it is then written
    once, as finding hot keys reads the keys first.
    ``small_keys`` says that no key has more rows than a segment (because a
    larger table with these keys was checked before), so nothing is counted.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        halo: int = 0,
        rows_per_segment: int | None = None,
        derived: bool = False,
        small_keys: bool = False,
    ):
        if not keys:
            df = df.withColumn(ONE_KEY, F.lit(0))
        self.keys = list(keys) or [ONE_KEY]
        self.order = list(order)
        self.halo = halo
        self.layout: DataFrame | None = None
        self.df = df
        if small_keys:
            return
        if derived:
            self.df = df = cut_lineage(df)
        limit = max(rows_per_segment or ROWS_PER_SEGMENT, halo, 1)
        counts = df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("__n"))
        total, most = counts.agg(F.sum("__n"), F.max("__n")).first()
        if not total or most <= limit:
            return
        laid = laid_out(df, self.keys, self.order, total, limit)
        self.layout = segments(laid, self.keys, halo)
        self.df = self._placed(laid)

    def _on_segment(self, df: DataFrame, table: DataFrame) -> Column:
        here = [df[k] for k in self.keys]
        return same_key(here, [table[f"__k{i}"] for i in range(len(self.keys))]) & (df[SEG] == table["__s"])

    def _placed(self, laid: DataFrame) -> DataFrame:
        """Rows with the number of rows before their segment, and copies as halos."""
        columns = [c for c in laid.columns if c != SEG]
        halo = self.halo
        shown = F.col("__first") - F.least(F.col("__first"), F.lit(halo))  # a segment's halo counts as its own rows
        home = laid.join(self.layout, self._on_segment(laid, self.layout))
        home = home.select(*columns, SEG, F.lit(False).alias(IS_HALO), shown.alias(BEFORE))
        if not halo:
            return home
        backwards = Window.partitionBy(*self.keys, SEG).orderBy(*[F.desc(c) for c in self.order])
        last = laid.withColumn("__back", F.row_number().over(backwards)).filter(F.col("__back") <= halo)
        looked = last.join(self.layout, self._on_segment(last, self.layout)).withColumn("__to", F.explode("__next"))
        place = F.col("__first") + F.col("__rows") - F.col("__back") + 1  # the key's rows up to this one
        copies = looked.filter(place > F.col("__to.first") - halo).select(
            *columns,
            F.col("__to.s").alias(SEG),
            F.lit(True).alias(IS_HALO),
            (F.col("__to.first") - F.least(F.col("__to.first"), F.lit(halo))).alias(BEFORE),
        )
        return home.unionByName(copies)

    def _each(self, step: Callable[[DataFrame], DataFrame]) -> KeyedRows:
        self.df = step(self.df)
        return self

    @property
    def small_keys(self) -> bool:
        """No key was found to need a split."""
        return self.layout is None

    @property
    def parts(self) -> list[str]:
        """The columns whose rows lie together: the keys and the segment."""
        return self.keys + ([SEG] if self.layout else [])

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.parts).orderBy(*self.order)

    def with_columns(self, **columns: Column) -> KeyedRows:
        return self._each(lambda df: df.withColumns(columns))

    def frame(self, build: Callable[[WindowSpec], dict[str, Column]]) -> KeyedRows:
        """Add columns whose windows look back at most ``halo`` rows."""
        return self.with_columns(**build(self.window))

    def position(self, name: str) -> KeyedRows:
        """Add the 1-based row number per key as a long."""
        number = F.row_number().over(self.window).cast("long")
        if self.layout:
            number = number + F.coalesce(F.col(BEFORE), F.lit(0))
        return self.with_columns(**{name: number})

    def running(self, upto: int = 0, **wanted: tuple[str, Column]) -> KeyedRows:
        """Add running ``sum`` or ``max`` columns from the key's first row.

        ``upto=0`` includes the current row, ``upto=-1`` stops before it. With
        segments their totals are computed first, one row per key and segment.
        """
        frame = self.window.rowsBetween(Window.unboundedPreceding, upto)
        fold = {"sum": F.sum, "max": F.max}
        if not self.layout:
            return self.with_columns(**{n: fold[k](c).over(frame) for n, (k, c) in wanted.items()})
        value = {n: F.when(~F.col(IS_HALO), c) for n, (_, c) in wanted.items()}
        totals = self.df.groupBy(*self.keys, SEG).agg(
            *[fold[k](value[n]).alias(n) for n, (k, _) in wanted.items()]
        )
        earlier = Window.partitionBy(*self.keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
        names = [f"__k{i}" for i in range(len(self.keys))]
        carry = totals.select(
            *[F.col(k).alias(n) for k, n in zip(self.keys, names)],
            F.col(SEG).alias("__s"),
            *[fold[k](n).over(earlier).alias(f"__c_{n}") for n, (k, _) in wanted.items()],
        )
        # a key's first segment, the only one of most keys, has nothing before it
        carry = cut_lineage(carry.filter(F.coalesce(*[F.col(f"__c_{n}") for n in wanted]).isNotNull()), "carry")

        def step(df: DataFrame) -> DataFrame:
            local = df.withColumns({n: fold[k](value[n]).over(frame) for n, (k, _) in wanted.items()})
            joined = local.join(carry, self._on_segment(local, carry), "left")
            merged = {}
            for n, (k, _) in wanted.items():
                here, before = F.col(n), F.col(f"__c_{n}")
                merged[n] = F.greatest(here, before) if k == "max" else F.coalesce(here + before, here, before)
            return joined.withColumns(merged).drop("__s", *names, *[f"__c_{n}" for n in wanted])

        return self._each(step)

    def rows(self) -> DataFrame:
        """The table with all added columns, helper rows and columns removed."""
        out = self.df
        if self.layout:
            out = out.filter(~F.col(IS_HALO)).drop(SEG, BEFORE, IS_HALO)
        return out.drop(ONE_KEY)


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows per key. Spark cuts each task's share to ``n``
    before the shuffle, so a hot key sends at most ``n`` rows per task."""
    name = rank or "__rank"
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)
