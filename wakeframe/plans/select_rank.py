"""Exact order statistics over any number of groups of any size.

Equal values are counted together first. The counts are laid out in range
partitions, so a large group spreads over several; where a partition's part of a
group begins follows from one small row per partition and group. Nothing but a
scalar comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeframe.plans.ordered import laid_out, same_key
from wakeframe.session import cut_lineage

PART = "__part"
FEW = 1_000_000  # distinct rows, over all keys, that a window may rank without a layout


def value_counts(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Distinct ``keys, order`` with ``__n`` equal rows, written once."""
    return cut_lineage(df.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("__n")), "counts")


def ranked_counts(
    counts: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_segment: int | None = None
) -> DataFrame:
    """``counts`` with ``__end`` and ``__total``.

    ``__end`` is the number of the key's rows up to and with these, in order, and
    ``__total`` all of them. A few distinct rows are summed by a window per key. More are
    laid out in range partitions (segments of ``rows_per_segment`` distinct rows if given,
    else Spark chooses) and summed per partition, which gives the same numbers.
    """
    keys, order = list(keys), list(order)
    size = counts.count()
    if size <= (rows_per_segment or FEW):
        whole = Window.partitionBy(*keys)
        end = F.sum("__n").over(whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
        return counts.select(*keys, *order, "__n", end.alias("__end"), F.sum("__n").over(whole).alias("__total"))
    if rows_per_segment:
        laid = laid_out(counts, keys, order, size, rows_per_segment, PART)
    else:
        laid = counts.repartitionByRange(*keys, *order)
        laid = cut_lineage(laid.withColumn(PART, F.spark_partition_id()), "ranges")
    parts = laid.groupBy(*keys, PART).agg(F.sum("__n").alias("__in"))
    before = F.sum("__in").over(Window.partitionBy(*keys).orderBy(PART)) - F.col("__in")
    parts = parts.withColumns({"__before": before, "__total": F.sum("__in").over(Window.partitionBy(*keys))})
    parts = parts.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(PART).alias("__at"), "__before", "__total"
    )
    here = F.sum("__n").over(Window.partitionBy(*keys, PART).orderBy(*order))
    within = laid.withColumn("__here", here)
    on = same_key([within[k] for k in keys], [parts[f"__k{i}"] for i in range(len(keys))])
    joined = within.join(parts, on & (within[PART] == parts["__at"]))
    return joined.select(*keys, *order, "__n", (F.col("__before") + F.col("__here")).alias("__end"), "__total")


def running_counts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_segment: int | None = None
) -> DataFrame:
    """``ranked_counts`` of the rows themselves."""
    return ranked_counts(value_counts(df, keys, order), keys, order, rows_per_segment)


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    rows_per_segment: int | None = None,
    approximate: bool = False,
    counts: DataFrame | None = None,
) -> DataFrame:
    """``keys, n, q`` with ``q`` the linearly interpolated quantiles, in order.

    Exact by default, with one formula for groups of every size. ``approximate``
    uses ``percentile_approx`` in one pass. ``counts``: the ``value_counts`` of the rows
    that have a value, if they are there already.
    """
    keys = list(keys)
    if not keys:
        one = df.select(value, F.lit(0).alias("__all"))
        return quantiles(one, ["__all"], value, probs, rows_per_segment, approximate).drop("__all")
    rows = df.filter(F.col(value).isNotNull()).select(*keys, value)
    if approximate:
        probs_lit = F.array(*[F.lit(float(p)) for p in probs])
        counted = F.count(F.lit(1)).alias("n")
        return rows.groupBy(*keys).agg(counted, F.percentile_approx(value, probs_lit, 10_000).alias("q"))
    counts = value_counts(rows, keys, [value]) if counts is None else counts
    ended = ranked_counts(counts, keys, [value], rows_per_segment)
    spots = [F.lit(float(p)) * (F.col("__total") - 1) for p in probs]
    first = F.col("__end") - F.col("__n")

    def at(rank):
        return F.max(F.when((first <= rank) & (rank < F.col("__end")), F.col(value).cast("double")))

    picked = ended.groupBy(*keys).agg(
        F.max("__total").alias("n"),
        *[at(F.floor(h)).alias(f"__low{i}") for i, h in enumerate(spots)],
        *[at(F.ceil(h)).alias(f"__high{i}") for i, h in enumerate(spots)],
    )

    def between(i, p):
        h = F.lit(float(p)) * (F.col("n") - 1)
        low, high = F.col(f"__low{i}"), F.col(f"__high{i}")
        mixed = (F.ceil(h) - h) * low + (h - F.floor(h)) * high
        return F.when(low == high, low).otherwise(mixed)

    return picked.select(*keys, "n", F.array(*[between(i, p) for i, p in enumerate(probs)]).alias("q"))
