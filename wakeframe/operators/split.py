"""Exact stratified train/test split in a seeded order."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeframe.constants import SEED, TEST_SHARE
from wakeframe.plans.ordered import KeyedRows
from wakeframe.plans.select_rank import running_counts
from wakeframe.session import cut_lineage


def seeded_hash(columns: Sequence[str], seed: int) -> Column:
    """A reproducible random key of a row: md5 over its id and the seed."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns], F.lit(str(seed))))


def quotas(classes: DataFrame, label: str, share: float) -> DataFrame:
    """``label, __take``: ceil(share * N) test rows by largest remainder, ties by class.

    ``classes`` has one row per class with its size ``__total``, however many there are.
    """
    total = classes.agg(F.coalesce(F.sum("__total"), F.lit(0))).first()[0]
    wanted = math.ceil(share * total)
    exact = F.col("__total") / F.lit(float(max(total, 1))) * wanted
    parts = classes.select(label, exact.alias("__exact")).withColumn("__floor", F.floor("__exact"))
    left = wanted - parts.agg(F.coalesce(F.sum("__floor"), F.lit(0))).first()[0]
    order = [F.desc(F.col("__exact") - F.col("__floor")), F.coalesce(F.col(label).cast("string"), F.lit("None"))]
    more = parts.orderBy(*order).limit(left).select(F.col(label).alias("__more"), F.lit(1).alias("__one"))
    joined = parts.join(more, parts[label].eqNullSafe(more["__more"]), "left")
    return joined.select(label, (F.col("__floor") + F.coalesce("__one", F.lit(0))).alias("__take"))


def stratified_split(
    df: DataFrame,
    label: str = "label",
    ids: Sequence[str] = ("subject_id", "frame_id"),
    share: float = TEST_SHARE,
    seed: int = SEED,
    rows_per_segment: int | None = None,
) -> DataFrame:
    """Adds ``is_test``: per class exactly the quota of rows, drawn by seeded hash.

    Only the id and label columns are laid out in order. The table itself is not
    shuffled unless its classes are too many to send to every task: a row is compared
    with its class's last test row. Rows that repeat an id stay on one side, but for
    those of the last id, of which as many as are missing are numbered off.
    """
    ids = list(ids)
    order = ["__h", *ids]
    slim = df.select(label, *ids).withColumn("__h", seeded_hash(ids, seed))
    ended = cut_lineage(running_counts(slim, [label], order, rows_per_segment), "ended")
    classes = ended.groupBy(label).agg(F.max("__total").alias("__total"))
    take = quotas(classes, label, share).withColumnRenamed(label, "__class")
    last = ended.join(take, ended[label].eqNullSafe(take["__class"]))
    last = last.filter((F.col("__end") - F.col("__n") < F.col("__take")) & (F.col("__take") <= F.col("__end")))
    limits = last.select(
        "__class",
        F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(order)]).alias("__last"),
        (F.col("__take") - F.col("__end") + F.col("__n")).alias("__of_last"),
        F.col("__n").alias("__equal"),
    )
    limits = cut_lineage(limits, "limits")
    here = F.struct(seeded_hash(ids, seed).alias("c0"), *[F.col(c).alias(f"c{i + 1}") for i, c in enumerate(ids)])
    joined = df.join(limits, df[label].eqNullSafe(limits["__class"]), "left").withColumn("__here", here)
    tied = F.coalesce((F.col("__here") == F.col("__last")) & (F.col("__of_last") < F.col("__equal")), F.lit(False))
    plain = joined.withColumn("is_test", F.coalesce(F.col("__here") <= F.col("__last"), F.lit(False)))
    if not limits.filter("__of_last < __equal").isEmpty():
        # written before they are numbered, so that a row keeps its place; a class may tie as a whole
        alike = joined.filter(tied).withColumn("__row", F.monotonically_increasing_id())
        numbered = KeyedRows(alike, [label], ["__row"], rows_per_segment=rows_per_segment, derived=True).position("__no")
        numbered = numbered.rows().withColumn("is_test", F.col("__no") <= F.col("__of_last"))
        plain = plain.filter(~tied).unionByName(numbered.drop("__row", "__no"))
    return plain.select(*df.columns, "is_test")


def group_split(
    df: DataFrame,
    group: str = "subject_id",
    share: float = TEST_SHARE,
    seed: int = SEED,
    rows_per_segment: int | None = None,
) -> DataFrame:
    """Adds ``is_test`` so that all rows of a group are on one side."""
    groups = cut_lineage(df.select(group).distinct(), "groups").withColumns(
        {"__h": seeded_hash([group], seed), "__all": F.lit(0)}
    )
    wanted = math.ceil(share * groups.count())
    if not wanted:
        return df.withColumn("is_test", F.lit(False))
    ended = running_counts(groups, ["__all"], ["__h", group], rows_per_segment)
    last = ended.filter(F.col("__end") == wanted).first()
    return df.withColumn("is_test", seeded_hash([group], seed) <= F.lit(last["__h"]))


def split_summary(split: DataFrame, label: str = "label") -> DataFrame:
    """Rows per side and class."""
    return split.groupBy(label, "is_test").agg(F.count(F.lit(1)).alias("n"))


def shuffled(df: DataFrame, ids: Sequence[str], seed: int = SEED) -> DataFrame:
    """Rows in a seeded random order, the same on every run."""
    return df.withColumn("__h", seeded_hash(ids, seed)).orderBy("__h", *ids).drop("__h")
