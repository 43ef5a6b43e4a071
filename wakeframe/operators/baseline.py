"""Reference distributions: statistics, quantiles and density histograms."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeframe.constants import FEATURES, HISTOGRAM_BINS
from wakeframe.functions.scalars import nan_to_null
from wakeframe.plans.select_rank import quantiles, value_counts

QUANTILES = {"p5": 0.05, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p95": 0.95}


def to_long(df: DataFrame, columns: Sequence[str] = FEATURES, keep: Sequence[str] = ()) -> DataFrame:
    """Wide feature columns to rows ``feature, value``; absent columns are skipped."""
    present = [c for c in columns if c in df.columns]
    wide = df.select(*keep, *[nan_to_null(F.col(c).cast("double")).alias(c) for c in present])
    return wide.unpivot(list(keep), present, "feature", "value")


def column_stats(
    df: DataFrame, columns: Sequence[str], aggregates: dict[str, Callable[[Column], Column]], keys: Sequence[str] = ()
) -> DataFrame:
    """The same aggregates over several columns as rows ``keys, feature, ...``.

    The columns are aggregated side by side, so no row is multiplied before
    the shuffle; one output row per key is then taken apart. Columns without
    any value have no row.
    """
    present = [c for c in columns if c in df.columns]
    values = {c: nan_to_null(F.col(c).cast("double")) for c in present}
    wide = df.groupBy(*keys).agg(
        *[fn(values[c]).alias(f"{c}__{name}") for c in present for name, fn in aggregates.items()],
        *[F.count(values[c]).alias(f"{c}__n") for c in present],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"{c}__n").alias("n"),
                *[F.col(f"{c}__{name}").alias(name) for name in aggregates],
            )
            for c in present
        ]
    )
    return wide.select(*keys, F.inline(entries)).filter(F.col("n") > 0)


def summary_stats(df: DataFrame, columns: Sequence[str] = FEATURES, places: int = 6) -> DataFrame:
    """Count, mean, sample deviation and variance, bounds; nulls are skipped."""
    return column_stats(
        df,
        columns,
        {
            "mean": lambda v: F.round(F.avg(v), places),
            "std": lambda v: F.round(F.stddev_samp(v), places),
            "variance": lambda v: F.round(F.var_samp(v), places),
            "lo": F.min,
            "hi": F.max,
        },
    )


def gathered(stats: DataFrame) -> DataFrame:
    """A small table computed once and held on the driver.

    Meant for one row per feature column, so its size is bounded by the schema.
    """
    return stats.sparkSession.createDataFrame(stats.collect(), stats.schema)


def bin_number(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Index of the equal-width bin; the last bin includes its upper edge.

    The scaled position is checked against the edges ``low + i * width``, as a
    value on an edge may land one bin off by rounding.
    """
    width = (high - low) / bins
    at = F.least(F.lit(bins - 1), F.floor((value - low) / (high - low) * bins)).cast("int")
    down = (value < low + at * width).cast("int")
    up = ((value >= low + (at + 1) * width) & (at < bins - 1)).cast("int")
    return at - down + up


def widened(stats: DataFrame) -> DataFrame:
    """Histogram range; a single value gets half a unit on each side."""
    flat = F.col("lo") == F.col("hi")
    return stats.withColumns(
        {
            "low": F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")),
            "high": F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")),
        }
    )


def density_histogram(
    long: DataFrame, stats: DataFrame, bins: int = HISTOGRAM_BINS, places: int = 6, times: str | None = None
) -> DataFrame:
    """``feature, histogram_density, histogram_bins`` for each row of ``stats``.

    ``stats`` has one row per feature column of the table, so its size is
    bounded by the schema. All bins are counted by map-side partial sums. ``times``
    names the column that says how often a row's value occurs.
    """
    ranges = widened(stats).select("feature", "n", "low", "high")
    counts = (
        long.filter(F.col("value").isNotNull())
        .join(F.broadcast(ranges), "feature")
        .groupBy("feature", bin_number(F.col("value"), F.col("low"), F.col("high"), bins).alias("bin"))
        .agg((F.sum(times) if times else F.count(F.lit(1))).alias("k"))
        .groupBy("feature")
        .agg(F.map_from_entries(F.collect_list(F.struct("bin", "k"))).alias("by_bin"))  # at most ``bins`` entries
    )
    width = (F.col("high") - F.col("low")) / bins
    at = F.sequence(F.lit(0), F.lit(bins - 1))
    density = F.transform(
        at,
        lambda b: F.round(
            F.coalesce(F.try_element_at("by_bin", b), F.lit(0)) / (F.col("n") * width), places
        ),
    )
    edges = F.transform(
        F.sequence(F.lit(0), F.lit(bins)),
        lambda b: F.round(F.when(b < bins, F.col("low") + width * b).otherwise(F.col("high")), places),
    )
    return counts.join(F.broadcast(ranges), "feature").select(
        "feature", density.alias("histogram_density"), edges.alias("histogram_bins")
    )


def baseline(
    df: DataFrame,
    columns: Sequence[str] = FEATURES,
    bins: int = HISTOGRAM_BINS,
    approximate: bool = False,
    rows_per_segment: int | None = None,
    places: int = 6,
) -> DataFrame:
    """One row per feature: statistics, five quantiles, density histogram.

    The input is read twice: for the statistics, and for the number of times that each
    value occurs, of which quantiles and histogram are taken.
    """
    long = to_long(df, columns).filter("value is not null")
    stats = gathered(summary_stats(df, columns, places))
    counts = None if approximate else value_counts(long, ["feature"], ["value"])
    q = quantiles(long, ["feature"], "value", list(QUANTILES.values()), rows_per_segment, approximate, counts)
    hist = density_histogram(long if approximate else counts, stats, bins, places, None if approximate else "__n")
    spread = q.select(
        "feature", *[F.round(F.get("q", F.lit(i)), places).alias(p) for i, p in enumerate(QUANTILES)]
    )
    return (
        stats.join(F.broadcast(spread), "feature")
        .join(F.broadcast(hist), "feature")
        .select(
            "feature",
            "n",
            "mean",
            "std",
            "variance",
            F.round("lo", places).alias("min"),
            F.round("hi", places).alias("max"),
            *QUANTILES,
            "histogram_density",
            "histogram_bins",
        )
    )


def baseline_document(base: DataFrame, window: int, description: str = "feature distribution baseline") -> DataFrame:
    """The baseline as one JSON document: feature -> statistics."""
    names = [c for c in base.columns if c not in ("feature", "n")]
    entries = F.sort_array(F.collect_list(F.struct("feature", F.struct(*names).alias("stats"))))
    # one row per feature column, bounded by the schema
    doc = base.agg(F.max("n").alias("n_samples"), entries.alias("e")).select(
        F.to_json(
            F.struct(
                F.lit(description).alias("description"),
                F.lit(window).alias("window_size"),
                "n_samples",
                F.map_from_entries("e").alias("features"),
            )
        ).alias("value")
    )
    return doc
