"""Exact order statistics and running totals that do not need one task per group.

``percentile`` keeps one counter per distinct value in an aggregation buffer. That is right for
hourly counts, whose distinct values are few, and is used directly there. For continuous values
(ratios, residuals, scores) the helpers below work on a value histogram instead: a coarse,
order-preserving bin splits every group, per-bin totals (few against the values) give each
bin its offset, and only the bins that hold a wanted rank are ordered in detail. Bins are split by
the number of values they hold: values in a narrow range get as many bins as values spread wide.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from zonecast.session import materialize


def percentiles_of_counts(column: Column | str, probs: Sequence[float]) -> Column:
    """Array of exact, linearly interpolated percentiles of a low-cardinality column."""
    return F.percentile(column, F.array(*[F.lit(float(p)) for p in probs]))


def magnitude_bin(x: Column, per_octave: int = 32) -> Column:
    """Order-preserving coarse bin of a finite double: a logarithmic scale on both signs.

    The number of bins is bounded by the exponent range of the data (about 32 per factor of two),
    whatever the number of rows.
    """
    size = F.log2(F.lit(1.0) + F.abs(x) * F.lit(1e6)) * F.lit(float(per_octave))
    return (F.signum(x) * F.floor(size)).cast("long")


#: Distinct values a bin holds, about; and the bits that number the parts of a magnitude.
BIN_VALUES = 16_384
PART_BITS = 24


def value_histogram(df: DataFrame, keys: Sequence[str], value: str, weights: dict[str, Column] | None = None, bin_values: int = BIN_VALUES) -> DataFrame:
    """Rows per (keys, value) with a bin; combined before the shuffle.

    A magnitude that holds more than ``bin_values`` distinct values is cut into parts of equal width between its smallest and
    largest value, one for each ``bin_values``. The table of magnitudes is small: a row per group and power of two, times 32.
    """
    aggs = [expr.alias(name) for name, expr in (weights or {"n": F.count(F.lit(1))}).items()]
    hist = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("value"))
        .agg(*aggs)
    )
    # Several branches read the histogram; written once, the raw rows are aggregated once.
    hist = materialize(hist, "histogram").withColumn("_magnitude", magnitude_bin(F.col("value")))
    place = [*keys, "_magnitude"]
    held = hist.groupBy(*place).agg(F.count(F.lit(1)).alias("_held"), F.min("value").alias("_low"), F.max("value").alias("_high"))
    held = held.select(*[F.col(k).alias(f"_of{i}") for i, k in enumerate(place)], "_held", "_low", "_high")
    same = reduce(lambda a, b: a & b, [hist[k].eqNullSafe(held[f"_of{i}"]) for i, k in enumerate(place)])
    joined = hist.join(held, same)
    parts = F.least(F.ceil(F.col("_held") / F.lit(bin_values)), F.lit(1 << PART_BITS)).cast("double")
    part = F.floor(F.coalesce(F.try_divide(F.col("value") - F.col("_low"), F.col("_high") - F.col("_low")), F.lit(0.0)) * parts)
    number = F.shiftleft(F.col("_magnitude"), PART_BITS) + F.least(part, parts - 1).cast("long")
    return joined.withColumn("bin", number).select(*hist.columns, "bin").drop("_magnitude")


def running_totals(hist: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Adds ``<column>_before``: the total of ``column`` over smaller values of the group.

    Bin totals are running sums over a bounded number of rows per group; inside a bin the sums
    run per (keys, bin), so a group with many distinct values is spread over many tasks.
    """
    bins = hist.groupBy(*keys, "bin").agg(*[F.sum(c).alias(c) for c in columns])
    earlier = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bins.select(
        *keys, "bin", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}_offset") for c in columns]
    )
    inside = Window.partitionBy(*keys, "bin").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    joined = hist.join(offsets, on=[*keys, "bin"])
    return joined.select(
        *[c for c in hist.columns],
        *[(F.col(f"_{c}_offset") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{c}_before") for c in columns],
    )


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolation quantiles of ``value`` per group: keys, n, one column per name.

    Three shuffles of histogram rows, none of raw rows. Only the bins around a wanted rank are
    sorted, and no group is ever held in one task.
    """
    keys = list(keys)
    hist = value_histogram(df, keys, value)
    bins = hist.groupBy(*keys, "bin").agg(F.sum("n").alias("bin_n"))
    group = Window.partitionBy(*keys)
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(
        *keys,
        "bin",
        "bin_n",
        F.coalesce(F.sum("bin_n").over(upto), F.lit(0)).alias("bin_before"),
        F.sum("bin_n").over(group).alias("group_n"),
    )

    def hits(first: Column, count: Column) -> Column:
        found = []
        for p in probs.values():
            pos = (F.col("group_n") - 1) * F.lit(float(p))
            for rank in (F.floor(pos), F.ceil(pos)):
                found.append((rank >= first) & (rank < first + count))
        return reduce(lambda a, b: a | b, found)

    wanted = bins.filter(hits(F.col("bin_before"), F.col("bin_n")))
    inside = Window.partitionBy(*keys, "bin").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = hist.join(wanted, on=[*keys, "bin"]).withColumn(
        "before", F.col("bin_before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    )
    ranked = ranked.filter(hits(F.col("before"), F.col("n")))
    aggs = []
    for name, p in probs.items():
        pos = (F.col("group_n") - 1) * F.lit(float(p))

        def at(rank: Column) -> Column:
            here = (rank >= F.col("before")) & (rank < F.col("before") + F.col("n"))
            return F.max(F.when(here, F.col("value")))

        low, high = at(F.floor(pos)), at(F.ceil(pos))
        fraction = F.max(pos - F.floor(pos))
        aggs.append((low + (high - low) * fraction).alias(name))
    return ranked.groupBy(*keys).agg(F.max("group_n").alias("n"), *aggs)
