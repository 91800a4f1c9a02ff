"""Mergeable statistics: per-day sketches that roll up to any longer period without the raw rows.

A day and its keys are one row: exact count and sum, a KLL sketch of the values and an HLL sketch of the distinct entities. Sketches merge, so
a month is an aggregate over at most 31 stored rows per key. A day is scanned once, and again only if it is rewritten: days are
partitions, and writing a day replaces it.

Errors: a quantile's rank is off by at most ``rank_error(k)`` with a confidence of 99 %, whatever was merged; the number of distinct entities
has a relative standard deviation of ``distinct_error(bits)``. Up to ``k`` values a quantile is exact. NULL values and entities are left out;
rows without a time belong to no day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

KLL_K, HLL_BITS = 400, 12


def rank_error(k: int = KLL_K) -> float:
    """99 % bound of the normalised rank error of a KLL sketch of size ``k``."""
    return 2.446 / k**0.9433


def distinct_error(bits: int = HLL_BITS) -> float:
    """Relative standard deviation of an HLL estimate with 2 ** bits registers."""
    return 1.04 / 2 ** (bits / 2)


def daily(df: DataFrame, time: str, value: str, entity: str, keys: Sequence[str] = (), k: int = KLL_K, bits: int = HLL_BITS) -> DataFrame:
    """One row per day and ``keys``: day, keys, n, value_n, value_sum, value_sketch, entity_sketch."""
    x = F.col(value).cast("double")
    return df.filter(F.col(time).isNotNull()).groupBy(F.to_date(time).alias("day"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.count(x).alias("value_n"), F.sum(x).alias("value_sum"),
        F.kll_sketch_agg_double(x, k).alias("value_sketch"), F.hll_sketch_agg(entity, bits).alias("entity_sketch"),
    )


def store(days: DataFrame, path: str) -> None:
    """Writes days as partitions; a day that is there already is replaced, all others stay."""
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def rolled_up(days: DataFrame, by: Mapping[str, Column], probs: Mapping[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """One row per ``by`` and ``keys``: n, value_sum, value_mean, distinct, and a quantile per name of ``probs``, from sketches alone."""
    merged = days.groupBy(*[c.alias(name) for name, c in by.items()], *keys).agg(
        F.sum("n").alias("n"), F.sum("value_n").alias("value_n"), F.sum("value_sum").alias("value_sum"), F.count(F.lit(1)).alias("days"),
        F.kll_merge_agg_double("value_sketch").alias("value_sketch"), F.hll_union_agg("entity_sketch").alias("entity_sketch"),
    )
    quantiles = [F.when(F.col("value_n") > 0, F.kll_sketch_get_quantile_double("value_sketch", F.lit(float(p)))).alias(name) for name, p in probs.items()]
    mean = F.try_divide("value_sum", "value_n").alias("value_mean")
    return merged.select(*by, *keys, "days", "n", "value_sum", mean, F.hll_sketch_estimate("entity_sketch").alias("distinct"), *quantiles)
