"""Gold kept up to date by change propagation: a batch rewrites the rows that read what it changed, and no others.

A row of hour t reads the hour after it and up to ``reach`` hours before it, in the order of the hours seen anywhere. So a batch that touches
hour t changes the rows of the hour before t and of ``reach`` hours after it. The days of these rows are computed anew from the counts of
their hours and of the hours they read, and replace the partitions of these days.

Counts are kept as a log: the changes of batch n are the folder of n, which a repeated batch overwrites, and the count of a zone and hour is
the sum over the batches. A batch may bring hours late, out of order or between known ones; one that is applied again, also after a stop
halfway, changes nothing more. A batch reads its own days and neighbouring ones, and a table of one row per hour and batch.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from zonecast import rules as fixed
from zonecast.operators.demand import ZONE_KEY, dense_grid, gold_features
from zonecast.session import materialize

TIME = "window_start"
#: Rows before a row that its Gold columns read.
GOLD_REACH = 3


def _replace(df: DataFrame, path: str, by_day: bool) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy("day") if by_day else writer).parquet(path)


def _ranked(spark: SparkSession, path: str) -> DataFrame:
    """(window_start, rank) of every hour seen; one row per hour, so one ordered window is small."""
    seen = spark.read.parquet(os.path.join(path, "slots")).select(TIME).distinct()
    return seen.withColumn("rank", F.row_number().over(Window.orderBy(TIME)))


def _around(ranks: DataFrame, before: int, after: int) -> DataFrame:
    return ranks.select(F.explode(F.sequence(F.col("rank") - before, F.col("rank") + after)).alias("rank")).distinct()


def apply_batch(
    spark: SparkSession, path: str, number: int, changes: DataFrame, zones: int = fixed.ZONE_COUNT,
    build: Callable[[DataFrame], DataFrame] = gold_features, reach: int = GOLD_REACH,
) -> DataFrame:
    """Adds hourly counts (zone, window_start, window_end, trip_count) as batch ``number``; one row: hours changed, days and rows rewritten.

    ``build`` makes the table from a dense grid of hours; none of its rows reads more than one row after it and ``reach`` before it.
    """
    day = F.to_date(TIME)
    added = materialize(changes.select(ZONE_KEY, TIME, "window_end", "trip_count").withColumn("day", day), "changes")
    _replace(added, os.path.join(path, "deltas", f"batch={number}"), True)
    _replace(added.select(TIME).distinct(), os.path.join(path, "slots", f"batch={number}"), False)
    ranked = materialize(_ranked(spark, path), "slots")
    changed = ranked.join(added.select(TIME).distinct(), TIME, "left_semi")
    days = materialize(ranked.join(_around(changed, 1, reach), "rank", "left_semi").select(day.alias("day")).distinct(), "days")
    rewritten = ranked.withColumn("day", day).join(days, "day", "left_semi")
    needed = materialize(ranked.join(_around(rewritten, reach, 1), "rank", "left_semi").select(TIME, day.alias("day")), "needed")
    deltas = spark.read.parquet(os.path.join(path, "deltas"))
    counts = deltas.join(needed, [TIME, "day"], "left_semi").groupBy(ZONE_KEY, TIME, "window_end").agg(F.sum("trip_count").alias("trip_count"))
    rows = build(dense_grid(counts, zones)).withColumn("day", day).join(days, "day", "left_semi")
    rows = materialize(rows, "rewritten")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(os.path.join(path, "gold"))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("day").alias("days")).select(
        F.lit(number).alias("batch"), changed.agg(F.count(F.lit(1)).alias("n")).scalar().alias("hours"), "days", "rows"
    )


def gold(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is after the last batch."""
    return spark.read.parquet(os.path.join(path, "gold")).drop("day")
