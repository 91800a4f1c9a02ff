"""Hourly demand per zone on a dense grid, with the Gold features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from zonecast import rules as fixed
from zonecast.functions.scalar import weekend_sun1

ZONE_KEY = "PULocationID"


def hourly_demand(trips: DataFrame, ts: str = "tpep_pickup_datetime", size: str = fixed.HOUR, slide: str | None = None) -> DataFrame:
    """Trips per zone and time window; sliding windows with ``slide``.

    Counts are combined before the shuffle, so a zone holding most trips costs one row per map
    task and window.
    """
    window = F.window(F.col(ts), size, slide) if slide else F.window(F.col(ts), size)
    return (
        trips.groupBy(F.col(ZONE_KEY).cast("long").alias(ZONE_KEY), window.alias("w"))
        .agg(F.count(F.lit(1)).alias("trip_count"))
        .select(ZONE_KEY, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "trip_count")
    )


def dense_grid(demand: DataFrame, zones: int = fixed.ZONE_COUNT, calendar: str = "observed", step: str = fixed.HOUR) -> DataFrame:
    """A row for every zone 1..``zones`` and time slot, 0 where there was no trip.

    ``calendar="observed"`` uses the slots seen in any zone; ``"full"`` also fills hours nobody
    travelled. The slots are grouped once and the missing zones of each slot are appended to its
    list (at most ``zones`` entries), so neither a cross join nor a second scan of the trips is
    needed. Gaps between slots are filled inside a zone, on the partitioning the lag windows use.
    """
    if calendar not in ("observed", "full"):
        raise ValueError(f"unknown calendar: {calendar}")
    entry = F.struct(F.col(ZONE_KEY).alias("zone"), F.col("trip_count").alias("n"))
    in_range = F.col(ZONE_KEY).between(1, zones)
    slots = demand.groupBy("window_start", "window_end").agg(F.collect_list(F.when(in_range, entry)).alias("present"))
    every = F.sequence(F.lit(1).cast("long"), F.lit(zones).cast("long"))
    absent = F.array_except(every, F.transform("present", lambda e: e["zone"]))
    zeros = F.transform(absent, lambda z: F.struct(z.alias("zone"), F.lit(0).cast("long").alias("n")))
    grid = slots.select("window_start", "window_end", F.explode(F.concat("present", zeros)).alias("e")).select(
        F.col("e.zone").alias(ZONE_KEY), "window_start", "window_end", F.col("e.n").alias("trip_count")
    )
    if calendar == "observed":
        return grid
    by_zone = Window.partitionBy(ZONE_KEY).orderBy("window_start")
    unit = F.expr(f"INTERVAL {step}")
    following = F.coalesce(F.lead("window_start").over(by_zone), F.col("window_start") + unit)
    starts = F.sequence(F.col("window_start"), F.col("_next") - unit, unit)
    filled = grid.withColumn("_next", following).withColumn("_slot", F.explode(starts))
    return filled.select(
        ZONE_KEY,
        F.col("_slot").alias("window_start"),
        (F.col("_slot") + unit).alias("window_end"),
        F.when(F.col("_slot") == F.col("window_start"), F.col("trip_count")).otherwise(F.lit(0).cast("long")).alias("trip_count"),
    )


def gold_features(grid: DataFrame) -> DataFrame:
    """Next-hour target, two lags, mean of the previous three rows and calendar columns.

    All window expressions share one specification: one shuffle by zone and one sort. A zone has
    one row per hour whatever the number of trips, so the partitions are equal in size. The last
    row of a zone has no target and is dropped.
    """
    by_zone = Window.partitionBy(ZONE_KEY).orderBy("window_start")
    dow = F.dayofweek("window_start")
    return (
        grid.select(
            ZONE_KEY,
            "window_start",
            "window_end",
            "trip_count",
            F.lead("trip_count", 1).over(by_zone).alias("target_demand"),
            F.hour("window_start").alias("hour"),
            dow.alias("day_of_week"),
            weekend_sun1(dow).alias("is_weekend"),
            F.year("window_start").alias("year"),
            F.month("window_start").alias("month"),
            F.lag("trip_count", 1).over(by_zone).alias("lag_1h"),
            F.lag("trip_count", 2).over(by_zone).alias("lag_2h"),
            F.avg("trip_count").over(by_zone.rowsBetween(-3, -1)).alias("rolling_avg_3h"),
        )
        .filter(F.col("target_demand").isNotNull())
    )


def gold_table(trips: DataFrame, zones: int = fixed.ZONE_COUNT, calendar: str = "observed") -> DataFrame:
    """Cleaned trips to the demand table."""
    return gold_features(dense_grid(hourly_demand(trips), zones, calendar))


def with_gold_audit(gold: DataFrame) -> DataFrame:
    return gold.withColumn("_layer", F.lit("gold")).withColumn("_processed_at", F.current_timestamp())


def top_zones(gold: DataFrame, k: int = 5, column: str = "trip_count") -> DataFrame:
    """Zones with the highest mean; ties go to the lower zone number."""
    means = gold.groupBy(ZONE_KEY).agg(F.avg(column).alias("avg_demand"))
    return means.orderBy(F.desc("avg_demand"), F.asc(ZONE_KEY)).limit(k)


def hour_profile(gold: DataFrame, column: str = "trip_count") -> DataFrame:
    """Mean, maximum and sample deviation per hour of day."""
    return gold.groupBy("hour").agg(
        F.avg(column).alias("avg_trips"), F.max(column).alias("max_trips"), F.stddev_samp(column).alias("std_trips")
    )


def active_zones(df: DataFrame, threshold: float, column: str = "target_demand", fallback: int = 10) -> DataFrame:
    """Zones whose mean reaches the threshold; if none does, the ``fallback`` busiest ones.

    The means hold one row per zone; the fallback test is a one-row subquery on them.
    """
    means = df.groupBy(ZONE_KEY).agg(F.avg(column).alias("zone_avg"))
    busiest = means.orderBy(F.desc("zone_avg"), F.asc(ZONE_KEY)).limit(fallback)
    highest = means.agg(F.max("zone_avg").alias("m")).scalar()
    chosen = means.filter(F.col("zone_avg") >= threshold)
    return chosen.unionByName(busiest.filter(highest < F.lit(float(threshold)))).select(ZONE_KEY)


def keep_active(df: DataFrame, threshold: float, column: str = "target_demand", fallback: int = 10) -> DataFrame:
    """Semi join with the active zones; broadcast if the planner or AQE finds them small."""
    return df.join(active_zones(df, threshold, column, fallback), on=ZONE_KEY, how="left_semi")


def hour_bucket(df: DataFrame, bucket: str) -> DataFrame:
    """Rows whose hour lies in a named group of hours."""
    hours = fixed.HOUR_BUCKETS[bucket]
    return df.filter(F.col("hour").between(hours[0], hours[-1]))


def range_demand(gold: DataFrame, start: str, end: str, column: str = "trip_count") -> DataFrame:
    """Hourly demand between two times (both included): the range and the three columns reach the
    scan, duplicates of a key are summed. On a table partitioned by year and month the range also
    prunes partitions.
    """
    ts = F.col("window_start")
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in (start, end))
    if {"year", "month"} <= set(gold.columns):
        months = [int(t[:4]) * 100 + int(t[5:7]) for t in (start, end)]
        gold = gold.filter((F.col("year") * 100 + F.col("month")).between(*months))
    return (
        gold.select(ZONE_KEY, "window_start", F.col(column).alias("trip_count"))
        .filter((ts >= lo) & (ts <= hi))
        .groupBy(ZONE_KEY, "window_start")
        .agg(F.sum("trip_count").alias("trip_count"))
    )


def readiness(hourly: DataFrame, threshold: float = 5.0) -> DataFrame:
    """Hours with data, zones with data and active zones, in one row."""
    by_zone = hourly.groupBy(ZONE_KEY).agg(F.avg("trip_count").alias("m"))
    zones = by_zone.agg(F.count(F.lit(1)).alias("zones"), F.count_if(F.col("m") >= threshold).alias("active_zones"))
    return hourly.agg(F.countDistinct("window_start").alias("hours_ready")).select(
        "hours_ready",
        zones.select("zones").scalar().alias("zones"),
        zones.select("active_zones").scalar().alias("active_zones"),
    )
