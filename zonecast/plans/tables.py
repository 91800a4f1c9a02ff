"""Standard tables built from trips: Silver, Gold, features and forecasts.

Gold is read by several branches of the later steps, so it is written once to the shared folder
(see ``materialize``) and read back with column pruning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from zonecast.operators import features as feat
from zonecast.operators.clean import apply_rules, strict_rules
from zonecast.operators.demand import ZONE_KEY, gold_table, hourly_demand
from zonecast.operators.forecast import naive_forecasts
from zonecast.operators.prep import add_split
from zonecast.plans.adapters import ZONES, calendar, trips
from zonecast.session import materialize


def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(trips(spark, sf_dir), strict_rules())


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_demand(clean_trips(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str, calendar_mode: str = "observed", zones: int = ZONES) -> DataFrame:
    return gold_table(clean_trips(spark, sf_dir), zones, calendar_mode)


_STORED: dict[tuple, DataFrame] = {}


def shared(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table written once per application, input and name, and read by every query that uses it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        _STORED[key] = materialize(build(), name)
    return _STORED[key]


def stored_gold(spark: SparkSession, sf_dir: str, calendar_mode: str = "observed") -> DataFrame:
    return shared(spark, sf_dir, f"gold-{calendar_mode}", lambda: gold(spark, sf_dir, calendar_mode))


def main_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main-model features with the split; needs Gold twice (features, split bounds)."""
    source = stored_gold(spark, sf_dir)
    return add_split(feat.main_features(source, calendar(spark)), source=source)


def specialist_table(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return feat.specialist_features(stored_gold(spark, sf_dir), calendar(spark), kind)


def forecast_table(gold_df: DataFrame, holidays: DataFrame) -> DataFrame:
    """One row per zone and hour with the actual (next hour's demand) and baseline forecasts.

    Columns: keys, hour, day_of_week (Monday = 0), flags, split, actual, zone_hour_mean,
    zone_dow_hour_mean, hour_mean, baseline_blend, naive_day, naive_week, predicted. ``predicted``
    is the blended baseline. The first day and week of a zone have no naive forecast (NULL); what
    scores one leaves those rows out.
    """
    base = feat.add_specialist_baselines(feat.base_features(gold_df, holidays, hour_means=True), source=gold_df)
    order = Window.partitionBy(ZONE_KEY, "day_of_week", "hour").orderBy("window_start").rowsBetween(Window.unboundedPreceding, -1)
    base = base.withColumn(
        "zone_dow_hour_mean",
        F.coalesce(F.when(F.count("target_demand").over(order) >= 3, F.avg("target_demand").over(order)), F.col("zone_hour_mean")),
    )
    rows = add_split(naive_forecasts(base), source=gold_df)
    return rows.select(
        ZONE_KEY, "window_start", "hour", "day_of_week", "is_weekend", "is_holiday", "split",
        F.col("target_demand").cast("double").alias("actual"),
        "zone_hour_mean", "zone_dow_hour_mean", "hour_mean", "baseline_blend", "naive_day", "naive_week",
        F.col("baseline_blend").alias("predicted"),
    )


def stored_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast table written once: calibration and metrics read it."""
    return shared(spark, sf_dir, "forecasts", lambda: forecast_table(stored_gold(spark, sf_dir), calendar(spark)))
