from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.operators import demand as dem, features as feat, forecast, prep

T0 = datetime(2024, 1, 1)


def demand(spark, rows):
    """(zone, hour offset, count) rows."""
    data = [(z, T0 + timedelta(hours=h), T0 + timedelta(hours=h + 1), n) for z, h, n in rows]
    return spark.createDataFrame(data, "PULocationID bigint, window_start timestamp_ntz, window_end timestamp_ntz, trip_count bigint")


def gold(spark, series, zone=1):
    data = [(zone, T0 + timedelta(hours=h), n, series[h + 1]) for h, n in enumerate(series[:-1])]
    return spark.createDataFrame(data, "PULocationID bigint, window_start timestamp_ntz, trip_count bigint, target_demand bigint")


def holidays(spark):
    return spark.createDataFrame([(T0.date(), "New Year"), (T0.date(), "twice")], "date date, name string")


def test_grid_invariants(spark):
    counts = demand(spark, [(1, 0, 4), (3, 0, 1), (2, 5, 7), (9, 7, 5)])
    grid = dem.dense_grid(counts, zones=4)
    # Zone 9 lies outside the grid, but its hour is an observed one.
    assert grid.count() == 4 * 3
    assert grid.agg(F.sum("trip_count")).collect()[0][0] == 12
    full = dem.dense_grid(counts, zones=4, calendar="full")
    assert full.count() == 4 * 8
    assert full.agg(F.sum("trip_count")).collect()[0][0] == 12
    assert full.select("PULocationID", "window_start").distinct().count() == 4 * 8
    with pytest.raises(ValueError):
        dem.dense_grid(counts, calendar="none")


def test_grid_reads_its_input_once_and_has_no_cross_join(spark, tmp_path):
    demand(spark, [(1, 0, 4)]).write.parquet(str(tmp_path / "d"))
    plan = dem.gold_features(dem.dense_grid(spark.read.parquet(str(tmp_path / "d"))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "CartesianProduct" not in plan
    assert plan.count("Exchange hashpartitioning(PULocationID") == 1


def test_one_row_zone_has_no_target(spark):
    assert dem.gold_features(dem.dense_grid(demand(spark, [(1, 0, 3)]), zones=2)).count() == 0


def test_gap_hours_make_row_lags_differ_from_clock_lags(spark):
    counts = demand(spark, [(1, 0, 1), (1, 1, 2), (1, 5, 3), (1, 6, 4)])
    at = lambda mode: {r["window_start"].hour: r for r in dem.gold_features(dem.dense_grid(counts, 1, mode)).collect()}
    assert at("observed")[5]["lag_1h"] == 2 and at("full")[5]["lag_1h"] == 0


def test_sliding_windows_overlap(spark):
    trips = spark.createDataFrame([(1.0, datetime(2024, 1, 1, 0, 40))], "PULocationID double, tpep_pickup_datetime timestamp_ntz")
    rows = dem.hourly_demand(trips, size="1 hour", slide="30 minutes").collect()
    assert sorted(r["window_start"].strftime("%d %H:%M") for r in rows) == ["01 00:00", "01 00:30"]


def test_top_zone_ties_and_active_zones(spark):
    g = spark.createDataFrame([(3, 2, 2), (1, 2, 2), (2, 1, 1)], "PULocationID bigint, trip_count bigint, target_demand bigint")
    assert [r["PULocationID"] for r in dem.top_zones(g, 2).collect()] == [1, 3]
    assert {r[0] for r in dem.active_zones(g, 2.0).collect()} == {1, 3}
    assert [r[0] for r in dem.active_zones(g, 50.0, fallback=2).orderBy("PULocationID").collect()] == [1, 3]


def test_range_prunes_partitions_and_columns(spark, tmp_path):
    from zonecast.sources import sinks

    counts = demand(spark, [(1, h, h % 5) for h in range(0, 24 * 70, 7)])
    sinks.overwrite_partitions(dem.gold_features(dem.dense_grid(counts, 2)), str(tmp_path / "gold"), ["year", "month"])
    df = dem.range_demand(spark.read.parquet(str(tmp_path / "gold")), "2024-02-03 00:00:00", "2024-02-20 23:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "year" in filters and "month" in filters
    assert "GreaterThanOrEqual(window_start" in plan and "lag_1h" not in plan
    hours = {r["window_start"] for r in df.collect()}
    assert min(hours) >= datetime(2024, 2, 3) and max(hours) < datetime(2024, 2, 21) and len(hours) > 50


def test_weekday_conventions(spark):
    # 2024-01-06 is a Saturday, 2024-01-07 a Sunday.
    g = spark.createDataFrame([(1, datetime(2024, 1, 6)), (1, datetime(2024, 1, 7)), (1, datetime(2024, 1, 8))], "PULocationID bigint, window_start timestamp_ntz")
    rows = feat.add_calendar(g).orderBy("window_start").collect()
    assert [(r["dow_sun1"], r["dow_mon0"], r["is_weekend"]) for r in rows] == [(7, 5, 1), (1, 6, 1), (2, 0, 0)]


def test_holiday_flag_does_not_multiply_rows(spark):
    rows = feat.add_holiday(gold(spark, list(range(30))), holidays(spark)).collect()
    assert len(rows) == 29 and sum(r["is_holiday"] for r in rows) == 24


def test_expanding_means_need_enough_rows(spark):
    base = feat.add_lags(feat.add_calendar(gold(spark, [1] * 24 * 7)))
    rows = feat.add_zone_baselines(base.withColumn("rolling_avg_24h", F.lit(-1.0))).orderBy("window_start").collect()
    days = {r["window_start"].day: r["zone_hour_mean"] for r in rows if r["hour"] == 3}
    assert [days[d] for d in range(1, 8)] == [-1.0] * 5 + [1.0] * 2


@pytest.mark.parametrize("seed", [0, 1])
def test_features_do_not_see_later_rows(spark, seed):
    import random

    rng = random.Random(seed)
    series = [rng.randrange(20) for _ in range(24 * 9)]
    cut = rng.randrange(24 * 4, 24 * 6)
    changed = series[: cut + 1] + [v + 50 for v in series[cut + 1 :]]
    columns = [c for c in (*feat.LAGS, *feat.ROLLS, "zone_hour_mean", "zone_dow_hour_mean", "night_over_signal", "ramp_momentum")]

    def table(values):
        df = feat.main_features(gold(spark, values), holidays(spark)).filter(F.col("window_start") <= F.lit(T0 + timedelta(hours=cut)).cast("timestamp_ntz"))
        return [[r[c] for c in columns] for r in df.orderBy("window_start").collect()]

    assert table(series) == table(changed)


def test_hour_means_use_strictly_earlier_hours_of_all_zones(spark):
    both = gold(spark, [0] * 25 + [10] * 25, 1).unionByName(gold(spark, [4] * 50, 2))
    rows = {r["window_start"]: r["_hour_mean"] for r in feat.hour_means_before(both).collect()}
    assert rows[T0] is None and rows[T0 + timedelta(hours=24)] == 2.0


def test_sequences_need_unbroken_history(spark):
    g = gold(spark, list(range(12)))
    broken = g.filter(F.col("window_start") != F.lit(T0 + timedelta(hours=5)).cast("timestamp_ntz"))
    whole = feat.sequences(g, ["trip_count"], {"s": 3}).orderBy("window_start").collect()
    assert [[e["trip_count"] for e in r["s"]] for r in whole][:2] == [[0.0, 1.0, 2.0], [1.0, 2.0, 3.0]]
    assert [r["window_start"].hour for r in feat.sequences(broken, ["trip_count"], {"s": 3}).orderBy("window_start").collect()] == [3, 4, 9, 10]


def test_features_share_one_shuffle_by_zone(spark, tmp_path):
    gold(spark, list(range(30))).write.parquet(str(tmp_path / "g"))
    stored = spark.read.parquet(str(tmp_path / "g"))
    tables = [feat.main_features(stored, holidays(spark)), feat.specialist_features(stored, holidays(spark), "evening")]
    for df in tables:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(PULocationID") == 1


def test_split_covers_the_time_range(spark):
    rows = prep.add_split(gold(spark, [1] * 102)).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in rows} == {"train": 70, "val": 15, "test": 16}


def test_weights_average_to_one(spark):
    g = gold(spark, [h % 30 for h in range(300)]).withColumn("hour", F.hour("window_start"))
    assert prep.add_sample_weights(g).agg(F.avg("weight")).collect()[0][0] == pytest.approx(1.0)


def test_constant_target_scales_without_error(spark):
    g = gold(spark, [5] * 10)
    out = g.withColumn("s", prep.target_scaler(g).scalar()).select(prep.log_minmax(F.col("target_demand"), F.col("s")).alias("z"))
    assert {r["z"] for r in out.collect()} == {0.0}


def test_resample_prefers_critical_hours(spark):
    g = gold(spark, [1] * 24 * 200).withColumn("hour", F.hour("window_start"))
    drawn = prep.critical_resample(g)
    total = drawn.count()
    critical = drawn.filter(F.col("hour").isin(prep.fixed.CRITICAL_HOURS)).count()
    assert total == pytest.approx(g.count(), rel=0.08)
    assert critical / (total - critical) == pytest.approx(3.0, rel=0.12)


def test_resample_has_no_cap_and_no_randomness(spark):
    g = gold(spark, [1] * 24 * 4).withColumn("hour", F.when(F.hour("window_start") == 0, 0).otherwise(12))
    drawn = prep.critical_resample(g, factor=1e6)
    copies = [r["count"] for r in drawn.groupBy("window_start").count().collect()]
    # Four critical rows share all 95 copies; four rows at a rate of about 24 each.
    assert sum(copies) == pytest.approx(g.count(), rel=0.35) and len(copies) <= 4
    few = g.filter("hour = 0").limit(1).unionByName(g.filter("hour = 12").limit(9999).withColumn("hour", F.lit(12)))
    big = prep.critical_resample(few.withColumn("hour", F.when(F.col("hour") == 0, 0).otherwise(12)), factor=1e9)
    assert big.count() == pytest.approx(few.count(), rel=0.4) and big.count() > 41
    assert big.count() == prep.critical_resample(few.repartition(7), factor=1e9).count()


def test_poisson_draws_in_parts(spark):
    rates = spark.range(400).select(F.lit(900.0).alias("rate"), F.col("id").cast("string").alias("k"))
    parts = F.lit(15)
    draw = F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), lambda acc, i: acc + prep.poisson(F.col("rate") / parts, prep.uniform(F.col("k"), i.cast("string"))))
    row = rates.select(draw.alias("n")).agg(F.avg("n"), F.var_samp("n")).collect()[0]
    assert row[0] == pytest.approx(900, rel=0.01) and row[1] == pytest.approx(900, rel=0.25)


def test_weighted_mean_uses_all_rows(spark):
    values = [1000] * 200 + [0] * 98 + [0]
    rows = feat.add_extras(feat.add_lags(gold(spark, values)), alpha=0.05).orderBy("window_start").collect()
    w = s = 0.0
    for v, r in zip(values, rows):
        assert r["ewm_alpha03"] == pytest.approx(s / w if w else 0.0, rel=1e-9, abs=1e-12)
        s, w = s * 0.95 + v, w * 0.95 + 1


def test_context_precedence_and_copies(spark):
    old, new = demand(spark, [(1, 0, 5), (1, 0, 6), (1, 1, 2)]), demand(spark, [(1, 1, 9), (1, 2, 3)])
    got = {r["window_start"].hour: r["trip_count"] for r in forecast.merge_context(old, new).collect()}
    assert got == {0: 6, 1: 2, 2: 3}


def test_coverage_gate(spark):
    hourly = demand(spark, [(1, h, 1) for h in range(168)])
    zones = spark.createDataFrame([(1,)], "PULocationID bigint")
    full = forecast.coverage(hourly, zones, "2024-01-08").collect()[0]
    assert (full["coverage"], full["sufficient"]) == (1.0, True)
    two = forecast.coverage(hourly, spark.createDataFrame([(1,), (2,)], "PULocationID bigint"), "2024-01-08").collect()[0]
    assert (two["coverage"], two["sufficient"]) == (0.5, False)
    assert forecast.coverage(hourly.limit(0), zones.limit(0), "2024-01-08").collect()[0]["coverage"] == 0.0


def test_recursive_forecast_feeds_itself(spark):
    hourly = demand(spark, [(1, h, 6) for h in range(168)])
    zones = spark.createDataFrame([(1,)], "PULocationID bigint")
    table = forecast.baselines(hourly, "2024-01-08")
    rows = forecast.recursive_forecast(hourly, zones, "2024-01-08", table, step=lambda h, b: F.element_at(h, -1) + F.lit(1.0)).orderBy("hour").collect()
    assert [r["predicted"] for r in rows] == [6.0 + i for i in range(1, 25)]
    assert rows[0]["window_start"] == datetime(2024, 1, 8) and rows[23]["window_start"].hour == 23


def test_target_day_choice(spark):
    hourly = demand(spark, [(1, 24 * d, 1) for d in range(31)])
    calendar = spark.createDataFrame([(datetime(2024, 1, 9).date(), "Day off")], "date date, name string")
    got = forecast.resolve_day(hourly, calendar, 2024, 1).collect()[0]
    assert (got["target_date"].day, got["holiday_date"].day, got["holiday_name"]) == (10, 9, "")
    named = forecast.resolve_day(hourly, calendar, 2024, 1, target="2024-01-09").collect()[0]
    assert named["holiday_name"] == "Day off"
    nothing = forecast.resolve_day(hourly.limit(0), calendar.limit(0), 2024, 1).collect()[0]
    assert (nothing["target_date"].day, nothing["holiday_date"].day) == (15, 15)


@pytest.mark.parametrize("alpha", [0.001, 0.05, 0.3, 0.9, 0.999])
def test_weighted_mean_over_many_blocks(spark, alpha):
    """Two zones, NULL values, and blocks from seven rows to more than there are."""
    rng = np.random.default_rng(2)
    data = [(z, T0 + timedelta(hours=i), None if (i + z) % 9 == 0 else int(rng.poisson(5 + 40 * (i % 300 == 0)))) for z in (1, 2) for i in range(700)]
    df = spark.createDataFrame(data, "PULocationID long, window_start timestamp_ntz, trip_count long")
    got = {(r["PULocationID"], r["window_start"]): r["m"] for r in feat.add_ewm(df, "m", alpha=alpha).collect()}
    for z in (1, 2):
        s = w = 0.0
        for zone, t, n in data:
            if zone == z:
                assert got[z, t] == pytest.approx(s / w if w else 0.0, rel=1e-9, abs=1e-12)
                if n is not None:
                    s, w = (1 - alpha) * s + n, (1 - alpha) * w + 1


def test_weighted_mean_has_no_array_and_one_shuffle(spark):
    df = spark.createDataFrame([(1, T0, 2)], "PULocationID long, window_start timestamp_ntz, trip_count long")
    plan = feat.add_ewm(df, "m", alpha=0.001)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and plan.count("Exchange hashpartitioning") == 1
