from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from zonecast.operators import clean

T = datetime(2024, 1, 10, 8, 0, 0)
SCHEMA = (
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, trip_distance double, RatecodeID double, "
    "payment_type double, fare_amount double, passenger_count double, PULocationID double, DOLocationID double"
)
GOOD = (T, T + timedelta(minutes=12), 1.0, 1.0, 1.0, 9.0, 1.0, 10.0, 20.0)


def row(**changes):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    values = dict(zip(names, GOOD))
    values.update(changes)
    return tuple(values[n] for n in names)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize(
    "changes",
    [
        {"tpep_pickup_datetime": None}, {"tpep_dropoff_datetime": datetime(2024, 2, 1)}, {"trip_distance": 0.1}, {"RatecodeID": 7.0}, {"payment_type": 5.0},
        {"fare_amount": 0.99}, {"passenger_count": 0.0}, {"passenger_count": None}, {"PULocationID": 264.0}, {"DOLocationID": 0.0},
        {"tpep_pickup_datetime": datetime(2021, 1, 1), "tpep_dropoff_datetime": datetime(2021, 1, 1, 1)},
    ],
)
def test_each_strict_rule_drops(spark, changes):
    df = frame(spark, [GOOD, row(**changes)])
    assert clean.apply_rules(df, clean.strict_rules()).count() == 1
    steps = clean.waterfall(df, clean.strict_rules()).collect()
    assert sum(s["dropped"] for s in steps) == 1 and steps[-1]["after"] == 1


def test_waterfall_of_nothing(spark):
    steps = clean.waterfall(frame(spark, []), clean.strict_rules()).collect()
    assert all(s["before"] == 0 and s["dropped_pct"] == 0.0 for s in steps)


def test_silver_has_the_fixed_columns(spark):
    from zonecast import rules

    out = clean.silver(frame(spark, [GOOD]))
    assert out.columns == rules.SILVER_COLUMNS
    got = out.collect()[0]
    assert got["trip_duration_min"] == 12.0 and got["pickup_dayofweek"] == 4 and got["airport_fee"] is None


def test_adaptive_rule_order_decides(spark):
    # Passenger counts are mostly missing overall, but present on the rows the fare rule leaves.
    rows = [row(fare_amount=0.5, passenger_count=None)] * 6 + [row(passenger_count=0.0), row(), row(passenger_count=None)]
    profile = clean.adaptive_profile(clean.coerce_trips(frame(spark, rows)), 2024, 1).collect()[0]
    assert profile["use_passenger_count"] and profile["n_after_fare_amount"] == 3 and profile["n_after_passenger_count"] == 2
    assert clean.adaptive_clean(frame(spark, rows), 2024, 1).count() == 2


def test_adaptive_skips_a_sparse_column(spark):
    rows = [row(trip_distance=None)] * 3 + [row(trip_distance=500.0)]
    assert clean.adaptive_clean(frame(spark, rows), 2024, 1).count() == 4
    rows = [row(trip_distance=None)] * 2 + [row(trip_distance=500.0), row()]
    assert clean.adaptive_clean(frame(spark, rows), 2024, 1).count() == 1


def test_adaptive_keeps_month_crossing_trips_and_falls_back(spark):
    late = row(tpep_pickup_datetime=datetime(2024, 1, 31, 23, 50), tpep_dropoff_datetime=datetime(2024, 2, 1, 0, 13))
    assert clean.adaptive_clean(frame(spark, [late]), 2024, 1).count() == 1
    assert clean.apply_rules(frame(spark, [late]), clean.strict_rules()).count() == 0
    bad = [row(fare_amount=0.0), row(fare_amount=0.1), row(PULocationID=300.0)]
    assert clean.adaptive_clean(frame(spark, bad), 2024, 1).count() == 2
    assert clean.adaptive_clean(frame(spark, []), 2024, 1).count() == 0


def test_adaptive_matches_step_by_step_rules(spark):
    import random

    rng = random.Random(4)
    pick = lambda *values: rng.choice(values)
    for _ in range(3):
        rows = [
            row(trip_distance=pick(None, None, 0.05, 3.0), fare_amount=pick(None, 0.5, 8.0), passenger_count=pick(None, None, 0.0, 2.0), PULocationID=pick(None, 5.0, 400.0),
                tpep_dropoff_datetime=pick(None, T + timedelta(minutes=5), T + timedelta(days=1)))
            for _ in range(60)
        ]
        kept = [r for r in rows if r[7] is not None and 1 <= r[7] <= 263 and r[1] is not None and 0.5 <= (r[1] - r[0]).total_seconds() / 60 <= 360]
        for index, ok in ((2, lambda v: v is not None and 0.1 <= v <= 100), (5, lambda v: v is not None and v >= 1), (6, lambda v: v is None or v > 0)):
            if kept and sum(r[index] is not None for r in kept) / len(kept) >= 0.5:
                kept = [r for r in kept if ok(r[index])]
        assert clean.adaptive_clean(frame(spark, rows), 2024, 1).count() == len(kept)


def test_text_columns_are_coerced(spark):
    df = spark.createDataFrame([("2024-01-03 10:00:00", "7"), ("soon", "8"), ("2024-01-03 11:00:00", "x")], "tpep_pickup_datetime string, PULocationID string")
    assert [r["PULocationID"] for r in clean.adaptive_clean(df, 2024, 1).collect()] == [7.0]


def test_filters_reach_the_scan(spark, tmp_path):
    frame(spark, [GOOD]).write.parquet(str(tmp_path / "t"))
    df = clean.apply_rules(spark.read.parquet(str(tmp_path / "t")), clean.strict_rules()).select("PULocationID")
    plan = df._jdf.queryExecution().executedPlan().toString()
    for part in ("GreaterThan(trip_distance,0.1)", "LessThanOrEqual(RatecodeID,6.0)", "GreaterThanOrEqual(tpep_pickup_datetime,2022-01-01T00:00)", "LessThanOrEqual(PULocationID,263.0)"):
        assert part in plan
    kept, counts = clean.range_sanity(spark.sql("SELECT 300 AS PULocationID, 5 AS hour, 1 AS day_of_week UNION ALL SELECT 3, 24, 1 UNION ALL SELECT 3, 4, 7 UNION ALL SELECT 3, 4, 0"))
    assert kept.count() == 1
    assert counts.collect()[0].asDict() == {"rows_in": 4, "bad_zone": 1, "bad_hour": 1, "bad_dow": 1, "rows_out": 1}


def test_target_fallback(spark):
    both = spark.sql("SELECT '3' AS target_demand, 9 AS trip_count UNION ALL SELECT 'n/a', 9")
    assert sorted(r["target_demand"] for r in clean.with_target(both).collect()) == [0.0, 3.0]
    assert clean.with_target(both.drop("target_demand")).agg(F.sum("target_demand")).collect()[0][0] == 18.0
