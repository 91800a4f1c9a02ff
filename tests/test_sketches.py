"""Daily sketches: rolled up against exact results, days replaced one by one."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.operators import sketches

T0 = datetime(2024, 1, 1)
SCHEMA = "t timestamp_ntz, k string, v double, e long"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    n = 40_000
    hours = rng.integers(0, 24 * 60, n)
    return [(T0 + timedelta(hours=int(h)), "ab"[i % 2], None if i % 50 == 0 else float(v), None if i % 70 == 0 else int(e)) for i, (h, v, e) in enumerate(zip(hours, rng.lognormal(size=n), rng.integers(0, 9000, n)))]


def test_months_from_days_within_the_stated_errors(spark, rows, tmp_path):
    path = str(tmp_path / "days")
    sketches.store(sketches.daily(frame(spark, rows), "t", "v", "e", ["k"]), path)
    days = sketches.stored(spark, path)
    assert days.count() == 120
    got = sketches.rolled_up(days, {"month": F.date_format("day", "yyyy-MM")}, {"p10": 0.1, "p50": 0.5, "p99": 0.99}, ["k"]).collect()
    assert len(got) == 4
    for r in got:
        mine = [x for x in rows if x[0].strftime("%Y-%m") == r["month"] and x[1] == r["k"]]
        v = np.array([x[2] for x in mine if x[2] is not None])
        assert r["n"] == len(mine) and r["value_sum"] == pytest.approx(v.sum()) and r["value_mean"] == pytest.approx(v.mean())
        for name, p in (("p10", 0.1), ("p50", 0.5), ("p99", 0.99)):
            assert abs((v <= r[name]).mean() - p) <= 2 * sketches.rank_error()
        exact = len({x[3] for x in mine if x[3] is not None})
        assert abs(r["distinct"] - exact) <= 4 * sketches.distinct_error() * exact


def test_a_day_is_replaced_and_the_others_stay(spark, tmp_path):
    path = str(tmp_path / "days")
    first = [(T0 + timedelta(days=d), "a", float(d), d) for d in range(3)]
    sketches.store(sketches.daily(frame(spark, first), "t", "v", "e"), path)
    again = [(T0 + timedelta(days=1, hours=h), "a", 10.0, 100 + h) for h in range(5)]
    sketches.store(sketches.daily(frame(spark, again), "t", "v", "e"), path)
    r = sketches.rolled_up(sketches.stored(spark, path), {"all": F.lit(1)}, {"p50": 0.5}).first()
    assert (r["days"], r["n"], r["value_sum"], r["distinct"], r["p50"]) == (3, 7, 52.0, 7, 10.0)


def test_nulls_and_nothing(spark):
    rows = [(None, "a", 1.0, 1), (T0, "a", None, None)]
    days = sketches.daily(frame(spark, rows), "t", "v", "e")
    r = sketches.rolled_up(days, {"all": F.lit(1)}, {"p50": 0.5}).first()
    assert (r["n"], r["value_sum"], r["value_mean"], r["distinct"], r["p50"]) == (1, None, None, 0, None)
    assert sketches.rolled_up(sketches.daily(frame(spark, []), "t", "v", "e"), {"all": F.lit(1)}, {"p50": 0.5}).count() == 0
