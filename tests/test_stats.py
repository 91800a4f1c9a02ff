import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.functions import scalar
from zonecast.functions.stats import exact_quantiles, running_totals, value_histogram


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_quantiles_match_numpy_with_a_hot_group(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(3000):
        key = "hot" if rng.random() < 0.6 else rng.choice("abc")
        value = rng.choice([rng.gauss(0, 1), rng.gauss(1e6, 10), -rng.random() * 1e-3, 0.0, 7.0])
        rows.append((key, value))
    probs = {"p0": 0.0, "p1": 0.1, "p5": 0.5, "p7": 0.731, "p100": 1.0}
    got = {r["k"]: r for r in exact_quantiles(spark.createDataFrame(rows, "k string, v double"), "v", probs, ["k"]).collect()}
    for key in {k for k, _ in rows}:
        values = [v for k, v in rows if k == key]
        assert got[key]["n"] == len(values)
        for name, p in probs.items():
            assert got[key][name] == pytest.approx(np.percentile(values, p * 100), rel=1e-12, abs=1e-12)


def test_quantiles_of_one_row_ignore_nulls(spark):
    df = spark.createDataFrame([(1.5,), (None,)], "v double")
    assert exact_quantiles(df, "v", {"m": 0.5}).collect()[0].asDict() == {"n": 1, "m": 1.5}


def test_running_totals_match_a_sort(spark):
    values = [float(v) for v in np.random.default_rng(5).normal(0, 100, 500).round(1)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["value"]: r["n_before"] for r in running_totals(value_histogram(df, [], "v"), [], ["n"]).collect()}
    for v in set(values):
        assert got[v] == sum(x < v for x in values)


def test_no_global_ordering_in_quantiles(spark):
    df = spark.range(1000).select(F.rand(1).alias("v"), (F.col("id") % 3).alias("k"))
    plan = exact_quantiles(df, "v", {"m": 0.5}, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_scalar_expressions(spark):
    row = spark.createDataFrame([(0.0, 5.0, None)], "zero double, five double, nothing double").select(
        scalar.safe_ratio("five", "zero").alias("a"), scalar.safe_ratio(F.lit(500), "five").alias("b"), scalar.safe_ratio("nothing", "five").alias("c"),
        scalar.safe_div("five", "zero", 3.0).alias("d"), scalar.clip("nothing", 0, 1).alias("e"), scalar.py_round(F.lit(2.5)).alias("f"),
        scalar.py_round(F.lit(0.125), 2).alias("g"), scalar.huber(F.lit(-3.0), 1.0).alias("h"), scalar.pinball(F.lit(1.0), F.lit(3.0), 0.1).alias("i"),
        scalar.rounded(F.lit(-1e-12)).alias("j"),
    ).collect()[0]
    assert [row[c] for c in "abcdefgh"] == [0.0, 10.0, 0.0, 3.0, None, 2.0, 0.12, 2.5]
    assert row["i"] == pytest.approx(1.8)
    assert str(row["j"]) == "0.0"


def test_values_in_a_narrow_range_get_many_bins(spark):
    values = spark.range(1_000_000).select((F.lit(0.5) + F.col("id") * 1e-8).alias("x"))
    hist = value_histogram(values, [], "x")
    largest, bins = hist.groupBy("bin").count().agg(F.max("count"), F.count(F.lit(1))).collect()[0]
    assert bins >= 50 and largest <= 3 * 16_384
    order = hist.groupBy("bin").agg(F.min("value").alias("a"), F.max("value").alias("b")).orderBy("bin").collect()
    assert all(p["b"] < q["a"] for p, q in zip(order, order[1:]))
    row = exact_quantiles(values, "x", {"q": 0.25}).collect()[0]
    assert row["q"] == pytest.approx(0.5 + 249_999.75e-8, abs=1e-13)
