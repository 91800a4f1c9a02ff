"""Regressions by sums against exact small solutions, and the recursive forecast against a plain loop."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.operators import regression as reg


def frame(spark, x, y, w=None):
    names = [f"a{i}" for i in range(x.shape[1])]
    rows = [(*map(float, r), float(t), float(u)) for r, t, u in zip(x, y, np.ones(len(y)) if w is None else w)]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in [*names, "y", "w"])).repartition(3), names


def design(x):
    return np.column_stack([np.ones(len(x)), x])


def vector(model, names):
    return np.array([model.intercept, *[model.coefficients[n] for n in names]])


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(60, 2)) * [3.0, 0.2] + [10.0, -1.0]
    y = 2.0 + x @ [0.5, -4.0] + rng.standard_t(2, size=60)
    return x, y, rng.uniform(0.5, 2.0, size=60)


def test_least_squares_against_normal_equations(spark, data):
    x, y, w = data
    df, names = frame(spark, x, y, w)
    b = vector(reg.least_squares(df, names, "y", F.col("w")), names)
    z = design(x)
    assert b == pytest.approx(np.linalg.solve((z * w[:, None]).T @ z, z.T @ (w * y)), rel=1e-8)


def test_huber_meets_its_conditions_and_leaves_outliers(spark, data):
    x, y, w = data
    y = y.copy()
    y[:5] += 500.0
    df, names = frame(spark, x, y, w)
    model = reg.huber(df, names, "y", F.col("w"), delta=1.0, steps=100)
    z = design(x)
    r = y - z @ vector(model, names)
    gradient = z.T @ (w * np.clip(r, -1.0, 1.0))
    assert np.abs(gradient).max() < 1e-6
    plain = vector(reg.least_squares(df, names, "y", F.col("w")), names)
    assert abs(model.coefficients["a1"] + 4.0) < 0.25 * abs(plain[2] + 4.0)


def pinball(r, alpha):
    return np.maximum(alpha * r, (alpha - 1) * r).sum()


@pytest.mark.parametrize("alpha", [0.4, 0.45, 0.9])
def test_quantile_against_all_vertices(spark, data, alpha):
    """A best solution goes through three of the points: try all."""
    x, y, _ = data
    df, names = frame(spark, x[:30], y[:30])
    z = design(x[:30])
    best = min(pinball(y[:30] - z @ np.linalg.solve(z[list(c)], y[list(c)]), alpha) for c in itertools.combinations(range(30), 3))
    model = reg.quantile(df, names, "y", alpha)
    assert pinball(y[:30] - z @ vector(model, names), alpha) == pytest.approx(best, rel=1e-4)


def test_quantile_beats_a_group_table_on_a_slope(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 10, size=(400, 1))
    y = 3 * x[:, 0] + rng.exponential(size=400)
    df, names = frame(spark, x, y)
    model = reg.quantile(df.where("a0 < 8"), names, "y", 0.45)
    flat = np.quantile(y[x[:, 0] < 8], 0.45)
    later = model.predict(df.where("a0 >= 8"))
    loss = later.agg(F.avg(reg.pinball(F.col("y"), F.col("predicted"), 0.45)).alias("m")).first()["m"]
    table = later.agg(F.avg(reg.pinball(F.col("y"), F.lit(float(flat)), 0.45)).alias("m")).first()["m"]
    assert loss < 0.2 * table


def ordinal_likelihood(point, z, k, j):
    theta, beta = point[:j], point[j:]
    edge = np.concatenate([[-np.inf], theta, [np.inf]])
    eta = z @ beta
    cdf = lambda t: 1 / (1 + np.exp(np.clip(eta - t, -700, 700)))
    return np.log(np.maximum(cdf(edge[k + 1]) - cdf(edge[k]), 1e-300)).sum()


def test_ordinal_is_a_maximum_with_ordered_thresholds(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 2)) * [1.0, 20.0] + [0.0, 100.0]
    latent = x @ [1.5, 0.05] + rng.logistic(size=300)
    k = np.digitize(latent, [4.0, 5.5, 7.0])
    df, names = frame(spark, x, k)
    model = reg.ordinal(df, names, "y", 4)
    assert list(model.thresholds) == sorted(model.thresholds)
    point = np.array([*model.thresholds, *[model.coefficients[n] for n in names]])
    top = ordinal_likelihood(point, x, k, 3)
    for i in range(5):
        for sign in (-1, 1):
            moved = point.copy()
            moved[i] += sign * 1e-4 * max(1.0, abs(point[i]))
            assert ordinal_likelihood(moved, x, k, 3) < top
    assert point[3] == pytest.approx(1.5, abs=0.5)
    rows = model.predict(df).select("probs").collect()
    assert all(min(r["probs"]) >= 0 and sum(r["probs"]) == pytest.approx(1) for r in rows)


def test_ordinal_without_features_gives_the_shares(spark):
    df, _ = frame(spark, np.zeros((10, 1)), np.array([0, 0, 0, 1, 1, 1, 1, 2, 2, 2]))
    model = reg.ordinal(df, [], "y", 3)
    got = model.predict(df).first()["probs"]
    assert got == pytest.approx([0.3, 0.4, 0.3])


def test_odd_rows_and_flat_features(spark, data):
    x, y, w = data
    df, names = frame(spark, x, y, w)
    bad = df.limit(1).select(*[F.lit(None).cast("double").alias(n) for n in names], F.lit(1e9).alias("y"), F.lit(1.0).alias("w"))
    same = df.unionByName(bad).withColumn("flat", F.lit(3)).withColumn("twice", 2 * F.col("a0"))
    one = reg.least_squares(df, names, "y")
    two = reg.least_squares(same, [*names, "flat", "twice"], "y")
    assert two.coefficients["flat"] == 0.0
    assert two.coefficients["a0"] + 2 * two.coefficients["twice"] == pytest.approx(one.coefficients["a0"])
    none = reg.huber(df.limit(0), names, "y")
    assert none.intercept == 0.0 and set(none.coefficients.values()) == {0.0}
    assert reg.ordinal(df.limit(0), names, "y", 3).coefficients == {"a0": 0.0, "a1": 0.0}


def test_buckets(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (2.5,), (9.0,)], "y double")
    assert [r["b"] for r in df.select(reg.bucket_of(F.col("y"), [0, 2]).alias("b")).collect()] == [0, 1, 1, 2, 2]
    assert reg.bucket_means(df, "y", [0, 2]) == [0.0, 1.5, 5.75]
    assert reg.bucket_means(df.where("y > 2"), "y", [0, 2])[0] == 0.0


def test_log_link(spark):
    model = reg.Linear({"a": 0.5}, 1.0, "log")
    df = spark.createDataFrame([(2.0,), (1e6,)], "a double")
    assert [r["predicted"] for r in model.predict(df).collect()] == pytest.approx([math.exp(2.0), math.exp(20.0)])
