"""Metrics, calibration, searches, post-processing, quality checks, marts and models."""

import itertools
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast import rules
from zonecast.operators import calibrate as cal, grids, marts, metrics as met, models, postprocess as post, quality

T0 = datetime(2024, 1, 1)


def preds(spark, rows):
    """(hour, day_of_week, actual, predicted) rows."""
    data = [(1, T0 + timedelta(hours=i), h, d, int(d >= 5), 0, float(a), float(p)) for i, (h, d, a, p) in enumerate(rows)]
    return spark.createDataFrame(
        data, "PULocationID bigint, window_start timestamp_ntz, hour int, day_of_week int, is_weekend int, is_holiday int, actual double, predicted double"
    )


def test_metrics_with_zero_and_constant_actuals(spark):
    got = met.evaluate(preds(spark, [(1, 0, 0, 1), (2, 0, 0, 0)])).collect()[0]
    assert (got["mae"], got["wape"], got["r2"], got["mape"], got["smape"]) == (0.5, 100.0, None, 50.0, 100.0)
    nothing = met.evaluate(preds(spark, [(1, 0, 0, 1)]).limit(0)).collect()[0]
    assert nothing["n"] == 0 and nothing["mae"] is None


def test_auc_with_ties_matches_pairs(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(2), rng.choice([0.1, 0.1, 0.4, rng.random()])) for _ in range(400)]
    got = met.classifier_scores(spark.createDataFrame(rows, "label int, score double")).collect()[0]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert got["auc"] == pytest.approx(pairs / len(pos) / len(neg))


def test_one_class_has_no_auc(spark):
    got = met.classifier_scores(spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, score double")).collect()[0]
    assert got["auc"] is None and got["precision"] == 1.0 and got["recall"] == 0.5


def test_tertiles_are_right_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "zone_hour_mean double")
    assert [r["zone_vol_tertile"] for r in met.with_tertile(df).orderBy("zone_hour_mean").collect()] == ["low", "low", "mid", "high"]


def test_night_factors_levels(spark):
    rows = [(2, 0, 4, 1)] * 40 + [(2, 6, 4, 1)] * 10 + [(9, 0, 4, 1)] * 40
    factors = {(r["level"], r["is_weekend"], r["hour"]): r["factor"] for r in cal.night_factors(preds(spark, rows)).collect()}
    assert set(factors) == {("holiday_weekend_hour", 0, 2), ("weekend_hour", 0, 2), ("hour", -1, 2)}
    assert factors[("hour", -1, 2)] == pytest.approx(1 + 50 / 170 * 1.5)
    applied = cal.apply_night(preds(spark, [(2, 6, 4, 1), (2, 0, 4, 1), (9, 0, 4, 1)]), cal.night_factors(preds(spark, rows))).orderBy("window_start").collect()
    assert [round(r["predicted"], 4) for r in applied] == [1.4412, 1.375, 1.0]


def test_ratio_of_nothing_is_one(spark):
    rows = cal.hour_factors(preds(spark, [(1, 0, 0, 5), (2, 0, 90, 10), (3, 0, 11, 10)])).collect()
    assert {r["hour"]: r["factor"] for r in rows} == {1: 1.0, 2: 1.45, 3: 1.1}


def test_affine_needs_rows_and_stays_bounded(spark):
    rows = [(1, 0, 3 * p + 1, p) for p in range(20)] + [(2, 0, 1, 1)] * 15 + [(3, 0, 5, 2)] * 16
    got = {r["hour"]: (r["a"], r["b"]) for r in cal.hour_affine(preds(spark, rows)).collect()}
    assert set(got) == {1, 3} and got[1][0] == 1.2 and got[1][1] == pytest.approx(1.0) and got[3] == (1.0, 3.0)


def test_late_affine_search_matches_brute_force(spark):
    rng = random.Random(8)
    rows = [(h, 0, rng.randrange(30), rng.random() * 30) for h in (22, 23) for _ in range(25)]
    got = {r["hour"]: (r["factor"], r["bias"], r["wape"]) for r in grids.late_affine(preds(spark, rows)).collect()}
    for hour in (22, 23):
        y = np.array([float(r[2]) for r in rows if r[0] == hour])
        p = np.array([r[3] for r in rows if r[0] == hour])
        best = min(
            ((round(np.abs(y - np.clip(p * f + b, 0, None)).sum() / max(y.sum(), 1) * 100, 9), i, j, f, b)
             for i, f in enumerate(np.linspace(0.55, 1.15, 25)) for j, b in enumerate(np.linspace(-15, 8, 24))),
        )
        assert got[hour][0] == pytest.approx(best[3]) and got[hour][1] == pytest.approx(best[4]) and got[hour][2] == pytest.approx(best[0], abs=1e-8)


def test_first_of_equal_parameters_wins(spark):
    got = grids.blend_weight(preds(spark, [(1, 0, 5, 5)]).withColumn("other", F.lit(5.0)), "predicted", "other", [0.0, 0.5, 1.0]).collect()[0]
    assert got["w"] == 0.0


@pytest.mark.parametrize("seed", [1, 2])
def test_searching_regimes_apart_finds_the_joint_optimum(spark, seed, monkeypatch):
    reduced = {
        "deep": {"threshold": [0.2, 0.5], "blend": [0.0], "cap": [(999.0, 0.0), (1.0, 1.0)]},
        "ramp": {"threshold": [0.1, 0.4], "blend": [0.0, 0.3], "cap": [(1.5, 1.0)]},
        "morning": {"threshold": [0.1], "blend": [0.0, 0.5], "cap": [(999.0, 0.0), (2.0, 0.0)]},
    }
    monkeypatch.setattr(rules, "ZERO_INFLATED_SEARCH", reduced)
    rng = random.Random(seed)
    rows = [(rng.randrange(10), float(rng.randrange(6)), rng.random(), rng.random() * 8, rng.random() * 4, rng.random() * 4) for _ in range(120)]
    df = spark.createDataFrame(rows, "hour int, actual double, prob double, intensity double, zone_hour_mean double, baseline_blend double")
    params = grids.as_parameters(grids.zero_inflated_search(df)).collect()[0]["p"].asDict()
    score = lambda p: met.composite(post.zero_inflated(df, p)).collect()[0]["score"]
    found = score(params)

    def numpy_score(choice):
        h, y, prob, intensity, mean, blend = (np.array(c) for c in zip(*rows))
        out = np.zeros(len(rows))
        for name, mask in (("deep", h <= 2), ("ramp", (h > 2) & (h <= 4)), ("morning", h >= 5)):
            t, b, (mult, bias) = choice[name]
            q = np.where(prob < t, 0.0, prob * intensity)
            q = (1 - b) * q + b * blend if b > 0 else q
            out = np.where(mask, np.maximum(np.minimum(q, np.maximum(mean * mult + bias, 0)), 0), out)
        wape = lambda m: np.abs(y - out)[m].sum() / max(y[m].sum(), 1.0) * 100
        return 0.42 * wape(h >= 0) + 0.58 * wape(h >= 5)

    lists = {n: list(itertools.product(v["threshold"], v["blend"], v["cap"])) for n, v in reduced.items()}
    best = min(numpy_score(dict(zip(lists, combo))) for combo in itertools.product(*lists.values()))
    assert found == pytest.approx(best)


def test_weekend_search_shrinks_with_few_rows(spark):
    rows = [(22, 5, 10, 1)] * 30
    got = grids.weekend_adjust(preds(spark, rows)).collect()
    assert len(got) == 1 and got[0]["factor"] <= 1.022 + 1e-9 and got[0]["bias"] <= 1.2 + 1e-9
    assert grids.weekend_adjust(preds(spark, [(22, 1, 1, 1)])).count() == 0


def test_residual_correction_is_bounded(spark):
    df = preds(spark, [(22, 0, 0, 100), (22, 0, 0, 5), (22, 0, 0, 2), (10, 0, 0, 7)]).withColumn("delta", F.lit(-50.0))
    assert [r["predicted"] for r in post.residual_correction(df, "delta").orderBy("window_start").collect()] == [92.0, 2.0, 0.0, 7.0]


def test_routing_falls_back_to_the_main_model(spark):
    df = preds(spark, [(3, 0, 0, 1), (12, 0, 0, 1), (20, 0, 0, 1)]).withColumns({"low": F.lit(5.0), "eve": F.lit(None).cast("double")})
    rows = post.route_by_hour(df, "predicted", "low", "eve", out="final").orderBy("window_start").collect()
    assert [(r["final"], r["model_used"]) for r in rows] == [(5.0, "low_hour"), (1.0, "main"), (1.0, "main")]


def test_inverse_error_weights_sum_to_one(spark):
    df = preds(spark, [(1, 0, 10, 8), (2, 0, 10, 8)]).withColumn("other", F.lit(9.0))
    row = cal.inverse_mae_weights(df, ["predicted", "other"]).collect()[0]
    assert row["w_predicted"] == pytest.approx(1 / 3) and sum(row) == pytest.approx(1.0)


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 3.0, 1.0), (2.0, 3.0, None), (3.0, 3.0, 5.0)], "target_demand double, flat double, gap double")
    got = {r["feature"]: r["corr"] for r in quality.correlations(df, ["flat", "gap"]).collect()}
    assert got["flat"] is None and got["gap"] == pytest.approx(1.0)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 9, 10)], "x double")
    assert {r["bin"]: r["n"] for r in quality.histogram(df, "x", bins=10).collect()} == {0: 1, 1: 1, 9: 2}
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [(r["bin"], r["n"]) for r in quality.histogram(flat, "x").collect()] == [(0, 2)]


def test_quality_report_on_a_synthetic_series(spark):
    rng = np.random.default_rng(42)
    hours = np.arange(2000)
    values = np.abs(50 + 30 * np.sin(2 * np.pi * hours / 24) + 20 * np.sin(2 * np.pi * hours / 168) + rng.normal(0, 10, 2000))
    values[rng.choice(2000, 10, replace=False)] *= 20
    data = [(1 + int(h) % 5, T0 + timedelta(hours=int(h)), float(v)) for h, v in zip(hours, values)]
    df = spark.createDataFrame(data, "PULocationID bigint, window_start timestamp_ntz, target_demand double")
    status = {r["check"]: r["status"] for r in quality.report([quality.column_checks(df), quality.distribution_checks(df), quality.split_checks(df)]).collect()}
    assert status["spike_ratio"] == "WARN" and status["zero_share"] == "PASS" and status["feature:lag_1h"] == "FAIL" and status["feature:lag_3h"] == "WARN"
    assert status["test_size"] == "PASS" and status["nulls:target_demand"] == "PASS"


def test_deduplication_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 9.0), (1, "a", 3.0), (2, None, 1.0)], "transaction_id bigint, customer_id string, amount double")
    got = {r["transaction_id"]: (r["customer_id"], r["amount"]) for r in marts.first_copies(df, "transaction_id").collect()}
    assert got == {1: ("a", 3.0), 2: (None, 1.0)}
    assert "partial_min" in marts.first_copies(df, "transaction_id")._jdf.queryExecution().executedPlan().toString()


def test_marts_on_text_timestamps(spark):
    raw = spark.createDataFrame(
        [(1, 7, 1, 10.0, 2.0, " toys ", "2024-01-05 10:00:00", "F"), (2, 7, 1, 5.0, 1.0, "toys", "not a time", "O"), (2, 7, 1, 5.0, 1.0, "toys", "not a time", "O")],
        "transaction_id bigint, customer_id bigint, product_id bigint, amount double, quantity double, category string, timestamp string, status string",
    )
    silver = marts.sales_silver(raw)
    assert {(r["category"], r["event_month"], r["total_value"]) for r in silver.collect()} == {("toys", "2024-01", 20.0), ("toys", None, 5.0)}
    row = marts.customer_mart(silver).collect()[0]
    assert (row["txn_count"], row["total_spent"], row["completion_rate"]) == (2, 15.0, 0.5)
    exact, approximate = marts.monthly_mart(silver), marts.monthly_mart(silver, approximate=True)
    assert {r["event_month"]: r["active_customers"] for r in exact.collect()} == {r["event_month"]: r["active_customers"] for r in approximate.collect()}


def test_models_learn_a_simple_relation(spark):
    rng = random.Random(0)
    rows = [(1, h % 24, (h // 24) % 7, x := rng.randrange(20), 2 * x, float(x)) for h in range(600)]
    df = spark.createDataFrame(rows, "PULocationID bigint, hour int, day_of_week int, lag_1h int, target_demand int, zone_hour_mean double")
    df = df.withColumns({"weight": F.lit(1.0), "w_class": F.lit(1.0), "w_intensity": F.lit(1.0), "flat": F.lit(3.0)})
    scored = models.fit_main(df, ["lag_1h", "hour"], trees=5, depth=4).predict(df)
    error = scored.agg(F.avg(F.abs(F.col("predicted") - F.col("target_demand")))).collect()[0][0]
    assert error < 10
    pair = models.fit_zero_inflated(df, ["lag_1h", "flat"]).predict(df)
    low, high = (pair.filter(c).agg(F.avg("prob")).collect()[0][0] for c in ("lag_1h = 0", "lag_1h > 5"))
    assert low < high
    stopped = models.fit_main(df, ["lag_1h", "hour"], val=df.filter("hour < 5"), trees=200, depth=4, tolerance=0.01)
    assert stopped.model.stages[-1].getNumTrees < 200
    few, none = models.expert_enabled(df.limit(10), df.limit(10)), models.residual_enabled(df, df, 10, 1000)
    assert few.collect()[0]["enabled"] is False and none.collect()[0].asDict() == {"n_train": 50, "n_val": 50, "enabled": False}
    assert models.sunday_expert(df, few).count() == 0
    assert models.sunday_expert(df, models.expert_enabled(df, df, 1, 1)).count() == 3
    late = df.withColumns({"actual": F.col("target_demand").cast("double"), "predicted": F.col("zone_hour_mean")})
    model = models.fit_residual(late, ["lag_1h", "zone_hour_mean"])
    on, off = (models.residual_delta(model, late, models.residual_enabled(late, late, 1, n)) for n in (1, 10**6))
    assert off.filter(F.col("delta").isNotNull()).count() == 0 and on.filter(F.col("delta").isNull()).count() == 0
    head = models.with_quantile(df, models.quantile_head(df, 0.5))
    assert head.filter(F.col("pred_quantile").isNull()).count() == 0
