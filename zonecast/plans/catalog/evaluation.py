"""Forecast metrics and data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonecast import rules as fixed
from zonecast.operators import features as feat, metrics as met, prep, quality
from zonecast.functions.stats import exact_quantiles
from zonecast.plans.adapters import calendar, table
from zonecast.plans.catalog.base import SPLIT, ZONE_ROWS, query, sql_table
from zonecast.plans.tables import gold, main_table, shared, stored_forecasts, stored_gold
from zonecast.session import materialize

E = "abs(actual - predicted)"
METRICS = f"""count(*) AS n, avg({E}) AS mae, sqrt(avg({E} * {E})) AS rmse, 1 - sum({E} * {E}) / nullif(var_pop(actual) * count(*), 0) AS r2,
 avg({E} / greatest(actual, 1)) * 100 AS mape, sum({E}) / greatest(sum(actual), 1) * 100 AS wape,
 avg({E} / CASE WHEN (abs(actual) + abs(predicted)) / 2 = 0 THEN 1 ELSE (abs(actual) + abs(predicted)) / 2 END) * 100 AS smape"""
RATES = """, avg(CASE WHEN predicted > actual THEN 1.0 ELSE 0 END) AS over_pred_rate, avg(CASE WHEN predicted < actual THEN 1.0 ELSE 0 END) AS under_pred_rate,
 avg(CASE WHEN predicted = actual THEN 1.0 ELSE 0 END) AS equal_pred_rate, avg(predicted - actual) AS mean_signed_error"""
METRIC_SPEC = "n:l mae:d rmse:d r2:d mape:d wape:d smape:d"
RATE_SPEC = METRIC_SPEC + " over_pred_rate:d under_pred_rate:d equal_pred_rate:d mean_signed_error:d"


def _part(spark, sf_dir, split: str):
    return stored_forecasts(spark, sf_dir).filter(F.col("split") == split)


@query(
    "forecast_table",
    "PULocationID:l window_start:t hour:i day_of_week:i is_weekend:i is_holiday:i split:s actual:d zone_hour_mean:d zone_dow_hour_mean:d hour_mean:d baseline_blend:d naive_day:d naive_week:d",
    "SELECT * FROM forecasts",
    "forecasts",
)
def _(spark, sf_dir):
    return stored_forecasts(spark, sf_dir)


@query("metrics_overall", METRIC_SPEC, f"SELECT {METRICS} FROM test", "test")
def _(spark, sf_dir):
    return met.evaluate(_part(spark, sf_dir, "test"))


@query(
    "metrics_variants",
    "mape_zero_is_one:d mape_floor_1:d mape_floor_10:d wape_floor:d wape_raw:d smape_floor:d smape_shift:d",
    f"""SELECT avg({E} / CASE WHEN actual = 0 THEN 1 ELSE actual END) * 100 AS mape_zero_is_one, avg({E} / greatest(actual, 1)) * 100 AS mape_floor_1,
     avg({E} / greatest(actual, 10)) * 100 AS mape_floor_10, sum({E}) / greatest(sum(actual), 1) * 100 AS wape_floor, sum({E}) / sum(actual) * 100 AS wape_raw,
     avg(2 * {E} / greatest(abs(actual) + abs(predicted), 1e-9)) * 100 AS smape_floor, avg(2 * {E} / (abs(actual) + abs(predicted) + 1e-5)) * 100 AS smape_shift FROM test""",
    "test",
)
def _(spark, sf_dir):
    return _part(spark, sf_dir, "test").agg(
        met.mape(None).alias("mape_zero_is_one"), met.mape(1).alias("mape_floor_1"), met.mape(10).alias("mape_floor_10"),
        met.wape(1.0).alias("wape_floor"), met.wape(None).alias("wape_raw"), met.smape("floor").alias("smape_floor"), met.smape("shift").alias("smape_shift"),
    )


@query(
    "metrics_peak",
    "n_peak:l peak_mape:d",
    f"SELECT count(*) AS n_peak, avg({E} / CASE WHEN actual = 0 THEN 1 ELSE actual END) * 100 AS peak_mape FROM test WHERE actual > (SELECT quantile_cont(actual, 0.75) FROM test)",
    "test",
)
def _(spark, sf_dir):
    return met.peak_mape(_part(spark, sf_dir, "test"))


@query(
    "metrics_peak_by_zone",
    "PULocationID:l n_peak:l peak_mape:d",
    f"""SELECT "PULocationID", count(*) AS n_peak, avg({E} / CASE WHEN actual = 0 THEN 1 ELSE actual END) * 100 AS peak_mape
     FROM test JOIN (SELECT "PULocationID", quantile_cont(actual, 0.75) AS cut FROM test GROUP BY 1) USING ("PULocationID") WHERE actual > cut GROUP BY 1""",
    "test",
)
def _(spark, sf_dir):
    return met.peak_mape(_part(spark, sf_dir, "test"), ["PULocationID"])


@query("metrics_by_hour", "hour:i " + METRIC_SPEC, f"SELECT hour, {METRICS} FROM test GROUP BY 1", "test")
def _(spark, sf_dir):
    return met.evaluate(_part(spark, sf_dir, "test"), ["hour"])


@query("metrics_by_hour_and_weekday", "hour:i day_of_week:i " + RATE_SPEC, f"SELECT hour, day_of_week, {METRICS}{RATES} FROM test GROUP BY 1, 2", "test")
def _(spark, sf_dir):
    return met.segment_stats(_part(spark, sf_dir, "test"), ["hour", "day_of_week"])


@query("metrics_late_by_weekday", "day_of_week:i " + RATE_SPEC, f"SELECT day_of_week, {METRICS}{RATES} FROM forecasts WHERE hour >= 22 GROUP BY 1", "forecasts")
def _(spark, sf_dir):
    late = stored_forecasts(spark, sf_dir).filter(F.col("hour").isin(fixed.LATE_HOURS))
    return met.segment_stats(late, ["day_of_week"])


@query(
    "metrics_late_by_volume",
    "zone_vol_tertile:s " + RATE_SPEC,
    f"""SELECT CASE WHEN zone_hour_mean <= t1 THEN 'low' WHEN zone_hour_mean <= t2 THEN 'mid' ELSE 'high' END AS zone_vol_tertile, {METRICS}{RATES}
     FROM forecasts, (SELECT quantile_cont(zone_hour_mean, 1.0::DOUBLE / 3) AS t1, quantile_cont(zone_hour_mean, 2.0::DOUBLE / 3) AS t2 FROM forecasts WHERE hour >= 22) WHERE hour >= 22 GROUP BY 1""",
    "forecasts",
)
def _(spark, sf_dir):
    late = stored_forecasts(spark, sf_dir).filter(F.col("hour").isin(fixed.LATE_HOURS))
    return met.segment_stats(met.with_tertile(late), ["zone_vol_tertile"])


SEGMENTS = [
    ("late_night_00_04", "hour BETWEEN 0 AND 4"), ("transition_up_05_07", "hour BETWEEN 5 AND 7"), ("morning_peak_08_10", "hour BETWEEN 8 AND 10"),
    ("day_11_15", "hour BETWEEN 11 AND 15"), ("evening_peak_16_20", "hour BETWEEN 16 AND 20"), ("late_evening_21_23", "hour >= 21"),
    ("holiday", "is_holiday = 1"), ("weekend", "is_weekend = 1"),
]


@query(
    "metrics_named_segments",
    "segment:s n:l mae:d rmse:d mape:d bias:d",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS segment, count(*) AS n, avg({E}) AS mae, sqrt(avg({E} * {E})) AS rmse, avg({E} / CASE WHEN actual = 0 THEN 1 ELSE actual END) * 100 AS mape,
         avg(predicted - actual) AS bias FROM forecasts WHERE {c} HAVING count(*) > 0""" for n, c in SEGMENTS
    ),
    "forecasts",
)
def _(spark, sf_dir):
    return met.segment_report(stored_forecasts(spark, sf_dir))


@query(
    "metrics_by_part_of_day",
    "bucket:s n:l mae:d rmse:d r2:d wape:d smape:d",
    f"""SELECT CASE WHEN hour <= 8 THEN 'night' WHEN hour <= 16 THEN 'midday' ELSE 'evening' END AS bucket, count(*) AS n, avg({E}) AS mae, sqrt(avg({E} * {E})) AS rmse,
     1 - sum({E} * {E}) / nullif(var_pop(actual) * count(*), 0) AS r2, sum({E}) / sum(actual) * 100 AS wape, avg(2 * {E} / (abs(actual) + abs(predicted) + 1e-5)) * 100 AS smape FROM test GROUP BY 1""",
    "test",
)
def _(spark, sf_dir):
    return met.bucket_metrics(_part(spark, sf_dir, "test"))


sql_table("scored", "forecasts", "SELECT CASE WHEN actual > 1.5 THEN 1 ELSE 0 END AS label, baseline_blend / (1 + baseline_blend) AS score FROM forecasts")


@query(
    "classifier_scores",
    "auc:d accuracy:d f1:d precision:d recall:d",
    """SELECT (SELECT sum(CASE WHEN p.score > q.score THEN 1.0::DOUBLE WHEN p.score = q.score THEN 0.5 ELSE 0 END) / count(*) FROM scored p, scored q WHERE p.label = 1 AND q.label = 0) AS auc,
     (tp + tn) / (tp + tn + fp + fn) AS accuracy, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall
     FROM (SELECT count(*) FILTER (label = 1 AND score >= 0.6)::DOUBLE AS tp, count(*) FILTER (label = 0 AND score >= 0.6)::DOUBLE AS fp,
      count(*) FILTER (label = 1 AND score < 0.6)::DOUBLE AS fn, count(*) FILTER (label = 0 AND score < 0.6)::DOUBLE AS tn FROM scored)""",
    "scored",
)
def _(spark, sf_dir):
    scored = stored_forecasts(spark, sf_dir).select(
        (F.col("actual") > 1.5).cast("int").alias("label"), (F.col("baseline_blend") / (F.lit(1.0) + F.col("baseline_blend"))).alias("score")
    )
    return met.classifier_scores(scored, threshold=0.6)


sql_table("totals", "forecasts", "SELECT CAST(window_start AS DATE) AS date, hour, sum(actual) AS actual, sum(predicted) AS predicted FROM forecasts GROUP BY 1, 2")
sql_table("display", "totals", """SELECT date, hour, CAST(round_even(round(actual, 9), 0) AS BIGINT) AS actual, CAST(round_even(round(predicted, 9), 0) AS BIGINT) AS predicted,
 CASE WHEN sum(actual) OVER (PARTITION BY date) > 0 THEN CAST(round_even(round(abs(predicted - actual) / greatest(actual, 1) * 100, 9), 1) AS DOUBLE) END AS error_pct,
 sum(actual) OVER (PARTITION BY date) > 0 AS actual_available FROM totals""")


def _totals(spark, sf_dir):
    return met.hourly_totals(stored_forecasts(spark, sf_dir))


@query("hourly_totals", "date:D hour:i actual:d predicted:d", "SELECT * FROM totals", "totals")
def _(spark, sf_dir):
    return _totals(spark, sf_dir)


@query("hourly_display", "date:D hour:i actual:l predicted:l error_pct:d2 actual_available:b", "SELECT * FROM display", "display")
def _(spark, sf_dir):
    return met.hourly_display(_totals(spark, sf_dir))


@query(
    "day_summary",
    "date:D wape:d mape_avg_hourly:d smape_day:d mdape_hourly:d actual_available:b total_actual:l total_predicted:l",
    """SELECT date, CASE WHEN sum(actual) > 0 THEN CAST(round_even(round(sum(abs(predicted - actual)) / greatest(sum(actual), 1e-9) * 100, 9), 1) AS DOUBLE) END AS wape,
     CASE WHEN sum(actual) > 0 THEN CAST(round_even(round(avg(error_pct), 9), 1) AS DOUBLE) END AS mape_avg_hourly,
     CASE WHEN sum(actual) > 0 THEN CAST(round_even(round(avg(200.0 * abs(predicted - actual) / greatest(abs(actual) + abs(predicted), 1e-9)), 9), 1) AS DOUBLE) END AS smape_day,
     CAST(round_even(round(median(error_pct), 9), 1) AS DOUBLE) AS mdape_hourly, sum(actual) > 0 AS actual_available, sum(actual) AS total_actual, sum(predicted) AS total_predicted
     FROM display GROUP BY date""",
    "display",
)
def _(spark, sf_dir):
    return met.day_summary(met.hourly_display(_totals(spark, sf_dir)))


@query(
    "peak_hours",
    "date:D hour:i actual:d predicted:d error_pct:d is_peak:b",
    """SELECT date, hour, actual, predicted, abs(actual - predicted) / greatest(actual, 1) * 100 AS error_pct, actual >= cut AS is_peak
     FROM totals JOIN (SELECT date, quantile_cont(actual, 0.75) AS cut FROM totals GROUP BY 1) USING (date)""",
    "totals",
)
def _(spark, sf_dir):
    return met.peak_hours(_totals(spark, sf_dir))


@query(
    "compare_days",
    "total_1:d total_2:d difference:d difference_pct:d",
    """SELECT total_1, total_2, total_2 - total_1 AS difference, (total_2 - total_1) / greatest(total_1, 1) * 100 AS difference_pct FROM (SELECT coalesce(sum(actual) FILTER (date = DATE '2024-01-16'), 0) AS total_1,
     coalesce(sum(actual) FILTER (date = DATE '2024-01-15'), 0) AS total_2 FROM totals)""",
    "totals",
)
def _(spark, sf_dir):
    return met.compare_days(_totals(spark, sf_dir), "2024-01-16", "2024-01-15")


TOP_ZONES = 2


@query(
    "top_zones_of_day",
    "PULocationID:l hour:i actual:d predicted:d",
    f"""SELECT "PULocationID", hour, sum(actual) AS actual, sum(predicted) AS predicted FROM forecasts WHERE CAST(window_start AS DATE) = DATE '2024-01-16' AND "PULocationID" IN (
     SELECT "PULocationID" FROM forecasts WHERE CAST(window_start AS DATE) = DATE '2024-01-16' GROUP BY 1 ORDER BY sum(actual) DESC, 1 LIMIT {TOP_ZONES}) GROUP BY 1, 2""",
    "forecasts",
)
def _(spark, sf_dir):
    start, end = (F.lit(f"2024-01-{d} 00:00:00").cast("timestamp_ntz") for d in (16, 17))
    day = stored_forecasts(spark, sf_dir).filter((F.col("window_start") >= start) & (F.col("window_start") < end))
    busiest = day.groupBy("PULocationID").agg(F.sum("actual").alias("total")).orderBy(F.desc("total"), "PULocationID").limit(TOP_ZONES)
    series = day.join(busiest, on="PULocationID", how="left_semi")
    return series.groupBy("PULocationID", "hour").agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"))


COMPOSITE = """SELECT wape_all, wape_late, CASE WHEN total_late < 1e-6 THEN wape_all ELSE 0.42 * wape_all + 0.58 * wape_late END AS score FROM (
 SELECT sum(abs(actual - predicted)) / greatest(sum(actual), 1) * 100 AS wape_all, sum(abs(actual - predicted)) FILTER (hour >= 5) / greatest(sum(actual) FILTER (hour >= 5), 1) * 100 AS wape_late,
 sum(actual) FILTER (hour >= 5) AS total_late FROM val WHERE hour <= 9)"""


@query("composite_score", "wape_all:d wape_late:d score:d", COMPOSITE, "val")
def _(spark, sf_dir):
    return met.composite(_part(spark, sf_dir, "val").filter(F.col("hour") <= 9))


@query(
    "tiered_loss",
    "base:d one_sided:d loss:d",
    """SELECT *, base + one_sided AS loss FROM (SELECT avg(CASE WHEN abs(d) <= 1 THEN 0.5 * d * d ELSE abs(d) - 0.5 END * CASE WHEN actual > q3 THEN 6 WHEN actual < q1 THEN 2 ELSE 1 END
      * CASE WHEN hour <= 3 THEN 2.2 WHEN hour <= 8 THEN 1.8 WHEN hour >= 22 THEN 2.0 ELSE 1 END) AS base,
     0.45 * avg(CASE WHEN hour <= 8 AND d > 0 THEN d * d ELSE 0 END) + 0.15 * avg(CASE WHEN hour BETWEEN 17 AND 20 AND d > 0 THEN d * d ELSE 0 END)
     + 0.15 * avg(CASE WHEN hour >= 21 AND d > 0 THEN d * d ELSE 0 END) + 0.55 * avg(CASE WHEN hour >= 21 AND d < 0 THEN d * d ELSE 0 END) AS one_sided
     FROM (SELECT hour, actual, predicted - actual AS d FROM test), (SELECT quantile_cont(actual, 0.25) AS q1, quantile_cont(actual, 0.75) AS q3 FROM test))""",
    "test",
)
def _(spark, sf_dir):
    return met.tiered_loss(_part(spark, sf_dir, "test"))


@query(
    "bucket_loss",
    "point:d one_sided:d quantile:d loss:d",
    """SELECT *, point + 0.18 * quantile + one_sided AS loss FROM (SELECT avg(w * CASE WHEN abs(d) <= k THEN 0.5 * d * d ELSE k * (abs(d) - 0.5 * k) END) AS point,
     0.4 * avg(CASE WHEN hour <= 8 AND d > 0 THEN d * d ELSE 0 END) + 0.4 * avg(CASE WHEN hour >= 17 AND d < 0 THEN d * d ELSE 0 END) AS one_sided,
     (avg(w * greatest(0.1 * (actual - q10), -0.9 * (actual - q10))) + avg(w * greatest(0.9 * (actual - q90), -0.1 * (actual - q90)))) / 2 AS quantile
     FROM (SELECT hour, actual, predicted - actual AS d, 0.5 * predicted AS q10, 1.5 * predicted AS q90, CASE WHEN hour <= 8 THEN 3.2 WHEN hour >= 17 THEN 2.4 ELSE 1 END AS w,
      CASE WHEN hour <= 8 THEN 0.5 WHEN hour >= 17 THEN 0.7 ELSE 1 END AS k FROM test))""",
    "test",
)
def _(spark, sf_dir):
    rows = _part(spark, sf_dir, "test").withColumns({"q10": F.col("predicted") * 0.5, "q90": F.col("predicted") * 1.5})
    return met.bucket_loss(rows)


# Data quality.
DIST = """SELECT count(y) AS count, min(y) AS min, max(y) AS max, avg(y) AS mean, stddev_pop(y) AS std, quantile_cont(y, 0.5) AS p50, quantile_cont(y, 0.75) AS p75, quantile_cont(y, 0.9) AS p90,
 quantile_cont(y, 0.95) AS p95, quantile_cont(y, 0.99) AS p99, max(y) / (quantile_cont(y, 0.95) + 1e-9) AS spike_ratio, count(*) FILTER (y = 0) / count(y) * 100 AS zero_pct
 FROM (SELECT CAST(target_demand AS DOUBLE) AS y FROM gold)"""


@query("target_distribution", "count:l min:d max:d mean:d std:d p50:d p75:d p90:d p95:d p99:d spike_ratio:d zero_pct:d", DIST, "gold")
def _(spark, sf_dir):
    return quality.distribution(gold(spark, sf_dir))


CHECK_SPEC = "check:s status:s value:d threshold:d"


COLUMN_CHECKS = """SELECT 'required:' || c AS check, 'PASS' AS status, NULL AS value, NULL AS threshold FROM (VALUES ('target_demand'), ('window_start'), ('PULocationID')) AS t(c)
     UNION ALL SELECT 'feature:' || c, s, NULL, NULL FROM (VALUES ('lag_3h', 'WARN'), ('lag_24h', 'FAIL'), ('lag_168h', 'WARN'), ('rolling_avg_6h', 'WARN'), ('rolling_avg_24h', 'WARN'), ('hour_sin', 'FAIL'), ('hour_cos', 'FAIL'),
      ('dow_sin', 'FAIL'), ('dow_cos', 'FAIL'), ('month_sin', 'FAIL'), ('month_cos', 'FAIL'), ('is_holiday', 'WARN')) AS t(c, s)
     UNION ALL SELECT 'nulls:' || c, CASE WHEN p = 0 THEN 'PASS' WHEN p < 5 THEN 'WARN' ELSE 'FAIL' END, p, 5 FROM (
      SELECT 'lag_1h' AS c, 100.0 * (count(*) - count(lag_1h)) / count(*) AS p FROM gold UNION ALL SELECT 'lag_2h', 100.0 * (count(*) - count(lag_2h)) / count(*) FROM gold
      UNION ALL SELECT 'rolling_avg_3h', 100.0 * (count(*) - count(rolling_avg_3h)) / count(*) FROM gold UNION ALL SELECT 'is_weekend', 0 UNION ALL SELECT 'target_demand', 0)"""


@query("quality_columns", CHECK_SPEC, COLUMN_CHECKS, "gold")
def _(spark, sf_dir):
    return quality.column_checks(gold(spark, sf_dir))


DISTRIBUTION_CHECKS = f"""SELECT 'spike_ratio' AS check, CASE WHEN spike_ratio > 10 THEN 'WARN' ELSE 'PASS' END AS status, spike_ratio AS value, 10 AS threshold FROM ({DIST})
     UNION ALL SELECT 'zero_share', CASE WHEN zero_pct > 30 THEN 'WARN' ELSE 'PASS' END, zero_pct, 30 FROM ({DIST})"""


@query("quality_distribution", CHECK_SPEC, DISTRIBUTION_CHECKS, "gold")
def _(spark, sf_dir):
    return quality.distribution_checks(gold(spark, sf_dir))


sql_table("scaling", "gold bounds", f"""SELECT exp(l1) - 1 AS ceiling, max(target_demand) AS data_max, max((ln(target_demand + 1) - l0) / (l1 - l0)) AS scaled_max,
 avg(CASE WHEN (ln(target_demand + 1) - l0) / (l1 - l0) > 0.5 THEN 100.0 ELSE 0 END) AS pct_above_half, avg(CASE WHEN (target_demand - y0) / (y1 - y0) > 0.5 THEN 100.0 ELSE 0 END) AS pct_above_half_plain,
 quantile_cont((ln(target_demand + 1) - l0) / (l1 - l0), 0.9) AS suggested_threshold FROM gold, (SELECT min(ln(target_demand + 1)) AS l0, max(ln(target_demand + 1)) AS l1,
 CAST(min(target_demand) AS DOUBLE) AS y0, max(target_demand) AS y1 FROM (SELECT *, {SPLIT} AS split FROM gold) WHERE split = 'train') GROUP BY l0, l1""")


@query("scaling_stats", "ceiling:d data_max:d scaled_max:d pct_above_half:d pct_above_half_plain:d suggested_threshold:d", "SELECT * FROM scaling", "scaling")
def _(spark, sf_dir):
    return quality.scaling_stats(stored_gold(spark, sf_dir))


SCALING_CHECKS = """SELECT 'scaler_ceiling' AS check, CASE WHEN abs(ceiling - data_max) > data_max * 0.05 THEN 'WARN' ELSE 'PASS' END AS status, ceiling AS value, 0.05 AS threshold FROM scaling
     UNION ALL SELECT 'peak_threshold', CASE WHEN pct_above_half < 3 THEN 'FAIL' WHEN pct_above_half < 10 THEN 'WARN' ELSE 'PASS' END, pct_above_half, 3 FROM scaling
     UNION ALL SELECT 'log_helps', CASE WHEN pct_above_half > pct_above_half_plain THEN 'PASS' ELSE 'WARN' END, pct_above_half_plain, NULL FROM scaling"""


@query("quality_scaling", CHECK_SPEC, SCALING_CHECKS, "scaling")
def _(spark, sf_dir):
    return quality.scaling_checks(stored_gold(spark, sf_dir))


CORR = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CASE WHEN min({c}) < max({c}) THEN corr({c}, target_demand) END AS corr FROM base" for c in fixed.QUALITY_FEATURES
)


def _base(spark, sf_dir):
    return feat.base_features(gold(spark, sf_dir), calendar(spark))


@query("feature_correlations", "feature:s corr:d", CORR, "base")
def _(spark, sf_dir):
    return quality.correlations(_base(spark, sf_dir), fixed.QUALITY_FEATURES)


@query("feature_correlations_top", "feature:s corr:d", f"SELECT * FROM ({CORR}) ORDER BY abs(corr) DESC NULLS LAST, feature LIMIT 3", "base")
def _(spark, sf_dir):
    return quality.top_correlations(_base(spark, sf_dir), fixed.QUALITY_FEATURES)


LEAKAGE_CHECKS = f"""SELECT 'corr:' || feature AS check, CASE WHEN corr IS NULL THEN 'WARN' WHEN abs(corr) > 0.85 THEN 'FAIL' WHEN abs(corr) > 0.7 THEN 'WARN' ELSE 'PASS' END AS status, corr AS value, 0.85 AS threshold FROM ({CORR})
     UNION ALL SELECT 'lag_shift', CASE WHEN d < 1e-6 THEN 'FAIL' ELSE 'PASS' END, d, 1e-6 FROM (SELECT avg(abs(target_demand - nxt)) AS d FROM (SELECT target_demand, lead(lag_1h) OVER ({ZONE_ROWS}) AS nxt FROM base))"""


@query("quality_leakage", CHECK_SPEC, LEAKAGE_CHECKS, "base")
def _(spark, sf_dir):
    return quality.leakage_checks(materialize(_base(spark, sf_dir), "features"), fixed.QUALITY_FEATURES)


sql_table("splits", "gold bounds", f"""SELECT split, count(*) AS n, count(*) / any_value(total) * 100 AS pct, min(window_start) AS first, max(window_start) AS last, max(target_demand) AS max_target,
 avg(CASE WHEN target_demand > p90 THEN 100.0 ELSE 0 END) AS peak_pct FROM (SELECT *, {SPLIT} AS split FROM gold), (SELECT quantile_cont(target_demand, 0.9) AS p90, count(*)::DOUBLE AS total FROM gold) GROUP BY 1""")
sql_table("valid_seq", "gold bounds", f"""SELECT avg(CASE WHEN rn > 72 THEN 100.0 ELSE 0 END) AS valid_pct, count(*) AS train_rows FROM (SELECT {SPLIT} AS split, row_number() OVER ({ZONE_ROWS}) AS rn FROM gold) WHERE split = 'train'""")


@query("split_stats", "split:s n:l pct:d first:t last:t max_target:d peak_pct:d", "SELECT * FROM splits", "splits")
def _(spark, sf_dir):
    return quality.split_stats(stored_gold(spark, sf_dir))


@query("valid_sequence_share", "train_rows:l valid_pct:d", "SELECT * FROM valid_seq", "valid_seq")
def _(spark, sf_dir):
    return quality.valid_sequence_share(stored_gold(spark, sf_dir), 72)


SPLIT_CHECKS = """SELECT 'test_size' AS check, CASE WHEN n < 144 THEN 'FAIL' ELSE 'PASS' END AS status, n AS value, 144 AS threshold FROM splits WHERE split = 'test'
 UNION ALL SELECT 'test_peaks', CASE WHEN peak_pct < 5 THEN 'WARN' ELSE 'PASS' END, peak_pct, 5 FROM splits WHERE split = 'test'
 UNION ALL SELECT 'valid_sequences', CASE WHEN valid_pct < 50 THEN 'WARN' ELSE 'PASS' END, valid_pct, 50 FROM valid_seq"""


@query("quality_splits", CHECK_SPEC, SPLIT_CHECKS, "splits valid_seq")
def _(spark, sf_dir):
    return quality.split_checks(stored_gold(spark, sf_dir))


sql_table("gate", "test", f"""SELECT {METRICS}, (SELECT avg({E} / CASE WHEN actual = 0 THEN 1 ELSE actual END) * 100 FROM test WHERE actual > (SELECT quantile_cont(actual, 0.75) FROM test)) AS peak_mape FROM test""")
METRIC_CHECKS = """SELECT 'r2' AS check, CASE WHEN r2 < 0.9 THEN 'FAIL' ELSE 'PASS' END AS status, r2 AS value, 0.9 AS threshold FROM gate
 UNION ALL SELECT 'peak_mape', CASE WHEN peak_mape > 35 THEN 'FAIL' WHEN peak_mape > 20 THEN 'WARN' ELSE 'PASS' END, peak_mape, 35 FROM gate
 UNION ALL SELECT 'rmse_mae', CASE WHEN rmse / (mae + 1e-9) > 5 THEN 'WARN' ELSE 'PASS' END, rmse / (mae + 1e-9), 5 FROM gate"""


def _metric_row(spark, sf_dir):
    test = _part(spark, sf_dir, "test")
    return met.evaluate(test).withColumn("peak_mape", met.peak_mape(test).select("peak_mape").scalar())


@query("quality_metrics", CHECK_SPEC, METRIC_CHECKS, "gate")
def _(spark, sf_dir):
    return quality.metric_checks(_metric_row(spark, sf_dir))


ALL_CHECKS = [COLUMN_CHECKS, DISTRIBUTION_CHECKS, SCALING_CHECKS, LEAKAGE_CHECKS, SPLIT_CHECKS, METRIC_CHECKS]


@query(
    "quality_summary",
    "pass:l warn:l fail:l",
    f"""SELECT count(*) FILTER (status = 'PASS') AS pass, count(*) FILTER (status = 'WARN') AS warn, count(*) FILTER (status = 'FAIL') AS fail FROM (
     {' UNION ALL '.join(f"SELECT CAST(status AS VARCHAR) AS status FROM ({c})" for c in ALL_CHECKS)})""",
    "gold base scaling splits valid_seq gate",
)
def _(spark, sf_dir):
    source = stored_gold(spark, sf_dir)
    features = shared(spark, sf_dir, "base-features", lambda: feat.base_features(source, calendar(spark)))
    parts = [
        quality.column_checks(source), quality.distribution_checks(source), quality.scaling_checks(source),
        quality.leakage_checks(features, fixed.QUALITY_FEATURES), quality.split_checks(source), quality.metric_checks(_metric_row(spark, sf_dir)),
    ]
    return quality.summary(quality.report(parts))


def _histogram(expression: str, source: str, bins: int = 80) -> str:
    return f"""SELECT least(floor((x - lo) * {bins} / nullif(hi - lo, 0)), {bins - 1}) AS bin, count(*) AS n, min(x) AS low, max(x) AS high
     FROM (SELECT {expression} AS x FROM {source}), (SELECT min({expression}) AS lo, max({expression}) AS hi FROM {source}) GROUP BY 1"""


@query("histogram_of_values", "bin:i n:l low:d high:d", _histogram("value", "events"))
def _(spark, sf_dir):
    return quality.histogram(table(spark, sf_dir, "events"), "value")


@query("histogram_of_log_target", "bin:i n:l low:d high:d", _histogram("ln(target_demand + 1)", "gold"), "gold")
def _(spark, sf_dir):
    return quality.histogram(stored_gold(spark, sf_dir), "target_demand", transform=F.log1p)


@query(
    "cdf_of_values",
    "value:d n:l cdf:d",
    "SELECT value, n, sum(n) OVER (ORDER BY value) / (SELECT count(value)::DOUBLE FROM events) AS cdf FROM (SELECT value, count(*) AS n FROM events GROUP BY 1)",
)
def _(spark, sf_dir):
    return quality.cdf(table(spark, sf_dir, "events"), "value")


@query(
    "exact_quantiles_by_type",
    "event_type:s n:l q05:d median:d q99:d",
    "SELECT event_type, count(*) AS n, quantile_cont(value, 0.05) AS q05, median(value) AS median, quantile_cont(value, 0.99) AS q99 FROM events GROUP BY 1",
)
def _(spark, sf_dir):
    return exact_quantiles(table(spark, sf_dir, "events"), "value", {"q05": 0.05, "median": 0.5, "q99": 0.99}, ["event_type"])
