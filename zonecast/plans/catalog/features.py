"""Feature tables, window functions and model preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonecast import rules as fixed
from zonecast.operators import features as feat, prep
from zonecast.plans.adapters import calendar
from zonecast.plans.catalog.base import SPLIT, ZONE_ROWS, base_sql, query, sql_table
from zonecast.plans.tables import gold, main_table, specialist_table, stored_gold

INTS = {"PULocationID": "l", "hour": "i", "day_of_week": "i", "month": "i", "is_weekend": "i", "is_holiday": "i"}


def _spec(columns, extra: str = "") -> str:
    return " ".join(f"{c}:{INTS.get(c, 'd')}" for c in columns) + " " + extra


def _flag_sql(bounds) -> str:
    return ", ".join(f"CASE WHEN hour BETWEEN {lo} AND {hi} THEN 1 ELSE 0 END AS {n}" for n, (lo, hi) in bounds.items())


BASE_COLUMNS = list(fixed.MAIN_FEATURES[:19])

sql_table("main_flags", "main_means", f"""SELECT *, lag_1h - lag_2h AS g1, lag_2h - lag_3h AS g2, lag_1h - lag_3h AS g3, lag_24h - lag_168h AS gd,
 {_flag_sql(fixed.HOUR_FLAGS)} FROM main_means""")
sql_table("main_features", "main_flags", """SELECT *, least(lag_1h / (lag_24h + 1), 10) AS lag_ratio_1h_24h, least(lag_3h / (lag_24h + 1), 10) AS lag_ratio_3h_24h,
 least(rolling_avg_3h / (rolling_avg_24h + 1), 10) AS rolling_ratio_3h_24h, lag_1h - lag_24h AS lag_diff_1h_24h,
 g1 AS prev_1h_growth, g2 AS prev_2h_growth, g3 AS prev_3h_growth, gd AS prev_day_growth_24_168,
 is_ramp_up_05_08 * (0.55 * g1 + 0.25 * g2 + 0.20 * gd) AS ramp_momentum,
 (is_post_midnight + is_late_drop_23) * (lag_1h - rolling_avg_24h) AS night_decay_signal,
 g1 AS growth_1h, g2 AS growth_2h, g3 AS growth_3h, lag_1h - rolling_avg_6h AS growth_6h, lag_1h - lag_24h AS growth_24h, lag_1h - lag_168h AS growth_168h,
 g1 - g2 AS acceleration_1h, g3 - gd AS acceleration_3h,
 is_ramp_up_05_08 * (0.5 * g1 + 0.3 * (g1 - g2) + 0.2 * (lag_1h - lag_24h)) AS ramp_growth_signal,
 (is_morning_peak + is_evening_peak) * (0.6 * g1 + 0.25 * g3 + 0.15 * (lag_1h - lag_168h)) AS peak_growth_signal,
 (is_late_night + is_late_drop_23) * (lag_1h - zone_hour_mean) AS night_over_signal FROM main_flags""")


@query("features_base", _spec(BASE_COLUMNS, "window_start:t dow_sun1:i"), "SELECT * FROM base", "base")
def _(spark, sf_dir):
    return feat.base_features(gold(spark, sf_dir), calendar(spark))


sql_table("base_target", "gold holidays", base_sql("target_demand"))


@query(
    "features_lags_of_target",
    "PULocationID:l window_start:t lag_1h:d lag_2h:d lag_3h:d lag_24h:d lag_168h:d rolling_avg_3h:d rolling_avg_6h:d rolling_avg_24h:d",
    "SELECT * FROM base_target",
    "base_target",
)
def _(spark, sf_dir):
    return feat.add_lags(gold(spark, sf_dir), basis="target_demand")


@query("features_main", _spec(fixed.MAIN_FEATURES, "window_start:t target_demand:l split:s"), f"SELECT *, {SPLIT} AS split FROM main_features", "main_features bounds")
def _(spark, sf_dir):
    table = main_table(spark, sf_dir)
    return feat.project(table, fixed.MAIN_FEATURES, keep=["window_start", "target_demand", "split"])


sql_table("gaps", "special", """SELECT *, (lag_1h + 1) / (lag_24h + 1) AS lag_ratio_1h_24h, lag_1h - lag_24h AS lag_diff_1h_24h,
 (rolling_avg_3h + 1) / (rolling_avg_24h + 1) AS rolling_ratio_3h_24h, lag_1h - lag_2h AS momentum_1h_2h, lag_1h - lag_3h AS momentum_1h_3h,
 lag_1h - baseline_blend AS baseline_gap_1h, lag_24h - baseline_blend AS baseline_gap_24h,
 (lag_1h + 1) / (baseline_blend + 1) AS baseline_ratio_1h, (lag_24h + 1) / (baseline_blend + 1) AS baseline_ratio_24h FROM special""")
LOW_SQL = f"""SELECT *, hour AS night_order, {', '.join(f'CASE WHEN hour = {h} THEN 1 ELSE 0 END AS is_{h:02d}' for h in range(10))},
 CASE WHEN hour <= 2 THEN 1 ELSE 0 END AS is_deep_night, CASE WHEN hour IN (3, 4) THEN 1 ELSE 0 END AS is_pre_ramp, CASE WHEN hour >= 5 THEN 1 ELSE 0 END AS is_morning_ramp,
 CASE WHEN hour IN (3, 4) THEN 1 ELSE 0 END AS is_ramp_low, least(greatest((hour - 2.0) / 2.0, 0), 1) AS ramp_strength, least(greatest((hour - 2.0) / 7.0, 0), 1) AS morning_ramp_strength,
 CASE WHEN hour IN (3, 4) THEN baseline_gap_1h ELSE 0 END AS pre_ramp_gap, CASE WHEN hour >= 5 THEN baseline_gap_1h ELSE 0 END AS morning_gap_1h,
 baseline_blend * least(greatest((hour - 2.0) / 2.0, 0), 1) AS ramp_baseline_signal FROM gaps WHERE hour <= 9"""
EVENING_SQL = f"""SELECT *, hour - 17 AS evening_slot, {', '.join(f'CASE WHEN hour = {h} THEN 1 ELSE 0 END AS is_h{h}' for h in range(17, 24))},
 CASE WHEN hour <= 19 THEN 1 ELSE 0 END AS is_evening_segment_early, CASE WHEN hour >= 21 THEN 1 ELSE 0 END AS is_evening_segment_late, (23.0 - hour) / 6.0 AS evening_decay,
 CASE WHEN hour >= 21 THEN baseline_gap_1h ELSE 0 END AS evening_baseline_gap, greatest(lag_2h - lag_1h, 0) AS decline_2h_to_1h,
 greatest(lag_2h - lag_1h, 0) / (lag_2h + 1) AS decline_ratio_2h_to_1h, CASE WHEN hour >= 21 THEN greatest(lag_2h - lag_1h, 0) / (lag_2h + 1) ELSE 0 END AS late_decline_signal
 FROM gaps WHERE hour >= 17"""


@query("features_low_hour", _spec(fixed.LOW_HOUR_FEATURES, "window_start:t"), LOW_SQL, "gaps")
def _(spark, sf_dir):
    return feat.project(specialist_table(spark, sf_dir, "low_hour"), fixed.LOW_HOUR_FEATURES, keep=["window_start"])


@query("features_evening", _spec(fixed.EVENING_FEATURES, "window_start:t"), EVENING_SQL, "gaps")
def _(spark, sf_dir):
    return feat.project(specialist_table(spark, sf_dir, "evening"), fixed.EVENING_FEATURES, keep=["window_start"])


@query(
    "features_serving_flags",
    "PULocationID:l window_start:t " + " ".join(f"{n}:i" for n in fixed.SERVING_HOUR_FLAGS) + " is_peak:i rolling_mean_3h:d momentum_3h_24h:d",
    f"""SELECT *, greatest(is_morning_peak, is_evening_peak) AS is_peak, rolling_avg_3h AS rolling_mean_3h, rolling_avg_3h - rolling_avg_24h AS momentum_3h_24h
     FROM (SELECT "PULocationID", window_start, rolling_avg_3h, rolling_avg_24h, {_flag_sql(fixed.SERVING_HOUR_FLAGS)} FROM base)""",
    "base",
)
def _(spark, sf_dir):
    return feat.add_aliases(feat.serving_flags(feat.base_features(gold(spark, sf_dir), calendar(spark))))


@query(
    "features_extras",
    "PULocationID:l window_start:t rolling_max_3h:d rolling_max_6h:d demand_pct_ch1h:d ewm_alpha03:d",
    f"""SELECT a."PULocationID", a.window_start, any_value(m3) AS rolling_max_3h, any_value(m6) AS rolling_max_6h, any_value((lag_1h - lag_2h) / (lag_2h + 1)) AS demand_pct_ch1h,
     coalesce(sum(b.trip_count * pow(0.7, a.rn - b.rn - 1)) / sum(pow(0.7, a.rn - b.rn - 1)), 0) AS ewm_alpha03
     FROM (SELECT *, row_number() OVER (w) AS rn, coalesce(max(trip_count) OVER ({ZONE_ROWS} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) AS m3,
      coalesce(max(trip_count) OVER ({ZONE_ROWS} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), 0) AS m6 FROM base WINDOW w AS ({ZONE_ROWS})) a
     LEFT JOIN (SELECT "PULocationID", trip_count, row_number() OVER ({ZONE_ROWS}) AS rn FROM base) b
      ON a."PULocationID" = b."PULocationID" AND b.rn < a.rn GROUP BY 1, 2""",
    "base",
)
def _(spark, sf_dir):
    return feat.add_extras(feat.add_lags(gold(spark, sf_dir)))


SLOW = 0.001


@query(
    "ewm_slow",
    "PULocationID:l window_start:t ewm:d",
    f"""SELECT a."PULocationID", a.window_start, coalesce(sum(b.trip_count * pow(1 - {SLOW}, a.rn - b.rn - 1)) / sum(pow(1 - {SLOW}, a.rn - b.rn - 1)), 0) AS ewm
     FROM (SELECT "PULocationID", window_start, row_number() OVER ({ZONE_ROWS}) AS rn FROM gold) a LEFT JOIN (SELECT "PULocationID", trip_count, row_number() OVER ({ZONE_ROWS}) AS rn FROM gold) b
      ON a."PULocationID" = b."PULocationID" AND b.rn < a.rn GROUP BY 1, 2""",
    "gold",
)
def _(spark, sf_dir):
    """A mean that falls so slowly that each row weighs 40 thousand rows before it."""
    return feat.add_ewm(gold(spark, sf_dir), "ewm", alpha=SLOW)


@query(
    "sequence_samples",
    "PULocationID:l window_start:t hour:i day_of_week:i len_short:i len_long:i sum_short:d sum_long:d first_long:d last_short:d",
    f"""SELECT * FROM (SELECT "PULocationID", window_start, hour, day_of_week, 72 AS len_short, 168 AS len_long, sum(trip_count) OVER ({ZONE_ROWS} ROWS BETWEEN 72 PRECEDING AND 1 PRECEDING) AS sum_short,
     sum(trip_count) OVER ({ZONE_ROWS} ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS sum_long, lag(trip_count, 168) OVER w AS first_long, lag(trip_count, 1) OVER w AS last_short,
     lag(window_start, 168) OVER w AS t0 FROM base WINDOW w AS ({ZONE_ROWS})) WHERE t0 = window_start - INTERVAL 168 HOUR""",
    "base",
)
def _(spark, sf_dir):
    base = feat.base_features(gold(spark, sf_dir), calendar(spark))
    seq = feat.sequences(base, ["trip_count", "hour_sin"], {"short": 72, "long": 168}, keep=["hour", "day_of_week"])
    total = lambda name: F.aggregate(F.transform(name, lambda e: e["trip_count"]), F.lit(0.0), lambda a, x: a + x)
    return seq.select(
        "PULocationID", "window_start", "hour", "day_of_week", F.size("short").alias("len_short"), F.size("long").alias("len_long"),
        total("short").alias("sum_short"), total("long").alias("sum_long"),
        F.element_at("long", 1)["trip_count"].alias("first_long"), F.element_at("short", -1)["trip_count"].alias("last_short"),
    )


@query(
    "lag_shift_check",
    "mean_diff:d",
    f"SELECT avg(abs(target_demand - nxt)) AS mean_diff FROM (SELECT target_demand, lead(lag_1h) OVER ({ZONE_ROWS}) AS nxt FROM base)",
    "base",
)
def _(spark, sf_dir):
    return feat.lag_shift_check(feat.add_lags(gold(spark, sf_dir)))


@query(
    "time_split",
    "split:s n:l first:t last:t",
    f"SELECT split, count(*) AS n, min(window_start) AS first, max(window_start) AS last FROM (SELECT window_start, {SPLIT} AS split FROM gold) GROUP BY 1",
    "gold bounds",
)
def _(spark, sf_dir):
    return prep.add_split(stored_gold(spark, sf_dir)).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min("window_start").alias("first"), F.max("window_start").alias("last")
    )


sql_table("train_rows", "gold bounds", f"SELECT * FROM (SELECT *, {SPLIT} AS split FROM gold) WHERE split = 'train'")


@query(
    "scaled_target",
    "PULocationID:l window_start:t log_minmax:d log_standard:d minmax:d back:d",
    """SELECT "PULocationID", window_start, (ln(target_demand + 1) - l0) / (l1 - l0) AS log_minmax, (ln(target_demand + 1) - lm) / ls AS log_standard,
     (target_demand - y0) / (y1 - y0) AS minmax, target_demand AS back FROM gold, (SELECT min(ln(target_demand + 1)) AS l0, max(ln(target_demand + 1)) AS l1,
     avg(ln(target_demand + 1)) AS lm, stddev_pop(ln(target_demand + 1)) AS ls, CAST(min(target_demand) AS DOUBLE) AS y0, max(target_demand) AS y1 FROM train_rows)""",
    "gold train_rows",
)
def _(spark, sf_dir):
    source = stored_gold(spark, sf_dir)
    train = prep.add_split(source).filter(F.col("split") == "train")
    y, s = F.col("target_demand").cast("double"), F.col("s")
    scaled = source.withColumn("s", prep.target_scaler(train).scalar())
    return scaled.withColumns(
        {
            "log_minmax": prep.log_minmax(y, s), "log_standard": prep.log_standard(y, s), "minmax": prep.minmax(y, s),
            "back": prep.log_minmax_inverse(prep.log_minmax(y, s), s),
        }
    )


@query(
    "standardized_features",
    "PULocationID:l window_start:t trip_count:d rolling_avg_3h:d",
    """SELECT "PULocationID", window_start, (trip_count - m1) / s1 AS trip_count, (rolling_avg_3h - m2) / s2 AS rolling_avg_3h FROM gold,
     (SELECT avg(trip_count) AS m1, stddev_pop(trip_count) AS s1, avg(rolling_avg_3h) AS m2, stddev_pop(rolling_avg_3h) AS s2 FROM train_rows)""",
    "gold train_rows",
)
def _(spark, sf_dir):
    source = stored_gold(spark, sf_dir)
    train = prep.add_split(source).filter(F.col("split") == "train")
    return prep.standardize(source, train, ["trip_count", "rolling_avg_3h"])


@query(
    "sample_weights",
    "PULocationID:l window_start:t weight:d",
    """SELECT "PULocationID", window_start, w / avg(w) OVER () AS weight FROM (SELECT *, least(greatest(b * CASE WHEN y <= p10 THEN 1.25 ELSE 1 END * CASE WHEN y >= p75 THEN 4 ELSE 1 END * CASE WHEN y >= p90 THEN 1.1 ELSE 1 END
      * CASE WHEN hour <= 4 THEN 4 ELSE 1 END * CASE WHEN hour BETWEEN 5 AND 8 THEN 3.5 ELSE 1 END * CASE WHEN hour BETWEEN 7 AND 10 THEN 1.35 ELSE 1 END
      * CASE WHEN hour BETWEEN 16 AND 19 THEN 1.25 ELSE 1 END * CASE WHEN hour = 23 THEN 2.25 ELSE 1 END * CASE WHEN hour >= 20 THEN 2.5 ELSE 1 END, 0.5), 20) AS w
     FROM (SELECT *, CAST(target_demand AS DOUBLE) AS y, least(greatest(sqrt((p25 + 1) / (target_demand + 1)), 1), 3) AS b FROM train_rows, (SELECT quantile_cont(target_demand, 0.1) AS p10, quantile_cont(target_demand, 0.25) AS p25,
      quantile_cont(target_demand, 0.75) AS p75, quantile_cont(target_demand, 0.9) AS p90 FROM train_rows)))""",
    "train_rows",
)
def _(spark, sf_dir):
    train = prep.add_split(stored_gold(spark, sf_dir)).filter(F.col("split") == "train")
    return prep.add_sample_weights(train)


@query(
    "specialist_weights",
    "PULocationID:l window_start:t w_class:d w_intensity:d w_evening:d w_residual:d",
    """SELECT "PULocationID", window_start, CASE WHEN hour >= 5 THEN 1.45 WHEN hour IN (3, 4) THEN 1.12 ELSE 1 END AS w_class,
     CASE WHEN hour >= 5 THEN 1.55 WHEN hour IN (3, 4) THEN 1.15 ELSE 1 END * CASE WHEN target_demand > 0 THEN least(greatest(target_demand / 5, 0.85), 2.2) ELSE 1 END AS w_intensity,
     CASE WHEN hour >= 21 THEN 1.15 ELSE 1 END * CASE WHEN hour >= 22 THEN 1.1 ELSE 1 END * CASE WHEN hour >= 21 AND day_of_week >= 5 THEN 1.15 ELSE 1 END * CASE WHEN hour >= 21 AND day_of_week = 6 THEN 1.2 ELSE 1 END AS w_evening,
     least(greatest(target_demand / 8, 0.8), 3) AS w_residual FROM base""",
    "base",
)
def _(spark, sf_dir):
    rows = feat.add_calendar(gold(spark, sf_dir))
    weighted = prep.evening_weights(prep.low_hour_weights(rows)).withColumnRenamed("weight", "w_evening")
    return prep.residual_weights(weighted).withColumnRenamed("weight", "w_residual")


RESAMPLE = """
WITH rated AS (SELECT hour, CASE WHEN hour IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 21, 22, 23) THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
 CAST('0x' || substr(md5('42|' || "PULocationID" || '|' || strftime(window_start, '%Y-%m-%d %H:%M:%S') || '|1'), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496::DOUBLE AS u FROM gold),
drawn AS (SELECT hour, (SELECT count(*) FROM (SELECT sum(exp(-r + j * ln(r) - lgamma(j + 1))) OVER (ORDER BY j) AS c FROM (SELECT unnest(range(0, 60)) AS j)) WHERE c <= u) AS k
 FROM (SELECT hour, u, w / (SELECT avg(w) FROM rated) AS r FROM rated))
SELECT hour IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 21, 22, 23) AS critical, CAST(sum(k) AS BIGINT) AS n FROM drawn GROUP BY 1"""


@query("critical_resample", "critical:b n:l", f"SELECT * FROM ({RESAMPLE})", "gold")
def _(spark, sf_dir):
    drawn = prep.critical_resample(stored_gold(spark, sf_dir))
    return drawn.groupBy(F.col("hour").isin(fixed.CRITICAL_HOURS).alias("critical")).agg(F.count(F.lit(1)).alias("n"))
