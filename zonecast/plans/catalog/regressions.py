"""Regressions fitted by sums, and the recursive forecast of a model. SQL solves the same systems by determinants."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonecast.operators import demand as dem, forecast, postprocess as post, prep, regression as reg
from zonecast.plans.adapters import calendar
from zonecast.plans.catalog.base import SPLIT, query, sql_table
from zonecast.plans.catalog.demand import DAY
from zonecast.plans.tables import hourly, main_table, shared
from zonecast.session import materialize

FEATURES = ["rolling_avg_24h", "zone_hour_mean"]
FULL = ["lag_1h", "lag_2h", "lag_3h", "lag_24h", "lag_168h", "rolling_avg_3h", "rolling_avg_6h", "rolling_avg_24h", "zone_hour_mean", "zone_dow_hour_mean",
        "hour_sin", "hour_cos", "is_weekend", "is_holiday"]


def solved(a: list[str], g: list[str]) -> list[str]:
    """Cramer's rule: a = entries 00, 01, 02, 11, 12, 22 of a symmetric matrix."""
    m = [[a[0], a[1], a[2]], [a[1], a[3], a[4]], [a[2], a[4], a[5]]]
    det = lambda x: " + ".join(f"({x[0][i]}) * (({x[1][(i + 1) % 3]}) * ({x[2][(i + 2) % 3]}) - ({x[1][(i + 2) % 3]}) * ({x[2][(i + 1) % 3]}))" for i in range(3))
    return [f"({det([[g[r] if c == k else m[r][c] for c in range(3)] for r in range(3)])}) / ({det(m)})" for k in range(3)]


def _main(spark, sf_dir):
    return shared(spark, sf_dir, "main-features", lambda: main_table(spark, sf_dir))


def _part(spark, sf_dir, split):
    return _main(spark, sf_dir).filter(F.col("split") == split)


# -- Huber ----------------------------------------------------------------------------------------------------------------

X = [f"x{i}" for i in range(3)]
PAIRS = [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)]
sql_table("train_x", "main_features bounds", f"""SELECT CAST(1 AS DOUBLE) AS x0, {", ".join(f"{c} AS x{i}" for i, c in enumerate(FEATURES, 1))},
 CAST(target_demand AS DOUBLE) AS y, {SPLIT} AS split, "PULocationID", window_start, hour FROM main_features""")
WEIGHTED = ", ".join(f"sum(a * x{i} * x{j}) AS s{i}{j}" for i, j in PAIRS) + ", " + ", ".join(f"sum(a * y * {x}) AS g{i}" for i, x in enumerate(X))
SUMS, RIGHT = [f"s{i}{j}" for i, j in PAIRS], ["g0", "g1", "g2"]
DELTA = 0.02
HUBER_SQL = f"""(WITH RECURSIVE scale AS (SELECT min(ln(1 + y)) AS lo, max(ln(1 + y)) AS hi FROM train_x WHERE split = 'train'),
 rows AS (SELECT x0, x1, x2, (ln(1 + y) - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END AS y FROM train_x, scale WHERE split = 'train'),
 it AS (SELECT 0 AS k, {", ".join(f"{e} AS b{i}" for i, e in enumerate(solved(SUMS, RIGHT)))} FROM (SELECT {WEIGHTED} FROM (SELECT *, 1.0::DOUBLE AS a FROM rows))
  UNION ALL SELECT k + 1, {", ".join(solved(SUMS, RIGHT))} FROM (SELECT k, {WEIGHTED} FROM (SELECT r.*, k, least(1, {DELTA} / greatest(abs(y - b0 - b1 * x1 - b2 * x2), 1e-300)) AS a
   FROM it, rows r WHERE k < 60) GROUP BY k))
 SELECT * FROM it WHERE k = 60)"""


@query(
    "huber_coefficients",
    "name:s coefficient:d4",
    f"SELECT unnest(['intercept', '{FEATURES[0]}', '{FEATURES[1]}']) AS name, unnest([b0, b1, b2]) AS coefficient FROM {HUBER_SQL}",
    "train_x",
)
def _(spark, sf_dir):
    """Huber loss on the log target scaled to [0, 1], with a threshold that many rows exceed."""
    model = reg.fit_robust_main(_part(spark, sf_dir, "train"), FEATURES, weight=None, delta=DELTA, steps=100).model
    return spark.createDataFrame([("intercept", model.intercept), *model.coefficients.items()], "name string, coefficient double")


@query("robust_main_figures", "split:s n:l actual:d4 predicted:d4 mae:d4 baseline_mae:d4")
def _(spark, sf_dir):
    """Weighted Huber regression on the features of the main model: totals and errors by split."""
    model = reg.fit_robust_main(prep.add_sample_weights(_part(spark, sf_dir, "train")), FULL)
    y = F.col("target_demand").cast("double")
    rows = model.predict(_main(spark, sf_dir))
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("actual"), F.sum("predicted").alias("predicted"), F.avg(F.abs(y - F.col("predicted"))).alias("mae"),
        F.avg(F.abs(y - F.col("zone_hour_mean"))).alias("baseline_mae"),
    )


# -- Quantile ----------------------------------------------------------------------------------------------------------

ALPHA = 0.45
HOURS = list(range(18, 24))


def _evening(spark, sf_dir, split):
    rows = _part(spark, sf_dir, split).filter(F.col("hour") >= 17)
    return rows.withColumns({f"is_h{h}": (F.col("hour") == h).cast("int") for h in HOURS})


@query(
    "quantile_of_hours",
    "hour:i quantile:d2",
    f"SELECT hour, quantile_disc(y, {ALPHA}) AS quantile FROM train_x WHERE split = 'train' AND hour >= 17 GROUP BY 1",
    "train_x",
)
def _(spark, sf_dir):
    """With a flag for each hour the regression is the quantile of each hour's rows."""
    model = reg.quantile(_evening(spark, sf_dir, "train"), [f"is_h{h}" for h in HOURS], "target_demand", ALPHA)
    rows = [(h, model.intercept + model.coefficients.get(f"is_h{h}", 0.0)) for h in [17, *HOURS]]
    hours = _evening(spark, sf_dir, "train").select("hour").distinct()
    return spark.createDataFrame(rows, "hour int, quantile double").join(hours, "hour", "left_semi")


@query("quantile_pair_losses", "split:s n:l regression:d4 table:d4 mean:d4")
def _(spark, sf_dir):
    """Mean pinball loss of the regression, of the quantile table by zone, weekday and hour, and of the zone's mean."""
    from zonecast.operators import models

    train = _evening(spark, sf_dir, "train")
    model = reg.quantile(train, FULL, "target_demand", ALPHA)
    rows = materialize(_evening(spark, sf_dir, "val").unionByName(_evening(spark, sf_dir, "test")), "evening")
    scored = models.with_quantile(model.predict(rows), models.quantile_head(train))
    y = F.col("target_demand").cast("double")
    loss = lambda c: F.avg(reg.pinball(y, F.col(c), ALPHA))
    return scored.groupBy("split").agg(F.count(F.lit(1)).alias("n"), loss("predicted").alias("regression"), loss("pred_quantile").alias("table"), loss("zone_hour_mean").alias("mean"))


# -- Ordinal ---------------------------------------------------------------------------------------------------------------

#: Shares of the training rows below the two bounds of the demand buckets, which lie at least one apart.
SHARES = (0.35, 0.65)
sql_table("bucket_bounds", "train_x", f"SELECT lo, greatest(hi, lo + 1) AS hi FROM (SELECT quantile_disc(y, {SHARES[0]}) AS lo, quantile_disc(y, {SHARES[1]}) AS hi FROM train_x WHERE split = 'train' AND hour >= 17)")
H = "1 / (1 + exp(b2 * x - {}))"
ORDINAL_SQL = f"""(WITH RECURSIVE rows AS (SELECT x2 AS x, CASE WHEN y > hi THEN 2 WHEN y > lo THEN 1 ELSE 0 END AS k FROM train_x, bucket_bounds WHERE split = 'train' AND hour >= 17),
 cells AS (SELECT x, k, CAST(count(*) AS DOUBLE) AS w FROM rows GROUP BY 1, 2),
 it AS (SELECT 0 AS n, ln(c0 / (1 - c0)) AS b0, ln(c1 / (1 - c1)) AS b1, CAST(0 AS DOUBLE) AS b2 FROM (SELECT sum(CASE WHEN k = 0 THEN w END) / sum(w) AS c0, sum(CASE WHEN k <= 1 THEN w END) / sum(w) AS c1 FROM cells)
  UNION ALL SELECT n + 1, b0 + ({solved(["-h00", "-h01", "-h02", "-h11", "-h12", "-h22"], RIGHT)[0]}), b1 + ({solved(["-h00", "-h01", "-h02", "-h11", "-h12", "-h22"], RIGHT)[1]}),
   b2 + ({solved(["-h00", "-h01", "-h02", "-h11", "-h12", "-h22"], RIGHT)[2]}) FROM (
   SELECT n, any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2, sum(w * d0) AS g0, sum(w * d1) AS g1, sum(w * d2) AS g2,
    sum(w * (q00 - d0 * d0)) AS h00, sum(w * (q01 - d0 * d1)) AS h01, sum(w * (q02 - d0 * d2)) AS h02, sum(w * (q11 - d1 * d1)) AS h11, sum(w * (q12 - d1 * d2)) AS h12, sum(w * (q22 - d2 * d2)) AS h22
   FROM (SELECT *, CASE k WHEN 0 THEN f0 WHEN 1 THEN -f0 ELSE 0 END / p AS d0, CASE k WHEN 1 THEN f1 WHEN 2 THEN -f1 ELSE 0 END / p AS d1,
     -x * CASE k WHEN 0 THEN f0 WHEN 1 THEN f1 - f0 ELSE -f1 END / p AS d2,
     CASE k WHEN 0 THEN e0 WHEN 1 THEN -e0 ELSE 0 END / p AS q00, 0 AS q01, -x * CASE k WHEN 0 THEN e0 WHEN 1 THEN -e0 ELSE 0 END / p AS q02,
     CASE k WHEN 1 THEN e1 WHEN 2 THEN -e1 ELSE 0 END / p AS q11, -x * CASE k WHEN 1 THEN e1 WHEN 2 THEN -e1 ELSE 0 END / p AS q12,
     x * x * CASE k WHEN 0 THEN e0 WHEN 1 THEN e1 - e0 ELSE -e1 END / p AS q22
    FROM (SELECT *, c0 * (1 - c0) AS f0, c1 * (1 - c1) AS f1, c0 * (1 - c0) * (1 - 2 * c0) AS e0, c1 * (1 - c1) * (1 - 2 * c1) AS e1, CASE k WHEN 0 THEN c0 WHEN 1 THEN c1 - c0 ELSE 1 - c1 END AS p
     FROM (SELECT n, b0, b1, b2, x, k, w, {H.format("b0")} AS c0, {H.format("b1")} AS c1 FROM it, cells WHERE n < 25))) GROUP BY n))
 SELECT b0, b1, b2 FROM it WHERE n = 25)"""


def _buckets(spark, sf_dir):
    train = _evening(spark, sf_dir, "train")
    low, high = train.agg(*[F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY CAST(target_demand AS DOUBLE))") for q in SHARES]).first()
    bounds = [low, max(high, low + 1.0)]
    return train, bounds, reg.ordinal(train, FEATURES[1:], reg.bucket_of(F.col("target_demand"), bounds), len(bounds) + 1)


@query(
    "bucket_thresholds",
    "name:s value:d4",
    f"SELECT unnest(['threshold_0', 'threshold_1', '{FEATURES[1]}']) AS name, unnest([b0, b1, b2]) AS value FROM {ORDINAL_SQL}",
    "bucket_bounds",
)
def _(spark, sf_dir):
    _, _, model = _buckets(spark, sf_dir)
    rows = [(f"threshold_{i}", t) for i, t in enumerate(model.thresholds)] + list(model.coefficients.items())
    return spark.createDataFrame(rows, "name string, value double")


@query(
    "bucket_predictions",
    "PULocationID:l window_start:t p0:d4 p1:d4 p2:d4 predicted:d4",
    f"""SELECT "PULocationID", window_start, c0 AS p0, c1 - c0 AS p1, 1 - c1 AS p2, CASE WHEN c0 >= CASE WHEN hour <= 19 THEN 0.9 ELSE 0.8 END THEN 0 ELSE c0 * v0 + (c1 - c0) * v1 + (1 - c1) * v2 END AS predicted
     FROM (SELECT t.*, {H.format("b0").replace("* x ", "* x2 ")} AS c0, {H.format("b1").replace("* x ", "* x2 ")} AS c1 FROM train_x t, {ORDINAL_SQL} WHERE split = 'test' AND hour >= 17),
      (SELECT avg(y) FILTER (y <= lo) AS v0, avg(y) FILTER (y > lo AND y <= hi) AS v1, avg(y) FILTER (y > hi) AS v2 FROM train_x, bucket_bounds WHERE split = 'train' AND hour >= 17)""",
    "bucket_bounds",
)
def _(spark, sf_dir):
    """Learned bucket probabilities, and the demand expected from them with the zero gate."""
    train, bounds, model = _buckets(spark, sf_dir)
    rows = model.predict(_evening(spark, sf_dir, "test")).withColumn("baseline_blend", F.col("zone_hour_mean"))
    out = post.bucket_expectation(rows, "probs", reg.bucket_means(train, "target_demand", bounds), 0.9, 0.8)
    return out.select("PULocationID", "window_start", *[F.col("probs")[i].alias(f"p{i}") for i in range(3)], "predicted")


# -- Recursive forecasts ---------------------------------------------------------------------------------------------------------

FIXED = reg.Linear(
    {"lag_1h": 0.1, "lag_2h": 0.05, "lag_24h": 0.1, "lag_168h": 0.1, "rolling_avg_3h": 0.15, "rolling_avg_24h": 0.2, "zone_hour_mean": 0.2, "zone_dow_hour_mean": 0.1, "is_weekend": -0.05, "hour": 0.002},
    0.01,
)
FIXED_LOG = reg.Linear({"lag_1h": 0.02, "lag_3h": 0.02, "rolling_avg_6h": 0.1, "zone_hour_mean": 0.3, "is_holiday": 0.2, "hour": -0.005}, -0.5, "log")

sql_table("series169", "demand", f"""SELECT z."PULocationID", list(CAST(coalesce(d.trip_count, 0) AS DOUBLE) ORDER BY h.window_start) AS hist
 FROM (SELECT DISTINCT "PULocationID" FROM demand) z CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '{DAY} 00:00:00' - INTERVAL 169 HOUR, TIMESTAMP '{DAY} 00:00:00' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS window_start) h
 LEFT JOIN demand d USING ("PULocationID", window_start) GROUP BY 1""")
sql_table("day_steps", "series169 zh zdh holidays", f"""SELECT z."PULocationID", k, (k + 23) % 24 AS hour, CASE WHEN isodow(r) >= 6 THEN 1 ELSE 0 END AS is_weekend, CASE WHEN CAST(r AS DATE) IN (SELECT date FROM holidays) THEN 1 ELSE 0 END AS is_holiday,
  a.mean AS zh_mean, a.n AS zh_n, b.mean AS zdh_mean, b.n AS zdh_n FROM series169 z CROSS JOIN (SELECT k, TIMESTAMP '{DAY} 00:00:00' + (k - 1) * INTERVAL 1 HOUR AS r FROM (SELECT unnest(range(24)) AS k)) s
  LEFT JOIN zh a ON a."PULocationID" = z."PULocationID" AND a.hour = k LEFT JOIN zdh b ON b."PULocationID" = z."PULocationID" AND b.hour = k AND b.day_of_week = isodow(DATE '{DAY}') - 1""")
PAST = {f"lag_{n}h": f"hist[{-(n + 1)}]" for n in (1, 2, 3, 24, 168)} | {f"rolling_avg_{n}h": f"list_avg(list_slice(hist, {-(n + 1)}, -2))" for n in (3, 6, 24)}
PAST["zone_hour_mean"] = f"(CASE WHEN zh_n >= 5 THEN zh_mean ELSE {PAST['rolling_avg_24h']} END)"
PAST["zone_dow_hour_mean"] = f"(CASE WHEN zdh_n >= 3 THEN zdh_mean ELSE {PAST['zone_hour_mean']} END)"


def recursion(value: str, more: str = "") -> str:
    """24 hours, each from the list of the last 169 values."""
    return f"""(WITH RECURSIVE s AS (SELECT "PULocationID", -1 AS k, hist, CAST(NULL AS DOUBLE) AS p FROM series169
      UNION ALL SELECT "PULocationID", k, list_append(list_slice(hist, 2, 169), p), p FROM (
       SELECT s."PULocationID", d.k, hist, greatest({value}, 0) AS p FROM s JOIN day_steps d ON d."PULocationID" = s."PULocationID" AND d.k = s.k + 1{more}))
     SELECT "PULocationID", TIMESTAMP '{DAY} 00:00:00' + k * INTERVAL 1 HOUR AS window_start, k AS hour, p AS predicted FROM s WHERE k >= 0)"""


def linear_sql(model: reg.Linear) -> str:
    total = " + ".join([repr(model.intercept), *[f"{c!r} * {PAST.get(name, 'd.' + name)}" for name, c in model.coefficients.items()]])
    return f"exp(least({total}, 20))" if model.link == "log" else total


def _recursive(spark, sf_dir, model):
    source = materialize(hourly(spark, sf_dir), "hourly")
    zones = source.select("PULocationID").distinct()
    return source, forecast.recursive_model_forecast(source, dem.dense_grid(source, 4), zones, DAY, model, calendar(spark))


@query("recursive_model_forecast", "PULocationID:l window_start:t hour:i predicted:d", f"SELECT * FROM {recursion(linear_sql(FIXED))}", "series169 day_steps")
def _(spark, sf_dir):
    return _recursive(spark, sf_dir, FIXED)[1]


TOTALS = "hour:i zones:l predicted:d actual:l"


def totals_sql(recursive: str) -> str:
    return f"""SELECT hour, count(*) AS zones, sum(predicted) AS predicted, (SELECT coalesce(sum(trip_count), 0) FROM demand d WHERE d.window_start = TIMESTAMP '{DAY} 00:00:00' + r.hour * INTERVAL 1 HOUR) AS actual
     FROM {recursive} r GROUP BY hour"""


def _totals(found):
    source, rows = found
    inside = source.filter(F.to_date("window_start") == F.lit(DAY).cast("date")).groupBy(F.hour("window_start").alias("hour")).agg(F.sum("trip_count").alias("actual"))
    sums = rows.groupBy("hour").agg(F.count(F.lit(1)).alias("zones"), F.sum("predicted").alias("predicted"))
    return sums.join(inside, "hour", "left").withColumn("actual", F.coalesce("actual", F.lit(0)))


@query("recursive_log_totals", TOTALS, totals_sql(recursion(linear_sql(FIXED_LOG))), "series169 day_steps demand")
def _(spark, sf_dir):
    return _totals(_recursive(spark, sf_dir, FIXED_LOG))


LEARNED = f"SELECT {', '.join(f'{e} AS b{i}' for i, e in enumerate(solved(SUMS, RIGHT)))} FROM (SELECT {WEIGHTED} FROM (SELECT *, 1.0::DOUBLE AS a FROM train_x WHERE split = 'train'))"
sql_table("learned_b", "train_x", LEARNED)


@query(
    "recursive_learned_totals",
    TOTALS,
    totals_sql(recursion(f"b0 + b1 * {PAST[FEATURES[0]]} + b2 * {PAST[FEATURES[1]]}", " CROSS JOIN learned_b")),
    "series169 day_steps demand learned_b",
)
def _(spark, sf_dir):
    """Coefficients by least squares on the training rows, folded over the day."""
    return _totals(_recursive(spark, sf_dir, reg.least_squares(_part(spark, sf_dir, "train"), FEATURES, "target_demand")))


@query("recursive_robust_totals", "hour:i zones:l predicted:d4 actual:l")
def _(spark, sf_dir):
    """The day from a Huber regression on all features that the recursion recomputes."""
    model = reg.huber(_part(spark, sf_dir, "train"), FULL, "target_demand", delta=2.0)
    return _totals(_recursive(spark, sf_dir, model))
