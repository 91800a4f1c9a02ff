"""Hourly demand, grids, Gold, joins and aggregates on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonecast.operators import clean, demand as dem, features as feat, forecast, incremental, quality
from zonecast.plans.adapters import calendar, trips
from zonecast.plans.catalog.base import FULL, OBSERVED, gold_sql, grid_sql, query, sql_table
from zonecast.plans.tables import gold, hourly, stored_gold
from zonecast.session import materialize, scratch_path

GOLD_SPEC = (
    "PULocationID:l window_start:t window_end:t trip_count:l target_demand:l hour:i day_of_week:i is_weekend:i year:i month:i "
    "lag_1h:l lag_2h:l rolling_avg_3h:d"
)
sql_table("grid_full", "demand", grid_sql(4, FULL))
sql_table("gold_full", "grid_full", gold_sql("grid_full"))
sql_table("grid_city", "demand", grid_sql(263, OBSERVED))


@query("hourly_demand", "PULocationID:l window_start:t window_end:t trip_count:l", "SELECT * FROM demand", "demand")
def _(spark, sf_dir):
    return hourly(spark, sf_dir)


@query(
    "sliding_demand",
    "PULocationID:l window_start:t window_end:t trip_count:l",
    """SELECT "PULocationID", w AS window_start, w + INTERVAL 2 HOUR AS window_end, count(*) AS trip_count FROM (
      SELECT "PULocationID", date_trunc('hour', tpep_pickup_datetime) + CASE WHEN minute(tpep_pickup_datetime) >= 30 THEN INTERVAL 30 MINUTE ELSE INTERVAL 0 MINUTE END
       - unnest(range(0, 4)) * INTERVAL 30 MINUTE AS w FROM clean) GROUP BY 1, 2""",
    "clean",
)
def _(spark, sf_dir):
    df = clean.apply_rules(trips(spark, sf_dir), clean.strict_rules())
    return dem.hourly_demand(df, size="2 hours", slide="30 minutes")


@query("gold_demand", GOLD_SPEC, "SELECT * FROM gold", "gold")
def _(spark, sf_dir):
    return gold(spark, sf_dir)


@query("gold_demand_full_calendar", GOLD_SPEC, "SELECT * FROM gold_full", "gold_full")
def _(spark, sf_dir):
    return gold(spark, sf_dir, "full")


@query(
    "dense_grid_city",
    "PULocationID:l window_start:t trip_count:l",
    'SELECT "PULocationID", window_start, trip_count FROM grid_city',
    "grid_city",
)
def _(spark, sf_dir):
    return dem.dense_grid(hourly(spark, sf_dir))


@query(
    "top_zones",
    "PULocationID:l avg_demand:d",
    'SELECT "PULocationID", avg(trip_count) AS avg_demand FROM gold GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5',
    "gold",
)
def _(spark, sf_dir):
    return dem.top_zones(gold(spark, sf_dir))


@query(
    "hour_profile",
    "hour:i avg_trips:d max_trips:l std_trips:d",
    "SELECT hour, avg(trip_count) AS avg_trips, max(trip_count) AS max_trips, stddev_samp(trip_count) AS std_trips FROM gold GROUP BY 1",
    "gold",
)
def _(spark, sf_dir):
    return dem.hour_profile(gold(spark, sf_dir))


def _active(threshold: float) -> str:
    means = 'SELECT "PULocationID", avg(target_demand) AS m FROM gold GROUP BY 1'
    return f"""SELECT "PULocationID" FROM ({means}) WHERE m >= {threshold}
     UNION ALL SELECT "PULocationID" FROM (SELECT * FROM ({means}) ORDER BY m DESC, "PULocationID" LIMIT 10) WHERE (SELECT max(m) FROM ({means})) < {threshold}"""


@query("active_zones_low_threshold", "PULocationID:l", _active(1.0), "gold")
def _(spark, sf_dir):
    return dem.active_zones(stored_gold(spark, sf_dir), 1.0)


@query("active_zones_fallback", "PULocationID:l", _active(100000.0), "gold")
def _(spark, sf_dir):
    return dem.active_zones(stored_gold(spark, sf_dir), 100000.0)


@query(
    "rows_of_active_zones",
    "PULocationID:l n:l total:l",
    f'SELECT "PULocationID", count(*) AS n, sum(target_demand) AS total FROM gold WHERE "PULocationID" IN ({_active(1.73)}) GROUP BY 1',
    "gold",
)
def _(spark, sf_dir):
    kept = dem.keep_active(stored_gold(spark, sf_dir), 1.73)
    return kept.groupBy("PULocationID").agg(F.count(F.lit(1)).alias("n"), F.sum("target_demand").alias("total"))


@query(
    "hour_bucket_rows",
    "bucket:s n:l trips:l",
    """SELECT '00_09' AS bucket, count(*) AS n, sum(trip_count) AS trips FROM gold WHERE hour <= 9
     UNION ALL SELECT '10_16', count(*), sum(trip_count) FROM gold WHERE hour BETWEEN 10 AND 16
     UNION ALL SELECT '17_23', count(*), sum(trip_count) FROM gold WHERE hour >= 17
     UNION ALL SELECT 'all', count(*), sum(trip_count) FROM gold""",
    "gold",
)
def _(spark, sf_dir):
    source = stored_gold(spark, sf_dir)
    parts = [
        dem.hour_bucket(source, b).agg(F.count(F.lit(1)).alias("n"), F.sum("trip_count").alias("trips")).withColumn("bucket", F.lit(b))
        for b in ("00_09", "10_16", "17_23", "all")
    ]
    return quality.report(parts)


@query(
    "range_demand",
    "PULocationID:l window_start:t trip_count:l",
    """SELECT "PULocationID", window_start, trip_count FROM gold
     WHERE window_start BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-14 23:00:00'""",
    "gold",
)
def _(spark, sf_dir):
    return dem.range_demand(stored_gold(spark, sf_dir), "2024-01-08 00:00:00", "2024-01-14 23:00:00")


@query(
    "target_from_trip_count",
    "PULocationID:l window_start:t target_demand:d",
    'SELECT "PULocationID", window_start, trip_count AS target_demand FROM demand',
    "demand",
)
def _(spark, sf_dir):
    return clean.with_target(hourly(spark, sf_dir))


@query(
    "readiness",
    "hours_ready:l zones:l active_zones:l",
    """SELECT (SELECT count(DISTINCT window_start) FROM demand) AS hours_ready, count(*) AS zones, count(*) FILTER (m >= 1.5) AS active_zones
     FROM (SELECT avg(trip_count) AS m FROM demand GROUP BY "PULocationID")""",
    "demand",
)
def _(spark, sf_dir):
    return dem.readiness(materialize(hourly(spark, sf_dir), "hourly"), 1.5)


# Baselines, context and day forecasts.
DAY = "2024-01-16"
sql_table("hist", "grid", f"""SELECT "PULocationID", CAST(isodow(window_start) - 1 AS INTEGER) AS day_of_week, CAST(hour(window_start) AS INTEGER) AS hour,
 CAST(trip_count AS DOUBLE) AS v FROM grid WHERE window_start < TIMESTAMP '{DAY} 00:00:00'""")
sql_table("zdh", "hist", 'SELECT "PULocationID", day_of_week, hour, avg(v) AS mean, count(*) AS n FROM hist GROUP BY 1, 2, 3')
sql_table("zh", "hist", 'SELECT "PULocationID", hour, avg(v) AS mean, count(*) AS n FROM hist GROUP BY 1, 2')
sql_table("zo", "hist", 'SELECT "PULocationID", avg(v) AS mean, count(*) AS n FROM hist GROUP BY 1')
sql_table("ho", "hist", "SELECT hour, avg(v) AS mean, count(*) AS n FROM hist GROUP BY 1")


def _grid_table(spark, sf_dir):
    return materialize(dem.dense_grid(hourly(spark, sf_dir), 4), "grid")


@query(
    "historical_baselines",
    "level:s PULocationID:l day_of_week:i hour:i mean:d n:l",
    """SELECT 'zone_dow_hour' AS level, * FROM zdh UNION ALL SELECT 'zone_hour', "PULocationID", NULL, hour, mean, n FROM zh
     UNION ALL SELECT 'zone', "PULocationID", NULL, NULL, mean, n FROM zo UNION ALL SELECT 'hour', NULL, NULL, hour, mean, n FROM ho
     UNION ALL SELECT 'global', NULL, NULL, NULL, avg(v), count(*) FROM hist""",
    "zdh zh zo ho hist",
)
def _(spark, sf_dir):
    grid = dem.dense_grid(hourly(spark, sf_dir), 4)
    return forecast.baselines(grid, DAY)


LOOKUP_KEYS = """SELECT * FROM (SELECT unnest(range(1, 7)) AS "PULocationID") CROSS JOIN (SELECT unnest(range(0, 7)) AS day_of_week) CROSS JOIN (SELECT unnest(range(0, 24)) AS hour)"""


@query(
    "baseline_lookup",
    "PULocationID:l window_start:t zone_dow_hour_mean:d zone_hour_mean:d zone_mean:d hour_mean:d baseline_blend:d",
    """SELECT *, 0.7 * zone_hour_mean + 0.3 * hour_mean AS baseline_blend FROM (
     SELECT g."PULocationID", g.window_start, coalesce(a.mean, b.mean, c.mean, d.mean, t.m, 0) AS zone_dow_hour_mean, coalesce(b.mean, c.mean, d.mean, t.m, 0) AS zone_hour_mean,
      coalesce(c.mean, t.m, 0) AS zone_mean, coalesce(d.mean, t.m, 0) AS hour_mean
     FROM (SELECT "PULocationID" + 2 AS "PULocationID", window_start FROM grid) g
     LEFT JOIN zdh a ON a."PULocationID" = g."PULocationID" AND a.day_of_week = isodow(g.window_start) - 1 AND a.hour = hour(g.window_start)
     LEFT JOIN zh b ON b."PULocationID" = g."PULocationID" AND b.hour = hour(g.window_start)
     LEFT JOIN zo c ON c."PULocationID" = g."PULocationID" LEFT JOIN ho d ON d.hour = hour(g.window_start), (SELECT avg(v) AS m FROM hist) t)""",
    "grid zdh zh zo ho hist",
)
def _(spark, sf_dir):
    # Zones 3..6: two of them are unknown to the history, so every fallback level is used.
    grid = _grid_table(spark, sf_dir)
    rows = grid.select((F.col("PULocationID") + 2).alias("PULocationID"), "window_start").withColumns(
        {"day_of_week": F.weekday("window_start"), "hour": F.hour("window_start")}
    )
    return forecast.with_baselines(rows, materialize(forecast.baselines(grid, DAY), "baselines"))


@query(
    "context_merge",
    "PULocationID:l window_start:t trip_count:l",
    """SELECT coalesce(a."PULocationID", b."PULocationID") AS "PULocationID", coalesce(a.window_start, b.window_start) AS window_start, coalesce(a.trip_count, b.n) AS trip_count
     FROM (SELECT * FROM demand WHERE window_start < TIMESTAMP '2024-01-12 00:00:00') a
     FULL JOIN (SELECT "PULocationID", window_start, trip_count * 100 AS n FROM demand WHERE window_start >= TIMESTAMP '2024-01-10 00:00:00') b
     ON a."PULocationID" = b."PULocationID" AND a.window_start = b.window_start""",
    "demand",
)
def _(spark, sf_dir):
    source = materialize(hourly(spark, sf_dir), "hourly")
    cut = lambda day: F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
    old = source.filter(F.col("window_start") < cut("2024-01-12"))
    new = source.filter(F.col("window_start") >= cut("2024-01-10")).withColumn("trip_count", F.col("trip_count") * 100)
    return forecast.merge_context(old, new)


@query(
    "window_lookup",
    "PULocationID:l window_start:t trip_count:d present:b",
    """SELECT z."PULocationID", h.window_start, coalesce(d.trip_count, 0) AS trip_count, d.trip_count IS NOT NULL AS present
     FROM (SELECT DISTINCT "PULocationID" FROM demand) z CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2023-12-31 12:00:00', TIMESTAMP '2024-01-02 11:00:00', INTERVAL 1 HOUR)) AS window_start) h
     LEFT JOIN demand d USING ("PULocationID", window_start)""",
    "demand",
)
def _(spark, sf_dir):
    source = materialize(hourly(spark, sf_dir), "hourly")
    zones = source.select("PULocationID").distinct()
    return forecast.window_lookup(source, zones, F.lit("2023-12-31 12:00:00").cast("timestamp_ntz"), 48)


def _coverage(day: str) -> str:
    return f"""SELECT *, present / expected AS coverage, present / expected >= 0.85 AS sufficient FROM (SELECT z.n * 168 AS expected, p.n AS present
     FROM (SELECT count(DISTINCT "PULocationID") AS n FROM demand) z, (SELECT count(*) AS n FROM demand
     WHERE window_start >= TIMESTAMP '{day} 00:00:00' - INTERVAL 168 HOUR AND window_start < TIMESTAMP '{day} 00:00:00') p)"""


@query("context_coverage", "expected:l present:l coverage:d sufficient:b", _coverage(DAY), "demand")
def _(spark, sf_dir):
    source = materialize(hourly(spark, sf_dir), "hourly")
    return forecast.coverage(source, source.select("PULocationID").distinct(), DAY)


@query(
    "shifted_context",
    "PULocationID:l window_start:t trip_count:l",
    """SELECT "PULocationID", TIMESTAMP '2024-03-01 00:00:00' - INTERVAL 1 HOUR - (m - window_start) AS window_start, trip_count
     FROM demand, (SELECT max(window_start) AS m FROM demand) WHERE window_start >= m - INTERVAL 167 HOUR
     AND "PULocationID" IN (SELECT "PULocationID" FROM demand GROUP BY 1 HAVING avg(trip_count) >= 2.0)""",
    "demand",
)
def _(spark, sf_dir):
    source = materialize(hourly(spark, sf_dir), "hourly")
    return forecast.shifted_context(source, "2024-03-01", dem.active_zones(source, 2.0, "trip_count", fallback=0))


ZDH_AT = """coalesce((SELECT mean FROM zdh a WHERE a."PULocationID" = s."PULocationID" AND a.day_of_week = isodow(s.window_start) - 1 AND a.hour = hour(s.window_start)),
 (SELECT mean FROM zh b WHERE b."PULocationID" = s."PULocationID" AND b.hour = hour(s.window_start)), (SELECT mean FROM zo c WHERE c."PULocationID" = s."PULocationID"))"""
sql_table("series27", "demand", f"""SELECT z."PULocationID", h.window_start, CAST(coalesce(d.trip_count, 0) AS DOUBLE) AS v
 FROM (SELECT DISTINCT "PULocationID" FROM demand) z CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '{DAY} 00:00:00' - INTERVAL 3 HOUR, TIMESTAMP '{DAY} 23:00:00', INTERVAL 1 HOUR)) AS window_start) h
 LEFT JOIN demand d USING ("PULocationID", window_start)""")


@query(
    "day_forecast_with_history",
    "PULocationID:l window_start:t hour:i actual:d predicted:d",
    f"""SELECT "PULocationID", window_start, hour(window_start) AS hour, v AS actual, greatest(0.5 * recent + 0.5 * base, 0) AS predicted FROM (
     SELECT s.*, {ZDH_AT} AS base FROM (SELECT *, avg(v) OVER (PARTITION BY "PULocationID" ORDER BY window_start ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS recent FROM series27) s)
     WHERE window_start >= TIMESTAMP '{DAY} 00:00:00'""",
    "series27 zdh zh zo",
)
def _(spark, sf_dir):
    source = materialize(hourly(spark, sf_dir), "hourly")
    zones = source.select("PULocationID").distinct()
    table = materialize(forecast.baselines(dem.dense_grid(source, 4), DAY), "baselines")
    return forecast.day_forecast(source, zones, DAY, table)


@query(
    "day_forecast_recursive",
    "PULocationID:l window_start:t hour:i predicted:d",
    f"""WITH RECURSIVE steps AS (
      SELECT "PULocationID", -1 AS h, max(CASE WHEN k = 1 THEN v END) AS a, max(CASE WHEN k = 2 THEN v END) AS b, max(CASE WHEN k = 3 THEN v END) AS c, CAST(NULL AS DOUBLE) AS p
      FROM (SELECT *, row_number() OVER (PARTITION BY "PULocationID" ORDER BY window_start) AS k FROM series27 WHERE window_start < TIMESTAMP '{DAY} 00:00:00') GROUP BY 1
      UNION ALL SELECT s."PULocationID", h + 1, b, c, greatest(0.5 * ((a + b + c) / 3) + 0.5 * m.base, 0), greatest(0.5 * ((a + b + c) / 3) + 0.5 * m.base, 0)
      FROM steps s JOIN (SELECT s."PULocationID", hour(window_start) AS hh, {ZDH_AT} AS base FROM series27 s WHERE window_start >= TIMESTAMP '{DAY} 00:00:00') m
       ON m."PULocationID" = s."PULocationID" AND m.hh = s.h + 1 WHERE s.h < 23)
     SELECT "PULocationID", TIMESTAMP '{DAY} 00:00:00' + h * INTERVAL 1 HOUR AS window_start, h AS hour, p AS predicted FROM steps WHERE h >= 0""",
    "series27 zdh zh zo",
)
def _(spark, sf_dir):
    source = materialize(hourly(spark, sf_dir), "hourly")
    zones = source.select("PULocationID").distinct()
    table = materialize(forecast.baselines(dem.dense_grid(source, 4), DAY), "baselines")
    return forecast.recursive_forecast(source, zones, DAY, table)


@query(
    "target_day",
    "target_date:D holiday_name:s regular_date:D holiday_date:D",
    """SELECT regular_date AS target_date, coalesce((SELECT name FROM holidays WHERE date = regular_date), '') AS holiday_name, regular_date, holiday_date FROM (
     SELECT coalesce(min(d) FILTER (day(d) >= 8 AND d < DATE '2024-01-31' AND isodow(d) IN (2, 3, 4) AND name IS NULL AND has AND context >= 5), DATE '2024-01-15') AS regular_date,
      coalesce(min(d) FILTER (name IS NOT NULL AND context >= 5), max(d) FILTER (name IS NOT NULL), DATE '2024-01-15') AS holiday_date FROM (
      SELECT m.d, h.name, m.d IN (SELECT CAST(window_start AS DATE) FROM demand) AS has,
       (SELECT count(DISTINCT CAST(window_start AS DATE)) FROM demand WHERE CAST(window_start AS DATE) >= m.d - 7 AND CAST(window_start AS DATE) < m.d) AS context
      FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS d) m LEFT JOIN holidays h ON h.date = m.d))""",
    "demand holidays",
)
def _(spark, sf_dir):
    return forecast.resolve_day(hourly(spark, sf_dir), calendar(spark), 2024, 1)


def _batches(spark, sf_dir):
    """The month in four batches: most of it without some hours, these hours late, the last week, and single trips of the first week last."""
    source = materialize(hourly(spark, sf_dir), "hourly")
    late = F.hour("window_start").isin(3, 17) & (F.dayofmonth("window_start") % 5 == 0)
    end = F.col("window_start") >= F.lit("2024-01-24 00:00:00").cast("timestamp_ntz")
    last = (F.col("PULocationID") == 2) & (F.col("window_start") < F.lit("2024-01-08 00:00:00").cast("timestamp_ntz"))
    return [source.filter(~late & ~end & ~last), source.filter(late & ~end & ~last), source.filter(end), source.filter(last & ~end)]


@query(
    "incremental_gold",
    "PULocationID:l window_start:t window_end:t trip_count:l target_demand:l lag_1h:l lag_2h:l rolling_avg_3h:d",
    "SELECT * FROM gold",
    "gold",
)
def _(spark, sf_dir):
    """Gold after late and out-of-order batches, each of which rewrote only the days of rows that read what it changed."""
    path = scratch_path(spark, "incremental")
    for number, changes in enumerate(_batches(spark, sf_dir)):
        incremental.apply_batch(spark, path, number, changes, 4)
    return incremental.gold(spark, path)


@query(
    "incremental_lags",
    "PULocationID:l window_start:t trip_count:l target_demand:l lag_24h:d lag_168h:d rolling_avg_24h:d",
    "SELECT * FROM base",
    "base",
)
def _(spark, sf_dir):
    """The same with lags of a week: a batch reaches 168 rows further."""
    path = scratch_path(spark, "incremental-lags")
    build = lambda grid: feat.add_lags(dem.gold_features(grid).drop("lag_1h", "lag_2h", "rolling_avg_3h"))
    for number, changes in enumerate(_batches(spark, sf_dir)):
        incremental.apply_batch(spark, path, number, changes, 4, build, 168)
    return incremental.gold(spark, path)
