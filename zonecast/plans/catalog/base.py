"""Registry: a query, its output columns and, where SQL can state it, the same result in SQL.

The column list fixes names, types and rounding for both sides. Types: i int, l bigint, d double
(6 digits), d4 double (4 digits), f double (as it is), s text, t timestamp, D date, b boolean.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_TYPES = {"i": ("int", "INTEGER"), "l": ("bigint", "BIGINT"), "s": ("string", "VARCHAR"), "t": ("timestamp_ntz", "TIMESTAMP"),
          "D": ("date", "DATE"), "b": ("boolean", "BOOLEAN"), "f": ("double", "DOUBLE")}


def _columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(item.rsplit(":", 1)) for item in spec.split()]


def _nudge(digits: int) -> float:
    """Added before rounding: moves exact ties off the edge, where the last bit of a sum (whose
    order no engine fixes) would decide the digit.
    """
    return 10.0 ** -(digits + 3)


def shape(df: DataFrame, spec: str) -> DataFrame:
    def cast(name: str, kind: str) -> str:
        if kind.startswith("d"):
            digits = int(kind[1:] or 6)
            return f"round(CAST(`{name}` AS DOUBLE) + {_nudge(digits)!r}D, {digits}) + 0D AS `{name}`"
        return f"CAST(`{name}` AS {_TYPES[kind][0]}) AS `{name}`"

    return df.selectExpr(*[cast(n, k) for n, k in _columns(spec)])


def shape_sql(inner: str, spec: str, with_clause: str = "") -> str:
    def cast(name: str, kind: str) -> str:
        if kind.startswith("d"):
            digits = int(kind[1:] or 6)
            return f'round(CAST("{name}" AS DOUBLE) + CAST({_nudge(digits)!r} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE) AS "{name}"'
        return f'CAST("{name}" AS {_TYPES[kind][1]}) AS "{name}"'

    return f"{with_clause}SELECT {', '.join(cast(n, k) for n, k in _columns(spec))} FROM ({inner}) AS result"


def query(name: str, spec: str, sql: str | None = None, uses: str = "") -> Callable[[Query], Query]:
    """Registers a query. ``uses`` names the shared SQL tables the statement reads."""

    def register(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"duplicate query: {name}")
        _QUERIES[name] = lambda spark, sf_dir: shape(fn(spark, sf_dir), spec)
        if sql is not None:
            _SQL[name] = shape_sql(sql, spec, with_tables(uses.split()))
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# Shared SQL tables: name -> (tables it reads, statement).
TABLES: dict[str, tuple[list[str], str]] = {}


def sql_table(name: str, reads: str, statement: str) -> None:
    TABLES[name] = (reads.split(), statement)


def with_tables(names: list[str]) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for dependency in TABLES[name][0]:
            add(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return ""
    return "WITH " + ", ".join(f"{n} AS ({TABLES[n][1]})" for n in ordered) + " "


sql_table("trips", "", """
SELECT CAST(event_id % 2 + 1 AS DOUBLE) AS "VendorID",
 CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 97 = 0 THEN ts - INTERVAL 3 YEAR ELSE ts END AS tpep_pickup_datetime,
 CASE WHEN event_id % 89 = 0 THEN ts + INTERVAL 35 DAY ELSE ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) END AS tpep_dropoff_datetime,
 CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 5 AS DOUBLE) END AS passenger_count,
 value / 10 AS trip_distance, CAST(event_id % 8 AS DOUBLE) AS "RatecodeID",
 CASE WHEN event_id % 2 = 0 THEN 'N' ELSE 'Y' END AS store_and_fwd_flag,
 CAST(CASE WHEN event_id % 50 = 0 THEN 265 ELSE user_id % 4 + 1 END AS DOUBLE) AS "PULocationID",
 CAST(event_id % 270 + 1 AS DOUBLE) AS "DOLocationID", CAST(event_id % 6 AS DOUBLE) AS payment_type, value AS fare_amount,
 CAST(event_id % 3 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax, CAST(event_id % 10 AS DOUBLE) AS tip_amount,
 CAST(CASE WHEN event_id % 20 = 0 THEN 6.5 ELSE 0 END AS DOUBLE) AS tolls_amount, CAST(0.25 AS DOUBLE) AS improvement_surcharge,
 value + CAST(event_id % 10 AS DOUBLE) AS total_amount, CAST(2.5 AS DOUBLE) AS congestion_surcharge,
 CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(1.25 AS DOUBLE) END AS airport_fee
FROM events""")

STRICT_RULES = [
    "tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL",
    "year(tpep_pickup_datetime) = year(tpep_dropoff_datetime) AND month(tpep_pickup_datetime) = month(tpep_dropoff_datetime)",
    "year(tpep_pickup_datetime) >= 2022 AND year(tpep_pickup_datetime) < 2025",
    "trip_distance > 0.1",
    '"RatecodeID" <= 6',
    "payment_type < 5",
    "fare_amount >= 1",
    "passenger_count > 0",
    '"PULocationID" BETWEEN 1 AND 263',
    '"DOLocationID" BETWEEN 1 AND 263',
]
LOOSE_RULES = STRICT_RULES[:2] + ["trip_distance > 0", "fare_amount >= 0"] + STRICT_RULES[7:]

sql_table("clean", "trips", "SELECT * FROM trips WHERE " + " AND ".join(f"({r})" for r in STRICT_RULES))
sql_table("demand", "clean", """
SELECT CAST("PULocationID" AS BIGINT) AS "PULocationID", date_trunc('hour', tpep_pickup_datetime) AS window_start,
 date_trunc('hour', tpep_pickup_datetime) + INTERVAL 1 HOUR AS window_end, count(*) AS trip_count
FROM clean GROUP BY 1, 2, 3""")


def grid_sql(zones: int, slots: str) -> str:
    return f"""
SELECT z.zone AS "PULocationID", s.window_start, s.window_end, coalesce(d.trip_count, 0) AS trip_count
FROM (SELECT unnest(range(1, {zones + 1})) AS zone) z CROSS JOIN ({slots}) s
LEFT JOIN demand d ON d."PULocationID" = z.zone AND d.window_start = s.window_start"""


OBSERVED = "SELECT DISTINCT window_start, window_end FROM demand"
FULL = """SELECT h AS window_start, h + INTERVAL 1 HOUR AS window_end FROM (
 SELECT unnest(generate_series(min(window_start), max(window_start), INTERVAL 1 HOUR)) AS h FROM demand)"""


def gold_sql(grid: str) -> str:
    return f"""
SELECT * FROM (SELECT "PULocationID", window_start, window_end, trip_count, lead(trip_count) OVER w AS target_demand,
 hour(window_start) AS hour, dayofweek(window_start) + 1 AS day_of_week,
 CASE WHEN dayofweek(window_start) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, year(window_start) AS year, month(window_start) AS month,
 lag(trip_count, 1) OVER w AS lag_1h, lag(trip_count, 2) OVER w AS lag_2h,
 avg(trip_count) OVER (PARTITION BY "PULocationID" ORDER BY window_start ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_avg_3h
 FROM {grid} WINDOW w AS (PARTITION BY "PULocationID" ORDER BY window_start)) WHERE target_demand IS NOT NULL"""


sql_table("grid", "demand", grid_sql(4, OBSERVED))
sql_table("gold", "grid", gold_sql("grid"))
sql_table("holidays", "", "SELECT * FROM (VALUES (DATE '2024-01-01', 'New Year''s Day'), (DATE '2024-01-15', 'Martin Luther King Jr. Day')) AS h(date, name)")
sql_table("bounds", "gold", """
SELECT CAST(round(lo + (hi - lo) * CAST(0.7 AS DOUBLE)) AS BIGINT) AS train_end, CAST(round(lo + (hi - lo) * CAST(0.85 AS DOUBLE)) AS BIGINT) AS val_end
FROM (SELECT epoch_us(min(window_start)) AS lo, epoch_us(max(window_start)) AS hi FROM gold)""")
ZONE_ROWS = 'PARTITION BY "PULocationID" ORDER BY window_start'


def _lag(name: str, n: int, basis: str = "trip_count") -> str:
    return f"coalesce(CAST(lag({basis}, {n}) OVER w AS DOUBLE), 0) AS {name}"


def _roll(name: str, n: int, basis: str = "trip_count") -> str:
    return f"coalesce(avg({basis}) OVER ({ZONE_ROWS} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 0) AS {name}"


def base_sql(basis: str = "trip_count") -> str:
    lags = [_lag(f"lag_{n}h", n, basis) for n in (1, 2, 3, 24, 168)]
    rolls = [_roll(f"rolling_avg_{n}h", n, basis) for n in (3, 6, 24)]
    return f"""
SELECT "PULocationID", window_start, trip_count, target_demand, CAST(hour(window_start) AS INTEGER) AS hour,
 CAST(isodow(window_start) - 1 AS INTEGER) AS day_of_week, CAST(isodow(window_start) - 1 AS INTEGER) AS dow_mon0,
 dayofweek(window_start) + 1 AS dow_sun1, CAST(month(window_start) AS INTEGER) AS month,
 CASE WHEN isodow(window_start) >= 6 THEN 1 ELSE 0 END AS is_weekend,
 sin(2 * pi() * hour(window_start) / 24) AS hour_sin, cos(2 * pi() * hour(window_start) / 24) AS hour_cos,
 sin(2 * pi() * (isodow(window_start) - 1) / 7) AS dow_sin, cos(2 * pi() * (isodow(window_start) - 1) / 7) AS dow_cos,
 sin(2 * pi() * month(window_start) / 12) AS month_sin, cos(2 * pi() * month(window_start) / 12) AS month_cos,
 CASE WHEN CAST(window_start AS DATE) IN (SELECT date FROM holidays) THEN 1 ELSE 0 END AS is_holiday,
 {', '.join(lags)}, {', '.join(rolls)}
FROM gold WINDOW w AS ({ZONE_ROWS})"""


sql_table("base", "gold holidays", base_sql())


def earlier(value: str, at_least: int, *keys: str) -> str:
    parts = ", ".join(['"PULocationID"', *keys])
    frame = f"(PARTITION BY {parts} ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({value}) OVER {frame} >= {at_least} THEN avg({value}) OVER {frame} END"


sql_table("main_means", "base", f"""
SELECT *, coalesce(zh, rolling_avg_24h, 0) AS zone_hour_mean, coalesce(zdh, zh, rolling_avg_24h, 0) AS zone_dow_hour_mean
FROM (SELECT *, {earlier('target_demand', 5, 'hour')} AS zh, {earlier('target_demand', 3, 'day_of_week', 'hour')} AS zdh FROM base)""")
sql_table("train_mean", "gold bounds", "SELECT avg(target_demand) AS m FROM gold, bounds WHERE epoch_us(window_start) < train_end")
sql_table("hour_means", "gold", """
SELECT a.window_start, sum(b.s) / sum(b.n) AS hm FROM
 (SELECT DISTINCT window_start FROM gold) a LEFT JOIN
 (SELECT window_start, CAST(sum(target_demand) AS DOUBLE) AS s, count(target_demand) AS n FROM gold GROUP BY 1) b
 ON hour(a.window_start) = hour(b.window_start) AND b.window_start < a.window_start GROUP BY 1""")
sql_table("special", "base train_mean hour_means", f"""
SELECT *, 0.7 * zone_hour_mean + 0.3 * hour_mean AS baseline_blend FROM (
 SELECT b.*, coalesce(zm, m) AS zone_mean, coalesce(zh, zm, m) AS zone_hour_mean, coalesce(hm, m) AS hour_mean
 FROM (SELECT *, {earlier('target_demand', 1)} AS zm, {earlier('target_demand', 1, 'hour')} AS zh FROM base) b
 LEFT JOIN hour_means USING (window_start), train_mean)""")
SPLIT = "CASE WHEN epoch_us(window_start) < (SELECT train_end FROM bounds) THEN 'train' WHEN epoch_us(window_start) < (SELECT val_end FROM bounds) THEN 'val' ELSE 'test' END"
sql_table("forecasts", "special bounds", f"""
SELECT * FROM (SELECT "PULocationID", window_start, hour, day_of_week, is_weekend, is_holiday, {SPLIT} AS split,
 CAST(target_demand AS DOUBLE) AS actual, zone_hour_mean,
 coalesce({earlier('target_demand', 3, 'day_of_week', 'hour')}, zone_hour_mean) AS zone_dow_hour_mean, hour_mean, baseline_blend,
 CAST(lag(target_demand, 24) OVER w AS DOUBLE) AS naive_day, CAST(lag(target_demand, 168) OVER w AS DOUBLE) AS naive_week,
 baseline_blend AS predicted FROM special WINDOW w AS ({ZONE_ROWS}))""")
sql_table("val", "forecasts", "SELECT * FROM forecasts WHERE split = 'val'")
sql_table("test", "forecasts", "SELECT * FROM forecasts WHERE split = 'test'")
