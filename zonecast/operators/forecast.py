"""Baselines, context and day forecasts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from zonecast import rules as fixed
from zonecast.functions.scalar import cyclic, floor_zero, weekend_mon0
from zonecast.operators.demand import ZONE_KEY
from zonecast.operators.regression import Linear

TIME = "window_start"
HOURS = "INTERVAL '{}' HOUR"


def _start(day: str) -> Column:
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")


def baselines(hourly: DataFrame, before: str) -> DataFrame:
    """Means of all rows strictly before a day for five key sets, in one grouping-sets aggregate.

    Columns: level (zone_dow_hour, zone_hour, zone, hour, global), keys (NULL where unused), mean.
    """
    hist = hourly.filter(F.col(TIME) < _start(before)).select(
        F.col(ZONE_KEY), F.weekday(TIME).alias("day_of_week"), F.hour(TIME).alias("hour"), F.col("trip_count").cast("double").alias("v")
    )
    keys = [F.col(ZONE_KEY), F.col("day_of_week"), F.col("hour")]
    sets = [keys, [keys[0], keys[2]], [keys[0]], [keys[2]], []]
    grouped = hist.groupingSets(sets, *keys).agg(
        F.grouping_id(*keys).alias("gid"), F.avg("v").alias("mean"), F.count(F.lit(1)).alias("n")
    )
    level = (
        F.when(F.col("gid") == 0, "zone_dow_hour").when(F.col("gid") == 2, "zone_hour").when(F.col("gid") == 3, "zone")
        .when(F.col("gid") == 6, "hour").otherwise("global")
    )
    return grouped.select(level.alias("level"), ZONE_KEY, "day_of_week", "hour", "mean", "n")


BASELINE_LEVELS = [
    ("zone_dow_hour", [ZONE_KEY, "day_of_week", "hour"]), ("zone_hour", [ZONE_KEY, "hour"]), ("zone", [ZONE_KEY]), ("hour", ["hour"]),
]


def with_baselines(df: DataFrame, table: DataFrame) -> DataFrame:
    """Adds the mean of the most specific level that knows the row's key, per level chain.

    ``df`` has zone, day_of_week and hour. The table has at most zones × 168 rows; it is small
    enough that the planner may broadcast it, and joins by key if it is not.
    """
    out = df
    for level, keys in BASELINE_LEVELS:
        part = table.filter(F.col("level") == level).select(*keys, F.col("mean").alias(f"_{level}"))
        out = out.join(part, on=keys, how="left")
    overall = table.filter(F.col("level") == "global").agg(F.max("mean").alias("m")).scalar()
    out = out.withColumn("_global", F.coalesce(overall, F.lit(0.0)))
    chain = ["_zone_hour", "_zone", "_hour", "_global"]
    return out.select(
        *df.columns,
        F.coalesce("_zone_dow_hour", *chain).alias("zone_dow_hour_mean"),
        F.coalesce(*chain).alias("zone_hour_mean"),
        F.coalesce("_zone", "_global").alias("zone_mean"),
        F.coalesce("_hour", "_global").alias("hour_mean"),
    ).withColumn("baseline_blend", F.lit(0.70) * F.col("zone_hour_mean") + F.lit(0.30) * F.col("hour_mean"))


def merge_context(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Union of two hourly tables, one row per (zone, hour): the primary's row wins, and within
    a table the largest count. An aggregate instead of a row number, so copies of a key combine
    before the shuffle.
    """
    columns = [ZONE_KEY, TIME, "trip_count"]
    both = primary.select(*columns, F.lit(0).alias("_rank")).unionByName(secondary.select(*columns, F.lit(1).alias("_rank")))
    best = F.min_by("trip_count", F.struct(F.col("_rank"), -F.col("trip_count")))
    return both.groupBy(ZONE_KEY, TIME).agg(best.alias("trip_count"))


def window_grid(zones: DataFrame, first: Column, hours: int) -> DataFrame:
    """Every zone with ``hours`` consecutive hours from ``first`` (an array per zone, exploded)."""
    last = first + F.expr(HOURS.format(hours - 1))
    return zones.select(ZONE_KEY, F.explode(F.sequence(first, last, F.expr("INTERVAL '1' HOUR"))).alias(TIME))


def window_lookup(hourly: DataFrame, zones: DataFrame, first: Column, hours: int) -> DataFrame:
    """Counts of every zone and hour of a window, 0 where absent; copies of a key are summed."""
    last = first + F.expr(HOURS.format(hours - 1))
    present = (
        hourly.filter((F.col(TIME) >= first) & (F.col(TIME) <= last))
        .groupBy(ZONE_KEY, TIME).agg(F.sum("trip_count").cast("double").alias("trip_count"))
    )
    grid = window_grid(zones, first, hours).join(present, on=[ZONE_KEY, TIME], how="left")
    return grid.select(ZONE_KEY, TIME, F.coalesce("trip_count", F.lit(0.0)).alias("trip_count"), F.col("trip_count").isNotNull().alias("present"))


def coverage(hourly: DataFrame, zones: DataFrame, day: str, look_back: int = 168) -> DataFrame:
    """One row: share of (zone, hour) keys with data in the look-back before a day, and whether
    it passes the gate.
    """
    first = _start(day) - F.expr(HOURS.format(look_back))
    share = window_lookup(hourly, zones, first, look_back).agg(
        F.count(F.lit(1)).alias("expected"), F.count_if("present").alias("present")
    )
    ratio = F.coalesce(F.try_divide("present", "expected"), F.lit(0.0))
    return share.select("expected", "present", ratio.alias("coverage"), (ratio >= fixed.LIMITS["context_coverage"]).alias("sufficient"))


def shifted_context(hourly: DataFrame, month_start: str, zones: DataFrame | None = None, hours: int = 168) -> DataFrame:
    """The last ``hours`` hours of a table moved to end one hour before a month starts."""
    end = hourly.agg(F.max(TIME).alias("t")).scalar()
    recent = hourly.filter(F.col(TIME) >= end - F.expr(HOURS.format(hours - 1)))
    if zones is not None:
        recent = recent.join(zones, on=ZONE_KEY, how="left_semi")
    last = recent.agg(F.max(TIME).alias("t")).scalar()
    moved = _start(month_start) - F.expr("INTERVAL '1' HOUR") - (last - F.col(TIME))
    return recent.select(ZONE_KEY, moved.alias(TIME), "trip_count")


def naive_forecasts(df: DataFrame, value: str = "target_demand") -> DataFrame:
    """Same hour yesterday and last week, as forecasts of the row's value."""
    order = Window.partitionBy(ZONE_KEY).orderBy(TIME)
    return df.withColumns({"naive_day": F.lag(value, 24).over(order).cast("double"), "naive_week": F.lag(value, 168).over(order).cast("double")})


def day_forecast(hourly: DataFrame, zones: DataFrame, day: str, table: DataFrame, weight: float = 0.5) -> DataFrame:
    """24 hours of a day for every zone with known history: each hour is predicted from the mean
    of the three hours before it and the zone-weekday-hour baseline. All hours are independent.
    """
    first = _start(day) - F.expr("INTERVAL '3' HOUR")
    series = window_lookup(hourly, zones, first, 27)
    order = Window.partitionBy(ZONE_KEY).orderBy(TIME)
    recent = F.avg("trip_count").over(order.rowsBetween(-3, -1))
    rows = series.withColumn("recent", recent).filter(F.col(TIME) >= _start(day))
    rows = rows.withColumns({"day_of_week": F.weekday(TIME), "hour": F.hour(TIME)})
    known = with_baselines(rows, table)
    predicted = floor_zero(F.lit(weight) * F.col("recent") + F.lit(1.0 - weight) * F.col("zone_dow_hour_mean"))
    return known.select(ZONE_KEY, TIME, "hour", F.col("trip_count").alias("actual"), predicted.alias("predicted"))


def rows_for_day(features: DataFrame, day: str) -> DataFrame:
    """Feature rows whose target hour lies in a day (a row predicts the hour after it), with
    ``target_hour``. Serving reads the same feature columns as training.
    """
    target = F.col(TIME) + F.expr("INTERVAL '1' HOUR")
    inside = (F.col(TIME) >= _start(day) - F.expr("INTERVAL '1' HOUR")) & (F.col(TIME) < _start(day) + F.expr("INTERVAL '23' HOUR"))
    return features.filter(inside).withColumn("target_hour", target)


Step = Callable[[Column, Column], Column]


def blended_step(weight: float = 0.5) -> Step:
    """Mean of the last three values mixed with the hour's baseline."""

    def step(history: Column, baseline: Column) -> Column:
        recent = (F.element_at(history, -1) + F.element_at(history, -2) + F.element_at(history, -3)) / F.lit(3.0)
        return F.greatest(F.lit(weight) * recent + F.lit(1.0 - weight) * baseline, F.lit(0.0))

    return step


def recursive_forecast(
    hourly: DataFrame, zones: DataFrame, day: str, table: DataFrame, look_back: int = 168, step: Step | None = None
) -> DataFrame:
    """24 hours of a day without its actuals: each prediction becomes history of the next hour.

    The look-back of a zone is one array (its length is fixed), and the hours are folded over it
    inside the row: sequential in time, parallel over zones, and no Python per step.
    """
    step = step or blended_step()
    first = _start(day) - F.expr(HOURS.format(look_back))
    past = window_lookup(hourly, zones, first, look_back)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(TIME, "trip_count"))), lambda e: e["trip_count"])
    history = past.groupBy(ZONE_KEY).agg(ordered.alias("history"))
    target = window_grid(zones, _start(day), 24).withColumns({"day_of_week": F.weekday(TIME), "hour": F.hour(TIME)})
    means = with_baselines(target, table).groupBy(ZONE_KEY).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("hour", "zone_dow_hour_mean"))), lambda e: e["zone_dow_hour_mean"]).alias("means")
    )
    folded = F.aggregate(
        F.col("means"), F.col("history"), lambda acc, baseline: F.concat(acc, F.array(step(acc, baseline)))
    )
    out = history.join(means, on=ZONE_KEY).select(ZONE_KEY, F.slice(folded, look_back + 1, 24).alias("day"))
    return out.select(ZONE_KEY, F.posexplode("day").alias("hour", "predicted")).select(
        ZONE_KEY, (_start(day) + F.make_dt_interval(hours=F.col("hour"))).alias(TIME), "hour", "predicted"
    )


#: Features the recursive forecast recomputes at every hour; their meaning is that of the feature tables.
RECURSIVE_LAGS = {"lag_1h": 1, "lag_2h": 2, "lag_3h": 3, "lag_24h": 24, "lag_168h": 168}
RECURSIVE_MEANS = {"rolling_avg_3h": 3, "rolling_avg_6h": 6, "rolling_avg_24h": 24}
#: The row of an hour and 168 hours before it.
RECURSIVE_LOOK_BACK = 169


def _steps(calendar: DataFrame | None, spark: SparkSession, day: str, hours: int) -> DataFrame:
    """One row: what is known of each hour to come. A row predicts the hour after it, so an hour's features are those of the hour before."""
    target = _start(day) + F.make_dt_interval(hours=F.col("id").cast("int"))
    rows = spark.range(hours).select("id", target.alias("target"), (target - F.expr(HOURS.format(1))).alias(TIME))
    holiday = F.lit(0)
    if calendar is not None:
        days = calendar.select(F.to_date("date").alias("_day")).distinct().withColumn("_hit", F.lit(1))
        rows = rows.withColumn("_day", F.to_date(TIME)).join(days, "_day", "left")
        holiday = F.coalesce("_hit", F.lit(0))
    hour, dow = F.hour(TIME), F.weekday(TIME)
    (hour_sin, hour_cos), (dow_sin, dow_cos) = cyclic(hour, 24), cyclic(dow, 7)
    known = F.struct(
        "id", hour.alias("hour"), dow.alias("day_of_week"), weekend_mon0(dow).alias("is_weekend"), holiday.alias("is_holiday"),
        hour_sin.alias("hour_sin"), hour_cos.alias("hour_cos"), dow_sin.alias("dow_sin"), dow_cos.alias("dow_cos"),
        F.hour("target").alias("zh"), (F.weekday("target") * 24 + F.hour("target")).alias("zdh"),
    )
    return rows.agg(F.array_sort(F.collect_list(known)).alias("steps"))


def _sums(dense: DataFrame, key: Column, size: int, name: str) -> DataFrame:
    """Per zone the sums and numbers of earlier counts by ``key`` (0 .. size - 1), as two arrays."""
    by = dense.groupBy(ZONE_KEY, key.alias("k")).agg(F.sum("trip_count").cast("double").alias("s"), F.count("trip_count").cast("double").alias("n"))
    held = by.groupBy(ZONE_KEY).agg(F.map_from_entries(F.collect_list(F.struct("k", F.struct("s", "n")))).alias("m"))
    at = lambda part: F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.col("m")[i][part], F.lit(0.0)))
    return held.select(ZONE_KEY, at("s").alias(f"{name}_sum"), at("n").alias(f"{name}_n"))


def recursive_model_forecast(
    hourly: DataFrame, dense: DataFrame, zones: DataFrame, day: str, model: Linear, calendar: DataFrame | None = None, hours: int = 24
) -> DataFrame:
    """``hours`` hours from a day on without their actuals: features are computed anew at every hour from what was predicted before.

    A zone holds its last 169 values and the sums behind its zone-hour and zone-weekday-hour means (``dense``: all hours of all zones); a
    fold over the hours to come derives lags, rolling and expanding means from them, applies the coefficients, and appends the
    prediction to both. It runs inside the row: sequential in time, parallel over zones, no Python. The size of the state does not depend on
    the length of the history. Zones without history in ``dense`` have means of their last day.
    """
    spark = hourly.sparkSession
    first = _start(day) - F.expr(HOURS.format(RECURSIVE_LOOK_BACK))
    past = window_lookup(hourly, zones, first, RECURSIVE_LOOK_BACK)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(TIME, "trip_count"))), lambda e: e["trip_count"])
    state = past.groupBy(ZONE_KEY).agg(ordered.alias("history"))
    before = dense.filter(F.col(TIME) < _start(day))
    sizes = {"zh": (F.hour(TIME), 24), "zdh": (F.weekday(TIME) * 24 + F.hour(TIME), 168)}
    for name, (key, size) in sizes.items():
        state = state.join(_sums(before, key, size, name), on=ZONE_KEY, how="left")
        for part in (f"{name}_sum", f"{name}_n"):
            state = state.withColumn(part, F.coalesce(part, F.array_repeat(F.lit(0.0), size)))

    def step(acc: Column, known: Column) -> Column:
        history = acc["history"]
        mean = lambda n: F.aggregate(F.slice(history, -(n + 1), n), F.lit(0.0), lambda t, x: t + x) / F.lit(float(n))
        at = lambda part, name: F.element_at(acc[part], known[name] + 1)
        values = {name: F.element_at(history, -(n + 1)) for name, n in RECURSIVE_LAGS.items()} | {name: mean(n) for name, n in RECURSIVE_MEANS.items()}
        values["zone_hour_mean"] = F.when(at("zh_n", "zh") >= 5, at("zh_sum", "zh") / at("zh_n", "zh")).otherwise(values["rolling_avg_24h"])
        values["zone_dow_hour_mean"] = F.when(at("zdh_n", "zdh") >= 3, at("zdh_sum", "zdh") / at("zdh_n", "zdh")).otherwise(values["zone_hour_mean"])
        for name in ("hour", "day_of_week", "is_weekend", "is_holiday", "hour_sin", "hour_cos", "dow_sin", "dow_cos"):
            values[name] = known[name]
        value = floor_zero(model.column(values.__getitem__))

        def moved(p: Column) -> Column:
            add = lambda part, name, x: F.transform(acc[part], lambda v, i: F.when(i == known[name], v + x).otherwise(v)).alias(part)
            return F.struct(
                F.concat(F.slice(history, 2, RECURSIVE_LOOK_BACK - 1), F.array(p)).alias("history"),
                *[c for name in sizes for c in (add(f"{name}_sum", name, p), add(f"{name}_n", name, F.lit(1.0)))],
                F.concat(acc["out"], F.array(p)).alias("out"),
            )

        # The prediction is bound to a name, so that it is computed once.
        return F.transform(F.array(value), moved)[0]

    start = F.struct("history", *[f"{name}_{part}" for name in sizes for part in ("sum", "n")], F.array().cast("array<double>").alias("out"))
    steps = _steps(calendar, spark, day, hours).scalar()
    folded = state.withColumn("_steps", steps).select(ZONE_KEY, F.aggregate("_steps", start, step, lambda acc: acc["out"]).alias("out"))
    rows = folded.select(ZONE_KEY, F.posexplode("out").alias("ahead", "predicted"))
    time = _start(day) + F.make_dt_interval(hours=F.col("ahead"))
    return rows.select(ZONE_KEY, time.alias(TIME), F.hour(time).alias("hour"), "predicted")


def resolve_day(hourly: DataFrame, calendar: DataFrame, year: int, month: int, target: str | None = None, min_days: int = 5) -> DataFrame:
    """One row: the day to forecast with its holiday name, and the month's holiday candidate.

    Without a given day: the earliest Tuesday, Wednesday or Thursday from the 8th on (the last day
    of the month excluded) that is no holiday, has data and has data on at least ``min_days`` of
    the seven days before; else the 15th. Holiday: the first with that context, else the last of
    the month, else the 15th.
    """
    first = f"{year:04d}-{month:02d}-01"
    month_start = F.lit(first).cast("date")
    dates = hourly.select(F.to_date(TIME).alias("d")).filter(F.col("d").between(F.date_sub(month_start, 7), F.last_day(month_start))).distinct()
    holidays = calendar.select(F.to_date("date").alias("d"), "name").groupBy("d").agg(F.min("name").alias("name"))
    month_days = calendar.sparkSession.range(1).select(F.explode(F.sequence(F.date_sub(month_start, 7), F.last_day(month_start))).alias("d"))
    known = month_days.join(dates.withColumn("has_data", F.lit(1)), on="d", how="left").join(holidays, on="d", how="left")
    # At most 38 calendar days: one small ordered window.
    ordered = Window.partitionBy(F.lit(1)).orderBy("d").rowsBetween(-7, -1)
    days = known.withColumn("context", F.count("has_data").over(ordered)).filter(F.col("d") >= month_start)
    enough = F.col("context") >= min_days
    is_holiday = F.col("name").isNotNull()
    regular = (
        (F.dayofmonth("d") >= 8) & (F.col("d") < F.last_day(month_start)) & F.weekday("d").isin(1, 2, 3)
        & ~is_holiday & F.col("has_data").isNotNull() & enough
    )
    middle = F.lit(f"{year:04d}-{month:02d}-15").cast("date")
    picked = days.agg(
        F.coalesce(F.min(F.when(regular, F.col("d"))), middle).alias("regular_date"),
        F.coalesce(F.min(F.when(is_holiday & enough, F.col("d"))), F.max(F.when(is_holiday, F.col("d"))), middle).alias("holiday_date"),
    )
    chosen = F.lit(target).cast("date") if target else F.col("regular_date")
    named = picked.withColumn("target_date", chosen)
    labels = holidays.select(F.col("d").alias("target_date"), F.col("name").alias("holiday_name"))
    return named.join(labels, on="target_date", how="left").select(
        "target_date", F.coalesce("holiday_name", F.lit("")).alias("holiday_name"), "regular_date", "holiday_date"
    )
