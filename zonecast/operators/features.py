"""Feature columns shared by training and serving.

Meaning of the lags: they count back from the current row's ``trip_count`` (``lag_1h`` is the
hour before), and the target is the next hour. ``basis="target_demand"`` gives lags of the target
instead. Every window starts with the zone, so one shuffle by zone serves all of them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from zonecast import rules as fixed
from zonecast.functions.scalar import cyclic, safe_ratio, weekend_mon0
from zonecast.operators.demand import ZONE_KEY
from zonecast.operators.prep import split_column

TIME = "window_start"
LAGS = {"lag_1h": 1, "lag_2h": 2, "lag_3h": 3, "lag_24h": 24, "lag_168h": 168}
ROLLS = {"rolling_avg_3h": 3, "rolling_avg_6h": 6, "rolling_avg_24h": 24}


def _zone_order(*keys: str):
    return Window.partitionBy(ZONE_KEY, *keys).orderBy(TIME)


def add_calendar(df: DataFrame) -> DataFrame:
    """Hour, weekday in both conventions, month, weekend and the cyclic encodings.
    ``day_of_week`` counts from Monday = 0, as do the model inputs.
    """
    monday0 = F.weekday(TIME)
    hour, month = F.hour(TIME), F.month(TIME)
    out = df.withColumns(
        {
            "hour": hour, "day_of_week": monday0, "dow_mon0": monday0, "dow_sun1": F.dayofweek(TIME),
            "month": month, "is_weekend": weekend_mon0(monday0),
        }
    )
    for name, column, period in (("hour", hour, 24), ("dow", monday0, 7), ("month", month, 12)):
        sine, cosine = cyclic(column, period)
        out = out.withColumns({f"{name}_sin": sine, f"{name}_cos": cosine})
    return out


def add_holiday(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """``is_holiday`` from a table of dates; dates may repeat. The dates are few, so the planner
    broadcasts them by their size; no hint forces it.
    """
    days = calendar.select(F.to_date("date").alias("_day")).distinct().withColumn("_hit", F.lit(1))
    joined = df.withColumn("_day", F.to_date(TIME)).join(days, on="_day", how="left")
    return joined.withColumn("is_holiday", F.coalesce("_hit", F.lit(0))).drop("_day", "_hit")


def add_lags(df: DataFrame, basis: str = "trip_count", lags: Mapping[str, int] = LAGS, rolls: Mapping[str, int] = ROLLS) -> DataFrame:
    """Lags and means of the previous rows, 0 where there is no history."""
    order = _zone_order()
    columns: dict[str, Column] = {
        name: F.coalesce(F.lag(basis, n).over(order).cast("double"), F.lit(0.0)) for name, n in lags.items()
    }
    for name, n in rolls.items():
        columns[name] = F.coalesce(F.avg(basis).over(order.rowsBetween(-n, -1)), F.lit(0.0))
    return df.withColumns(columns)


def add_ewm(df: DataFrame, name: str, basis: str = "trip_count", alpha: float = 0.3) -> DataFrame:
    """Exponentially weighted mean of all previous rows of the zone, 0 where there are none; NULL values are passed over.

    One more row maps the weighted sum s to (1 - alpha) * s + x. Such maps are composed in blocks: a running sum inside a block, in which every
    value is scaled up by its place so that one factor brings all down again, and the end of the blocks before as a carry. A
    block is so long that its weights fall by 2 ** 60, the whole range of a double, so two blocks carry all there is. The work of a row
    does not depend on ``alpha``, no row holds an array, and all windows start with the zone.
    """
    if not 0.0 < alpha < 1.0:
        raise ValueError("alpha lies between 0 and 1")
    fall = -math.log1p(-alpha)
    size = math.ceil(60 * math.log(2.0) / fall)
    order = _zone_order()
    x = F.coalesce(F.col(basis).cast("double"), F.lit(0.0))
    rows = df.withColumn("_n", F.count(basis).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    at = F.greatest(F.col("_n") - 1, F.lit(0))
    rows = rows.withColumns({"_block": F.floor(at / size), "_place": (at % size).cast("double")})
    inside = Window.partitionBy(ZONE_KEY, "_block").orderBy(TIME).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_sum", F.sum(x * F.exp(F.col("_place") * fall)).over(inside) * F.exp(F.col("_place") * -fall))
    blocks = Window.partitionBy(ZONE_KEY).orderBy("_block")
    ends = [F.max(F.when(F.col("_place") == size - 1, F.col("_sum"))).over(blocks.rangeBetween(-b, -b)) for b in (1, 2)]
    carry = F.coalesce(ends[0], F.lit(0.0)) + F.coalesce(ends[1], F.lit(0.0)) * math.exp(-size * fall)
    rows = rows.withColumn("_sum", F.col("_sum") + F.exp((F.col("_place") + 1.0) * -fall) * carry)
    weight = -F.expm1(F.col("_n") * -fall) / alpha
    mean = F.lag(F.try_divide("_sum", weight)).over(order)
    return rows.withColumn(name, F.coalesce(mean, F.lit(0.0))).drop("_n", "_block", "_place", "_sum")


def add_extras(df: DataFrame, basis: str = "trip_count", alpha: float = 0.3) -> DataFrame:
    """Rolling maxima, relative change and an exponentially weighted mean of all previous rows."""
    order = _zone_order()
    out = df.withColumns(
        {
            "rolling_max_3h": F.coalesce(F.max(basis).over(order.rowsBetween(-3, -1)).cast("double"), F.lit(0.0)),
            "rolling_max_6h": F.coalesce(F.max(basis).over(order.rowsBetween(-6, -1)).cast("double"), F.lit(0.0)),
            "demand_pct_ch1h": (F.col("lag_1h") - F.col("lag_2h")) / (F.col("lag_2h") + 1.0),
        }
    )
    return add_ewm(out, "ewm_alpha03", basis, alpha)


def _earlier_mean(value: str, at_least: int, *keys: str) -> Column:
    """Mean of the earlier rows of the same zone (and keys), NULL with fewer than ``at_least``."""
    frame = _zone_order(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return F.when(F.count(value).over(frame) >= at_least, F.avg(value).over(frame))


def add_zone_baselines(df: DataFrame, value: str = "target_demand") -> DataFrame:
    """Main-model baselines: zone and hour (5 earlier rows), zone, weekday and hour (3)."""
    zone_hour = F.coalesce(_earlier_mean(value, 5, "hour"), F.col("rolling_avg_24h"), F.lit(0.0))
    out = df.withColumn("zone_hour_mean", zone_hour)
    zone_dow_hour = F.coalesce(_earlier_mean(value, 3, "day_of_week", "hour"), F.col("zone_hour_mean"), F.lit(0.0))
    return out.withColumn("zone_dow_hour_mean", zone_dow_hour)


def hour_means_before(df: DataFrame, value: str = "target_demand") -> DataFrame:
    """Per time slot: the mean over all zones of the same hour of day at strictly earlier times.

    Slots are aggregated first (one row per slot), so the running sums run over slots, not rows.
    """
    slots = df.groupBy(TIME).agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    order = Window.partitionBy(F.hour(TIME)).orderBy(TIME).rowsBetween(Window.unboundedPreceding, -1)
    return slots.select(TIME, F.try_divide(F.sum("s").over(order).cast("double"), F.sum("n").over(order)).alias("_hour_mean"))


def with_hour_means(df: DataFrame, source: DataFrame, value: str = "target_demand") -> DataFrame:
    """Adds ``_hour_mean``. To be joined before the zone windows, so that a shuffle for the join
    does not undo the partitioning by zone.
    """
    return df.join(hour_means_before(source, value), on=TIME, how="left")


def train_mean(df: DataFrame, value: str = "target_demand", ratio: float = fixed.TRAIN_RATIO) -> DataFrame:
    """One row: the mean over the training part of the time range."""
    return df.withColumn("_split", split_column(df, ratio)).filter(F.col("_split") == "train").agg(F.avg(value).alias("m"))


def add_specialist_baselines(df: DataFrame, value: str = "target_demand", source: DataFrame | None = None) -> DataFrame:
    """Expanding zone, zone-hour and hour means of earlier rows, and their blend.

    Without history the zone mean falls back to the mean of the training period (never later rows).
    ``source`` is the stored table with the same rows, read for the means over all zones.
    """
    source = df if source is None else source
    overall = F.coalesce(train_mean(source, value).scalar(), F.lit(0.0))
    if "_hour_mean" not in df.columns:
        df = with_hour_means(df, source, value)
    out = df.withColumn("_overall", overall)
    out = out.withColumn("zone_mean", F.coalesce(_earlier_mean(value, 1), F.col("_overall")))
    out = out.withColumn("zone_hour_mean", F.coalesce(_earlier_mean(value, 1, "hour"), F.col("zone_mean")))
    out = out.withColumn("hour_mean", F.coalesce("_hour_mean", F.col("_overall"))).drop("_hour_mean", "_overall")
    return out.withColumn("baseline_blend", F.lit(0.70) * F.col("zone_hour_mean") + F.lit(0.30) * F.col("hour_mean"))


def _with_sql(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Columns given as SQL text over the existing ones."""
    return df.withColumns({name: F.expr(text) for name, text in columns.items()})


def hour_flags(df: DataFrame, bounds: Mapping[str, tuple[int, int]] = fixed.HOUR_FLAGS) -> DataFrame:
    return _with_sql(df, {name: f"CAST(hour BETWEEN {lo} AND {hi} AS INT)" for name, (lo, hi) in bounds.items()})


def serving_flags(df: DataFrame) -> DataFrame:
    """The serving bounds, and the flag of either peak."""
    out = hour_flags(df, fixed.SERVING_HOUR_FLAGS)
    return out.withColumn("is_peak", F.greatest("is_morning_peak", "is_evening_peak"))


def add_regime(df: DataFrame) -> DataFrame:
    """Hour flags, ratios, momentum, growth and acceleration of the main model."""
    out = hour_flags(df).withColumns(
        {
            "lag_ratio_1h_24h": safe_ratio("lag_1h", F.col("lag_24h") + 1),
            "lag_ratio_3h_24h": safe_ratio("lag_3h", F.col("lag_24h") + 1),
            "rolling_ratio_3h_24h": safe_ratio("rolling_avg_3h", F.col("rolling_avg_24h") + 1),
        }
    )
    out = _with_sql(
        out,
        {
            "lag_diff_1h_24h": "lag_1h - lag_24h",
            "growth_1h": "lag_1h - lag_2h",
            "growth_2h": "lag_2h - lag_3h",
            "growth_3h": "lag_1h - lag_3h",
            "growth_6h": "lag_1h - rolling_avg_6h",
            "growth_24h": "lag_1h - lag_24h",
            "growth_168h": "lag_1h - lag_168h",
            "prev_1h_growth": "lag_1h - lag_2h",
            "prev_2h_growth": "lag_2h - lag_3h",
            "prev_3h_growth": "lag_1h - lag_3h",
            "prev_day_growth_24_168": "lag_24h - lag_168h",
        },
    )
    return _with_sql(
        _with_sql(out, {"acceleration_1h": "growth_1h - growth_2h", "acceleration_3h": "growth_3h - prev_day_growth_24_168"}),
        {
            "ramp_momentum": "is_ramp_up_05_08 * (0.55D * prev_1h_growth + 0.25D * prev_2h_growth + 0.20D * prev_day_growth_24_168)",
            "night_decay_signal": "(is_post_midnight + is_late_drop_23) * (lag_1h - rolling_avg_24h)",
            "ramp_growth_signal": "is_ramp_up_05_08 * (0.50D * growth_1h + 0.30D * acceleration_1h + 0.20D * growth_24h)",
            "peak_growth_signal": "(is_morning_peak + is_evening_peak) * (0.60D * growth_1h + 0.25D * growth_3h + 0.15D * growth_168h)",
            "night_over_signal": "(is_late_night + is_late_drop_23) * (lag_1h - zone_hour_mean)",
        },
    )


def _gaps(df: DataFrame) -> DataFrame:
    """Columns both specialists derive from lags and the blended baseline."""
    return _with_sql(
        df,
        {
            "lag_ratio_1h_24h": "(lag_1h + 1) / (lag_24h + 1)",
            "lag_diff_1h_24h": "lag_1h - lag_24h",
            "rolling_ratio_3h_24h": "(rolling_avg_3h + 1) / (rolling_avg_24h + 1)",
            "momentum_1h_2h": "lag_1h - lag_2h",
            "momentum_1h_3h": "lag_1h - lag_3h",
            "baseline_gap_1h": "lag_1h - baseline_blend",
            "baseline_gap_24h": "lag_24h - baseline_blend",
            "baseline_ratio_1h": "(lag_1h + 1) / (baseline_blend + 1)",
            "baseline_ratio_24h": "(lag_24h + 1) / (baseline_blend + 1)",
        },
    )


def add_low_hour(df: DataFrame) -> DataFrame:
    """Columns of the 00-09 model."""
    is_hour = {f"is_{h:02d}": f"CAST(hour = {h} AS INT)" for h in fixed.HOUR_BUCKETS["00_09"]}
    out = _with_sql(
        _gaps(df),
        is_hour
        | {
            "night_order": "CASE WHEN hour <= 9 THEN hour ELSE -1 END",
            "is_deep_night": "CAST(hour BETWEEN 0 AND 2 AS INT)",
            "is_pre_ramp": "CAST(hour BETWEEN 3 AND 4 AS INT)",
            "is_morning_ramp": "CAST(hour BETWEEN 5 AND 9 AS INT)",
            "is_ramp_low": "CAST(hour BETWEEN 3 AND 4 AS INT)",
            "ramp_strength": "least(greatest((hour - 2) / 2.0D, 0D), 1D)",
            "morning_ramp_strength": "CASE WHEN hour <= 9 THEN least(greatest((hour - 2) / 7.0D, 0D), 1D) ELSE 0D END",
        },
    )
    return _with_sql(
        out,
        {
            "pre_ramp_gap": "baseline_gap_1h * is_pre_ramp",
            "morning_gap_1h": "baseline_gap_1h * is_morning_ramp",
            "ramp_baseline_signal": "baseline_blend * ramp_strength",
        },
    )


def add_evening(df: DataFrame) -> DataFrame:
    """Columns of the 17-23 model."""
    is_hour = {f"is_h{h}": f"CAST(hour = {h} AS INT)" for h in fixed.EVENING_HOURS}
    out = _with_sql(
        _gaps(df),
        is_hour
        | {
            "evening_slot": "CASE WHEN hour >= 17 THEN hour - 17 ELSE -1 END",
            "is_evening_segment_early": "CAST(hour BETWEEN 17 AND 19 AS INT)",
            "is_evening_segment_late": "CAST(hour BETWEEN 21 AND 23 AS INT)",
            "evening_decay": "CASE WHEN hour >= 17 THEN (23 - hour) / 6.0D ELSE 0D END",
            "decline_2h_to_1h": "greatest(lag_2h - lag_1h, 0D)",
        },
    )
    out = _with_sql(out, {"decline_ratio_2h_to_1h": "decline_2h_to_1h / (lag_2h + 1)"})
    return _with_sql(
        out,
        {
            "evening_baseline_gap": "baseline_gap_1h * is_evening_segment_late",
            "late_decline_signal": "decline_ratio_2h_to_1h * is_evening_segment_late",
        },
    )


def add_aliases(df: DataFrame, aliases: Mapping[str, str] = fixed.SERVING_ALIASES) -> DataFrame:
    """Other names of existing columns."""
    out = df.withColumns({name: F.col(source) for name, source in aliases.items() if source in df.columns})
    three_day = F.col("rolling_avg_3h") - F.col("rolling_avg_24h")
    return out.withColumns({"lag_diff_3h_24h": three_day, "lag_3h_diff_24h": three_day, "momentum_3h_24h": three_day})


def project(df: DataFrame, features: Sequence[str], missing: str = "zero", keep: Sequence[str] = ()) -> DataFrame:
    """Model input columns in order. Absent ones are 0 (``"zero"``) or left out (``"drop"``)."""
    have = set(df.columns)
    columns = [F.col(k) for k in keep]
    for name in features:
        if name in keep:
            continue
        if name in have:
            columns.append(F.col(name))
        elif missing == "zero":
            columns.append(F.lit(0).alias(name))
    return df.select(columns)


def base_features(gold: DataFrame, calendar: DataFrame, basis: str = "trip_count", hour_means: bool = False) -> DataFrame:
    """Calendar, holiday, lags and rolling means on the Gold table.

    Joins come before the windows: if the planner has to shuffle for one, the rows are still
    partitioned by zone only once.
    """
    rows = add_calendar(gold.select(ZONE_KEY, TIME, "trip_count", "target_demand"))
    if hour_means:
        rows = with_hour_means(rows, gold)
    return add_lags(add_holiday(rows, calendar), basis)


def main_features(gold: DataFrame, calendar: DataFrame, basis: str = "trip_count") -> DataFrame:
    return add_regime(add_zone_baselines(base_features(gold, calendar, basis)))


def specialist_features(gold: DataFrame, calendar: DataFrame, kind: str, basis: str = "trip_count") -> DataFrame:
    """Features of the ``low_hour`` or ``evening`` model on their hours.

    ``gold`` feeds several branches (means by slot, the training mean): pass a written table.
    """
    base = add_specialist_baselines(base_features(gold, calendar, basis, hour_means=True), source=gold)
    if kind == "low_hour":
        return add_low_hour(base).filter(F.col("hour") <= 9)
    if kind == "evening":
        return add_evening(base).filter(F.col("hour") >= 17)
    raise ValueError(f"unknown kind: {kind}")


def sequences(df: DataFrame, columns: Sequence[str], look_backs: Mapping[str, int], keep: Sequence[str] = ()) -> DataFrame:
    """The previous n rows of the zone as an array per look-back, for rows with unbroken history.

    A row qualifies if the row n places before it is exactly n hours older, so gaps and filtered
    hours do not pass. Columns are projected before collecting; the array length is fixed by n.
    """
    order = _zone_order()
    longest = max(look_backs.values())
    item = F.struct(*[F.col(c).cast("double").alias(c) for c in columns])
    out = df.withColumn("_first", F.lag(TIME, longest).over(order))
    # One array is collected; a row that qualifies has it whole, so the shorter ones are its ends.
    out = out.withColumn("_all", F.collect_list(item).over(order.rowsBetween(-longest, -1)))
    unbroken = F.col("_first") == F.col(TIME) - F.expr(f"INTERVAL '{longest}' HOUR")
    arrays = [F.slice("_all", -n, n).alias(name) for name, n in look_backs.items()]
    return out.filter(unbroken).select(ZONE_KEY, TIME, *keep, *arrays)


def lag_shift_check(df: DataFrame) -> DataFrame:
    """Mean |target − next row's lag_1h| within a zone; near 0 means the lag shows the target."""
    following = F.lead("lag_1h").over(_zone_order())
    return df.select(F.abs(F.col("target_demand") - following).alias("d")).agg(F.avg("d").alias("mean_diff"))
