"""Turning model outputs into final predictions: gates, blends, corrections and caps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from zonecast import rules as fixed
from zonecast.functions.scalar import clip, floor_zero


def _param(params: Mapping[str, float] | Column, name: str, default: float) -> Column:
    if isinstance(params, Column):
        return params[name]
    return F.lit(float(params.get(name, default)))


def zero_inflated(df: DataFrame, params: Mapping[str, float] | Column, out: str = "predicted") -> DataFrame:
    """prob × intensity, zero below the regime's threshold, blended with the baseline in hours
    3-4 and from 5 on, capped by a multiple of the zone-hour mean, floored.

    ``params`` is a mapping, or a struct column (a subquery) with every parameter. One projection.
    """
    hour = F.col("hour")
    default = fixed.ZERO_INFLATED_DEFAULTS
    get = lambda name: _param(params, name, default[name])
    by_regime = lambda name: F.when(hour <= 2, get(f"{name}_deep")).when(hour <= 4, get(f"{name}_ramp")).otherwise(get(f"{name}_morning"))
    gated = F.when(F.col("prob") < by_regime("threshold"), F.lit(0.0)).otherwise(F.col("prob") * clip("intensity", 0.0, None))
    alpha = F.when(hour.isin(3, 4), get("ramp_blend_alpha")).when(hour >= 5, get("morning_blend_alpha")).otherwise(F.lit(0.0))
    blended = F.when(alpha > 0, (F.lit(1.0) - alpha) * gated + alpha * F.col("baseline_blend")).otherwise(gated)
    cap = F.greatest(F.col("zone_hour_mean") * by_regime("cap_mult") + by_regime("cap_bias"), F.lit(0.0))
    return df.withColumn(out, F.greatest(F.least(blended, cap), get("min_floor"), F.lit(0.0)))


def residual_correction(df: DataFrame, delta: str, predicted: str = "predicted") -> DataFrame:
    """Late-hour correction, limited to a fifth of the prediction (at least 3) and to ±8."""
    p = F.col(predicted)
    limit = F.greatest(F.lit(0.20) * p, F.lit(3.0))
    bounded = clip(clip(delta, -limit, limit), -8.0, 8.0)
    late = F.col("hour").isin(fixed.LATE_HOURS) & F.col(delta).isNotNull()
    return df.withColumn(predicted, F.when(late, floor_zero(p + bounded)).otherwise(p))


def expert_blend(df: DataFrame, expert: str, weight: float | Column, predicted: str = "predicted") -> DataFrame:
    """Mix of an expert model on Sunday late hours, where it says something."""
    w = weight if isinstance(weight, Column) else F.lit(float(weight))
    rows = (F.col("day_of_week") == 6) & F.col("hour").isin(fixed.WEEKEND_LATE_HOURS) & F.col(expert).isNotNull()
    p = F.col(predicted)
    return df.withColumn(predicted, F.when(rows, (F.lit(1.0) - w) * p + w * floor_zero(expert)).otherwise(p))


def evening_caps(df: DataFrame, params: Mapping[str, float] = fixed.EVENING_POST, predicted: str = "predicted") -> DataFrame:
    """Late blend with the baseline, then caps by the zone-hour mean."""
    late = F.col("hour").isin(fixed.WEEKEND_LATE_HOURS)
    p = F.col(predicted)
    a = float(params.get("blend_alpha_late", 0.0))
    blended = F.when(late, F.lit(1.0 - a) * p + F.lit(a) * F.col("baseline_blend")).otherwise(p)
    mean = F.col("zone_hour_mean")
    cap = F.when(late, mean * params["cap_mult_late"] + params["cap_bias_late"]).otherwise(
        mean * params["cap_mult_evening"] + params["cap_bias_evening"]
    )
    return df.withColumn(predicted, floor_zero(F.least(blended, F.greatest(cap, F.lit(0.0)))))


def bucket_expectation(
    df: DataFrame, probabilities: str, values: list[float], zero_gate_early: float = 1.10, zero_gate_late: float = 1.10,
    blend: float = 0.0, caps: Mapping[str, float] | None = None, out: str = "predicted",
) -> DataFrame:
    """Expected value of a demand-bucket distribution (array column), with a gate on the
    zero bucket, a late blend with the baseline and caps.
    """
    caps = caps or {}
    hour = F.col("hour")
    late = hour.isin(fixed.WEEKEND_LATE_HOURS)
    level = F.array(*[F.lit(float(v)) for v in values])
    terms = F.zip_with(F.col(probabilities), level, lambda p, v: p * v)
    expected = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    gate = F.when(hour <= 19, zero_gate_early).otherwise(zero_gate_late)
    gated = F.when(F.col(probabilities)[0] >= gate, F.lit(0.0)).otherwise(expected)
    blended = F.when(late & F.lit(blend > 0), F.lit(1.0 - blend) * gated + F.lit(blend) * F.col("baseline_blend")).otherwise(gated)
    mean = F.col("zone_hour_mean")
    cap = F.when(late, mean * caps.get("cap_mult_late", 999.0) + caps.get("cap_bias_late", 0.0)).otherwise(
        mean * caps.get("cap_mult_evening", 999.0) + caps.get("cap_bias_evening", 0.0)
    )
    return df.withColumn(out, floor_zero(F.least(blended, F.greatest(cap, F.lit(0.0)))))


def route_by_hour(df: DataFrame, main: str, low: str | None, evening: str | None, out: str = "predicted") -> DataFrame:
    """Hours 00-09 from the low-hour model, 17-23 from the evening model, the rest from the main
    one; a missing or NULL specialist leaves its hours to the main model.
    """
    hour = F.col("hour")
    value = F.col(main)
    name = F.lit("main")
    if evening:
        use = (hour >= 17) & F.col(evening).isNotNull()
        value, name = F.when(use, F.col(evening)).otherwise(value), F.when(use, "evening").otherwise(name)
    if low:
        use = (hour <= 9) & F.col(low).isNotNull()
        value, name = F.when(use, F.col(low)).otherwise(value), F.when(use, "low_hour").otherwise(name)
    return df.withColumns({out: value, "model_used": name})
