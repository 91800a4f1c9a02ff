"""Calibration factors fitted on validation rows, and their application.

Every fitted table has one row per combination of hour, weekday and flags, so at most 24 × 7 × 4
rows whatever the data size; that bound is why these tables, and no others, are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from zonecast import rules as fixed
from zonecast.functions.scalar import clip, floor_zero
from zonecast.functions.stats import exact_quantiles
from zonecast.operators.metrics import mape, wape

NIGHT_LEVELS = [("holiday_weekend_hour", ["is_holiday", "is_weekend", "hour"]), ("weekend_hour", ["is_weekend", "hour"]), ("hour", ["hour"])]
FLAG_KEYS = ["is_holiday", "is_weekend", "hour"]


def _yp() -> tuple[Column, Column]:
    return F.col("actual").cast("double"), F.col("predicted").cast("double")


def night_factors(val: DataFrame, min_rows: int = 30, alpha: float = 120.0) -> DataFrame:
    """Shrunken median ratio (actual + 1) / (predicted + 1) for hours 0-4 on three key levels.

    Keys a level does not use are −1. Medians are exact and computed from distributed histograms.
    """
    y, p = _yp()
    night = val.filter(F.col("hour").isin(fixed.NIGHT_HOURS)).withColumn("_ratio", (y + 1.0) / (p + 1.0))
    copies = [
        F.struct(F.lit(level).alias("level"), *[(F.col(k).cast("int") if k in keys else F.lit(-1)).alias(k) for k in FLAG_KEYS])
        for level, keys in NIGHT_LEVELS
    ]
    expanded = night.select("_ratio", F.explode(F.array(*copies)).alias("k")).select("_ratio", "k.*")
    medians = exact_quantiles(expanded, "_ratio", {"raw_ratio": 0.5}, keys=["level", *FLAG_KEYS])
    n = F.col("n")
    factor = clip(F.lit(1.0) + n / (n + F.lit(alpha)) * (F.col("raw_ratio") - 1.0), 0.75, 1.45)
    return medians.filter(n >= min_rows).select("level", *FLAG_KEYS, "n", "raw_ratio", factor.alias("factor"))


def apply_night(df: DataFrame, factors: DataFrame, predicted: str = "predicted") -> DataFrame:
    """Most specific factor first (flags and hour, weekend and hour, hour), otherwise 1."""
    out = df
    found = []
    for i, (level, keys) in enumerate(NIGHT_LEVELS):
        name = f"_f{i}"
        part = factors.filter(F.col("level") == level).select(*keys, F.col("factor").alias(name))
        out = out.join(F.broadcast(part), on=keys, how="left")
        found.append(F.col(name))
    factor = F.coalesce(*found, F.lit(1.0))
    return out.withColumn(predicted, floor_zero(F.col(predicted) * factor)).select(*df.columns)


def night_gate(val: DataFrame, factors: DataFrame) -> DataFrame:
    """One row: errors before and after, and whether the factors are worth using.

    They are switched off if both night errors rise, or the overall MAPE rises by over 0.25.
    """
    night = F.col("hour").isin(fixed.NIGHT_HOURS)

    def errors(df: DataFrame, prefix: str) -> DataFrame:
        return df.withColumn("_night", night).groupBy("_night").agg(
            mape(None).alias("m"), wape(1.0).alias("w"), F.count(F.lit(1)).alias("n")
        ).agg(
            (F.sum(F.col("m") * F.col("n")) / F.sum("n")).alias(f"{prefix}_mape"),
            F.max(F.when(F.col("_night"), F.col("m"))).alias(f"{prefix}_night_mape"),
            F.max(F.when(F.col("_night"), F.col("w"))).alias(f"{prefix}_night_wape"),
        )

    raw, cal = errors(val, "raw"), errors(apply_night(val, factors), "cal")
    cal_row = cal.select(F.struct("*").alias("c")).scalar()
    out = raw.withColumn("_c", cal_row).select("*", "_c.*").drop("_c")
    worse_night = (F.col("cal_night_mape") > F.col("raw_night_mape")) & (F.col("cal_night_wape") > F.col("raw_night_wape"))
    worse = F.coalesce(worse_night, F.lit(False)) | (F.col("cal_mape") > F.col("raw_mape") + 0.25)
    return out.withColumn("enabled", ~worse)


def ratio_factors(val: DataFrame, keys: Sequence[str], low: float, high: float) -> DataFrame:
    """Σactual / Σpredicted per key, clipped; 1 where either sum is (almost) zero."""
    y, p = _yp()
    t, s = F.sum(y), F.sum(p)
    factor = F.when((t <= 1e-6) | (s <= 1e-6), F.lit(1.0)).otherwise(clip(F.try_divide(t, s), low, high))
    return val.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), factor.alias("factor"))


def hour_factors(val: DataFrame) -> DataFrame:
    return ratio_factors(val, ["hour"], 0.55, 1.45)


def dow_hour_factors(val: DataFrame) -> DataFrame:
    return ratio_factors(val, ["day_of_week", "hour"], 0.45, 1.65)


def evening_factors(val: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hour factors and weekday-hour factors of hours 17-23."""
    evening = val.filter(F.col("hour") >= 17)
    return ratio_factors(evening, ["hour"], 0.75, 1.25), ratio_factors(evening, ["day_of_week", "hour"], 0.70, 1.30)


def hour_bias(val: DataFrame) -> DataFrame:
    """Exact median residual of the critical hours, within ±1200."""
    y, p = _yp()
    critical = val.filter(F.col("hour").isin(fixed.CRITICAL_HOURS)).select("hour", (y - p).alias("_residual"))
    medians = exact_quantiles(critical, "_residual", {"median": 0.5}, keys=["hour"])
    return medians.select("hour", clip("median", -1200.0, 1200.0).alias("bias"))


def hour_affine(val: DataFrame, min_rows: int = 16) -> DataFrame:
    """Least-squares line actual ≈ a · predicted + b per critical hour; both bounded."""
    y, p = _yp()
    fit = val.filter(F.col("hour").isin(fixed.CRITICAL_HOURS)).groupBy("hour").agg(
        F.count(F.lit(1)).alias("n"), F.avg(y).alias("my"), F.avg(p).alias("mp"),
        F.covar_pop(p, y).alias("cov"), F.var_pop(p).alias("var"),
    )
    a = F.when(F.col("var") < 1e-9, F.lit(1.0)).otherwise(F.try_divide("cov", "var"))
    return fit.filter(F.col("n") >= min_rows).select(
        "hour", clip(a, 0.70, 1.20).alias("a"), clip(F.col("my") - a * F.col("mp"), -1500.0, 1500.0).alias("b")
    )


def apply_hour_calibration(
    df: DataFrame, hours: DataFrame, dow_hours: DataFrame, bias: DataFrame, affine: DataFrame, predicted: str = "predicted"
) -> DataFrame:
    """The line where a critical hour has one; otherwise the weekday-hour factor (or, if that is
    missing or 1, the hour factor) plus the bias. Never below 0.
    """
    out = (
        df.join(F.broadcast(affine.select("hour", F.col("a").alias("_a"), F.col("b").alias("_b"))), on="hour", how="left")
        .join(F.broadcast(dow_hours.select("day_of_week", "hour", F.col("factor").alias("_dh"))), on=["day_of_week", "hour"], how="left")
        .join(F.broadcast(hours.select("hour", F.col("factor").alias("_h"))), on="hour", how="left")
        .join(F.broadcast(bias.select("hour", F.col("bias").alias("_bias"))), on="hour", how="left")
    )
    p = F.col(predicted)
    specific = F.when(F.col("_dh") != 1.0, F.col("_dh"))
    factor = F.coalesce(specific, F.col("_h"), F.lit(1.0))
    shifted = p * factor + F.coalesce("_bias", F.lit(0.0))
    value = F.when(F.col("_a").isNotNull(), F.col("_a") * p + F.col("_b")).otherwise(shifted)
    return out.withColumn(predicted, floor_zero(value)).select(*df.columns)


def apply_evening(
    df: DataFrame, hours: DataFrame, dow_hours: DataFrame, late: DataFrame | None = None, predicted: str = "predicted"
) -> DataFrame:
    """Weekday-hour factor (else hour factor) plus the late bias.

    ``late``: hour, factor, bias; its factor replaces the hour factor.
    """
    p = F.col(predicted)
    out = df.join(F.broadcast(dow_hours.select("day_of_week", "hour", F.col("factor").alias("_dh"))), on=["day_of_week", "hour"], how="left")
    out = out.join(F.broadcast(hours.select("hour", F.col("factor").alias("_h"))), on="hour", how="left")
    names = [F.col("_dh"), F.col("_h")]
    bias = F.lit(0.0)
    if late is not None:
        out = out.join(F.broadcast(late.select("hour", F.col("factor").alias("_lf"), F.col("bias").alias("_lb"))), on="hour", how="left")
        names.insert(1, F.col("_lf"))
        bias = F.coalesce("_lb", F.lit(0.0))
    out = out.withColumn(predicted, floor_zero(p * F.coalesce(*names, F.lit(1.0)) + bias))
    return out.select(*df.columns)


def apply_weekend(df: DataFrame, weekend: DataFrame, predicted: str = "predicted", out: str = "predicted") -> DataFrame:
    """Factor and bias of weekend late hours; ``weekend``: day_of_week, hour, factor, bias.

    They belong to predictions that are calibrated already: fit them on such rows.
    """
    w = weekend.select("day_of_week", "hour", F.col("factor").alias("_wf"), F.col("bias").alias("_wb"))
    p = F.col(predicted)
    joined = df.join(F.broadcast(w), on=["day_of_week", "hour"], how="left")
    adjusted = F.when(F.col("_wf").isNull(), p).otherwise(floor_zero(p * F.col("_wf") + F.col("_wb")))
    return joined.withColumn(out, adjusted).select(*dict.fromkeys([*df.columns, out]))


def inverse_mae_weights(val: DataFrame, predictions: Sequence[str]) -> DataFrame:
    """One row with a weight per prediction column: (1 / MAE) over the sum of these."""
    y = F.col("actual").cast("double")
    errors = val.agg(*[F.avg(F.abs(y - F.col(c))).alias(c) for c in predictions])
    total = sum((F.lit(1.0) / F.col(c) for c in predictions[1:]), F.lit(1.0) / F.col(predictions[0]))
    return errors.select(*[(F.lit(1.0) / F.col(c) / total).alias(f"w_{c}") for c in predictions])


def apply_weights(df: DataFrame, weights: DataFrame, predictions: Sequence[str], out: str = "predicted") -> DataFrame:
    w = weights.select(F.struct(*[f"w_{c}" for c in predictions]).alias("w")).scalar()
    blended = sum((F.col("_w")[f"w_{c}"] * F.col(c) for c in predictions[1:]), F.col("_w")[f"w_{predictions[0]}"] * F.col(predictions[0]))
    return df.withColumn("_w", w).withColumn(out, blended).drop("_w")


def improvement(val: DataFrame, base: str, other: str, ratio: float = 1.0) -> DataFrame:
    """One row: WAPE of two prediction columns and whether the other beats ``ratio`` × base.

    Used to keep a weekend adjustment (ratio 1) or a residual correction (0.995) only if it helps.
    """
    y = F.col("actual").cast("double")
    score = lambda c: F.sum(F.abs(y - F.col(c))) / F.greatest(F.sum(y), F.lit(1.0)) * 100
    scores = val.agg(score(base).alias("wape_base"), score(other).alias("wape_other"))
    better = F.col("wape_other") < F.col("wape_base") * F.lit(float(ratio))
    return scores.withColumn("enabled", F.coalesce(better, F.lit(False)))


def choose(df: DataFrame, gate: DataFrame, base: str, other: str, out: str = "predicted") -> DataFrame:
    """The other column if the gate is open, else the base column."""
    return df.withColumn(out, F.when(gate.select("enabled").scalar(), F.col(other)).otherwise(F.col(base)))
