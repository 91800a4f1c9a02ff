"""Forecast metrics as aggregates over (actual, predicted) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from zonecast import rules as fixed
from zonecast.functions.scalar import clip, huber, pinball, py_round
from zonecast.functions.stats import exact_quantiles, percentiles_of_counts, running_totals, value_histogram


def _yp() -> tuple[Column, Column]:
    return F.col("actual").cast("double"), F.col("predicted").cast("double")


def mae() -> Column:
    y, p = _yp()
    return F.avg(F.abs(y - p))


def rmse() -> Column:
    y, p = _yp()
    return F.sqrt(F.avg((y - p) * (y - p)))


def r2() -> Column:
    """1 − Σe² / Σ(y − ȳ)²; NULL for a constant actual."""
    y, p = _yp()
    return F.lit(1.0) - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y))


def mape(floor: float | None = None) -> Column:
    """Mean absolute percentage error; the denominator is max(actual, floor), or for no floor
    the actual with 0 read as 1.
    """
    y, p = _yp()
    den = F.when(y == 0, F.lit(1.0)).otherwise(y) if floor is None else F.greatest(y, F.lit(float(floor)))
    return F.avg(F.abs((y - p) / den)) * 100


def wape(floor: float | None = 1.0) -> Column:
    """Σ|e| / Σactual in percent; the denominator is bounded below by ``floor`` if given."""
    y, p = _yp()
    den = F.sum(y) if floor is None else F.greatest(F.sum(y), F.lit(float(floor)))
    return F.try_divide(F.sum(F.abs(y - p)), den) * 100


def smape(kind: str = "half") -> Column:
    """Symmetric error in percent. ``half``: mean of the two as denominator, 0 read as 1;
    ``floor``: sum of the two, at least 1e-9; ``shift``: sum of the two plus 1e-5.
    """
    y, p = _yp()
    total = F.abs(y) + F.abs(p)
    if kind == "half":
        half = total / 2.0
        return F.avg(F.abs(y - p) / F.when(half == 0, F.lit(1.0)).otherwise(half)) * 100
    if kind == "floor":
        return F.avg(F.lit(2.0) * F.abs(y - p) / F.greatest(total, F.lit(1e-9))) * 100
    if kind == "shift":
        return F.avg(F.lit(2.0) * F.abs(y - p) / (total + F.lit(1e-5))) * 100
    raise ValueError(f"unknown kind: {kind}")


def metric_columns(mape_floor: float | None = 1.0, wape_floor: float | None = 1.0) -> dict[str, Column]:
    return {"mae": mae(), "rmse": rmse(), "r2": r2(), "mape": mape(mape_floor), "wape": wape(wape_floor), "smape": smape("half")}


def evaluate(df: DataFrame, keys: Sequence[str] = (), **options) -> DataFrame:
    """Standard metrics per group, one aggregate."""
    columns = metric_columns(**options)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in columns.items()])


def peak_mape(df: DataFrame, keys: Sequence[str] = (), prob: float = 0.75) -> DataFrame:
    """MAPE over rows whose actual exceeds the group's percentile (actuals are hourly counts)."""
    cut = df.groupBy(*keys).agg(percentiles_of_counts(F.col("actual").cast("double"), [prob])[0].alias("_cut"))
    y, p = _yp()
    if keys:
        peaks = df.join(cut, on=list(keys))
    else:
        peaks = df.withColumn("_cut", cut.select("_cut").scalar())
    peaks = peaks.filter(y > F.col("_cut"))
    error = F.abs((y - p) / F.when(y == 0, F.lit(1.0)).otherwise(y))
    return peaks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_peak"), (F.avg(error) * 100).alias("peak_mape"))


def segment_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Metrics plus over-, under- and exact-prediction rates and signed bias per segment."""
    floored = df.withColumn("predicted", clip(F.col("predicted").cast("double"), 0.0, None))
    y, p = _yp()
    share = lambda condition: F.avg(condition.cast("double"))
    columns = metric_columns()
    return floored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[c.alias(n) for n, c in columns.items()],
        share(p > y).alias("over_pred_rate"),
        share(p < y).alias("under_pred_rate"),
        share(p == y).alias("equal_pred_rate"),
        F.avg(p - y).alias("mean_signed_error"),
    )


def named_segments(df: DataFrame) -> DataFrame:
    """A row may lie in several segments (part of day, holiday, weekend): at most three copies."""
    hour = F.col("hour")
    parts = {
        "late_night_00_04": (0, 4), "transition_up_05_07": (5, 7), "morning_peak_08_10": (8, 10),
        "day_11_15": (11, 15), "evening_peak_16_20": (16, 20), "late_evening_21_23": (21, 23),
    }
    names = [F.when(hour.between(lo, hi), F.lit(name)) for name, (lo, hi) in parts.items()]
    names += [F.when(F.col("is_holiday") == 1, F.lit("holiday")), F.when(F.col("is_weekend") == 1, F.lit("weekend"))]
    return df.withColumn("segment", F.explode(F.array_compact(F.array(*names))))


def segment_report(df: DataFrame) -> DataFrame:
    y, p = _yp()
    return named_segments(df).groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"), mae().alias("mae"), rmse().alias("rmse"), mape(None).alias("mape"), F.avg(p - y).alias("bias")
    )


def with_tertile(df: DataFrame, column: str = "zone_hour_mean") -> DataFrame:
    """``zone_vol_tertile`` by linear quantile edges of the rows, upper edges included.

    The edges come from an exact distributed quantile, the label is a comparison per row.
    """
    edges = exact_quantiles(df, column, {"t1": 1.0 / 3.0, "t2": 2.0 / 3.0}).select(F.struct("t1", "t2").alias("e"))
    v, e = F.col(column), F.col("_e")
    label = F.when(v <= e["t1"], "low").when(v <= e["t2"], "mid").otherwise("high")
    return df.withColumn("_e", edges.scalar()).withColumn("zone_vol_tertile", label).drop("_e")


def bucket_metrics(df: DataFrame) -> DataFrame:
    """Metrics for night, midday and evening."""
    hour = F.col("hour")
    label = F.lit(None).cast("string")
    for name, (lo, hi) in fixed.METRIC_BUCKETS.items():
        label = F.when(hour.between(lo, hi), F.lit(name)).otherwise(label)
    labelled = df.withColumn("bucket", label)
    return labelled.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), mae().alias("mae"), rmse().alias("rmse"), r2().alias("r2"),
        wape(None).alias("wape"), smape("shift").alias("smape"),
    )


def classifier_scores(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, F1 and exact AUC in one row.

    AUC counts, for each distinct score, the negatives below it (ties half). The counts run over a
    score histogram with bin offsets, so no task sees the whole ordering.
    """
    y, s = F.col(label), F.col(score)
    said = s >= threshold
    n = lambda condition: F.count_if(condition).cast("double")
    confusion = df.agg(
        n((y == 1) & said).alias("tp"), n((y == 0) & said).alias("fp"),
        n((y == 1) & ~said).alias("fn"), n((y == 0) & ~said).alias("tn"),
    )
    hist = value_histogram(df, [], score, {"pos": F.count_if(y == 1), "neg": F.count_if(y == 0)})
    ranked = running_totals(hist, [], ["neg"])
    pairs = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") * 0.5)).cast("double")
    auc = ranked.agg(
        F.try_divide(pairs, (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide(tp, tp + fp), zero)
    recall = F.coalesce(F.try_divide(tp, tp + fn), zero)
    return confusion.select(
        auc.scalar().alias("auc"),
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.coalesce(F.try_divide(2.0 * tp, 2.0 * tp + fp + fn), zero).alias("f1"),
        precision.alias("precision"),
        recall.alias("recall"),
    )


def hourly_totals(df: DataFrame) -> DataFrame:
    """City-wide actual and predicted demand per day and hour."""
    return df.groupBy(F.to_date("window_start").alias("date"), "hour").agg(
        F.sum("actual").cast("double").alias("actual"), F.sum("predicted").cast("double").alias("predicted")
    )


def hourly_display(totals: DataFrame) -> DataFrame:
    """Rounded hourly rows with the percentage error; NULL error on a day without any actual."""
    y, p = _yp()
    day = Window.partitionBy("date")
    available = F.sum(y).over(day) > 0
    error = F.when(available, py_round(F.abs(p - y) / F.greatest(y, F.lit(1.0)) * 100, 1))
    return totals.select(
        "date", "hour", py_round(y, 0).cast("long").alias("actual"), py_round(p, 0).cast("long").alias("predicted"),
        error.alias("error_pct"), available.alias("actual_available"),
    )


def day_summary(display: DataFrame) -> DataFrame:
    """Per day: WAPE, mean and median hourly error, sMAPE and totals (24 rows per day)."""
    y, p = _yp()
    has = F.sum(y) > 0
    symmetric = F.lit(200.0) * F.abs(p - y) / F.greatest(F.abs(y) + F.abs(p), F.lit(1e-9))
    return display.groupBy("date").agg(
        F.when(has, py_round(F.sum(F.abs(p - y)) / F.greatest(F.sum(y), F.lit(1e-9)) * 100, 1)).alias("wape"),
        F.when(has, py_round(F.avg("error_pct"), 1)).alias("mape_avg_hourly"),
        F.when(has, py_round(F.avg(symmetric), 1)).alias("smape_day"),
        py_round(F.median("error_pct"), 1).alias("mdape_hourly"),
        has.alias("actual_available"),
        F.sum("actual").cast("long").alias("total_actual"),
        F.sum("predicted").cast("long").alias("total_predicted"),
    )


def peak_hours(totals: DataFrame, prob: float = 0.75) -> DataFrame:
    """Hourly error with a flag for hours at or above the day's percentile (24 rows per day)."""
    y, p = _yp()
    cut = totals.groupBy("date").agg(F.percentile(y, F.lit(prob)).alias("_cut"))
    joined = totals.join(cut, on="date")
    error = F.abs(y - p) / F.greatest(y, F.lit(1.0)) * 100
    return joined.select("date", "hour", "actual", "predicted", error.alias("error_pct"), (y >= F.col("_cut")).alias("is_peak"))


def compare_days(totals: DataFrame, day1: str, day2: str) -> DataFrame:
    """Totals of two days and their difference in percent."""
    day = lambda d: F.coalesce(F.sum(F.when(F.col("date") == F.lit(d).cast("date"), F.col("actual"))), F.lit(0.0))
    one, two = day(day1), day(day2)
    return totals.agg(
        one.alias("total_1"), two.alias("total_2"), (two - one).alias("difference"),
        ((two - one) / F.greatest(one, F.lit(1.0)) * 100).alias("difference_pct"),
    )


def composite(df: DataFrame) -> DataFrame:
    """0.42 × WAPE of all hours + 0.58 × WAPE of hours 5 and later; all hours only if the later
    ones hold no demand.
    """
    y, p = _yp()
    p = F.greatest(p, F.lit(0.0))
    late = F.col("hour") >= 5
    error, error_late = F.sum(F.abs(y - p)), F.coalesce(F.sum(F.when(late, F.abs(y - p))), F.lit(0.0))
    total, total_late = F.sum(y), F.coalesce(F.sum(F.when(late, y)), F.lit(0.0))
    everything = error / F.greatest(total, F.lit(1.0)) * 100
    later = error_late / F.greatest(total_late, F.lit(1.0)) * 100
    return df.agg(
        everything.alias("wape_all"), later.alias("wape_late"),
        F.when(total_late < 1e-6, everything).otherwise(F.lit(0.42) * everything + F.lit(0.58) * later).alias("score"),
    )


def tiered_loss(df: DataFrame, phase: int = 2) -> DataFrame:
    """Huber loss with weights by demand tier and hour, plus one-sided squared terms.

    Percentiles are over the table. Columns ``actual`` and ``predicted`` hold scaled values whose
    distinct actuals are as few as the hourly counts they come from.
    """
    y, p = _yp()
    hour = F.col("hour")
    cuts = df.agg(percentiles_of_counts(y, [0.25, 0.75]).alias("q")).scalar()
    low, high = F.col("_q")[0], F.col("_q")[1]
    tier = F.when(y > high, 6.0).when(y < low, 2.0).otherwise(1.0)
    by_hour = F.when(hour <= 3, 2.2).when(hour.between(4, 8), 1.8).when(hour >= 22, 2.0).otherwise(1.0)
    over, under = F.greatest(p - y, F.lit(0.0)), F.greatest(y - p, F.lit(0.0))
    when = lambda condition, value: F.when(condition, value * value).otherwise(0.0)
    asym = (
        F.lit(0.45) * F.avg(when(hour <= 8, over))
        + F.lit(0.15) * F.avg(when(hour.between(17, 20), over))
        + F.lit(0.15) * F.avg(when(hour.between(21, 23), over))
        + F.lit(0.55) * F.avg(when(hour.between(21, 23), under))
    )
    base = F.avg(huber(p - y, 1.0) * tier * by_hour)
    share = F.lit(0.35 if phase <= 1 else 1.0)
    return df.withColumn("_q", cuts).agg(base.alias("base"), asym.alias("one_sided"), (base + share * asym).alias("loss"))


def bucket_loss(df: DataFrame) -> DataFrame:
    """Huber loss per part of day with two pinball terms (columns ``q10`` and ``q90``)."""
    y, p = _yp()
    hour = F.col("hour")
    night, evening = hour <= 8, hour >= 17
    weight = F.when(night, 3.2).when(evening, 2.4).otherwise(1.0)
    delta = F.when(night, 0.5).when(evening, 0.7).otherwise(1.0)
    over, under = F.greatest(p - y, F.lit(0.0)), F.greatest(y - p, F.lit(0.0))
    point = F.avg(weight * huber(p - y, delta))
    asym = F.lit(0.4) * F.avg(F.when(night, over * over).otherwise(0.0)) + F.lit(0.4) * F.avg(F.when(evening, under * under).otherwise(0.0))
    tails = (F.avg(weight * pinball(y, F.col("q10"), 0.10)) + F.avg(weight * pinball(y, F.col("q90"), 0.90))) / F.lit(2.0)
    return df.agg(
        point.alias("point"), asym.alias("one_sided"), tails.alias("quantile"),
        (point + F.lit(0.18) * tails + asym).alias("loss"),
    )


def align(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """Actual and predicted values of the same zone and hour."""
    keys = ["PULocationID", "window_start"]
    return actual.select(*keys, "actual").join(predicted.select(*keys, "predicted"), on=keys)
