"""Splitting, scaling and weighting for models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from zonecast import rules as fixed
from zonecast.functions.scalar import clip, epoch_us
from zonecast.functions.stats import percentiles_of_counts

TIME = "window_start"


def split_bounds(df: DataFrame, train: float = fixed.TRAIN_RATIO, val: float = fixed.VAL_RATIO) -> DataFrame:
    """One row with the two cut points in microseconds, rounded to the nearest one."""
    us = epoch_us(TIME)
    lo, hi = F.min(us), F.max(us)
    cut1 = F.round(lo + (hi - lo) * F.lit(train)).cast("long")
    cut2 = F.round(lo + (hi - lo) * F.lit(train + val)).cast("long")
    return df.agg(F.struct(cut1.alias("train_end"), cut2.alias("val_end")).alias("b"))


def split_column(df: DataFrame, train: float = fixed.TRAIN_RATIO, val: float = fixed.VAL_RATIO) -> Column:
    """train / val / test by position in the time range, as an expression on ``df``'s rows.

    The bounds are a one-row subquery: a second pass over two columns, no shuffle of the rows.
    """
    b = split_bounds(df, train, val).scalar()
    us = epoch_us(TIME)
    return F.when(us < b["train_end"], "train").when(us < b["val_end"], "val").otherwise("test")


def add_split(
    df: DataFrame, train: float = fixed.TRAIN_RATIO, val: float = fixed.VAL_RATIO, source: DataFrame | None = None
) -> DataFrame:
    """``split`` column; the time range is read from ``source`` (a cheaper frame with the same
    times, such as the stored table the features come from) if given.
    """
    return df.withColumn("split", split_column(df if source is None else source, train, val))


def target_scaler(train: DataFrame, column: str = "target_demand") -> DataFrame:
    """One row ``s``: minimum, maximum, mean and population deviation of the raw and log target.

    Fit on training rows only.
    """
    y = F.col(column).cast("double")
    log = F.log1p(y)
    return train.agg(
        F.struct(
            F.min(y).alias("min"), F.max(y).alias("max"), F.min(log).alias("log_min"), F.max(log).alias("log_max"),
            F.avg(log).alias("log_mean"), F.stddev_pop(log).alias("log_std"),
        ).alias("s")
    )


def _span(width: Column) -> Column:
    return F.when(width == 0, F.lit(1.0)).otherwise(width)


def log_minmax(x: Column, s: Column) -> Column:
    return (F.log1p(x) - s["log_min"]) / _span(s["log_max"] - s["log_min"])


def log_minmax_inverse(z: Column, s: Column) -> Column:
    return F.expm1(z * _span(s["log_max"] - s["log_min"]) + s["log_min"])


def log_standard(x: Column, s: Column) -> Column:
    return (F.log1p(x) - s["log_mean"]) / _span(s["log_std"])


def log_standard_inverse(z: Column, s: Column) -> Column:
    return F.expm1(z * _span(s["log_std"]) + s["log_mean"])


def minmax(x: Column, s: Column) -> Column:
    return (x - s["min"]) / _span(s["max"] - s["min"])


def standardize(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns shifted and divided by mean and population deviation of the training rows."""
    stats = train.agg(
        F.struct(
            *[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("d")).alias(c) for c in columns]
        ).alias("s")
    )
    scaled = df.withColumn("_s", stats.scalar())
    return scaled.withColumns(
        {c: (F.col(c) - F.col("_s")[c]["m"]) / _span(F.col("_s")[c]["d"]) for c in columns}
    ).drop("_s")


def add_sample_weights(train: DataFrame, column: str = "target_demand") -> DataFrame:
    """Weights by demand tier and hour, clipped to [0.5, 20] and scaled to a mean of 1.

    The percentiles are over hourly counts (few distinct values, combined before the shuffle).
    """
    y, hour = F.col(column).cast("double"), F.col("hour")
    p = train.agg(percentiles_of_counts(F.col(column).cast("double"), [0.10, 0.25, 0.50, 0.75, 0.90]).alias("p"))
    p10, p25, p75, p90 = (F.col("_p")[i] for i in (0, 1, 3, 4))

    def times(condition: Column, factor: float) -> Column:
        return F.when(condition, F.lit(factor)).otherwise(F.lit(1.0))

    raw = clip(F.sqrt((p25 + 1.0) / (y + 1.0)), 1.0, 3.0)
    for condition, factor in (
        (y <= p10, 1.25), (y >= p75, 4.0), (y >= p90, 1.10),
        (hour.between(0, 4), 4.0), (hour.between(5, 8), 3.5), (hour.between(7, 10), 1.35),
        (hour.between(16, 19), 1.25), (hour == 23, 2.25), (hour.between(20, 23), 2.5),
    ):
        raw = raw * times(condition, factor)
    weighted = train.withColumn("_p", p.scalar()).withColumn("_w", clip(raw, 0.5, 20.0)).drop("_p")
    mean = weighted.agg(F.avg("_w").alias("m")).scalar()
    return weighted.withColumn("weight", F.col("_w") / mean).drop("_w")


def low_hour_weights(df: DataFrame, column: str = "target_demand") -> DataFrame:
    """Weights of the zero / non-zero classifier and of the intensity model."""
    y, hour = F.col(column).cast("double"), F.col("hour")
    by_hour = lambda late, ramp: F.when(hour >= 5, late).when(hour.isin(3, 4), ramp).otherwise(1.0)
    size = F.when(y > 0, clip(y / 5.0, 0.85, 2.2)).otherwise(1.0)
    return df.withColumns({"w_class": by_hour(1.45, 1.12), "w_intensity": by_hour(1.55, 1.15) * size})


def evening_weights(df: DataFrame) -> DataFrame:
    """Late, weekend-late and Sunday-late emphasis."""
    hour, dow = F.col("hour"), F.col("day_of_week")
    late = hour.between(21, 23)
    w = F.when(late, 1.15).otherwise(1.0) * F.when(hour >= 22, 1.10).otherwise(1.0)
    w = w * F.when(late & (dow >= 5), 1.15).otherwise(1.0) * F.when(late & (dow == 6), 1.20).otherwise(1.0)
    return df.withColumn("weight", w)


def residual_weights(df: DataFrame, column: str = "target_demand") -> DataFrame:
    return df.withColumn("weight", clip(F.col(column) / 8.0, 0.8, 3.0))


#: Largest expected number of copies drawn at once; a sum of Poisson draws is a Poisson draw.
POISSON_PART = 64.0


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from an MD5 digest of the parts, the same in every run and engine."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson(rate: Column, draw: Column) -> Column:
    """The number of cumulative Poisson probabilities at or below ``draw``, for rates up to ``POISSON_PART``.

    The terms go on until the remaining probability is below the last bit of ``draw``.
    """
    last = F.ceil(rate + 12.0 * F.sqrt(rate) + 40.0).cast("int")
    zero = F.struct(F.exp(-rate).alias("p"), F.lit(0.0).alias("c"), F.lit(0).alias("k"))

    def add(acc: Column, i: Column) -> Column:
        reached = acc["c"] + acc["p"]
        return F.struct((acc["p"] * rate / (i + 1)).alias("p"), reached.alias("c"), (acc["k"] + (reached <= draw).cast("int")).alias("k"))

    return F.aggregate(F.sequence(F.lit(0), last), zero, add, lambda acc: acc["k"])


def critical_resample(df: DataFrame, factor: float = 3.0, seed: int = 42, keys: Sequence[str] = ("PULocationID", TIME)) -> DataFrame:
    """Resampling with replacement that draws critical hours ``factor`` times as often.

    Each row is drawn a Poisson number of times with its expected share, which is what drawing
    as many rows as there are with replacement tends to at scale. The draw is a digest of the
    seed and the row's keys, so it depends on neither partitions nor run. No shuffle, no cap.
    """
    weighted = df.withColumn("_w", F.when(F.col("hour").isin(fixed.CRITICAL_HOURS), F.lit(float(factor))).otherwise(1.0))
    mean = weighted.agg(F.avg("_w").alias("m")).scalar()
    rated = weighted.withColumn("_rate", F.col("_w") / mean)
    parts = F.ceil(F.col("_rate") / POISSON_PART).cast("int")
    text = [F.col(k).cast("string") for k in keys]
    drawn = F.aggregate(
        F.sequence(F.lit(1), parts), F.lit(0),
        lambda acc, i: acc + poisson(F.col("_rate") / parts, uniform(F.lit(str(seed)), *text, i.cast("string"))),
    )
    copies = rated.withColumn("_k", drawn).filter(F.col("_k") > 0)
    return copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_k")))).drop("_w", "_rate", "_k", "_copy")
