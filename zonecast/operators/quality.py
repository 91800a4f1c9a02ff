"""Data-quality and drift checks, reported as (check, status, value, threshold) rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from zonecast import rules as fixed
from zonecast.functions.scalar import epoch_us, rounded
from zonecast.functions.stats import percentiles_of_counts, running_totals, value_histogram
from zonecast.operators.demand import ZONE_KEY
from zonecast.operators.features import lag_shift_check
from zonecast.operators.prep import TIME, log_minmax, minmax, split_column, target_scaler

LIMITS = fixed.LIMITS


def _check(name: str, status: Column | str, value: Column | float | None = None, threshold: float | None = None) -> Column:
    status = status if isinstance(status, Column) else F.lit(status)
    value = value if isinstance(value, Column) else F.lit(value)
    return F.struct(
        F.lit(name).alias("check"), status.alias("status"), value.cast("double").alias("value"),
        F.lit(threshold).cast("double").alias("threshold"),
    )


def _rows(stats: DataFrame, checks: Sequence[Column]) -> DataFrame:
    return stats.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


def distribution(df: DataFrame, column: str = "target_demand") -> DataFrame:
    """Size, range, mean, population deviation, percentiles, spike ratio and zero share, one pass.

    The column holds hourly counts: the percentile buffer has one entry per distinct count.
    """
    x = F.col(column).cast("double")
    stats = df.agg(
        F.count(x).alias("count"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"),
        F.stddev_pop(x).alias("std"), percentiles_of_counts(x, [0.5, 0.75, 0.9, 0.95, 0.99]).alias("q"),
        F.count_if(x == 0).alias("zeros"),
    )
    named = [F.col("q")[i].alias(f"p{p}") for i, p in enumerate((50, 75, 90, 95, 99))]
    return stats.select(
        "count", "min", "max", "mean", "std", *named,
        (F.col("max") / (F.col("q")[3] + F.lit(1e-9))).alias("spike_ratio"),
        (F.try_divide("zeros", "count") * 100).alias("zero_pct"),
    )


def column_checks(df: DataFrame, features: Sequence[str] = tuple(fixed.QUALITY_FEATURES)) -> DataFrame:
    """Presence of columns and share of NULLs (one aggregate over all columns)."""
    have = set(df.columns)
    checks = [_check(f"required:{c}", "PASS" if c in have else "FAIL") for c in ("target_demand", TIME, ZONE_KEY)]
    for c in features:
        if c not in have:
            optional = c in fixed.OPTIONAL_QUALITY_FEATURES
            checks.append(_check(f"feature:{c}", "WARN" if optional else "FAIL"))
    present = [c for c in features if c in have] + (["target_demand"] if "target_demand" in have else [])
    share = {c: F.coalesce(F.try_divide(F.count_if(F.col(c).isNull()) * 100, F.count(F.lit(1))), F.lit(0.0)) for c in present}
    stats = df.agg(*[v.alias(f"_{c}") for c, v in share.items()])
    for c in present:
        pct = F.col(f"_{c}")
        status = F.when(pct == 0, "PASS").when(pct < LIMITS["null_pct"], "WARN").otherwise("FAIL")
        checks.append(_check(f"nulls:{c}", status, pct, LIMITS["null_pct"]))
    return _rows(stats, checks)


def distribution_checks(df: DataFrame) -> DataFrame:
    spike, zero = F.col("spike_ratio"), F.col("zero_pct")
    return _rows(
        distribution(df),
        [
            _check("spike_ratio", F.when(spike > LIMITS["spike_ratio"], "WARN").otherwise("PASS"), spike, LIMITS["spike_ratio"]),
            _check("zero_share", F.when(zero > LIMITS["zero_pct"], "WARN").otherwise("PASS"), zero, LIMITS["zero_pct"]),
        ],
    )


def scaling_stats(df: DataFrame) -> DataFrame:
    """One row about the scaled target: the scaler's ceiling, shares above one half, and the 90th
    percentile as a better peak threshold. The scaler is fitted on the training period.
    """
    y = F.col("target_demand").cast("double")
    train = df.withColumn("_split", split_column(df)).filter(F.col("_split") == "train")
    scaled = df.filter(y.isNotNull()).withColumn("_s", target_scaler(train).scalar())
    log, plain = log_minmax(y, F.col("_s")), minmax(y, F.col("_s"))
    share = lambda c: F.avg((c > 0.5).cast("double")) * 100
    return scaled.agg(
        F.expm1(F.max(F.col("_s.log_max"))).alias("ceiling"), F.max(y).alias("data_max"),
        F.max(log).alias("scaled_max"), share(log).alias("pct_above_half"), share(plain).alias("pct_above_half_plain"),
        percentiles_of_counts(log, [0.9])[0].alias("suggested_threshold"),
    )


def scaling_checks(df: DataFrame) -> DataFrame:
    gap = F.abs(F.col("ceiling") - F.col("data_max"))
    above, plain = F.col("pct_above_half"), F.col("pct_above_half_plain")
    return _rows(
        scaling_stats(df),
        [
            _check("scaler_ceiling", F.when(gap > F.col("data_max") * LIMITS["ceiling_tolerance"], "WARN").otherwise("PASS"), F.col("ceiling"), LIMITS["ceiling_tolerance"]),
            _check("peak_threshold", F.when(above < LIMITS["peak_pct_fail"], "FAIL").when(above < LIMITS["peak_pct_warn"], "WARN").otherwise("PASS"), above, LIMITS["peak_pct_fail"]),
            _check("log_helps", F.when(above > plain, "PASS").otherwise("WARN"), plain),
        ],
    )


def correlations(df: DataFrame, features: Sequence[str], target: str = "target_demand") -> DataFrame:
    """Pearson correlation of every feature with the target from one aggregate; NULL for a
    constant feature (its deviation is 0, and the division is a guarded one).
    """
    known = df.select(F.col(target).cast("double").alias("_y"), *features).filter(F.col("_y").isNotNull())
    aggs = []
    for c in features:
        x = F.col(c).cast("double")
        deviation = F.stddev_pop(x) * F.stddev_pop(F.when(x.isNotNull(), F.col("_y")))
        aggs.append(F.try_divide(F.covar_pop(x, F.col("_y")), deviation).alias(c))
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr")) for c in features])
    return known.agg(*aggs).select(F.explode(pairs).alias("p")).select("p.*")


def leakage_checks(df: DataFrame, features: Sequence[str]) -> DataFrame:
    size = F.abs(F.col("corr"))
    status = (
        F.when(F.col("corr").isNull(), "WARN").when(size > LIMITS["corr_fail"], "FAIL").when(size > LIMITS["corr_warn"], "WARN").otherwise("PASS")
    )
    by_feature = correlations(df, features).select(
        F.concat(F.lit("corr:"), "feature").alias("check"), status.alias("status"), F.col("corr").alias("value"),
        F.lit(LIMITS["corr_fail"]).alias("threshold"),
    )
    diff = F.col("mean_diff")
    shift = _rows(lag_shift_check(df), [_check("lag_shift", F.when(diff < 1e-6, "FAIL").otherwise("PASS"), diff, 1e-6)])
    return by_feature.unionByName(shift)


def top_correlations(df: DataFrame, features: Sequence[str], k: int = 3) -> DataFrame:
    return correlations(df, features).orderBy(F.desc_nulls_last(F.abs("corr")), "feature").limit(k)


def split_stats(df: DataFrame) -> DataFrame:
    """Rows, share, time range, maximum and share of peaks (above the overall p90) per split."""
    y = F.col("target_demand").cast("double")
    # One subquery with the overall values instead of a window over all rows.
    overall = df.agg(F.struct(percentiles_of_counts(y, [0.9])[0].alias("p90"), F.count(F.lit(1)).alias("n")).alias("o")).scalar()
    labelled = df.withColumn("split", split_column(df)).withColumn("_o", overall)
    return labelled.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) / F.max("_o.n") * 100).alias("pct"),
        F.min(TIME).alias("first"), F.max(TIME).alias("last"), F.max(y).alias("max_target"),
        (F.avg((y > F.col("_o.p90")).cast("double")) * 100).alias("peak_pct"),
    )


def valid_sequence_share(df: DataFrame, look_back: int) -> DataFrame:
    """Share of training rows with at least ``look_back`` earlier rows in their zone."""
    number = F.row_number().over(Window.partitionBy(ZONE_KEY).orderBy(TIME))
    numbered = df.select(ZONE_KEY, TIME, split_column(df).alias("split"), number.alias("rn")).filter(F.col("split") == "train")
    return numbered.agg(F.count(F.lit(1)).alias("train_rows"), (F.avg((F.col("rn") > look_back).cast("double")) * 100).alias("valid_pct"))


def split_checks(df: DataFrame, look_back: int = 72) -> DataFrame:
    test = split_stats(df).filter(F.col("split") == "test").agg(F.max("n").alias("n"), F.max("peak_pct").alias("peak"))
    n, peak = F.coalesce("n", F.lit(0)), F.coalesce("peak", F.lit(0.0))
    sizes = _rows(
        test,
        [
            _check("test_size", F.when(n < 2 * look_back, "FAIL").otherwise("PASS"), n, float(2 * look_back)),
            _check("test_peaks", F.when(peak < LIMITS["peak_share_pct"], "WARN").otherwise("PASS"), peak, LIMITS["peak_share_pct"]),
        ],
    )
    valid = F.col("valid_pct")
    sequences = _rows(
        valid_sequence_share(df, look_back),
        [_check("valid_sequences", F.when(valid < LIMITS["valid_sequence_pct"], "WARN").otherwise("PASS"), valid, LIMITS["valid_sequence_pct"])],
    )
    return sizes.unionByName(sequences)


def metric_checks(metrics: DataFrame) -> DataFrame:
    """Gates on a one-row metrics table with r2, peak_mape, rmse and mae."""
    r2, peak = F.col("r2"), F.col("peak_mape")
    ratio = F.col("rmse") / (F.col("mae") + F.lit(1e-9))
    return _rows(
        metrics,
        [
            _check("r2", F.when(r2 < LIMITS["r2"], "FAIL").otherwise("PASS"), r2, LIMITS["r2"]),
            _check("peak_mape", F.when(peak > LIMITS["peak_mape_fail"], "FAIL").when(peak > LIMITS["peak_mape_warn"], "WARN").otherwise("PASS"), peak, LIMITS["peak_mape_fail"]),
            _check("rmse_mae", F.when(ratio > LIMITS["rmse_mae"], "WARN").otherwise("PASS"), ratio, LIMITS["rmse_mae"]),
        ],
    )


def report(parts: Sequence[DataFrame]) -> DataFrame:
    """All checks in one table."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def summary(checks: DataFrame) -> DataFrame:
    """Number of PASS, WARN and FAIL."""
    return checks.agg(*[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("PASS", "WARN", "FAIL")])


def histogram(df: DataFrame, column: str, bins: int = 80, transform=None) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin includes its upper edge."""
    x = F.col(column).cast("double")
    x = transform(x) if transform else x
    values = df.select(x.alias("x")).filter(F.col("x").isNotNull())
    span = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("s")).scalar()
    s = F.col("s")
    place = F.floor(F.try_divide((F.col("x") - s["lo"]) * F.lit(float(bins)), s["hi"] - s["lo"]))
    number = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    return values.withColumn("s", span).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))


def cdf(df: DataFrame, column: str) -> DataFrame:
    """Share of rows at or below every distinct value, from a histogram with bin offsets."""
    hist = value_histogram(df, [], column)
    total = hist.agg(F.sum("n").alias("t")).scalar()
    ranked = running_totals(hist, [], ["n"])
    return ranked.select("value", "n", ((F.col("n_before") + F.col("n")) / total).alias("cdf"))


def time_range(df: DataFrame) -> DataFrame:
    return df.agg(rounded((F.max(epoch_us(TIME)) - F.min(epoch_us(TIME))) / F.lit(3.6e9), 3).alias("hours"))
