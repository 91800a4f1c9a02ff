"""Column expressions. All are built-in functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clip(x: Column | str, low: float | Column | None, high: float | Column | None) -> Column:
    """Bound ``x``; NULL stays NULL (least/greatest alone would skip it)."""
    x = _c(x)
    out = x
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(float(low)))
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(float(high)))
    return F.when(x.isNotNull(), out)


def floor_zero(x: Column | str) -> Column:
    return clip(x, 0.0, None)


def cyclic(x: Column | str, period: int) -> tuple[Column, Column]:
    """Sine and cosine of ``x`` on a circle of length ``period``."""
    angle = _c(x) * F.lit(2.0 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den with an undefined ratio read as 0, clipped to [0, 10]."""
    ratio = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return F.least(F.greatest(F.coalesce(ratio, F.lit(0.0)), F.lit(0.0)), F.lit(10.0))


def safe_div(num: Column | str, den: Column | str, default: float = 0.0) -> Column:
    """num / den, or ``default`` where the denominator is within 1e-6 of zero."""
    den = _c(den).cast("double")
    return F.when(F.abs(den) > 1e-6, _c(num).cast("double") / den).otherwise(F.lit(float(default)))


def smoothed_ratio(num: Column | str, den: Column | str) -> Column:
    """(num + 1) / (den + 1)."""
    return (_c(num) + F.lit(1.0)) / (_c(den) + F.lit(1.0))


def py_round(x: Column | str, digits: int = 0) -> Column:
    """Half-even rounding. Nine digits are kept first, so that a tie is decided by the rule and
    not by the last bit of a sum.
    """
    return F.bround(F.round(_c(x).cast("double"), 9), digits)


def rounded(x: Column | str, digits: int = 6) -> Column:
    """Reporting precision; adding 0.0 turns -0.0 into 0.0."""
    return F.round(_c(x).cast("double"), digits) + F.lit(0.0)


def weekend_mon0(dow: Column | str) -> Column:
    """Weekend flag for a Monday = 0 weekday."""
    return (_c(dow) >= 5).cast("int")


def weekend_sun1(dow: Column | str) -> Column:
    """Weekend flag for a Sunday = 1 weekday."""
    return _c(dow).isin(1, 7).cast("int")


def hour_floor(ts: Column | str) -> Column:
    """Start of the hour as a zone-less timestamp."""
    return F.date_trunc("hour", _c(ts)).cast("timestamp_ntz")


def to_number(x: Column | str) -> Column:
    """Lossy conversion: text that is no number becomes NULL."""
    return _c(x).try_cast("double")


def to_time(x: Column | str) -> Column:
    """Lossy conversion: text that is no timestamp becomes NULL."""
    return _c(x).try_cast("timestamp_ntz")


def year_month_of_name(name: Column | str) -> tuple[Column, Column]:
    """Year and month from a file name such as ``trips_2024-01.parquet``; NULL if absent."""
    name = _c(name)
    pattern = r"(20\d{2})-(\d{2})"
    year = F.regexp_extract(name, pattern, 1).try_cast("int")
    month = F.regexp_extract(name, pattern, 2).try_cast("int")
    return year, month


def display_time(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


def status_json(**fields: Column) -> Column:
    """One JSON document per row."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))


def huber(error: Column, delta: Column | float) -> Column:
    """0.5 e² inside ``delta``, linear beyond it."""
    delta = delta if isinstance(delta, Column) else F.lit(float(delta))
    size = F.abs(error)
    return F.when(size <= delta, F.lit(0.5) * error * error).otherwise(delta * (size - F.lit(0.5) * delta))


def pinball(y: Column, predicted: Column, q: float) -> Column:
    error = y - predicted
    return F.greatest(F.lit(q) * error, F.lit(q - 1.0) * error)


def epoch_us(ts: Column | str) -> Column:
    """Microseconds since 1970 of a zone-less timestamp (the session runs in UTC)."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def minutes_between(start: Column | str, end: Column | str, whole_seconds: bool = True) -> Column:
    """Duration in minutes; whole seconds by default, microseconds otherwise."""
    start, end = _c(start), _c(end)
    if whole_seconds:
        return (F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))) / F.lit(60.0)
    return (epoch_us(end) - epoch_us(start)) / F.lit(60_000_000.0)
