"""Rule-based cleaning of trips.

A rule set is an ordered list of (name, condition). A row survives a rule only if its condition
is TRUE, so NULL inputs drop the row. Conditions on plain columns are kept in the form
column-op-literal, which reaches the parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from zonecast import rules as fixed
from zonecast.functions.scalar import hour_floor, minutes_between, py_round, to_number, to_time

Rules = list[tuple[str, Column]]
PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"


def _ts(year: int, month: int = 1) -> Column:
    return F.lit(f"{year:04d}-{month:02d}-01 00:00:00").cast("timestamp_ntz")


def _zone_rule(name: str) -> Column:
    return F.col(name).between(1, fixed.ZONE_COUNT)


def strict_rules(first_year: int = 2022, end_year: int = 2025) -> Rules:
    return [
        ("times_present", F.col(PICKUP).isNotNull() & F.col(DROPOFF).isNotNull()),
        ("same_month", (F.year(PICKUP) == F.year(DROPOFF)) & (F.month(PICKUP) == F.month(DROPOFF))),
        ("year_range", (F.col(PICKUP) >= _ts(first_year)) & (F.col(PICKUP) < _ts(end_year))),
        ("distance", F.col("trip_distance") > 0.1),
        ("rate_code", F.col("RatecodeID") <= 6),
        ("payment_type", F.col("payment_type") < 5.0),
        ("fare", F.col("fare_amount") >= 1.0),
        ("passengers", F.col("passenger_count") > 0),
        ("pickup_zone", _zone_rule("PULocationID")),
        ("dropoff_zone", _zone_rule("DOLocationID")),
    ]


def loose_rules() -> Rules:
    return [
        ("times_present", F.col(PICKUP).isNotNull() & F.col(DROPOFF).isNotNull()),
        ("same_month", (F.year(PICKUP) == F.year(DROPOFF)) & (F.month(PICKUP) == F.month(DROPOFF))),
        ("distance", F.col("trip_distance") > 0),
        ("fare", F.col("fare_amount") >= 0),
        ("passengers", F.col("passenger_count") > 0),
        ("pickup_zone", _zone_rule("PULocationID")),
        ("dropoff_zone", _zone_rule("DOLocationID")),
    ]


def apply_rules(df: DataFrame, rule_set: Rules) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [condition for _, condition in rule_set]))


def _report(df: DataFrame, names: list[str], counts: list[str]) -> DataFrame:
    """Row counts after each step, turned into before / after / dropped rows."""
    steps = []
    for i, name in enumerate(names):
        before, after = F.col(counts[i]), F.col(counts[i + 1])
        steps.append(
            F.struct(
                F.lit(i + 1).alias("position"), F.lit(name).alias("step"),
                before.alias("before"), after.alias("after"), (before - after).alias("dropped"),
                F.when(before > 0, py_round((before - after) / before * 100, 2)).otherwise(F.lit(0.0)).alias("dropped_pct"),
            )
        )
    return df.select(F.explode(F.array(*steps)).alias("s")).select("s.*")


def waterfall(df: DataFrame, rule_set: Rules) -> DataFrame:
    """Rows before and after every rule: one pass, one counter per step."""
    passed = F.lit(True)
    counters = [F.count(F.lit(1)).alias("_n0")]
    for i, (_, condition) in enumerate(rule_set, start=1):
        passed = passed & F.coalesce(condition, F.lit(False))
        counters.append(F.count_if(passed).alias(f"_n{i}"))
    return _report(df.agg(*counters), [n for n, _ in rule_set], [f"_n{i}" for i in range(len(rule_set) + 1)])


def row_loss(df: DataFrame, rule_set: Rules) -> DataFrame:
    """Raw rows, kept rows, dropped rows and percentage dropped, in one pass."""
    keep = reduce(lambda a, b: a & b, [condition for _, condition in rule_set])
    counted = df.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(keep).alias("kept_rows"))
    dropped = F.col("raw_rows") - F.col("kept_rows")
    pct = F.when(F.col("raw_rows") > 0, py_round(dropped / F.col("raw_rows") * 100, 1)).otherwise(F.lit(0.0))
    return counted.select("raw_rows", "kept_rows", dropped.alias("dropped_rows"), pct.alias("dropped_pct"))


def coerce_trips(df: DataFrame) -> DataFrame:
    """Lossy typing of the columns the adaptive rules read; unreadable values become NULL."""
    casts = {PICKUP: to_time, DROPOFF: to_time}
    casts.update({c: to_number for c in ("PULocationID", "trip_distance", "fare_amount", "passenger_count")})
    return df.withColumns({name: cast(name) for name, cast in casts.items() if name in df.columns})


OPTIONAL_RULES = ("trip_distance", "fare_amount", "passenger_count")


def _adaptive_conditions(df: DataFrame, year: int, month: int) -> dict[str, Column]:
    end = (year + 1, 1) if month == 12 else (year, month + 1)
    has = set(df.columns)
    cond = {
        "required": F.col(PICKUP).isNotNull() & F.col("PULocationID").isNotNull(),
        "month": (F.col(PICKUP) >= _ts(year, month)) & (F.col(PICKUP) < _ts(*end)),
        "zone": _zone_rule("PULocationID"),
        "duration": minutes_between(PICKUP, DROPOFF, whole_seconds=False).between(0.5, 360) if DROPOFF in has else F.lit(True),
        "trip_distance": F.col("trip_distance").between(0.1, 100) if "trip_distance" in has else F.lit(True),
        "fare_amount": F.col("fare_amount") >= 1.0 if "fare_amount" in has else F.lit(True),
        "passenger_count": F.coalesce(F.col("passenger_count"), F.lit(1.0)) > 0 if "passenger_count" in has else F.lit(True),
    }
    return {name: F.coalesce(c, F.lit(False)) for name, c in cond.items()}


def adaptive_outcomes(df: DataFrame, year: int, month: int) -> DataFrame:
    """Rows per outcome of all conditions: a few hundred combinations at most, combined before the shuffle.

    The counts of two tables add up to those of both, so they can be kept and carried on.
    """
    c = _adaptive_conditions(df, year, month)
    present = {f"has_{n}": F.col(n).isNotNull() if n in df.columns else F.lit(False) for n in OPTIONAL_RULES}
    flags = {**c, **present}
    return df.select(*[e.alias(f"_{n}") for n, e in flags.items()]).groupBy(*[f"_{n}" for n in flags]).agg(F.count(F.lit(1)).alias("n"))


def adaptive_profile(df: DataFrame, year: int, month: int, min_share: float = 0.5) -> DataFrame:
    """One row: rows after every step, and which optional rules apply. One scan, no loop over rules."""
    return decided(adaptive_outcomes(df, year, month), min_share)


def decided(outcomes: DataFrame, min_share: float = 0.5) -> DataFrame:
    """The profile that outcome counts give.

    An optional rule applies when at least ``min_share`` of the rows that reached it have a value.
    That depends on the optional rules before it; every possible course is read off the counts.
    """

    def total(conditions: list[str], name: str) -> Column:
        return F.expr(f"coalesce(sum(CASE WHEN {' AND '.join(conditions)} THEN n END), 0L)").alias(name)

    essential = ["_required", "_month", "_zone"]
    aggs = [total(["TRUE"], "n_all"), *[total(essential[: i + 1], f"n_{essential[i][1:]}") for i in range(3)]]
    for mask in range(2 ** len(OPTIONAL_RULES)):
        rows = [*essential, "_duration", *[f"_{name}" for i, name in enumerate(OPTIONAL_RULES) if mask >> i & 1]]
        aggs.append(total(rows, f"n_{mask}"))
        aggs += [total([*rows, f"_has_{name}"], f"v_{mask}_{name}") for name in OPTIONAL_RULES]
    counts = outcomes.agg(*aggs)

    # One step per optional rule, so that each decision is computed once and then referred to.
    state = counts.withColumn("_mask", F.lit(0))

    def at_mask(template: str, masks: int) -> Column:
        return F.expr(f"get(array({', '.join(template.format(m) for m in range(masks))}), _mask)")

    for i, name in enumerate(OPTIONAL_RULES):
        share = F.try_divide(at_mask("v_{}_" + name, 2 ** i), at_mask("n_{}", 2 ** i))
        state = state.withColumn(f"use_{name}", F.coalesce(share >= min_share, F.lit(False)))
        state = state.withColumn("_mask", F.col("_mask") + F.when(F.col(f"use_{name}"), 2 ** i).otherwise(0))
        state = state.withColumn(f"n_after_{name}", at_mask("n_{}", 2 ** (i + 1)))
    chosen = [c for n in OPTIONAL_RULES for c in (f"use_{n}", f"n_after_{n}")]
    return state.select("n_all", "n_required", "n_month", "n_zone", F.col("n_0").alias("n_duration"), *chosen).withColumn(
        "fallback", (F.col("n_after_passenger_count") == 0) & (F.col("n_all") > 0)
    )


def adaptive_clean(df: DataFrame, year: int, month: int, profile: DataFrame | None = None) -> DataFrame:
    """Cleaning that skips optional rules on poorly filled columns, and falls back to the
    essential rules if nothing would be left. The decisions come from a one-row subquery; pass a
    ``profile`` frozen from history to clean a stream without looking at its own rows.
    """
    df = coerce_trips(df)
    profile = adaptive_profile(df, year, month) if profile is None else profile
    choice = profile.select(F.struct(*[f"use_{n}" for n in OPTIONAL_RULES], "fallback").alias("d"))
    c = _adaptive_conditions(df, year, month)
    kept = df.filter(c["required"] & c["month"] & c["zone"]).withColumn("_d", choice.scalar())
    quality = c["duration"]
    for name in OPTIONAL_RULES:
        quality = quality & (~F.col(f"_d.use_{name}") | c[name])
    return kept.filter(F.col("_d.fallback") | quality).drop("_d")


def essential_clean(df: DataFrame, year: int, month: int) -> DataFrame:
    """Only the required, month and zone rules."""
    df = coerce_trips(df)
    c = _adaptive_conditions(df, year, month)
    return df.filter(c["required"] & c["month"] & c["zone"])


def adaptive_waterfall(df: DataFrame, year: int, month: int) -> DataFrame:
    """Step report of ``adaptive_clean`` from the same single profile."""
    profile = adaptive_profile(coerce_trips(df), year, month)
    names = ["parse_datetime", "drop_missing_required", "pickup_month", "valid_zone", "duration"] + [
        f"{n}_optional" for n in OPTIONAL_RULES
    ]
    counts = ["n_all", "n_all", "n_required", "n_month", "n_zone", "n_duration"] + [f"n_after_{n}" for n in OPTIONAL_RULES]
    return _report(profile, names, counts)


def add_trip_columns(df: DataFrame, whole_seconds: bool = True) -> DataFrame:
    """Duration and calendar parts of the pickup time. Both weekday conventions are given:
    ``pickup_dayofweek`` counts from Sunday = 1, ``pickup_weekday`` from Monday = 0.
    """
    return df.withColumns(
        {
            "trip_duration_min": minutes_between(PICKUP, DROPOFF, whole_seconds),
            "pickup_year": F.year(PICKUP),
            "pickup_month": F.month(PICKUP),
            "pickup_day": F.dayofmonth(PICKUP),
            "pickup_hour": F.hour(PICKUP),
            "pickup_dayofweek": F.dayofweek(PICKUP),
            "pickup_weekday": F.weekday(PICKUP),
            "pickup_date": F.to_date(PICKUP),
        }
    )


def silver(df: DataFrame, rule_set: Rules | None = None) -> DataFrame:
    """Cleaned trips in the fixed column order; columns the input lacks are NULL."""
    out = add_trip_columns(apply_rules(df, strict_rules() if rule_set is None else rule_set))
    out = out.withColumn("_layer", F.lit("silver")).withColumn("_processed_at", F.current_timestamp())
    types = {PICKUP: "timestamp_ntz", DROPOFF: "timestamp_ntz", "store_and_fwd_flag": "string",
             "_source_file": "string", "_ingested_at": "timestamp"}
    columns = [
        F.col(c) if c in out.columns else F.lit(None).cast(types.get(c, "double")).alias(c) for c in fixed.SILVER_COLUMNS
    ]
    return out.select(columns)


def range_sanity(df: DataFrame, max_zone: int = 265, dow: tuple[int, int] = (0, 6)) -> tuple[DataFrame, DataFrame]:
    """Rows with zone, hour and weekday in range, and a one-row count of the rejects."""
    zone, hour, day = F.col("PULocationID"), F.col("hour"), F.col("day_of_week")
    checks = {"zone": zone.between(1, max_zone), "hour": hour.between(0, 23), "dow": day.between(*dow)}
    counts = [F.count(F.lit(1)).alias("rows_in")]
    passed = F.lit(True)
    for name, check in checks.items():
        ok = F.coalesce(check, F.lit(False))
        counts.append(F.count_if(passed & ~ok).alias(f"bad_{name}"))
        passed = passed & ok
    counts.append(F.count_if(passed).alias("rows_out"))
    return df.filter(passed), df.agg(*counts)


def with_target(df: DataFrame) -> DataFrame:
    """``target_demand`` as a number without NULLs, taken from ``trip_count`` if absent."""
    source = "target_demand" if "target_demand" in df.columns else "trip_count"
    return df.withColumn("target_demand", F.coalesce(to_number(source), F.lit(0.0)))


def with_hour_key(df: DataFrame, ts: str = PICKUP) -> DataFrame:
    return df.withColumn("window_start", hour_floor(ts))


