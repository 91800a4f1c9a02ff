"""Exhaustive parameter searches.

Each row meets the fixed parameter list by exploding a literal array, and the errors are summed
per parameter before the shuffle: what moves is one row per map task and parameter, not the
exploded rows. The list length does not depend on the data. Scores are rounded to 9 digits so
that the order of summation cannot decide a tie; ties go to the parameter listed first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from zonecast import rules as fixed
from zonecast.functions.scalar import clip

SCORE_DIGITS = 9


def linspace(start: float, stop: float, count: int) -> list[float]:
    step = (stop - start) / (count - 1)
    return [start + i * step for i in range(count - 1)] + [stop]


def _literals(values: Sequence[float]) -> Column:
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


def _grid(rows: Sequence[dict[str, float]]) -> Column:
    """Parameter sets as one literal array of structs, numbered in order."""
    items = (", ".join([f"'ord', {i}", *[f"'{k}', {float(v)!r}D" for k, v in row.items()]]) for i, row in enumerate(rows))
    return F.expr("array(" + ", ".join(f"named_struct({item})" for item in items) + ")")


def _first_best(df: DataFrame, keys: Sequence[str], keep: Sequence[str], score: str, *ties: str) -> DataFrame:
    order = F.struct(F.round(score, SCORE_DIGITS), *[F.round(t, SCORE_DIGITS) for t in ties], F.col("ord"))
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*keep), order).alias("b"))
    return best.select(*keys, "b.*")


def late_affine(val: DataFrame) -> DataFrame:
    """Per late hour: the factor (25 values) and bias (24 values) with the lowest WAPE."""
    late = val.filter(F.col("hour").isin(fixed.LATE_HOURS))
    options = F.struct(_literals(linspace(0.55, 1.15, 25)).alias("f"), _literals(linspace(-15.0, 8.0, 24)).alias("b"))
    y, p = F.col("actual").cast("double"), F.col("predicted").cast("double")
    index = F.explode(F.sequence(F.lit(0), F.lit(25 * 24 - 1)))
    tried = late.select("hour", y.alias("y"), p.alias("p"), index.alias("ord")).withColumn("o", options)
    tried = tried.select(
        "hour", "y", "p", "ord",
        F.get(F.col("o.f"), F.floor(F.col("ord") / 24).cast("int")).alias("factor"),
        F.get(F.col("o.b"), F.col("ord") % 24).alias("bias"),
    )
    error = F.abs(F.col("y") - F.greatest(F.col("p") * F.col("factor") + F.col("bias"), F.lit(0.0)))
    # Factor and bias follow from the number, so only the number is a key.
    scored = tried.groupBy("hour", "ord").agg(
        F.first("factor").alias("factor"), F.first("bias").alias("bias"),
        (F.sum(error) / F.greatest(F.sum("y"), F.lit(1.0)) * 100).alias("wape")
    )
    return _first_best(scored, ["hour"], ["factor", "bias", "wape"], "wape")


def _span_table() -> Column:
    """Bounds of factor and bias for Saturday (5) and Sunday (6) late hours."""
    rows = []
    for dow in (5, 6):
        for hour in fixed.WEEKEND_LATE_HOURS:
            if dow == 5 and hour >= 22:
                bounds = (0.88, 1.22, -1.25, 12.0)
            elif dow == 5:
                bounds = (0.85, 1.15, -10.0, 10.0)
            elif hour == 23:
                bounds = (0.66, 1.00, -8.0, 6.0)
            else:
                bounds = (0.72, 1.00, -14.0, 4.0)
            values = ", ".join(f"'{n}', {v!r}D" for n, v in zip(("f_min", "f_max", "b_min", "b_max"), bounds))
            rows.append(f"named_struct('dow', {dow}, 'h', {hour}, {values})")
    return F.expr("array(" + ", ".join(rows) + ")")


def weekend_adjust(val: DataFrame, points: int = 17) -> DataFrame:
    """Per weekend day and late hour: factor and bias with the lowest penalised score.

    The searched range shrinks towards (1, 0) with fewer than 300 rows. Score: WAPE plus penalties
    for the bias and rates that matter on that day and hour; ties go to the lower WAPE.
    """
    late = val.filter(F.col("hour").isin(fixed.WEEKEND_LATE_HOURS) & F.col("day_of_week").isin(5, 6)).select(
        F.col("day_of_week").cast("int").alias("day_of_week"), F.col("hour").cast("int").alias("hour"),
        F.col("actual").cast("double").alias("y"), F.col("predicted").cast("double").alias("p"),
    )
    counts = late.groupBy("day_of_week", "hour").agg(F.count(F.lit(1)).alias("n"))
    span = F.filter(_span_table(), lambda s: (s["dow"] == F.col("day_of_week")) & (s["h"] == F.col("hour")))[0]
    shrink = F.least(F.lit(1.0), F.col("n") / F.lit(300.0))
    ranges = counts.withColumn("s", span).withColumn("k", shrink).select(
        "day_of_week", "hour", "n",
        (F.lit(1.0) - (F.lit(1.0) - F.col("s.f_min")) * F.col("k")).alias("f_lo"),
        (F.lit(1.0) + (F.col("s.f_max") - F.lit(1.0)) * F.col("k")).alias("f_hi"),
        (F.col("s.b_min") * F.col("k")).alias("b_lo"),
        (F.col("s.b_max") * F.col("k")).alias("b_hi"),
    )
    steps = float(points - 1)
    tried = late.join(F.broadcast(ranges), on=["day_of_week", "hour"]).withColumn(
        "ord", F.explode(F.sequence(F.lit(0), F.lit(points * points - 1)))
    )
    i, j = F.floor(F.col("ord") / points).cast("double"), (F.col("ord") % points).cast("double")
    tried = tried.withColumns(
        {
            "factor": F.col("f_lo") + (F.col("f_hi") - F.col("f_lo")) / F.lit(steps) * i,
            "bias": F.col("b_lo") + (F.col("b_hi") - F.col("b_lo")) / F.lit(steps) * j,
        }
    )
    q = F.greatest(F.col("p") * F.col("factor") + F.col("bias"), F.lit(0.0))
    y = F.col("y")
    scored = tried.groupBy("day_of_week", "hour", "ord").agg(
        F.first("n").alias("n"), F.first("factor").alias("factor"), F.first("bias").alias("bias"),
        (F.sum(F.abs(y - q)) / F.greatest(F.sum("y"), F.lit(1.0)) * 100).alias("wape"),
        F.avg(q - y).alias("drift"), F.avg((q > y).cast("double")).alias("over"), F.avg((q < y).cast("double")).alias("under"),
    )
    dow, hour = F.col("day_of_week"), F.col("hour")
    positive = lambda x: F.greatest(x, F.lit(0.0))
    penalty = (
        F.when((dow == 5) & (hour >= 22), F.lit(0.55) * positive(-F.col("drift")) + F.lit(8.0) * positive(F.col("under") - 0.55))
        .when(dow == 5, F.lit(0.3) * positive(-F.col("drift")))
        .when(hour == 23, F.lit(0.6) * positive(F.col("drift")) + F.lit(20.0) * positive(F.col("over") - 0.48))
        .otherwise(F.lit(0.4) * positive(-F.col("drift")) + F.lit(0.25) * positive(F.col("drift")))
    )
    scored = scored.withColumn("score", F.col("wape") + penalty)
    return _first_best(scored, ["day_of_week", "hour", "n"], ["factor", "bias", "wape", "score"], "score", "wape")


def blend_weight(val: DataFrame, base: str, other: str, weights: Sequence[float]) -> DataFrame:
    """The weight w with the lowest WAPE of (1 − w) · base + w · other, in one row."""
    y = F.col("actual").cast("double")
    tried = val.select(y.alias("y"), F.col(base).alias("a"), F.col(other).alias("b"), F.explode(_grid([{"w": w} for w in weights])).alias("g"))
    tried = tried.select("y", "a", "b", "g.ord", "g.w")
    error = F.abs(F.col("y") - ((F.lit(1.0) - F.col("w")) * F.col("a") + F.col("w") * F.col("b")))
    scored = tried.groupBy("ord", "w").agg((F.sum(error) / F.greatest(F.sum("y"), F.lit(1.0)) * 100).alias("wape"))
    return _first_best(scored, [], ["w", "wape"], "wape")


def ensemble_weight(val: DataFrame, base: str, other: str) -> DataFrame:
    """Weight of the auxiliary model between 0 and 0.5 (21 values)."""
    return blend_weight(val, base, other, linspace(0.0, 0.5, 21))


def expert_weight(val: DataFrame, base: str, expert: str) -> DataFrame:
    """Weight of the Sunday-late model (11 values), fitted on Sunday-late rows."""
    late = val.filter((F.col("day_of_week") == 6) & F.col("hour").isin(fixed.WEEKEND_LATE_HOURS))
    return blend_weight(late, base, expert, linspace(0.0, 1.0, 11))


def regime(hour: Column) -> Column:
    return F.when(hour <= 2, "deep").when(hour <= 4, "ramp").otherwise("morning")


def zero_inflated_search(val: DataFrame) -> DataFrame:
    """Best threshold, blend and cap per hour regime (deep 0-2, ramp 3-4, morning 5-9).

    The joint score is a weighted sum of absolute errors, and the parameters of a regime touch
    only its own hours. So the regimes are searched apart: 10 + 60 + 100 combinations find the
    optimum of all 60 000. Input: hour, actual, prob, intensity, zone_hour_mean, baseline_blend.
    """
    grids = {}
    for name, lists in fixed.ZERO_INFLATED_SEARCH.items():
        rows = [
            {"threshold": t, "blend": b, "cap_mult": mult, "cap_bias": bias}
            for t in lists["threshold"]
            for b in lists["blend"]
            for mult, bias in lists["cap"]
        ]
        grids[name] = _grid(rows)
    name = regime(F.col("hour"))
    options = F.when(name == "deep", grids["deep"]).when(name == "ramp", grids["ramp"]).otherwise(grids["morning"])
    tried = val.select(
        name.alias("regime"), F.col("actual").cast("double").alias("y"), "prob", clip("intensity", 0.0, None).alias("intensity"),
        "zone_hour_mean", "baseline_blend", F.explode(options).alias("g"),
    ).select("*", "g.*").drop("g")
    gated = F.when(F.col("prob") < F.col("threshold"), F.lit(0.0)).otherwise(F.col("prob") * F.col("intensity"))
    blended = F.when(
        F.col("blend") > 0, (F.lit(1.0) - F.col("blend")) * gated + F.col("blend") * F.col("baseline_blend")
    ).otherwise(gated)
    cap = F.greatest(F.col("zone_hour_mean") * F.col("cap_mult") + F.col("cap_bias"), F.lit(0.0))
    q = F.greatest(F.least(blended, cap), F.lit(0.0))
    scored = tried.groupBy("regime", "ord", "threshold", "blend", "cap_mult", "cap_bias").agg(
        F.sum(F.abs(F.col("y") - q)).alias("abs_error")
    )
    return _first_best(scored, ["regime"], ["threshold", "blend", "cap_mult", "cap_bias", "abs_error"], "abs_error")


def as_parameters(best: DataFrame) -> DataFrame:
    """The searched regimes as one row ``p`` of named post-processing parameters (three rows in)."""
    pick = lambda regime_name, column: F.max(F.when(F.col("regime") == regime_name, F.col(column)))
    fields = []
    for name in ("deep", "ramp", "morning"):
        fields.append(F.coalesce(pick(name, "threshold"), F.lit(fixed.ZERO_INFLATED_DEFAULTS[f"threshold_{name}"])).alias(f"threshold_{name}"))
        for part in ("mult", "bias"):
            default = fixed.ZERO_INFLATED_DEFAULTS[f"cap_{part}_{name}"]
            fields.append(F.coalesce(pick(name, f"cap_{part}"), F.lit(default)).alias(f"cap_{part}_{name}"))
    for name in ("ramp", "morning"):
        fields.append(F.coalesce(pick(name, "blend"), F.lit(0.0)).alias(f"{name}_blend_alpha"))
    return best.agg(F.struct(*fields, F.lit(0.0).alias("min_floor")).alias("p"))
