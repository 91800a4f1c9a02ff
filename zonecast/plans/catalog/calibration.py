"""Calibration, parameter searches, post-processing, ensembles and routing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from zonecast import rules as fixed
from zonecast.operators import calibrate as cal, grids, metrics as met, postprocess as post
from zonecast.plans.catalog.base import query, sql_table
from zonecast.plans.tables import stored_forecasts
from zonecast.session import materialize


def _val(spark, sf_dir):
    return stored_forecasts(spark, sf_dir).filter(F.col("split") == "val")


def _test(spark, sf_dir):
    return stored_forecasts(spark, sf_dir).filter(F.col("split") == "test")


def _clip(x: str, lo: float, hi: float) -> str:
    return f"least(greatest({x}, {lo}), {hi})"


# Night factors: three key levels.
LEVELS = [("holiday_weekend_hour", "is_holiday", "is_weekend"), ("weekend_hour", "-1", "is_weekend"), ("hour", "-1", "-1")]
_night = " UNION ALL ".join(
    f"SELECT '{name}' AS level, {a} AS is_holiday, {b} AS is_weekend, hour, (actual + 1) / (predicted + 1) AS ratio FROM val WHERE hour <= 4" for name, a, b in LEVELS
)
sql_table("night", "val", f"""SELECT *, {_clip('1 + n / (n + 120) * (raw_ratio - 1)', 0.75, 1.45)} AS factor FROM (
 SELECT level, is_holiday, is_weekend, hour, count(*)::DOUBLE AS n, median(ratio) AS raw_ratio FROM ({_night}) GROUP BY 1, 2, 3, 4 HAVING count(*) >= 30)""")
NIGHT_VALUE = """greatest(predicted * coalesce((SELECT factor FROM night f WHERE level = 'holiday_weekend_hour' AND f.is_holiday = r.is_holiday AND f.is_weekend = r.is_weekend AND f.hour = r.hour),
 (SELECT factor FROM night f WHERE level = 'weekend_hour' AND f.is_weekend = r.is_weekend AND f.hour = r.hour), (SELECT factor FROM night f WHERE level = 'hour' AND f.hour = r.hour), 1), 0)"""
sql_table("night_applied", "night forecasts", f"SELECT * REPLACE ({NIGHT_VALUE} AS predicted) FROM forecasts r WHERE split <> 'train'")


@query("night_factors", "level:s is_holiday:i is_weekend:i hour:i n:l raw_ratio:d factor:d", "SELECT * FROM night", "night")
def _(spark, sf_dir):
    return cal.night_factors(_val(spark, sf_dir))


@query("night_factors_applied", "PULocationID:l window_start:t hour:i predicted:d", "SELECT * FROM night_applied WHERE split = 'test'", "night_applied")
def _(spark, sf_dir):
    return cal.apply_night(_test(spark, sf_dir), materialize(cal.night_factors(_val(spark, sf_dir)), "night"))


def _errors(source: str, prefix: str) -> str:
    ape = "abs(actual - predicted) / CASE WHEN actual = 0 THEN 1 ELSE actual END"
    return f"""SELECT avg({ape}) * 100 AS {prefix}_mape, avg({ape}) FILTER (hour <= 4) * 100 AS {prefix}_night_mape,
     sum(abs(actual - predicted)) FILTER (hour <= 4) / greatest(sum(actual) FILTER (hour <= 4), 1) * 100 AS {prefix}_night_wape FROM {source}"""


@query(
    "night_gate",
    "raw_mape:d raw_night_mape:d raw_night_wape:d cal_mape:d cal_night_mape:d cal_night_wape:d enabled:b",
    f"""SELECT *, NOT ((cal_night_mape > raw_night_mape AND cal_night_wape > raw_night_wape) OR cal_mape > raw_mape + 0.25) AS enabled
     FROM ({_errors('val', 'raw')}), ({_errors("(SELECT * FROM night_applied WHERE split = 'val')", 'cal')})""",
    "val night_applied",
)
def _(spark, sf_dir):
    rows = _val(spark, sf_dir)
    return cal.night_gate(rows, materialize(cal.night_factors(rows), "night"))


def _ratio(source: str, keys: str, lo: float, hi: float, where: str = "TRUE") -> str:
    return f"""SELECT {keys}, count(*) AS n, CASE WHEN sum(actual) <= 1e-6 OR sum(predicted) <= 1e-6 THEN 1 ELSE {_clip('sum(actual) / sum(predicted)', lo, hi)} END AS factor
     FROM {source} WHERE {where} GROUP BY {keys}"""


sql_table("h_factor", "val", _ratio("val", "hour", 0.55, 1.45))
sql_table("dh_factor", "val", _ratio("val", "day_of_week, hour", 0.45, 1.65))
CRITICAL = "hour IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 21, 22, 23)"
sql_table("h_bias", "val", f"SELECT hour, {_clip('median(actual - predicted)', -1200, 1200)} AS bias FROM val WHERE {CRITICAL} GROUP BY 1")
sql_table("h_affine", "val", f"""SELECT hour, {_clip('a', 0.7, 1.2)} AS a, {_clip('my - a * mp', -1500, 1500)} AS b FROM (SELECT hour, avg(actual) AS my, avg(predicted) AS mp,
 CASE WHEN var_pop(predicted) < 1e-9 THEN 1 ELSE covar_pop(predicted, actual) / var_pop(predicted) END AS a FROM val WHERE {CRITICAL} GROUP BY 1 HAVING count(*) >= 16)""")


@query("hour_factors", "hour:i n:l factor:d", "SELECT * FROM h_factor", "h_factor")
def _(spark, sf_dir):
    return cal.hour_factors(_val(spark, sf_dir))


@query("weekday_hour_factors", "day_of_week:i hour:i n:l factor:d", "SELECT * FROM dh_factor", "dh_factor")
def _(spark, sf_dir):
    return cal.dow_hour_factors(_val(spark, sf_dir))


@query("hour_bias", "hour:i bias:d", "SELECT * FROM h_bias", "h_bias")
def _(spark, sf_dir):
    return cal.hour_bias(_val(spark, sf_dir))


@query("hour_affine", "hour:i a:d b:d", "SELECT * FROM h_affine", "h_affine")
def _(spark, sf_dir):
    return cal.hour_affine(_val(spark, sf_dir))


@query(
    "hour_calibration_applied",
    "PULocationID:l window_start:t hour:i predicted:d",
    """SELECT v."PULocationID", v.window_start, v.hour, greatest(CASE WHEN a.a IS NOT NULL THEN a.a * v.predicted + a.b
     ELSE v.predicted * coalesce(nullif(d.factor, 1), h.factor, 1) + coalesce(b.bias, 0) END, 0) AS predicted FROM test v
     LEFT JOIN h_affine a ON a.hour = v.hour LEFT JOIN dh_factor d ON d.hour = v.hour AND d.day_of_week = v.day_of_week LEFT JOIN h_factor h ON h.hour = v.hour LEFT JOIN h_bias b ON b.hour = v.hour""",
    "test h_affine dh_factor h_factor h_bias",
)
def _(spark, sf_dir):
    val = _val(spark, sf_dir)
    return cal.apply_hour_calibration(
        _test(spark, sf_dir), cal.hour_factors(val), cal.dow_hour_factors(val), cal.hour_bias(val), cal.hour_affine(val)
    )


# Evening: factors, late affine search, weekend search.
sql_table("eh_factor", "val", _ratio("val", "hour", 0.75, 1.25, "hour >= 17"))
sql_table("edh_factor", "val", _ratio("val", "day_of_week, hour", 0.70, 1.30, "hour >= 17"))


@query(
    "evening_factors",
    "day_of_week:i hour:i n:l factor:d",
    "SELECT -1 AS day_of_week, * FROM eh_factor UNION ALL SELECT * FROM edh_factor",
    "eh_factor edh_factor",
)
def _(spark, sf_dir):
    hours, dow_hours = cal.evening_factors(_val(spark, sf_dir))
    return hours.withColumn("day_of_week", F.lit(-1)).unionByName(dow_hours)


def _axis(values: list[float], name: str) -> str:
    return "(VALUES " + ", ".join(f"({i}, {v!r}::DOUBLE)" for i, v in enumerate(values)) + f") AS {name}(i, v)"


sql_table("late_grid", "val", f"""SELECT hour, factor, bias, wape FROM (SELECT *, row_number() OVER (PARTITION BY hour ORDER BY round(wape, 9), ord) AS k FROM (
 SELECT hour, f.i * 24 + b.i AS ord, any_value(f.v) AS factor, any_value(b.v) AS bias, sum(abs(actual - greatest(predicted * f.v + b.v, 0))) / greatest(sum(actual), 1) * 100 AS wape
 FROM val, {_axis(grids.linspace(0.55, 1.15, 25), 'f')}, {_axis(grids.linspace(-15.0, 8.0, 24), 'b')} WHERE hour >= 22 GROUP BY 1, 2)) WHERE k = 1""")


@query("late_affine_search", "hour:i factor:d bias:d wape:d", "SELECT * FROM late_grid", "late_grid")
def _(spark, sf_dir):
    return grids.late_affine(_val(spark, sf_dir))


# The evening chain. Every step is fitted on the validation rows as the steps before it left them, kept only if
# it lowers their WAPE, and then applied to all rows.
sql_table("evening_cal", "forecasts eh_factor edh_factor late_grid", """SELECT f.* REPLACE (greatest(f.predicted * coalesce(d.factor, l.factor, h.factor, 1) + coalesce(l.bias, 0), 0) AS predicted) FROM forecasts f
 LEFT JOIN edh_factor d ON d.hour = f.hour AND d.day_of_week = f.day_of_week LEFT JOIN eh_factor h ON h.hour = f.hour LEFT JOIN late_grid l ON l.hour = f.hour WHERE f.hour >= 17""")
sql_table("val_cal", "evening_cal", "SELECT * FROM evening_cal WHERE split = 'val'")
sql_table("weekend_grid", "val_cal", """SELECT day_of_week, hour, n, factor, bias, wape, score FROM (SELECT *, row_number() OVER (PARTITION BY day_of_week, hour ORDER BY round(score, 9), round(wape, 9), ord) AS k FROM (
 SELECT *, wape + CASE WHEN day_of_week = 5 AND hour >= 22 THEN 0.55 * greatest(-drift, 0) + 8 * greatest(under - 0.55, 0) WHEN day_of_week = 5 THEN 0.3 * greatest(-drift, 0)
  WHEN hour = 23 THEN 0.6 * greatest(drift, 0) + 20 * greatest(over - 0.48, 0) ELSE 0.4 * greatest(-drift, 0) + 0.25 * greatest(drift, 0) END AS score FROM (
 SELECT day_of_week, hour, ord, any_value(n) AS n, any_value(factor) AS factor, any_value(bias) AS bias, sum(abs(y - q)) / greatest(sum(y), 1) * 100 AS wape, avg(q - y) AS drift,
  avg(CASE WHEN q > y THEN 1.0::DOUBLE ELSE 0 END) AS over, avg(CASE WHEN q < y THEN 1.0::DOUBLE ELSE 0 END) AS under FROM (
 SELECT *, greatest(p * factor + bias, 0) AS q FROM (
 SELECT h.day_of_week, h.hour, actual AS y, predicted AS p, n, i.i * 17 + j.i AS ord, f_lo + (f_hi - f_lo) / 16.0::DOUBLE * i.i AS factor, b_lo + (b_hi - b_lo) / 16.0::DOUBLE * j.i AS bias
 FROM val_cal h JOIN (SELECT day_of_week, hour, n, 1 - (1 - f0) * k AS f_lo, 1 + (f1 - 1) * k AS f_hi, b0 * k AS b_lo, b1 * k AS b_hi FROM (
  SELECT day_of_week, hour, count(*) AS n, least(1, count(*) / 300.0::DOUBLE) AS k FROM val_cal WHERE hour >= 21 AND day_of_week >= 5 GROUP BY 1, 2)
  JOIN (VALUES (5, 21, 0.85::DOUBLE, 1.15::DOUBLE, -10::DOUBLE, 10::DOUBLE), (5, 22, 0.88, 1.22, -1.25, 12), (5, 23, 0.88, 1.22, -1.25, 12), (6, 21, 0.72, 1, -14, 4), (6, 22, 0.72, 1, -14, 4), (6, 23, 0.66, 1, -8, 6))
   AS s(day_of_week, hour, f0, f1, b0, b1) USING (day_of_week, hour)) r USING (day_of_week, hour), (SELECT unnest(range(0, 17)) AS i) i, (SELECT unnest(range(0, 17)) AS i) j))
 GROUP BY 1, 2, 3))) WHERE k = 1""")




@query("weekend_search", "day_of_week:i hour:i n:l factor:d bias:d wape:d score:d", "SELECT * FROM weekend_grid", "weekend_grid")
def _(spark, sf_dir):
    val = _val(spark, sf_dir).filter(F.col("hour") >= 17)
    hours, dow_hours = cal.evening_factors(val)
    return grids.weekend_adjust(cal.apply_evening(val, hours, dow_hours, grids.late_affine(val)))


def _better(base: str, other: str, source: str, where: str, ratio: float) -> str:
    score = "sum(abs(actual - {})) / greatest(sum(actual), 1) * 100"
    return f"""SELECT *, coalesce(wape_other < wape_base * {ratio}::DOUBLE, FALSE) AS enabled FROM (
     SELECT {score.format(base)} AS wape_base, {score.format(other)} AS wape_other FROM {source} WHERE split = 'val' AND {where})"""


sql_table("evening_weekend", "evening_cal weekend_grid", """SELECT c.*, CASE WHEN w.factor IS NULL THEN predicted ELSE greatest(predicted * w.factor + w.bias, 0) END AS other
 FROM evening_cal c LEFT JOIN weekend_grid w ON w.hour = c.hour AND w.day_of_week = c.day_of_week""")
sql_table("weekend_gate", "evening_weekend", _better("predicted", "other", "evening_weekend", "hour >= 21 AND day_of_week >= 5", 1.0))
sql_table("evening_residual", "evening_weekend weekend_gate", """SELECT *, CASE WHEN hour >= 22 AND naive_day IS NOT NULL THEN greatest(predicted + least(greatest(least(greatest(
 naive_day - predicted, -greatest(0.2 * predicted, 3)), greatest(0.2 * predicted, 3)), -8), 8), 0) ELSE predicted END AS corrected
 FROM (SELECT * EXCLUDE (other) REPLACE (CASE WHEN (SELECT enabled FROM weekend_gate) THEN other ELSE predicted END AS predicted) FROM evening_weekend)""")
sql_table("residual_gate", "evening_residual", _better("predicted", "corrected", "evening_residual", "hour >= 22", 0.995))
sql_table("evening_chosen", "evening_residual residual_gate", """SELECT * EXCLUDE (corrected) REPLACE (CASE WHEN (SELECT enabled FROM residual_gate) THEN corrected ELSE predicted END AS predicted),
 greatest(naive_week, 0) AS expert FROM evening_residual""")
sql_table("expert_choice", "evening_chosen", f"""SELECT w, wape FROM (SELECT *, row_number() OVER (ORDER BY round(wape, 9), ord) AS k FROM (SELECT g.i AS ord, any_value(g.v) AS w,
 sum(abs(actual - ((1 - g.v) * predicted + g.v * expert))) / greatest(sum(actual), 1) * 100 AS wape FROM evening_chosen, {_axis(grids.linspace(0.0, 1.0, 11), 'g')}
 WHERE split = 'val' AND day_of_week = 6 AND hour >= 21 GROUP BY 1)) WHERE k = 1""")
sql_table("evening_final", "evening_chosen expert_choice", """SELECT "PULocationID", window_start, hour, day_of_week, split, actual,
 greatest(least(CASE WHEN hour >= 21 THEN 0.9 * p + 0.1 * baseline_blend ELSE p END, greatest(CASE WHEN hour >= 21 THEN 4 * zone_hour_mean + 6 ELSE 5 * zone_hour_mean + 6 END, 0)), 0) AS predicted
 FROM (SELECT *, CASE WHEN day_of_week = 6 AND hour >= 21 AND expert IS NOT NULL THEN (1 - w) * predicted + w * expert ELSE predicted END AS p
  FROM evening_chosen, (SELECT coalesce(max(w), 0) AS w FROM expert_choice))""")


@dataclass
class EveningChain:
    """Fitted evening post-processing; every table has at most 7 × 24 rows.

    ``naive_day`` stands in for the residual model and ``naive_week`` for the Sunday expert.
    """

    hours: DataFrame
    dow_hours: DataFrame
    late: DataFrame
    weekend: DataFrame
    weekend_gate: DataFrame
    residual_gate: DataFrame
    expert: DataFrame

    @classmethod
    def fit(cls, val: DataFrame) -> EveningChain:
        val = val.filter(F.col("hour") >= 17)
        hours, dow_hours = cal.evening_factors(val)
        late = materialize(grids.late_affine(val), "late")
        calibrated = cal.apply_evening(val, hours, dow_hours, late)
        weekend = materialize(grids.weekend_adjust(calibrated), "weekend")
        adjusted = cal.apply_weekend(calibrated, weekend, out="other")
        weekend_rows = F.col("hour").isin(fixed.WEEKEND_LATE_HOURS) & F.col("day_of_week").isin(5, 6)
        weekend_gate = materialize(cal.improvement(adjusted.filter(weekend_rows), "predicted", "other"), "gate")
        chosen = cls._residual(cal.choose(adjusted, weekend_gate, "predicted", "other"))
        residual_gate = materialize(cal.improvement(chosen.filter(F.col("hour").isin(fixed.LATE_HOURS)), "predicted", "corrected", 0.995), "gate")
        expert_rows = cal.choose(chosen, residual_gate, "predicted", "corrected").withColumn("expert", F.greatest("naive_week", F.lit(0.0)))
        expert = materialize(grids.expert_weight(expert_rows, "predicted", "expert"), "expert")
        return cls(hours, dow_hours, late, weekend, weekend_gate, residual_gate, expert)

    @staticmethod
    def _residual(rows: DataFrame) -> DataFrame:
        moved = rows.withColumns({"corrected": F.col("predicted"), "_delta": F.col("naive_day") - F.col("predicted")})
        return post.residual_correction(moved, "_delta", predicted="corrected").drop("_delta")

    def apply(self, rows: DataFrame) -> DataFrame:
        out = cal.apply_evening(rows.filter(F.col("hour") >= 17), self.hours, self.dow_hours, self.late)
        out = cal.choose(cal.apply_weekend(out, self.weekend, out="other"), self.weekend_gate, "predicted", "other")
        out = cal.choose(self._residual(out), self.residual_gate, "predicted", "corrected")
        weight = self.expert.agg(F.coalesce(F.max("w"), F.lit(0.0))).scalar()
        return post.evening_caps(post.expert_blend(out, "naive_week", weight)).drop("other", "corrected")


def _evening(rows):
    return EveningChain.fit(rows.filter(F.col("split") == "val")).apply(rows)


@query("evening_post_processed", "PULocationID:l window_start:t hour:i predicted:d", "SELECT * FROM evening_final", "evening_final")
def _(spark, sf_dir):
    return _evening(stored_forecasts(spark, sf_dir))


GATES = "step:s wape_base:d wape_other:d enabled:b"


@query("evening_gates", GATES, "SELECT 'weekend' AS step, * FROM weekend_gate UNION ALL SELECT 'residual', * FROM residual_gate", "weekend_gate residual_gate")
def _(spark, sf_dir):
    chain = EveningChain.fit(_val(spark, sf_dir))
    return chain.weekend_gate.withColumn("step", F.lit("weekend")).unionByName(chain.residual_gate.withColumn("step", F.lit("residual")))


@query("evening_expert", "w:d wape:d", "SELECT * FROM expert_choice", "expert_choice")
def _(spark, sf_dir):
    return EveningChain.fit(_val(spark, sf_dir)).expert


@query(
    "residual_and_expert",
    "PULocationID:l window_start:t hour:i predicted:d",
    """SELECT "PULocationID", window_start, hour, CASE WHEN day_of_week = 6 AND hour >= 21 THEN 0.7 * p + 0.3 * greatest(naive_week, 0) ELSE p END AS predicted FROM (
     SELECT *, CASE WHEN hour >= 22 THEN greatest(predicted + least(greatest(least(greatest(naive_day - predicted, -greatest(0.2 * predicted, 3)), greatest(0.2 * predicted, 3)), -8), 8), 0) ELSE predicted END AS p
     FROM forecasts WHERE hour >= 17 AND naive_week IS NOT NULL)""",
    "forecasts",
)
def _(spark, sf_dir):
    known = (F.col("hour") >= 17) & F.col("naive_week").isNotNull()
    rows = stored_forecasts(spark, sf_dir).filter(known).withColumn("delta", F.col("naive_day") - F.col("predicted"))
    return post.expert_blend(post.residual_correction(rows, "delta"), "naive_week", 0.3)


# Zero-inflated model: stand-in outputs, search, application.
ZI = """SELECT *, baseline_blend / (1 + baseline_blend) * CASE WHEN naive_day = 0 THEN 0.2 ELSE 1 END AS prob, 0.5 * naive_day + 0.7 * baseline_blend AS intensity FROM forecasts WHERE hour <= 9 AND naive_day IS NOT NULL"""
sql_table("zi", "forecasts", ZI)


def _zero_inflated_rows(rows):
    prob = F.col("baseline_blend") / (F.lit(1.0) + F.col("baseline_blend")) * F.when(F.col("naive_day") == 0, 0.2).otherwise(1.0)
    return rows.filter((F.col("hour") <= 9) & F.col("naive_day").isNotNull()).withColumns({"prob": prob, "intensity": F.lit(0.5) * F.col("naive_day") + F.lit(0.7) * F.col("baseline_blend")})


@query(
    "zero_inflated_defaults",
    "PULocationID:l window_start:t hour:i predicted:d",
    """SELECT "PULocationID", window_start, hour, greatest(least(CASE WHEN prob < CASE WHEN hour <= 2 THEN 0.22 ELSE 0.10 END THEN 0 ELSE prob * intensity END,
     CASE WHEN hour <= 2 THEN 3 * zone_hour_mean + 2 WHEN hour <= 4 THEN 3 * zone_hour_mean + 4 ELSE 4.5 * zone_hour_mean + 5 END), 0) AS predicted FROM zi""",
    "zi",
)
def _(spark, sf_dir):
    return post.zero_inflated(_zero_inflated_rows(stored_forecasts(spark, sf_dir)), fixed.ZERO_INFLATED_DEFAULTS)


def _zi_values() -> str:
    rows = []
    for regime, lists in fixed.ZERO_INFLATED_SEARCH.items():
        i = 0
        for t in lists["threshold"]:
            for b in lists["blend"]:
                for mult, bias in lists["cap"]:
                    rows.append(f"('{regime}', {i}, {t}::DOUBLE, {b}::DOUBLE, {mult}::DOUBLE, {bias}::DOUBLE)")
                    i += 1
    return "(VALUES " + ", ".join(rows) + ") AS g(regime, ord, threshold, blend, cap_mult, cap_bias)"


sql_table("zi_best", "zi", f"""SELECT regime, threshold, blend, cap_mult, cap_bias, abs_error FROM (SELECT *, row_number() OVER (PARTITION BY regime ORDER BY round(abs_error, 9), ord) AS k FROM (
 SELECT g.regime, ord, any_value(threshold) AS threshold, any_value(blend) AS blend, any_value(cap_mult) AS cap_mult, any_value(cap_bias) AS cap_bias,
  sum(abs(actual - greatest(least(CASE WHEN blend > 0 THEN (1 - blend) * q + blend * baseline_blend ELSE q END, greatest(zone_hour_mean * cap_mult + cap_bias, 0)), 0))) AS abs_error
 FROM (SELECT zi.*, g.*, CASE WHEN prob < threshold THEN 0 ELSE prob * intensity END AS q FROM zi JOIN {_zi_values()} ON g.regime = CASE WHEN hour <= 2 THEN 'deep' WHEN hour <= 4 THEN 'ramp' ELSE 'morning' END
  WHERE split = 'val') g GROUP BY 1, 2)) WHERE k = 1""")


@query("zero_inflated_search", "regime:s threshold:d blend:d cap_mult:d cap_bias:d abs_error:d", "SELECT * FROM zi_best", "zi_best")
def _(spark, sf_dir):
    rows = _zero_inflated_rows(stored_forecasts(spark, sf_dir))
    return grids.zero_inflated_search(rows.filter(F.col("split") == "val"))


sql_table("zi_final", "zi zi_best", """SELECT "PULocationID", window_start, hour, split, actual, greatest(least(CASE WHEN blend > 0 THEN (1 - blend) * q + blend * baseline_blend ELSE q END, greatest(zone_hour_mean * cap_mult + cap_bias, 0)), 0) AS predicted
 FROM (SELECT zi.*, b.*, CASE WHEN prob < threshold THEN 0 ELSE prob * intensity END AS q FROM zi JOIN zi_best b ON b.regime = CASE WHEN hour <= 2 THEN 'deep' WHEN hour <= 4 THEN 'ramp' ELSE 'morning' END)""")


def _low_hour(rows):
    low = _zero_inflated_rows(rows)
    best = grids.as_parameters(grids.zero_inflated_search(low.filter(F.col("split") == "val")))
    return post.zero_inflated(low.withColumn("_p", best.scalar()), F.col("_p")).drop("_p")


@query("zero_inflated_tuned", "PULocationID:l window_start:t hour:i predicted:d", "SELECT * FROM zi_final", "zi_final")
def _(spark, sf_dir):
    return _low_hour(stored_forecasts(spark, sf_dir))


@query(
    "bucket_expectation",
    "PULocationID:l window_start:t hour:i predicted:d",
    """SELECT "PULocationID", window_start, hour, greatest(least(CASE WHEN hour >= 21 THEN 0.8 * g + 0.2 * baseline_blend ELSE g END, CASE WHEN hour >= 21 THEN 3 * zone_hour_mean + 1 ELSE 4 * zone_hour_mean + 2 END), 0) AS predicted FROM (
     SELECT *, CASE WHEN p0 >= CASE WHEN hour <= 19 THEN 0.5 ELSE 0.4 END THEN 0 ELSE (1 - p0) * 0.7 * 2 + (1 - p0) * 0.3 * 6 END AS g FROM (SELECT *, 1 / (1 + baseline_blend) AS p0 FROM forecasts WHERE hour >= 17))""",
    "forecasts",
)
def _(spark, sf_dir):
    rows = stored_forecasts(spark, sf_dir).filter(F.col("hour") >= 17)
    zero = F.lit(1.0) / (F.lit(1.0) + F.col("baseline_blend"))
    rows = rows.withColumn("probs", F.array(zero, (F.lit(1.0) - zero) * 0.7, (F.lit(1.0) - zero) * 0.3))
    caps = {"cap_mult_late": 3.0, "cap_bias_late": 1.0, "cap_mult_evening": 4.0, "cap_bias_evening": 2.0}
    return post.bucket_expectation(rows, "probs", [0.0, 2.0, 6.0], 0.5, 0.4, blend=0.2, caps=caps)


# Ensembles and routing.
sql_table("inv", "val", """SELECT w1 / (w1 + w2 + w3) AS w_baseline_blend, w2 / (w1 + w2 + w3) AS w_naive_day, w3 / (w1 + w2 + w3) AS w_naive_week FROM (
 SELECT 1 / avg(abs(actual - baseline_blend)) AS w1, 1 / avg(abs(actual - naive_day)) AS w2, 1 / avg(abs(actual - naive_week)) AS w3 FROM val)""")
MODELS = ["baseline_blend", "naive_day", "naive_week"]


@query("inverse_error_weights", "w_baseline_blend:d w_naive_day:d w_naive_week:d", "SELECT * FROM inv", "inv")
def _(spark, sf_dir):
    return cal.inverse_mae_weights(_val(spark, sf_dir), MODELS)


@query(
    "ensemble_predictions",
    "PULocationID:l window_start:t predicted:d",
    """SELECT "PULocationID", window_start, w_baseline_blend * baseline_blend + w_naive_day * naive_day + w_naive_week * naive_week AS predicted FROM test, inv""",
    "test inv",
)
def _(spark, sf_dir):
    rows = stored_forecasts(spark, sf_dir)
    weights = cal.inverse_mae_weights(rows.filter(F.col("split") == "val"), MODELS)
    return cal.apply_weights(rows.filter(F.col("split") == "test"), weights, MODELS)


def _blend(source: str, base: str, other: str, weights: list[float]) -> str:
    return f"""SELECT w, wape FROM (SELECT *, row_number() OVER (ORDER BY round(wape, 9), ord) AS k FROM (SELECT g.i AS ord, any_value(g.v) AS w,
     sum(abs(actual - ((1 - g.v) * {base} + g.v * {other}))) / greatest(sum(actual), 1) * 100 AS wape FROM {source}, {_axis(weights, 'g')} GROUP BY 1)) WHERE k = 1"""


@query("ensemble_weight_search", "w:d wape:d", _blend("val", "baseline_blend", "naive_day", grids.linspace(0.0, 0.5, 21)), "val")
def _(spark, sf_dir):
    return grids.ensemble_weight(_val(spark, sf_dir), "baseline_blend", "naive_day")


@query(
    "expert_weight_search",
    "w:d wape:d",
    _blend("(SELECT * FROM val WHERE day_of_week = 6 AND hour >= 21)", "baseline_blend", "naive_week", grids.linspace(0.0, 1.0, 11)),
    "val",
)
def _(spark, sf_dir):
    return grids.expert_weight(_val(spark, sf_dir), "baseline_blend", "naive_week")


ROUTED = """SELECT f."PULocationID", f.window_start, f.hour, f.split, f.actual, coalesce(z.predicted, e.predicted, f.predicted) AS predicted,
 CASE WHEN z.predicted IS NOT NULL THEN 'low_hour' WHEN e.predicted IS NOT NULL THEN 'evening' ELSE 'main' END AS model_used FROM forecasts f
 LEFT JOIN zi_final z ON z."PULocationID" = f."PULocationID" AND z.window_start = f.window_start
 LEFT JOIN evening_final e ON e."PULocationID" = f."PULocationID" AND e.window_start = f.window_start"""
sql_table("routed", "forecasts zi_final evening_final", ROUTED)


def _routed(spark, sf_dir):
    """The specialists are functions of a row and a few fitted parameters, and their hours do not overlap:
    the rows of each part go through their own model and the parts are put together, without a join.
    """
    rows = stored_forecasts(spark, sf_dir)
    hour, keep = F.col("hour"), ["PULocationID", "window_start", "hour", "split", "actual", "predicted"]
    low_hours = (hour <= 9) & F.col("naive_day").isNotNull()
    low = _low_hour(rows).select(*keep, F.lit("low_hour").alias("model_used"))
    evening = _evening(rows).select(*keep, F.lit("evening").alias("model_used"))
    main = rows.filter((hour < 17) & ~low_hours).select(*keep, F.lit("main").alias("model_used"))
    return main.unionByName(low).unionByName(evening)


@query("hour_routed_forecast", "PULocationID:l window_start:t hour:i model_used:s predicted:d", "SELECT * FROM routed", "routed")
def _(spark, sf_dir):
    return _routed(spark, sf_dir)


@query(
    "hour_routed_metrics",
    "model_used:s n:l mae:d wape:d",
    "SELECT model_used, count(*) AS n, avg(abs(actual - predicted)) AS mae, sum(abs(actual - predicted)) / greatest(sum(actual), 1) * 100 AS wape FROM routed WHERE split = 'test' GROUP BY 1",
    "routed",
)
def _(spark, sf_dir):
    return met.evaluate(_routed(spark, sf_dir).filter(F.col("split") == "test"), ["model_used"])


@query(
    "improvement_gate",
    "wape_base:d wape_other:d enabled:b",
    """SELECT *, wape_other < wape_base * 0.995 AS enabled FROM (SELECT sum(abs(actual - naive_day)) / greatest(sum(actual), 1) * 100 AS wape_base,
     sum(abs(actual - baseline_blend)) / greatest(sum(actual), 1) * 100 AS wape_other FROM val WHERE hour >= 22)""",
    "val",
)
def _(spark, sf_dir):
    late = _val(spark, sf_dir).filter(F.col("hour").isin(fixed.LATE_HOURS))
    return cal.improvement(late, "naive_day", "baseline_blend", 0.995)


@query(
    "gated_predictions",
    "PULocationID:l window_start:t predicted:d",
    """SELECT "PULocationID", window_start, CASE WHEN (SELECT sum(abs(actual - naive_week)) < sum(abs(actual - naive_day)) FROM val) THEN naive_week ELSE naive_day END AS predicted FROM test""",
    "val test",
)
def _(spark, sf_dir):
    rows = stored_forecasts(spark, sf_dir)
    gate = cal.improvement(rows.filter(F.col("split") == "val"), "naive_day", "naive_week")
    return cal.choose(rows.filter(F.col("split") == "test"), gate, "naive_day", "naive_week")


@query(
    "aligned_predictions",
    "PULocationID:l window_start:t actual:d predicted:d",
    'SELECT "PULocationID", window_start, actual, predicted FROM evening_final',
    "evening_final",
)
def _(spark, sf_dir):
    rows = stored_forecasts(spark, sf_dir)
    return met.align(rows, _evening(rows))
