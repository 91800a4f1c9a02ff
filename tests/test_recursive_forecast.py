"""The recursive forecast of a model against a plain loop over lists."""

import math
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest

from zonecast.operators import forecast, regression as reg

DAY = datetime(2024, 2, 5)


@pytest.fixture(scope="module")
def counts():
    rng = np.random.default_rng(3)
    return {(z, DAY + timedelta(hours=-h)): int(rng.poisson(2 + z + math.sin(h / 4))) for z in (1, 2, 3) for h in range(1, (30 if z == 3 else 24 * 20)) if z != 2 or h % 7}


def plain(counts, zones, model, hours, holidays):
    out = {}
    for z in zones:
        past = {t: float(n) for (zone, t), n in counts.items() if zone == z}
        series = [past.get(DAY - timedelta(hours=h), 0.0) for h in range(169, 0, -1)]
        by_hour, by_week = defaultdict(list), defaultdict(list)
        for t, n in past.items():
            by_hour[t.hour].append(n)
            by_week[t.weekday(), t.hour].append(n)
        for k in range(hours):
            target = DAY + timedelta(hours=k)
            row = target - timedelta(hours=1)
            f = {f"lag_{n}h": series[-(n + 1)] for n in (1, 2, 3, 24, 168)} | {f"rolling_avg_{n}h": sum(series[-(n + 1) : -1]) / n for n in (3, 6, 24)}
            a, b = by_hour[target.hour], by_week[target.weekday(), target.hour]
            f["zone_hour_mean"] = sum(a) / len(a) if len(a) >= 5 else f["rolling_avg_24h"]
            f["zone_dow_hour_mean"] = sum(b) / len(b) if len(b) >= 3 else f["zone_hour_mean"]
            f |= {"hour": row.hour, "day_of_week": row.weekday(), "is_weekend": int(row.weekday() >= 5), "is_holiday": int(row.date() in holidays)}
            f |= {"hour_sin": math.sin(2 * math.pi * row.hour / 24), "dow_cos": math.cos(2 * math.pi * row.weekday() / 7)}
            total = model.intercept + sum(c * f[name] for name, c in model.coefficients.items())
            p = max(math.exp(min(total, 20.0)) if model.link == "log" else total, 0.0)
            out[z, target] = p
            series = [*series[1:], p]
            a.append(p)
            b.append(p)
    return out


LINEAR = reg.Linear(
    {"lag_1h": 0.2, "lag_2h": -0.05, "lag_3h": 0.05, "lag_24h": 0.1, "lag_168h": 0.1, "rolling_avg_3h": 0.2, "rolling_avg_6h": 0.1, "rolling_avg_24h": 0.1, "zone_hour_mean": 0.2,
     "zone_dow_hour_mean": 0.1, "is_weekend": 0.3, "is_holiday": -0.4, "hour_sin": 0.2, "dow_cos": 0.1, "day_of_week": 0.01, "hour": 0.01}, -0.2,
)
LOG = reg.Linear({"lag_1h": 0.05, "rolling_avg_24h": 0.05, "zone_hour_mean": 0.1, "is_holiday": 0.5}, 0.1, "log")
FALLING = reg.Linear({"rolling_avg_3h": 0.5}, -3.0)


@pytest.mark.parametrize("model, hours", [(LINEAR, 24), (LINEAR, 200), (LOG, 48), (FALLING, 24)])
def test_against_a_plain_loop(spark, counts, model, hours):
    """200 hours: the means by zone, weekday and hour take in predictions of the week before."""
    df = spark.createDataFrame([(z, t, n) for (z, t), n in counts.items()], "PULocationID long, window_start timestamp_ntz, trip_count long")
    calendar = spark.createDataFrame([(DAY.date(), "a"), (DAY.date(), "b")], "date date, name string")
    zones = spark.createDataFrame([(1,), (2,), (3,), (9,)], "PULocationID long")
    got = forecast.recursive_model_forecast(df, df, zones, "2024-02-05", model, calendar, hours).collect()
    want = plain(counts, (1, 2, 3, 9), model, hours, {DAY.date()})
    assert {(r["PULocationID"], r["window_start"]): r["predicted"] for r in got} == pytest.approx(want)
    assert len(got) == 4 * hours and all(r["hour"] == r["window_start"].hour for r in got)


def test_no_python_in_the_plan(spark, counts):
    df = spark.createDataFrame([(z, t, n) for (z, t), n in counts.items()], "PULocationID long, window_start timestamp_ntz, trip_count long")
    plan = forecast.recursive_model_forecast(df, df, df.select("PULocationID").distinct(), "2024-02-05", LINEAR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
