"""Gold by change propagation against full rebuilds."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from zonecast.operators import demand as dem, features as feat, incremental as inc

T0 = datetime(2024, 1, 1)
SCHEMA = "PULocationID long, window_start timestamp_ntz, window_end timestamp_ntz, trip_count long"


def frame(spark, rows):
    return spark.createDataFrame([(z, T0 + timedelta(hours=h), T0 + timedelta(hours=h + 1), n) for z, h, n in rows], SCHEMA)


def whole(spark, batches, build):
    every = frame(spark, [r for b in batches for r in b])
    counts = every.groupBy("PULocationID", "window_start", "window_end").agg(F.sum("trip_count").alias("trip_count"))
    return build(dem.dense_grid(counts, 4))


def same(a, b):
    columns = sorted(b.columns)
    rows = lambda df: sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    assert sorted(a.columns) == columns and rows(a) == rows(b)


def lagged(grid):
    return feat.add_lags(dem.gold_features(grid).drop("lag_1h", "lag_2h", "rolling_avg_3h"))


@pytest.fixture(scope="module")
def batches():
    """Hours in order with gaps, then late ones between and before known hours, then new ones at the end."""
    rng = random.Random(5)
    row = lambda h: (rng.randint(1, 4), h, rng.randint(1, 9))
    first = [row(h) for h in range(0, 24 * 20) if h % 11 and not 100 <= h < 130 for _ in range(2)]
    return [first, [row(h) for h in (55, 110, 111, 240, 240)], [row(h) for h in range(24 * 20, 24 * 21)], [row(-30)]]


@pytest.mark.parametrize("build, reach", [(dem.gold_features, 3), (lagged, 168)])
def test_batches_equal_a_full_rebuild(spark, batches, tmp_path, build, reach):
    path = str(tmp_path / "store")
    for n, rows in enumerate(batches):
        told = inc.apply_batch(spark, path, n, frame(spark, rows), 4, build, reach).first()
        want = whole(spark, batches[: n + 1], build)
        same(inc.gold(spark, path), want)
        total = want.count()
        if n == 1:
            # Five hours changed: not more than the days of their readers are written.
            assert told["hours"] == 4 and told["rows"] <= (7 if reach == 3 else 20) * 24 * 4 and told["rows"] < total
        if n > 1 and reach == 3:
            assert told["rows"] <= 3 * 24 * 4


def test_a_batch_applied_again_changes_nothing(spark, batches, tmp_path):
    path = str(tmp_path / "store")
    for n in (0, 1, 1, 0, 1):
        inc.apply_batch(spark, path, n, frame(spark, batches[n]), 4)
    same(inc.gold(spark, path), whole(spark, batches[:2], dem.gold_features))


def test_a_stop_before_the_table_is_written(spark, batches, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    inc.apply_batch(spark, path, 0, frame(spark, batches[0]), 4)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(inc, "dense_grid", lost)
        with pytest.raises(RuntimeError):
            inc.apply_batch(spark, path, 1, frame(spark, batches[1]), 4)
    inc.apply_batch(spark, path, 1, frame(spark, batches[1]), 4)
    same(inc.gold(spark, path), whole(spark, batches[:2], dem.gold_features))
