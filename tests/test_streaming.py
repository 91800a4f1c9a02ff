import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from zonecast.streaming import trips as st

T0 = datetime(2024, 1, 1)
SCHEMA = "PULocationID double, tpep_pickup_datetime timestamp_ntz, trip_id bigint"


def write_files(spark, folder, batches):
    """One file per batch, with increasing modification times, so that they are read in order."""
    os.makedirs(folder)
    now = time.time() - 1000
    for i, rows in enumerate(batches):
        target = os.path.join(folder, f"part-{i}.parquet")
        spark.createDataFrame(rows, SCHEMA).toPandas().to_parquet(target, index=False, coerce_timestamps="us")
        os.utime(target, (now + i * 10, now + i * 10))


def trip(zone, hour, number):
    return (float(zone), T0 + timedelta(hours=hour, minutes=5), number)


def counts(spark, folder, out, delay):
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = st.with_event_time(st.read_files(spark, folder, schema, files_per_batch=1), delay=delay)
    result = st.hourly_counts(stream)
    with st.ProgressLog(spark) as log:
        query = st.start_upsert(result, out, name="counts")
        query.awaitTermination()
        log.wait(query)
    return st.upserted(spark, out, result.schema, ["PULocationID", "window_start"]), log


def as_dict(df):
    return {(r["PULocationID"], r["window_start"].hour): r["trip_count"] for r in df.collect()}


BATCHES = [[trip(1, 5, 1), trip(1, 5, 2)], [trip(1, 6, 3), trip(2, 9, 4)], [trip(1, 5, 5), trip(2, 9, 6)]]


def test_wide_watermark_equals_batch(spark, tmp_path):
    write_files(spark, str(tmp_path / "in"), BATCHES)
    got, log = counts(spark, str(tmp_path / "in"), str(tmp_path / "out"), "12 hours")
    assert as_dict(got) == {(1, 5): 3, (1, 6): 1, (2, 9): 2}
    assert sum(r[3] for r in log.rows) == 6 and sum(r[5] for r in log.rows) == 0 and log.rows[-1][6] == "done"


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    # A watermark filters rows from the second batch after the one that moved it.
    batches = [BATCHES[0], BATCHES[1], [trip(2, 9, 7)], BATCHES[2]]
    write_files(spark, str(tmp_path / "in"), batches)
    got, log = counts(spark, str(tmp_path / "in"), str(tmp_path / "out"), "1 hour")
    assert as_dict(got) == {(1, 5): 2, (1, 6): 1, (2, 9): 3}
    log.save(str(tmp_path / "progress"))
    assert spark.read.parquet(str(tmp_path / "progress")).agg(F.sum("dropped_late")).collect()[0][0] == 1


def test_stopped_query_continues(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_files(spark, folder, BATCHES[:2])
    counts(spark, folder, out, "12 hours")
    extra = str(tmp_path / "more")
    write_files(spark, extra, BATCHES[2:])
    os.rename(os.path.join(extra, "part-0.parquet"), os.path.join(folder, "part-9.parquet"))
    got, _ = counts(spark, folder, out, "12 hours")
    assert as_dict(got) == {(1, 5): 3, (1, 6): 1, (2, 9): 2}


def test_duplicates_within_the_watermark(spark, tmp_path):
    write_files(spark, str(tmp_path / "in"), [[trip(1, 5, 1), trip(1, 5, 1)], [trip(1, 5, 1), trip(1, 6, 2)]])
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = st.with_event_time(st.read_files(spark, str(tmp_path / "in"), schema, files_per_batch=1), delay="3 hours")
    unique = st.deduplicate(stream, ["trip_id"])
    st.start_append(unique, str(tmp_path / "out")).awaitTermination()
    assert sorted(r["trip_id"] for r in st.appended(spark, str(tmp_path / "out"), unique.schema).collect()) == [1, 2]


def test_new_replay_replaces_the_old_one(spark, tmp_path):
    out = str(tmp_path / "out")
    schema = spark.createDataFrame([], SCHEMA).schema
    for name, batches in (("a", BATCHES), ("b", BATCHES[:2])):
        write_files(spark, str(tmp_path / name), batches)
        stream = st.read_files(spark, str(tmp_path / name), schema, files_per_batch=1)
        st.start_table_replay(stream, out).awaitTermination()
    rows = spark.read.parquet(os.path.join(out, "data"))
    assert sorted(r["trip_id"] for r in rows.collect()) == [1, 2, 3, 4]


def test_replay_files_have_bounded_size(spark, tmp_path):
    st.write_replay(spark.range(25).coalesce(1), str(tmp_path / "f"), rows_per_file=10)
    sizes = sorted(r["count"] for r in spark.read.parquet(str(tmp_path / "f")).groupBy(F.input_file_name()).count().collect())
    assert sizes == [5, 10, 10]


def test_lanes_are_replayed_side_by_side(spark, tmp_path):
    """Every row once, repeated and null ones too; a file per micro-batch, no more files than one lane has; streams overlap in time."""
    rows = [trip(i % 3, i % 20, i // 2) for i in range(23)] + [(None, None, None)] * 2
    files, out = str(tmp_path / "f"), str(tmp_path / "out")
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    st.write_replay(df, files, rows_per_file=5, lanes=3)
    sizes = [r["count"] for r in spark.read.parquet(files).groupBy(F.input_file_name()).count().collect()]
    assert sizes == [5] * 5
    got = st.replay_lanes(spark, files, out, df.schema, 3)
    assert sorted((tuple(r) for r in got.drop("lane", "batch").collect()), key=str) == sorted(rows, key=str)
    assert sorted(tuple(r) for r in got.select("lane", "batch").distinct().collect()) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)]
    assert got.groupBy("lane", "batch").count().where("count > 5").count() == 0


def test_error_of_one_lane_is_raised(spark, tmp_path):
    df = spark.createDataFrame([trip(1, 5, i) for i in range(20)], SCHEMA).coalesce(1)
    st.write_replay(df, str(tmp_path / "f"), rows_per_file=5, lanes=3)
    broken = F.when(F.col("trip_id") == 7, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("trip_id")).alias("trip_id")
    with pytest.raises(StreamingQueryException, match="broken row"):
        st.replay_lanes(spark, str(tmp_path / "f"), str(tmp_path / "out"), df.schema, 3, [broken])
    assert not spark.streams.active


def test_lanes_of_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    st.write_replay(df, str(tmp_path / "f"), rows_per_file=5, lanes=3)
    assert st.replay_lanes(spark, str(tmp_path / "f"), str(tmp_path / "out"), df.schema, 3).count() == 0


def test_no_progress_of_a_long_run_is_lost(spark, tmp_path):
    write_files(spark, str(tmp_path / "in"), [[trip(1, 5, i)] for i in range(130)])
    schema = spark.createDataFrame([], SCHEMA).schema
    with st.ProgressLog(spark) as log:
        query = st.start_append(st.read_files(spark, str(tmp_path / "in"), schema, files_per_batch=1), str(tmp_path / "out"))
        query.awaitTermination()
        log.wait(query)
    assert sum(r[3] for r in log.rows) == 130 and len({r[2] for r in log.rows if r[2] is not None}) >= 130


def test_failed_query_is_an_error(spark, tmp_path):
    write_files(spark, str(tmp_path / "in"), BATCHES[:1])
    stream = st.read_files(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema)
    with st.ProgressLog(spark) as log:
        query = st.start_append(stream.withColumn("x", F.raise_error(F.lit("broken row")).cast("int")), str(tmp_path / "out"))
        with pytest.raises(StreamingQueryException):
            query.awaitTermination()
        log.wait(query)
    assert log.rows[-1][6] == "error" and "broken row" in log.rows[-1][7]


def test_compaction_keeps_the_table(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_files(spark, folder, BATCHES[:2])
    got, _ = counts(spark, folder, out, "12 hours")
    before = as_dict(got)
    st.compact(spark, out, got.schema, ["PULocationID", "window_start"])
    assert as_dict(st.upserted(spark, out, got.schema, ["PULocationID", "window_start"])) == before
    extra = str(tmp_path / "more")
    write_files(spark, extra, BATCHES[2:])
    os.rename(os.path.join(extra, "part-0.parquet"), os.path.join(folder, "part-9.parquet"))
    assert as_dict(counts(spark, folder, out, "12 hours")[0]) == {(1, 5): 3, (1, 6): 1, (2, 9): 2}


@pytest.mark.parametrize("cut", ["_complete", "_empty"])
def test_compaction_that_stops_halfway(spark, tmp_path, monkeypatch, cut):
    """Whatever is left undone, the table reads the same, and another call finishes."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    keys = ["PULocationID", "window_start"]
    write_files(spark, folder, BATCHES[:2])
    got, _ = counts(spark, folder, out, "12 hours")
    before = as_dict(got)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(st, cut, lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            st.compact(spark, out, got.schema, keys)
    assert as_dict(st.upserted(spark, out, got.schema, keys)) == before
    st.compact(spark, out, got.schema, keys)
    st.compact(spark, out, got.schema, keys)
    assert as_dict(st.upserted(spark, out, got.schema, keys)) == before
    assert spark.read.parquet(os.path.join(out, "data")).count() == 0
    extra = str(tmp_path / "more")
    write_files(spark, extra, BATCHES[2:])
    os.rename(os.path.join(extra, "part-0.parquet"), os.path.join(folder, "part-9.parquet"))
    assert as_dict(counts(spark, folder, out, "12 hours")[0]) == {(1, 5): 3, (1, 6): 1, (2, 9): 2}


def test_late_rows_are_kept_and_repaired(spark, tmp_path):
    """Rows behind the watermark stand aside; a repair folds them in once, however often it runs, and later ones the next time."""
    schema = "PULocationID double, tpep_pickup_datetime timestamp_ntz"
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(folder)

    def batch(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / name))
        source = next(f for f in os.listdir(tmp_path / name) if f.startswith("part-"))
        os.rename(tmp_path / name / source, os.path.join(folder, f"{name}.parquet"))
        stream = st.read_files(spark, folder, spark.createDataFrame([], schema).schema)
        st.start_counting(stream, out).awaitTermination()

    at = lambda h, m=0: datetime(2024, 1, 1, h, m)
    table = lambda repaired=True: {(r["PULocationID"], r["window_start"].hour): r["trip_count"] for r in st.counted(spark, out, repaired).collect()}
    batch("a", [(1.0, at(5)), (1.0, at(5, 30)), (2.0, at(8))])
    assert st.late_rows(spark, out).count() == 0
    st.repair(spark, out)
    batch("b", [(1.0, at(6)), (2.0, at(7, 1)), (2.0, at(9)), (None, at(9))])
    # The mark is 07:00: one hour before the latest event of the first batch.
    assert [(r["PULocationID"], r["batch"]) for r in st.late_rows(spark, out).collect()] == [(1.0, 1)]
    assert table() == {(1, 5): 2, (2, 8): 1, (2, 7): 1, (2, 9): 1, (None, 9): 1}
    st.repair(spark, out)
    st.repair(spark, out)
    assert table()[1, 6] == 1 and (1, 6) not in table(repaired=False)
    batch("c", [(1.0, at(6, 59)), (1.0, at(5))])
    st.repair(spark, out)
    assert table()[1, 6] == 2 and table()[1, 5] == 3
