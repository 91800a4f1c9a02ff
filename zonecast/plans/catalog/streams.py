"""The streaming queries, run over the event files until they are used up."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from zonecast.functions.scalar import py_round
from zonecast.operators import clean
from zonecast.plans.adapters import table, trip_columns, trips
from zonecast.plans.catalog.base import STRICT_RULES, TABLES, query
from zonecast.plans.catalog.cleaning import ADAPTIVE, DURATION, ESSENTIAL
from zonecast.session import materialize, scratch_path
from zonecast.streaming import trips as st


def _trips(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return st.read_files(spark, sf_dir, schema, glob="events.parquet").select(*trip_columns())


def _finish(query_):
    query_.awaitTermination()


@query("stream_bronze", "PULocationID:d tpep_pickup_datetime:t fare_amount:d _layer:s", """SELECT *, 'bronze' AS _layer FROM trips""", "trips")
def _(spark, sf_dir):
    out = st.bronze_stream(_trips(spark, sf_dir))
    path = scratch_path(spark, "stream-bronze")
    _finish(st.start_append(out, path))
    return st.appended(spark, path, out.schema)


@query(
    "stream_silver",
    "PULocationID:d tpep_pickup_datetime:t trip_duration_min:d pickup_hour:i pickup_weekday:i _layer:s",
    """SELECT *, (epoch(date_trunc('second', tpep_dropoff_datetime)) - epoch(date_trunc('second', tpep_pickup_datetime))) / 60 AS trip_duration_min, hour(tpep_pickup_datetime) AS pickup_hour,
     isodow(tpep_pickup_datetime) - 1 AS pickup_weekday, 'silver' AS _layer FROM clean""",
    "clean",
)
def _(spark, sf_dir):
    out = st.silver_stream(_trips(spark, sf_dir))
    path = scratch_path(spark, "stream-silver")
    _finish(st.start_append(out, path))
    return st.appended(spark, path, out.schema)


#: Clean trips of any table of events.
STRICT_SQL = f"SELECT * FROM ({TABLES['trips'][1].replace('FROM events', 'FROM {{source}}')}) WHERE {' AND '.join(f'({r})' for r in STRICT_RULES)}".replace("{{source}}", "{source}")
#: Days on which the replayed files begin: three slices of the month, each read by a run of its own.
CUTS = ["2024-01-01", "2024-01-11", "2024-01-21", "2024-12-31"]


def _replay(spark, sf_dir, path, start, slices=None, name=None):
    """Runs a query once per slice of the events, in order: state and watermark go from run to run through its checkpoint."""
    events = table(spark, sf_dir, "events")
    slices = slices or [events.filter((F.col("ts") >= a) & (F.col("ts") < b)) for a, b in zip(CUTS[:-1], CUTS[1:])]
    files = os.path.join(path, "files")
    with st.ProgressLog(spark) as log:
        for rows in slices:
            rows.write.mode("append").parquet(files)
            running = start(st.read_files(spark, files, events.schema))
            _finish(running)
            log.wait(running)
        log.save(os.path.join(path, "progress"))
    return spark.read.parquet(os.path.join(path, "progress"))


def _strict(stream):
    return clean.apply_rules(stream.select(*trip_columns()), clean.strict_rules())


def _counted(spark, path, like):
    return st.upserted(spark, path, like.schema, ["PULocationID", "window_start"])


@query("stream_hourly_demand", "PULocationID:l window_start:t window_end:t trip_count:l", "SELECT * FROM demand", "demand")
def _(spark, sf_dir):
    """In order, a watermark of an hour loses nothing, and state older than that is dropped."""
    path = scratch_path(spark, "stream-gold")
    counts = lambda stream: st.hourly_counts(st.with_event_time(_strict(stream), delay="1 hour"))
    events = table(spark, sf_dir, "events")
    halves = [events.filter(F.col("ts") < "2024-01-16"), events.filter(F.col("ts") >= "2024-01-16")]
    _replay(spark, sf_dir, path, lambda stream: st.start_upsert(counts(stream), path), halves)
    return _counted(spark, path, counts(events))


@query(
    "stream_sliding_demand",
    "PULocationID:l window_start:t trip_count:l",
    """SELECT "PULocationID", date_trunc('hour', tpep_pickup_datetime) - i * INTERVAL 1 HOUR AS window_start, count(*) AS trip_count FROM clean, (SELECT unnest(range(0, 3)) AS i) GROUP BY 1, 2""",
    "clean",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "stream-sliding")
    counts = lambda stream: st.hourly_counts(st.with_event_time(_strict(stream), delay="1 hour"), size="3 hours", slide="1 hour")
    _replay(spark, sf_dir, path, lambda stream: st.start_upsert(counts(stream), path))
    return _counted(spark, path, counts(table(spark, sf_dir, "events")))


HELD = "event_id % 10 = 0 AND ts < TIMESTAMP '2024-01-11'"
LATE_CLEAN = STRICT_SQL.format(source=f"(SELECT * FROM events WHERE {HELD})")


@query(
    "stream_late_rows",
    "on_time:l windows:l dropped_windows:l input_rows:l",
    f"""SELECT (SELECT count(*) FROM clean) - (SELECT count(*) FROM ({LATE_CLEAN})) AS on_time,
     (SELECT count(*) FROM (SELECT DISTINCT "PULocationID", date_trunc('hour', tpep_pickup_datetime) FROM ({STRICT_SQL.format(source=f"(SELECT * FROM events WHERE NOT ({HELD}))")}))) AS windows,
     (SELECT count(*) FROM (SELECT DISTINCT "PULocationID", date_trunc('hour', tpep_pickup_datetime) FROM ({LATE_CLEAN}))) AS dropped_windows, (SELECT count(*) FROM events) AS input_rows""",
    "clean",
)
def _(spark, sf_dir):
    """A tenth of the first slice arrives last, weeks behind the watermark: it is dropped, and counted by window and zone."""
    path = scratch_path(spark, "stream-late")
    events = table(spark, sf_dir, "events")
    held = F.expr(HELD)
    counts = lambda stream: st.hourly_counts(st.with_event_time(_strict(stream), delay="1 hour"))
    slices = [events.filter((F.col("ts") < CUTS[1]) & ~held), events.filter(F.col("ts") >= CUTS[1]), events.filter(held)]
    progress = _replay(spark, sf_dir, path, lambda stream: st.start_upsert(counts(stream), path), slices)
    kept = _counted(spark, path, counts(events)).agg(F.sum("trip_count").alias("on_time"), F.count(F.lit(1)).alias("windows"))
    seen = progress.agg(F.struct(F.sum("dropped_late").alias("dropped_windows"), F.sum("input_rows").alias("input_rows")).alias("p")).scalar()
    return kept.withColumn("p", seen).select("on_time", "windows", "p.*")


def _counting(spark, sf_dir):
    """Slices as in ``stream_late_rows``, counted with the late rows kept."""
    path = scratch_path(spark, "stream-kept")
    events = table(spark, sf_dir, "events")
    held = F.expr(HELD)
    slices = [events.filter((F.col("ts") < CUTS[1]) & ~held), events.filter(F.col("ts") >= CUTS[1]), events.filter(held)]
    _replay(spark, sf_dir, path, lambda stream: st.start_counting(_strict(stream), path), slices)
    return path


@query("stream_late_repaired", "PULocationID:l window_start:t window_end:t trip_count:l", "SELECT * FROM demand", "demand")
def _(spark, sf_dir):
    """Rows weeks behind the watermark are kept aside and folded in by a repair run: stream and repair equal the batch result."""
    path = _counting(spark, sf_dir)
    st.repair(spark, path)
    st.repair(spark, path)
    return st.counted(spark, path)


@query(
    "stream_late_kept",
    "PULocationID:l on_time:l late:l",
    f"""SELECT "PULocationID", count(*) FILTER (NOT held) AS on_time, count(*) FILTER (held) AS late FROM (
     SELECT "PULocationID", FALSE AS held FROM ({STRICT_SQL.format(source=f"(SELECT * FROM events WHERE NOT ({HELD}))")}) UNION ALL SELECT "PULocationID", TRUE FROM ({LATE_CLEAN})) GROUP BY 1""",
    "clean",
)
def _(spark, sf_dir):
    path = _counting(spark, sf_dir)
    on_time = st.counted(spark, path).groupBy("PULocationID").agg(F.sum("trip_count").alias("on_time"))
    late = st.late_rows(spark, path).groupBy(F.col("PULocationID").cast("long").alias("PULocationID")).agg(F.count(F.lit(1)).alias("late"))
    return on_time.join(late, "PULocationID", "left").withColumn("late", F.coalesce("late", F.lit(0)))


@query(
    "stream_deduplicated",
    "user_id:l n:l",
    "SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1",
)
def _(spark, sf_dir):
    """One row per user and type for good: such keys have no end, so their state is kept for the whole range of times."""
    path = scratch_path(spark, "stream-unique")
    unique = lambda stream: st.deduplicate(st.with_event_time(stream, ts="ts", delay="400 days"), ["user_id", "event_type"]).select("user_id", "event_type")
    _replay(spark, sf_dir, path, lambda stream: st.start_append(unique(stream), path))
    return st.appended(spark, path, unique(table(spark, sf_dir, "events")).schema).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("stream_redelivered", "event_type:s n:l total:d4", "SELECT event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1")
def _(spark, sf_dir):
    """Every event is delivered twice; a watermark of an hour is enough to drop the second copies."""
    path = scratch_path(spark, "stream-redelivered")
    events = table(spark, sf_dir, "events")
    slices = [p.unionByName(p) for p in (events.filter((F.col("ts") >= a) & (F.col("ts") < b)) for a, b in zip(CUTS[:-1], CUTS[1:]))]
    unique = lambda stream: st.deduplicate(st.with_event_time(stream, ts="ts", delay="1 hour"), ["event_id"]).drop("event_time")
    _replay(spark, sf_dir, path, lambda stream: st.start_append(unique(stream), path), slices)
    rows = st.appended(spark, path, events.schema)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query(
    "stream_adaptive_silver",
    "tpep_pickup_datetime:t PULocationID:i trip_distance:f fare_amount:f passenger_count:f",
    f"SELECT * FROM trips WHERE {ADAPTIVE}",
    "trips",
)
def _(spark, sf_dir):
    """The rules are decided once from the stored trips, then applied to every micro-batch."""
    path = scratch_path(spark, "stream-adaptive")
    known = clean.coerce_trips(trips(spark, sf_dir))
    profile = materialize(clean.adaptive_profile(known, 2024, 1), "profile")
    cleaned = lambda stream: st.adaptive_stream(stream.select(*trip_columns()), 2024, 1, profile)
    _replay(spark, sf_dir, path, lambda stream: st.start_append(cleaned(stream), path))
    return st.appended(spark, path, cleaned(table(spark, sf_dir, "events")).schema)


DRIFTED = " UNION ALL ".join(
    f"""SELECT {i} AS batch, CASE WHEN {i} > 0 AND "DOLocationID" > 30 THEN NULL ELSE passenger_count END AS p, {ESSENTIAL} AND {DURATION} AND trip_distance BETWEEN 0.1 AND 100 AND fare_amount >= 1 AS ok
     FROM ({TABLES['trips'][1].replace('FROM events', f"FROM (SELECT * FROM events WHERE ts >= TIMESTAMP '{a}' AND ts < TIMESTAMP '{b}')")})"""
    for i, (a, b) in enumerate(zip(CUTS[:-1], CUTS[1:]))
)


@query(
    "stream_running_profile",
    "batch:l rules:i n:l",
    f"""SELECT batch, CASE WHEN used THEN 7 ELSE 3 END AS rules, CASE WHEN used THEN good ELSE n END AS n FROM (
     SELECT *, sum(filled) OVER (ORDER BY batch) / sum(n) OVER (ORDER BY batch) >= 0.5 AS used FROM (
      SELECT batch, count(*) AS n, count(p) AS filled, count(*) FILTER (coalesce(p, 1) > 0) AS good FROM ({DRIFTED}) WHERE ok GROUP BY 1))""",
)
def _(spark, sf_dir):
    """From the second slice on most passenger counts are missing: the share over all slices so far decides for each."""
    path = scratch_path(spark, "stream-running")
    drift = F.when((F.col("ts") >= CUTS[1]) & (F.col("DOLocationID") > 30), F.lit(None).cast("double")).otherwise(F.col("passenger_count"))

    def start(stream):
        rows = stream.select("ts", *trip_columns()).withColumn("passenger_count", drift).drop("ts")
        return st.start_adaptive(rows, path, 2024, 1)

    _replay(spark, sf_dir, path, start)
    return spark.read.parquet(os.path.join(path, "data")).groupBy(F.col("batch").cast("long").alias("batch"), "rules").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stream_filter_progress",
    "rows_in:l rows_out:l filtered_pct:d runs:l",
    "SELECT (SELECT count(*) FROM trips) AS rows_in, (SELECT count(*) FROM clean) AS rows_out, CAST(round_even(round((1 - (SELECT count(*) FROM clean)::DOUBLE / (SELECT count(*) FROM trips)) * 100, 9), 1) AS DOUBLE) AS filtered_pct, 3 AS runs",
    "trips clean",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "stream-progress")
    silver = lambda stream: st.silver_stream(stream.select(*trip_columns()))
    progress = _replay(spark, sf_dir, path, lambda stream: st.start_append(silver(stream), path))
    seen = progress.agg(F.struct(F.sum("input_rows").alias("rows_in"), F.count_if(F.col("state") == "done").alias("runs")).alias("p")).scalar()
    written = st.appended(spark, path, silver(table(spark, sf_dir, "events")).schema).agg(F.count(F.lit(1)).alias("rows_out"))
    share = (F.lit(1.0) - F.col("rows_out") / F.col("rows_in")) * 100
    return written.withColumn("p", seen).select("rows_out", "p.*").withColumn("filtered_pct", py_round(share, 1))


#: Streams of a replay that run side by side.
LANES = 12


@query("stream_replayed_batches", "rows:l enough_batches:b total:d4", "SELECT count(*) AS rows, TRUE AS enough_batches, sum(fare_amount) AS total FROM trips", "trips")
def _(spark, sf_dir):
    """Files of 2000 rows at most from as many writers as the scan has, one file per micro-batch, in lanes side by side."""
    path = scratch_path(spark, "replay")
    source = table(spark, sf_dir, "events")
    st.write_replay(source, os.path.join(path, "files"), rows_per_file=2000, lanes=LANES)
    written = st.replay_lanes(spark, os.path.join(path, "files"), path, source.schema, LANES, trip_columns())
    sums = written.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("lane", "batch").alias("batches"), F.sum("fare_amount").alias("total"))
    return sums.withColumn("enough_batches", F.col("batches") >= F.ceil(F.col("rows") / 2000))


@query("stream_chained_tables", "PULocationID:l window_start:t trip_count:l", "SELECT * FROM demand", "demand")
def _(spark, sf_dir):
    path = scratch_path(spark, "chain")
    bronze = st.bronze_stream(_trips(spark, sf_dir))
    _finish(st.start_append(bronze, os.path.join(path, "bronze")))
    silver = st.silver_stream(st.read_files(spark, os.path.join(path, "bronze", "data"), bronze.schema))
    _finish(st.start_append(silver, os.path.join(path, "silver")))
    # One run reads the whole silver table here, in no order: the watermark must cover its range.
    events = st.with_event_time(st.read_files(spark, os.path.join(path, "silver", "data"), silver.schema), delay="40 days")
    counts = st.hourly_counts(events)
    _finish(st.start_upsert(counts, os.path.join(path, "gold")))
    return st.upserted(spark, os.path.join(path, "gold"), counts.schema, ["PULocationID", "window_start"])
