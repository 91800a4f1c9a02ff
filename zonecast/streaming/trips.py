"""The batch transformations as Structured Streaming queries over a folder of trip files.

``availableNow`` reads everything present and stops, which takes the place of an end marker. Each
query keeps its offsets and state below the shared folder, so a restarted query continues where
it stopped, also after losing executors.
"""

from __future__ import annotations

import os
import threading
import uuid

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from zonecast import rules as fixed
from zonecast.operators.clean import (
    OPTIONAL_RULES, PICKUP, Rules, adaptive_clean, adaptive_outcomes, add_trip_columns, apply_rules, coerce_trips, decided, strict_rules,
)
from zonecast.sources.bronze import audit, normalize

ZONE_KEY = "PULocationID"


def read_files(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None, glob: str | None = None) -> DataFrame:
    """A stream of parquet files; ``files_per_batch`` bounds the size of a micro-batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def write_replay(df: DataFrame, path: str, rows_per_file: int = 10_000, lanes: int | None = None) -> None:
    """A table as a folder of files of at most ``rows_per_file`` rows, to be replayed as a stream.

    With ``lanes``, runs of ``rows_per_file`` rows of a writer are dealt to so many folders (``lane_path``), for as many streams side by side.
    Each run is one file, so there are no more files than without lanes.
    """
    writer = df.write
    if lanes:
        number = F.monotonically_increasing_id()
        run = F.floor(number.bitwiseAND((1 << 33) - 1) / rows_per_file) + F.shiftright(number, 33)
        writer = df.withColumn("lane", F.pmod(run, F.lit(lanes)).cast("int")).write.partitionBy("lane").option("partitionOverwriteMode", "static")
    writer.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def lane_path(path: str, lane: int) -> str:
    return os.path.join(path, f"lane={lane}")


def start_append(stream: DataFrame, path: str, name: str | None = None) -> StreamingQuery:
    """Appends the stream to a parquet table, exactly once, and stops when the input is used up."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", os.path.join(path, "_state"))
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True).start(os.path.join(path, "data"))


def appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(os.path.join(path, "data"))


def bronze_stream(stream: DataFrame) -> DataFrame:
    """Unified types and audit columns."""
    return audit(normalize(stream), "bronze")


def adaptive_stream(stream: DataFrame, year: int, month: int, profile: DataFrame) -> DataFrame:
    """Cleaning with the rules a profile of known trips decided on; the stream's own rows are not looked at first."""
    return adaptive_clean(stream, year, month, profile=profile)


def silver_stream(stream: DataFrame, rule_set: Rules | None = None) -> DataFrame:
    """Row-wise cleaning: only new rows are read, nothing is rewritten."""
    cleaned = add_trip_columns(apply_rules(stream, strict_rules() if rule_set is None else rule_set))
    return cleaned.withColumn("_layer", F.lit("silver"))


def with_event_time(stream: DataFrame, ts: str = PICKUP, delay: str = "1 hour") -> DataFrame:
    """Watermark on the event time (a zoned timestamp; the session runs in UTC)."""
    return stream.withColumn("event_time", F.col(ts).cast("timestamp")).withWatermark("event_time", delay)


def deduplicate(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Drops repeated records that arrive within the watermark; state is dropped after it."""
    return stream.dropDuplicatesWithinWatermark(keys)


def hourly_counts(stream: DataFrame, size: str = fixed.HOUR, slide: str | None = None) -> DataFrame:
    """Trips per zone and window of a watermarked stream. Rows older than the watermark are
    dropped, and counted in the query's progress.
    """
    window = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    counts = stream.groupBy(F.col(ZONE_KEY).cast("long").alias(ZONE_KEY), window.alias("w")).agg(F.count(F.lit(1)).alias("trip_count"))
    return counts.select(
        ZONE_KEY, F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), "trip_count"
    )


def start_upsert(stream: DataFrame, path: str, name: str | None = None) -> StreamingQuery:
    """Writes changed keys of every micro-batch into the folder of its batch number.

    Open windows are included (``update`` mode), and a batch that is run again after a failure
    replaces its own folder, so the log stays exact.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(os.path.join(path, "data", f"batch={number}"))

    writer = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", os.path.join(path, "_state"))
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True).start()


def upserted(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The current row of every key: the one of the latest batch (combined before the shuffle).

    After a ``compact`` that is the newest whole base and the batches after it; older batches are not read, whether they are still there or not.
    """
    numbered = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    log = spark.read.schema(numbered).parquet(os.path.join(path, "data"))
    base = _base(spark, path)
    if base is not None:
        whole = spark.read.schema(schema).parquet(os.path.join(path, "base", f"number={base}")).withColumn("batch", F.lit(base).cast("long"))
        log = log.filter(F.col("batch") > base).unionByName(whole)
    rest = [f.name for f in schema.fields if f.name not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*").select(*schema.names)


def _table_or_none(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """A parquet table, or None if its folder does not exist."""
    try:
        table = spark.read.schema(schema).parquet(path)
        table.schema  # noqa: B018  (resolves the path)
        return table
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _base(spark: SparkSession, path: str) -> int | None:
    """The number of the newest base that was completed: only then its number is in the table of bases."""
    done = _table_or_none(spark, os.path.join(path, "bases"), "number long")
    return None if done is None else done.agg(F.max("number")).first()[0]


def start_table_replay(stream: DataFrame, path: str) -> StreamingQuery:
    """A new run replaces the table with its first micro-batch and adds the later ones.

    Every batch owns one partition, which a repeated batch overwrites. The first batch overwrites
    the whole table, so rows of an earlier run do not survive.
    """
    data = os.path.join(path, "data")

    def write(batch: DataFrame, number: int) -> None:
        if number == 0:
            batch = batch.withColumn("batch", F.lit(number).cast("long"))
            batch.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch").parquet(data)
        else:
            batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(os.path.join(data, f"batch={number}"))

    state = os.path.join(path, f"_state-{uuid.uuid4().hex}")
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()


def replay_lanes(spark: SparkSession, files: str, path: str, schema: T.StructType, lanes: int, columns: list | None = None, files_per_batch: int = 1) -> DataFrame:
    """Replays the lanes of ``write_replay`` as streams that run side by side, and gives the table they wrote, with ``lane`` and ``batch``.

    A micro-batch costs the driver the same however few rows it has (logs, planning, a job, a commit), and those of one stream follow each other;
    those of different lanes do not wait. An error of one stream stops the others and is raised.
    """
    folders = [p for p in (lane_path(files, i) for i in range(lanes)) if _table_or_none(spark, p, schema) is not None]
    running = []
    try:
        for folder in folders:
            stream = read_files(spark, folder, schema, files_per_batch=files_per_batch)
            running.append(start_table_replay(stream.select(*columns) if columns else stream, os.path.join(path, os.path.basename(folder))))
        for query in running:
            query.awaitTermination()
    finally:
        for query in running:
            if query.isActive:
                query.stop()
    like = spark.createDataFrame([], schema)
    written = T.StructType([*(like.select(*columns) if columns else like).schema.fields, T.StructField("batch", T.LongType())])
    out = spark.createDataFrame([], written).withColumn("lane", F.lit(0))
    for folder in folders:
        name = os.path.basename(folder)
        table = spark.read.schema(written).parquet(os.path.join(path, name, "data")).withColumn("lane", F.lit(int(name.removeprefix("lane="))))
        out = out.unionByName(table)
    return out


PROGRESS_SCHEMA = "run string, name string, batch_id long, input_rows long, rows_per_second double, dropped_late long, state string, error string"


class ProgressLog(StreamingQueryListener):
    """Progress and end of the queries of a session, kept as rows: one per micro-batch, and a last one with the state
    ``done`` or ``error`` (and its message). Nothing of a long run is forgotten; ``save`` appends the rows to a table.

    Use as a context manager: it is registered on entry and removed on exit.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.rows: list[tuple] = []
        self._names: dict[str, str | None] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.streams.removeListener(self)

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._names[str(event.runId)] = event.name
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(int(o.numRowsDroppedByWatermark) for o in p.stateOperators)
        self.rows.append((str(p.runId), p.name, int(p.batchId), int(p.numInputRows), float(p.processedRowsPerSecond or 0.0), late, "running", None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        state = "error" if event.exception else "done"
        self.rows.append((run, self._names.get(run), None, 0, 0.0, 0, state, event.exception))
        self._end(run).set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the end of a terminated query has been reported (events arrive a little later)."""
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end of {query.name or query.id} within {seconds} s")

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(list(self.rows), PROGRESS_SCHEMA)

    def save(self, path: str) -> None:
        self.frame().write.mode("append").parquet(path)


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> None:
    """Shrinks the log of ``start_upsert`` to one row per key, between two runs of its query.

    The current rows become a base beside the log; once it is whole, one appended row makes readers use it in place of the batches up to its
    number, and only then are these emptied. Whenever this stops, readers find either the old batches or the base, and another call finishes.
    """
    data = os.path.join(path, "data")
    batches = sorted(r["batch"] for r in spark.read.parquet(data).select("batch").distinct().collect())
    base = _base(spark, path)
    if batches and (base is None or batches[-1] > base):
        upserted(spark, path, schema, keys).write.mode("overwrite").parquet(os.path.join(path, "base", f"number={batches[-1]}"))
        _complete(spark, path, batches[-1])
        base = batches[-1]
    _empty(spark, data, schema, [n for n in batches if n <= base] if base is not None else [])


def _complete(spark: SparkSession, path: str, number: int) -> None:
    spark.createDataFrame([(number,)], "number long").coalesce(1).write.mode("append").parquet(os.path.join(path, "bases"))


def _empty(spark: SparkSession, data: str, schema: T.StructType, batches: list[int]) -> None:
    for number in batches:
        spark.createDataFrame([], schema).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(os.path.join(data, f"batch={number}"))


def start_adaptive(stream: DataFrame, path: str, year: int, month: int, min_share: float = 0.5, name: str | None = None) -> StreamingQuery:
    """Adaptive cleaning with a profile that is carried from batch to batch.

    A batch adds its outcome counts to those of the batches before it; their sum decides which optional rules apply to it. Counts, rows and
    decisions of a batch are folders of its number, so a repeated batch replaces its own and decides as before. Every row keeps
    the number of its batch (partition ``batch``) and the rules it was held to (``rules``: a bit per optional rule, and 8 for the fallback).
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        rows = coerce_trips(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            put = lambda df, part: df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(os.path.join(path, part, f"batch={number}"))
            put(adaptive_outcomes(rows, year, month), "outcomes")
            known = spark.read.parquet(os.path.join(path, "outcomes")).filter(F.col("batch") <= number)
            flags = [c for c in known.columns if c not in ("n", "batch")]
            put(decided(known.groupBy(*flags).agg(F.sum("n").alias("n")), min_share), "profiles")
            profile = spark.read.parquet(os.path.join(path, "profiles", f"batch={number}"))
            bits = sum(F.col(f"use_{n}").cast("int") * (1 << i) for i, n in enumerate(OPTIONAL_RULES)) + F.col("fallback").cast("int") * 8
            put(adaptive_clean(rows, year, month, profile).withColumn("rules", profile.select(bits.alias("b")).scalar()), "data")
        finally:
            rows.unpersist()

    writer = stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", os.path.join(path, "_state"))
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True).start()


# -- Late rows -------------------------------------------------------------------------------------------------------------

MARKS = "latest timestamp, batch long"


def _counts(rows: DataFrame) -> DataFrame:
    start = F.date_trunc("hour", F.col("event_time")).cast("timestamp_ntz")
    counts = rows.groupBy(F.col(ZONE_KEY).cast("long").alias(ZONE_KEY), start.alias("window_start")).agg(F.count(F.lit(1)).alias("trip_count"))
    return counts.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL '1' HOUR")).select(ZONE_KEY, "window_start", "window_end", "trip_count")


def start_counting(stream: DataFrame, path: str, ts: str = PICKUP, delay: str = "1 hour", name: str | None = None) -> StreamingQuery:
    """Counts per zone and hour as a log of sums by micro-batch, with the rows behind the watermark kept aside.

    A row is late if it is older than the latest event of all earlier batches less ``delay``. What is on time is summed in ``counts``, what is
    late goes whole to ``late``, and the latest event of the batch to ``marks``. Every batch owns a folder in each of them, which a repeated
    batch overwrites with the same rows, as only earlier batches decide. There is no state but these tables.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("event_time", F.col(ts).cast("timestamp"))
        marks = _table_or_none(spark, os.path.join(path, "marks"), MARKS)
        mark = None if marks is None else marks.filter(F.col("batch") < number).agg((F.max("latest") - F.expr(f"INTERVAL {delay}")).alias("m")).first()["m"]
        late = F.col("event_time") < F.lit(mark) if mark is not None else F.lit(False)
        rows = rows.withColumn("_late", F.coalesce(late, F.lit(False))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for part, kept in (
                ("late", rows.filter("_late").drop("_late")),
                ("counts", _counts(rows.filter("NOT _late"))),
                ("marks", rows.agg(F.max("event_time").alias("latest"))),
            ):
                kept.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(os.path.join(path, part, f"batch={number}"))
        finally:
            rows.unpersist()

    writer = stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", os.path.join(path, "_state"))
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True).start()


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came behind the watermark, with their batch."""
    return spark.read.parquet(os.path.join(path, "late"))


def repair(spark: SparkSession, path: str) -> None:
    """Folds late rows into the counts. Each batch's late rows are summed in a folder of their own, so a run that is repeated or was cut off
    counts nothing twice, and rows that come later are folded by the next run.
    """
    numbered = late_rows(spark, path)
    counts = numbered.groupBy("batch", F.col(ZONE_KEY).cast("long").alias(ZONE_KEY), F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("window_start")).agg(F.count(F.lit(1)).alias("trip_count"))
    counts = counts.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL '1' HOUR"))
    counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(os.path.join(path, "repaired"))


COUNTS = f"{ZONE_KEY} long, window_start timestamp_ntz, window_end timestamp_ntz, trip_count long"


def counted(spark: SparkSession, path: str, repaired: bool = True) -> DataFrame:
    """Trips per zone and hour: the sums of all batches, with what ``repair`` added."""
    columns = [ZONE_KEY, "window_start", "window_end", "trip_count"]
    log = spark.read.schema(COUNTS).parquet(os.path.join(path, "counts")).select(*columns)
    extra = _table_or_none(spark, os.path.join(path, "repaired"), COUNTS) if repaired else None
    if extra is not None:
        log = log.unionByName(extra.select(*columns))
    return log.groupBy(ZONE_KEY, "window_start", "window_end").agg(F.sum("trip_count").alias("trip_count"))
