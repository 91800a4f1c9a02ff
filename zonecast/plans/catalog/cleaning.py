"""Sources, sinks, filters and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonecast import rules as fixed
from zonecast.functions import scalar
from zonecast.operators import clean, features as feat
from zonecast.plans.adapters import table, trips
from zonecast.plans.catalog.base import LOOSE_RULES, STRICT_RULES, query
from zonecast.plans.tables import clean_trips
from zonecast.session import scratch_path
from zonecast.sources import bronze, inspect, sinks

BRONZE_FILES = ("customer", "events", "supplier")


@query(
    "bronze_union_of_schemas",
    "_source_file:s _layer:s row_count:l c_custkey_sum:d s_acctbal_sum:d4 event_id_sum:d first_ts:t names:l",
    """
    SELECT _source_file, 'bronze' AS _layer, count(*) AS row_count, sum(c_custkey) AS c_custkey_sum, sum(s_acctbal) AS s_acctbal_sum,
     sum(event_id) AS event_id_sum, min(ts) AS first_ts, count(DISTINCT s_name) AS names FROM (
      SELECT 'customer.parquet' AS _source_file, CAST(c_custkey AS DOUBLE) AS c_custkey, NULL AS s_acctbal, NULL AS event_id, NULL AS ts, NULL AS s_name FROM customer
      UNION ALL SELECT 'events.parquet', NULL, NULL, CAST(event_id AS DOUBLE), ts, NULL FROM events
      UNION ALL SELECT 'supplier.parquet', NULL, s_acctbal, NULL, NULL, s_name FROM supplier) GROUP BY 1
    """,
)
def _(spark, sf_dir):
    df, _ = bronze.ingest(spark, [f"{sf_dir}/{name}.parquet" for name in BRONZE_FILES])
    return df.groupBy(F.element_at(F.split("_source_file", "/"), -1).alias("_source_file"), "_layer").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("c_custkey").alias("c_custkey_sum"), F.sum("s_acctbal").alias("s_acctbal_sum"),
        F.sum("event_id").alias("event_id_sum"), F.min("ts").alias("first_ts"), F.countDistinct("s_name").alias("names"),
    )


@query(
    "bronze_normalized_orders",
    "o_orderkey:f o_custkey:f o_orderstatus:s o_totalprice:f o_orderdate:t o_orderpriority:s",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def _(spark, sf_dir):
    return bronze.normalize(table(spark, sf_dir, "orders"))


@query(
    "bronze_audit_columns",
    "event_id:l _source_file:s _layer:s",
    "SELECT event_id, 'events.parquet' AS _source_file, 'bronze' AS _layer FROM events",
)
def _(spark, sf_dir):
    df = bronze.audit(table(spark, sf_dir, "events"), "bronze", source_file=True)
    return df.withColumn("_source_file", F.element_at(F.split("_source_file", "/"), -1))


@query(
    "bronze_skips_unreadable",
    "row_count:l damaged_files:l reasons:l",
    "SELECT count(*) AS row_count, 1 AS damaged_files, 1 AS reasons FROM supplier",
)
def _(spark, sf_dir):
    """Good files beside one that only calls itself Parquet; it is reported with its reason."""
    folder = scratch_path(spark, "damaged")
    table(spark, sf_dir, "supplier").write.parquet(f"{folder}/good")
    # A text file stands for the damaged one: its writer, too, only needs Spark's file systems.
    spark.range(1).select(F.lit("no parquet").alias("value")).write.text(f"{folder}/bad")
    bad = [p for p in bronze.discover(spark, [f"{folder}/bad"], suffix=".txt")]
    df, damaged = bronze.ingest(spark, [*bronze.discover(spark, [f"{folder}/good"]), *bad], with_audit=False, skip_damaged=True)
    report = damaged.agg(F.struct(F.count(F.lit(1)).alias("damaged_files"), F.count("reason").alias("reasons")).alias("d")).scalar()
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("d", report).select("row_count", "d.*")


@query(
    "context_of_fallbacks",
    "month:s n:l",
    """SELECT m AS month, count(*) AS n FROM (SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'first' ELSE 'second' END AS m FROM events) WHERE m = 'first' GROUP BY 1""",
)
def _(spark, sf_dir):
    """History is looked for in ordered places; only the archive of the year before holds it here."""
    folder = scratch_path(spark, "context")
    events = table(spark, sf_dir, "events").filter("ts < TIMESTAMP '2024-01-16'")
    events.write.parquet(f"{folder}/archive/m-2023-05")
    candidates = bronze.context_candidates(2024, 5, [folder + "/new/m-{year}-{month:02d}", folder + "/archive/m-{year}-{month:02d}"])
    found = spark.read.parquet(bronze.first_available(spark, candidates))
    return found.agg(F.lit("first").alias("month"), F.count(F.lit(1)).alias("n"))


@query(
    "null_safe_table",
    "PULocationID:f store_and_fwd_flag:s airport_fee:f promo_code:s comment:s",
    """
    SELECT "PULocationID", store_and_fwd_flag, airport_fee, '' AS promo_code,
     coalesce(CASE WHEN passenger_count IS NULL THEN NULL ELSE store_and_fwd_flag END, '') AS comment FROM trips
    """,
    "trips",
)
def _(spark, sf_dir):
    df = trips(spark, sf_dir).select(
        "PULocationID", "store_and_fwd_flag", "airport_fee", F.lit(None).cast("double").alias("promo_code"),
        F.when(F.col("passenger_count").isNotNull(), F.col("store_and_fwd_flag")).alias("comment"),
    )
    return sinks.write_null_safe(df, scratch_path(spark, "null-safe"))


@query(
    "partitioned_overwrite_read_back",
    "rows:l columns:i column_list:s",
    """SELECT count(*) AS rows, 5 AS columns, 'PULocationID,trip_distance,fare_amount,pickup_year,pickup_month' AS column_list FROM clean""",
    "clean",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "silver")
    df = clean.silver(trips(spark, sf_dir)).select("PULocationID", "trip_distance", "fare_amount", "pickup_year", "pickup_month")
    sinks.overwrite_partitions(df, path, ["pickup_year", "pickup_month"])
    return sinks.read_back(spark, path)


@query(
    "table_overwrite_read_back",
    "rows:l columns:i column_list:s",
    "SELECT count(*) AS rows, 6 AS columns, 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS column_list FROM orders",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    sinks.overwrite(bronze.normalize(table(spark, sf_dir, "orders")), path)
    return sinks.read_back(spark, path)


@query(
    "csv_report_round_trip",
    "status:s n:l total:d4",
    "SELECT o_orderstatus AS status, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1",
)
def _(spark, sf_dir):
    report = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n"), scalar.rounded(F.sum("o_totalprice"), 6).alias("total")
    )
    path = scratch_path(spark, "report") + ".csv"
    sinks.write_csv(report, path)
    return bronze.read_table(spark, path)


@query(
    "layer_null_counts",
    "column_name:s row_count:l null_count:l",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count("{c}") AS null_count FROM trips""" for c in fixed.TRIP_COLUMNS
    ),
    "trips",
)
def _(spark, sf_dir):
    return inspect.null_counts(trips(spark, sf_dir))


@query(
    "layer_describe_numeric",
    "column_name:s count:l mean:d4 std:d4 min:d4 max:d4",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max FROM lineitem"
        for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
)
def _(spark, sf_dir):
    return inspect.describe_numeric(table(spark, sf_dir, "lineitem"))


@query(
    "layer_rows_per_file",
    "file_name:s row_count:l",
    " UNION ALL ".join(f"SELECT '{t}.parquet' AS file_name, count(*) AS row_count FROM {t}" for t in ("orders", "lineitem")),
)
def _(spark, sf_dir):
    parts = [inspect.rows_per_file(table(spark, sf_dir, name)) for name in ("orders", "lineitem")]
    return parts[0].unionByName(parts[1])


@query("layer_files", "prefix:s files:l sized:b", "SELECT 'clean/hour=' || h AS prefix, 1 AS files, TRUE AS sized FROM (SELECT DISTINCT hour(tpep_pickup_datetime) AS h FROM clean)", "clean")
def _(spark, sf_dir):
    """Files of a layer this query writes: cleaned trips by hour of day, one file each."""
    root = scratch_path(spark, "layer")
    rows = clean_trips(spark, sf_dir).withColumn("hour", F.hour("tpep_pickup_datetime"))
    rows.repartition(24, "hour").write.partitionBy("hour").parquet(f"{root}/clean")
    files = inspect.layer_files(spark, root, depth=2).filter(F.col("prefix").startswith("clean/hour="))
    return files.withColumn("sized", F.col("bytes") > 0)


@query(
    "silver_strict",
    "VendorID:f tpep_pickup_datetime:t tpep_dropoff_datetime:t passenger_count:f trip_distance:f RatecodeID:f store_and_fwd_flag:s "
    "PULocationID:f DOLocationID:f payment_type:f fare_amount:f extra:f mta_tax:f tip_amount:f tolls_amount:f improvement_surcharge:f "
    "total_amount:f congestion_surcharge:f airport_fee:f trip_duration_min:d pickup_year:i pickup_month:i pickup_day:i pickup_hour:i "
    "pickup_dayofweek:i pickup_date:D _layer:s",
    """
    SELECT *, (epoch(date_trunc('second', tpep_dropoff_datetime)) - epoch(date_trunc('second', tpep_pickup_datetime))) / 60 AS trip_duration_min,
     year(tpep_pickup_datetime) AS pickup_year, month(tpep_pickup_datetime) AS pickup_month, day(tpep_pickup_datetime) AS pickup_day,
     hour(tpep_pickup_datetime) AS pickup_hour, dayofweek(tpep_pickup_datetime) + 1 AS pickup_dayofweek,
     CAST(tpep_pickup_datetime AS DATE) AS pickup_date, 'silver' AS _layer FROM clean
    """,
    "clean",
)
def _(spark, sf_dir):
    return clean.silver(trips(spark, sf_dir))


@query(
    "silver_loose",
    "tpep_pickup_datetime:t PULocationID:f DOLocationID:f trip_distance:f fare_amount:f passenger_count:f",
    "SELECT * FROM trips WHERE " + " AND ".join(f"({r})" for r in LOOSE_RULES),
    "trips",
)
def _(spark, sf_dir):
    return clean.apply_rules(trips(spark, sf_dir), clean.loose_rules())


def _waterfall_sql(names: list[str], conditions: list[str]) -> str:
    passed = ["TRUE"]
    for c in conditions:
        passed.append(f"{passed[-1]} AND coalesce(({c}), FALSE)")
    counts = ", ".join(f"count(*) FILTER ({p}) AS n{i}" for i, p in enumerate(passed))
    steps = " UNION ALL ".join(
        f"SELECT {i} AS position, '{n}' AS step, n{i - 1} AS before, n{i} AS after FROM c" for i, n in enumerate(names, start=1)
    )
    return f"""SELECT *, before - after AS dropped, CASE WHEN before > 0 THEN CAST(round_even(round((before - after) / before * 100, 9), 2) AS DOUBLE) ELSE 0 END AS dropped_pct
     FROM (WITH c AS (SELECT {counts} FROM trips) {steps})"""


@query(
    "clean_waterfall",
    "position:i step:s before:l after:l dropped:l dropped_pct:d",
    _waterfall_sql([n for n in ("times_present", "same_month", "year_range", "distance", "rate_code", "payment_type", "fare", "passengers", "pickup_zone", "dropoff_zone")], STRICT_RULES),
    "trips",
)
def _(spark, sf_dir):
    return clean.waterfall(trips(spark, sf_dir), clean.strict_rules())


@query(
    "clean_row_loss",
    "raw_rows:l kept_rows:l dropped_rows:l dropped_pct:d",
    """SELECT *, raw_rows - kept_rows AS dropped_rows, CAST(round_even(round((raw_rows - kept_rows) / raw_rows * 100, 9), 1) AS DOUBLE) AS dropped_pct
     FROM (SELECT (SELECT count(*) FROM trips) AS raw_rows, (SELECT count(*) FROM clean) AS kept_rows)""",
    "trips clean",
)
def _(spark, sf_dir):
    return clean.row_loss(trips(spark, sf_dir), clean.strict_rules())


ESSENTIAL = (
    'tpep_pickup_datetime IS NOT NULL AND "PULocationID" IS NOT NULL AND year(tpep_pickup_datetime) = 2024 '
    'AND month(tpep_pickup_datetime) = 1 AND "PULocationID" BETWEEN 1 AND 263'
)
DURATION = "(epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) / 60000000.0 BETWEEN 0.5 AND 360"
ADAPTIVE = f"{ESSENTIAL} AND {DURATION} AND trip_distance BETWEEN 0.1 AND 100 AND fare_amount >= 1 AND coalesce(passenger_count, 1) > 0"


@query(
    "silver_adaptive",
    "tpep_pickup_datetime:t tpep_dropoff_datetime:t PULocationID:i trip_distance:f fare_amount:f passenger_count:f",
    f"SELECT * FROM trips WHERE {ADAPTIVE}",
    "trips",
)
def _(spark, sf_dir):
    return clean.adaptive_clean(trips(spark, sf_dir), 2024, 1)


# A view whose passenger counts are mostly missing: the passenger rule must switch itself off.
SPARSE = "CASE WHEN DOLocationID > 100 THEN NULL ELSE passenger_count END"


@query(
    "silver_adaptive_sparse_column",
    "tpep_pickup_datetime:t PULocationID:i trip_distance:f fare_amount:f passenger_count:f",
    f"""SELECT tpep_pickup_datetime, "PULocationID", trip_distance, fare_amount, {SPARSE} AS passenger_count FROM trips
     WHERE {ESSENTIAL} AND {DURATION} AND trip_distance BETWEEN 0.1 AND 100 AND fare_amount >= 1""",
    "trips",
)
def _(spark, sf_dir):
    return clean.adaptive_clean(trips(spark, sf_dir).withColumn("passenger_count", F.expr(SPARSE)), 2024, 1)


@query(
    "silver_adaptive_fallback",
    "tpep_pickup_datetime:t PULocationID:i trip_distance:f fare_amount:f",
    f'SELECT tpep_pickup_datetime, "PULocationID", trip_distance, -fare_amount AS fare_amount FROM trips WHERE {ESSENTIAL}',
    "trips",
)
def _(spark, sf_dir):
    return clean.adaptive_clean(trips(spark, sf_dir).withColumn("fare_amount", -F.col("fare_amount")), 2024, 1)


@query(
    "silver_essential",
    "tpep_pickup_datetime:t PULocationID:i trip_distance:f",
    f"SELECT * FROM trips WHERE {ESSENTIAL}",
    "trips",
)
def _(spark, sf_dir):
    return clean.essential_clean(trips(spark, sf_dir), 2024, 1)


@query(
    "adaptive_waterfall",
    "position:i step:s before:l after:l dropped:l dropped_pct:d",
    _waterfall_sql(
        ["parse_datetime", "drop_missing_required", "pickup_month", "valid_zone", "duration", "trip_distance_optional", "fare_amount_optional", "passenger_count_optional"],
        [
            "TRUE", 'tpep_pickup_datetime IS NOT NULL AND "PULocationID" IS NOT NULL',
            "year(tpep_pickup_datetime) = 2024 AND month(tpep_pickup_datetime) = 1", '"PULocationID" BETWEEN 1 AND 263',
            DURATION, "trip_distance BETWEEN 0.1 AND 100", "fare_amount >= 1", "coalesce(passenger_count, 1) > 0",
        ],
    ),
    "trips",
)
def _(spark, sf_dir):
    return clean.adaptive_waterfall(trips(spark, sf_dir), 2024, 1)


@query(
    "trip_durations",
    "tpep_pickup_datetime:t fare_amount:f whole:d exact:d",
    """SELECT tpep_pickup_datetime, fare_amount,
     (epoch(date_trunc('second', tpep_dropoff_datetime)) - epoch(date_trunc('second', tpep_pickup_datetime))) / 60 AS whole,
     (epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) / 60000000.0 AS exact FROM trips""",
    "trips",
)
def _(spark, sf_dir):
    p, d = clean.PICKUP, clean.DROPOFF
    return trips(spark, sf_dir).select(
        p, "fare_amount", scalar.minutes_between(p, d).alias("whole"), scalar.minutes_between(p, d, whole_seconds=False).alias("exact")
    )


@query(
    "calendar_parts",
    "o_orderkey:l year:i month:i day:i hour:i dow_sun1:i dow_mon0:i date:D weekend_sun1:i weekend_mon0:i text:s",
    """SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day, hour(o_orderdate) AS hour,
     dayofweek(o_orderdate) + 1 AS dow_sun1, isodow(o_orderdate) - 1 AS dow_mon0, CAST(o_orderdate AS DATE) AS date,
     CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 1 ELSE 0 END AS weekend_sun1, CASE WHEN isodow(o_orderdate) > 5 THEN 1 ELSE 0 END AS weekend_mon0,
     strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS text FROM orders""",
)
def _(spark, sf_dir):
    d = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"), F.hour(d).alias("hour"),
        F.dayofweek(d).alias("dow_sun1"), F.weekday(d).alias("dow_mon0"), F.to_date(d).alias("date"),
        scalar.weekend_sun1(F.dayofweek(d)).alias("weekend_sun1"), scalar.weekend_mon0(F.weekday(d)).alias("weekend_mon0"),
        scalar.display_time(d).alias("text"),
    )


@query(
    "range_sanity_counts",
    "rows_in:l bad_zone:l bad_hour:l bad_dow:l rows_out:l",
    """SELECT count(*) AS rows_in, count(*) - count(*) FILTER (z BETWEEN 1 AND 263) AS bad_zone, count(*) FILTER (z BETWEEN 1 AND 263 AND h IS NULL) AS bad_hour,
     count(*) FILTER (z BETWEEN 1 AND 263 AND h IS NOT NULL AND d NOT BETWEEN 0 AND 6) AS bad_dow,
     count(*) FILTER (z BETWEEN 1 AND 263 AND h IS NOT NULL AND d BETWEEN 0 AND 6) AS rows_out
     FROM (SELECT "PULocationID" AS z, hour(tpep_pickup_datetime) AS h, dayofweek(tpep_pickup_datetime) + 1 AS d FROM trips)""",
    "trips",
)
def _(spark, sf_dir):
    df = trips(spark, sf_dir).withColumns({"hour": F.hour(clean.PICKUP), "day_of_week": F.dayofweek(clean.PICKUP)})
    return clean.range_sanity(df, max_zone=263)[1]


@query(
    "lossy_coercion",
    "event_id:l k:d text_number:d moment:t",
    """SELECT event_id, TRY_CAST(props->>'k' AS DOUBLE) AS k, TRY_CAST(CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(event_id AS VARCHAR) END AS DOUBLE) AS text_number,
     TRY_CAST(CASE WHEN event_id % 4 = 0 THEN 'unknown' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS moment FROM events""",
)
def _(spark, sf_dir):
    text = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("event_id").cast("string"))
    moment = F.when(F.col("event_id") % 4 == 0, F.lit("unknown")).otherwise(scalar.display_time("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", scalar.to_number(F.get_json_object("props", "$.k")).alias("k"), scalar.to_number(text).alias("text_number"),
        scalar.to_time(moment).alias("moment"),
    )


@query(
    "hour_floor_key",
    "tpep_pickup_datetime:t window_start:t",
    "SELECT tpep_pickup_datetime, date_trunc('hour', tpep_pickup_datetime) AS window_start FROM trips",
    "trips",
)
def _(spark, sf_dir):
    return clean.with_hour_key(trips(spark, sf_dir))


@query(
    "latest_records",
    "tpep_pickup_datetime:s PULocationID:f passenger_count:f total_amount:f",
    """SELECT strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS tpep_pickup_datetime, "PULocationID", passenger_count, total_amount
     FROM trips ORDER BY trips.tpep_pickup_datetime DESC NULLS LAST, total_amount DESC LIMIT 8""",
    "trips",
)
def _(spark, sf_dir):
    return sinks.latest_rows(
        trips(spark, sf_dir), ["tpep_pickup_datetime", "total_amount"], ["tpep_pickup_datetime", "PULocationID", "passenger_count", "total_amount"]
    )


@query(
    "feature_projection",
    "PULocationID:f trip_distance:f surge_level:f fare_amount:f",
    """SELECT "PULocationID", trip_distance, 0 AS surge_level, fare_amount FROM trips""",
    "trips",
)
def _(spark, sf_dir):
    return feat.project(trips(spark, sf_dir), ["PULocationID", "trip_distance", "surge_level", "fare_amount"])


@query(
    "year_month_of_names",
    "doc_id:l year:i month:i",
    """SELECT doc_id, TRY_CAST(regexp_extract(n, '(20\\d{2})-(\\d{2})', 1) AS INTEGER) AS year, TRY_CAST(regexp_extract(n, '(20\\d{2})-(\\d{2})', 2) AS INTEGER) AS month
     FROM (SELECT doc_id, CASE WHEN n_chars % 5 = 0 THEN source ELSE source || '_20' || (20 + n_chars % 6) || '-0' || (1 + n_chars % 9) || '.parquet' END AS n FROM documents)""",
)
def _(spark, sf_dir):
    name = F.expr("CASE WHEN n_chars % 5 = 0 THEN source ELSE source || '_20' || (20 + n_chars % 6) || '-0' || (1 + n_chars % 9) || '.parquet' END")
    year, month = scalar.year_month_of_name(name)
    return table(spark, sf_dir, "documents").select("doc_id", year.alias("year"), month.alias("month"))


@query(
    "status_documents",
    "o_orderstatus:s status:s",
    """SELECT o_orderstatus, '{"state":"done","rows":' || count(*) || ',"label":"' || o_orderstatus || '"}' AS status FROM orders GROUP BY o_orderstatus""",
)
def _(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("o_orderstatus", scalar.status_json(state=F.lit("done"), rows=F.col("n"), label=F.col("o_orderstatus")).alias("status"))


@query(
    "scalar_ratios",
    "l_orderkey:l l_linenumber:i l_extendedprice:f ratio:d division:d smoothed:d clipped:d half_even:d",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, least(greatest(coalesce(CASE WHEN l_tax = 0 THEN NULL ELSE l_discount / l_tax END, 0), 0), 10) AS ratio,
     CASE WHEN abs(l_discount) > 1e-6 THEN l_tax / l_discount ELSE 0 END AS division, (l_quantity + 1) / (l_tax + 1) AS smoothed,
     least(greatest(l_quantity - 25, -10), 10) AS clipped, CAST(round_even(round(l_quantity / 4, 9), 1) AS DOUBLE) AS half_even FROM lineitem""",
)
def _(spark, sf_dir):
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", scalar.safe_ratio("l_discount", "l_tax").alias("ratio"),
        scalar.safe_div("l_tax", "l_discount").alias("division"), scalar.smoothed_ratio("l_quantity", "l_tax").alias("smoothed"),
        scalar.clip(c("l_quantity") - 25, -10, 10).alias("clipped"), scalar.py_round(c("l_quantity") / 4, 1).alias("half_even"),
    )
