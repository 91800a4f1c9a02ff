"""The benchmark tables seen as trips, sales and a holiday calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ZONES = 4  # zones the trip view contains (1..4, plus the invalid 265)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trip_columns() -> list[Column]:
    """Trip columns as expressions over an event row; every cleaning rule rejects some rows."""
    e = F.expr
    return [
        e("CAST(event_id % 2 + 1 AS DOUBLE)").alias("VendorID"),
        e("CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 97 = 0 THEN ts - INTERVAL '3' YEAR ELSE ts END").alias("tpep_pickup_datetime"),
        e("CASE WHEN event_id % 89 = 0 THEN ts + INTERVAL '35' DAY ELSE timestampadd(SECOND, CAST(floor(value * 60) AS INT), ts) END").alias("tpep_dropoff_datetime"),
        e("CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 5 AS DOUBLE) END").alias("passenger_count"),
        e("value / 10").alias("trip_distance"),
        e("CAST(event_id % 8 AS DOUBLE)").alias("RatecodeID"),
        e("CASE WHEN event_id % 2 = 0 THEN 'N' ELSE 'Y' END").alias("store_and_fwd_flag"),
        e("CAST(CASE WHEN event_id % 50 = 0 THEN 265 ELSE user_id % 4 + 1 END AS DOUBLE)").alias("PULocationID"),
        e("CAST(event_id % 270 + 1 AS DOUBLE)").alias("DOLocationID"),
        e("CAST(event_id % 6 AS DOUBLE)").alias("payment_type"),
        e("value").alias("fare_amount"),
        e("CAST(event_id % 3 AS DOUBLE)").alias("extra"),
        e("CAST(0.5 AS DOUBLE)").alias("mta_tax"),
        e("CAST(event_id % 10 AS DOUBLE)").alias("tip_amount"),
        e("CASE WHEN event_id % 20 = 0 THEN CAST(6.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END").alias("tolls_amount"),
        e("CAST(0.25 AS DOUBLE)").alias("improvement_surcharge"),
        e("value + CAST(event_id % 10 AS DOUBLE)").alias("total_amount"),
        e("CAST(2.5 AS DOUBLE)").alias("congestion_surcharge"),
        e("CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(1.25 AS DOUBLE) END").alias("airport_fee"),
    ]


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*trip_columns())


def product_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the product mart reads of the sales: every line has its order, so orders are not joined."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("product_id"), F.col("l_extendedprice").alias("amount"))


def sales(spark: SparkSession, sf_dir: str, category: bool = True) -> DataFrame:
    """Order lines with their order and, if wanted, the part's type as category. The tables grow
    together, so the join strategy is left to the planner's size estimates and AQE (which also
    splits a key that holds very many lines).
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if category:
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
        joined = joined.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").alias("quantity"),
        *([F.col("p_type").alias("category")] if category else []),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_orderstatus").alias("status"),
    )


HOLIDAYS = [("2024-01-01", "New Year's Day"), ("2024-01-15", "Martin Luther King Jr. Day")]


def calendar(spark: SparkSession) -> DataFrame:
    """Holidays are an input of the library; these two lie inside the benchmark's time range."""
    days = [F.struct(F.lit(d).cast("date").alias("date"), F.lit(n).alias("name")) for d, n in HOLIDAYS]
    return spark.range(1).select(F.explode(F.array(*days)).alias("h")).select("h.*")
