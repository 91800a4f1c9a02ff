"""Customer, product and month marts over sales transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from zonecast.functions.scalar import to_time


def first_copies(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest in column order.

    ``min`` of the whole row combines copies before the shuffle, so a key with very many copies
    arrives as one row per map task.
    """
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("r")).select(key, "r.*").select(*df.columns)


def sales_silver(raw: DataFrame, completed: str = "F", dedupe: bool = True) -> DataFrame:
    """Transactions deduplicated, trimmed and typed, with total value, completion and month."""
    clean = raw.withColumns({f.name: F.trim(f.name) for f in raw.schema.fields if isinstance(f.dataType, T.StringType)})
    if isinstance(raw.schema["timestamp"].dataType, T.StringType):
        clean = clean.withColumn("timestamp", to_time("timestamp"))
    if dedupe:
        clean = first_copies(clean, "transaction_id")
    return clean.withColumns(
        {
            "total_value": F.col("amount") * F.col("quantity"),
            "is_completed": (F.col("status") == completed).cast("int"),
            "event_month": F.date_format("timestamp", "yyyy-MM"),
        }
    )


def customer_mart(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_spent"), F.avg("is_completed").alias("completion_rate")
    )


def product_mart(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_id").agg(F.sum("amount").alias("total_revenue"))


def monthly_mart(sales: DataFrame, approximate: bool = False) -> DataFrame:
    """Per month: transactions, revenue, average order value, active customers.

    Exact customers are first reduced to one row per (month, customer), so a month holding most
    sales is counted from partial results; ``approximate`` uses a fixed-size sketch.
    """
    if approximate:
        return sales.groupBy("event_month").agg(
            F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("monthly_revenue"),
            F.avg("amount").alias("avg_order_value"), F.approx_count_distinct("customer_id").alias("active_customers"),
        )
    by_customer = sales.groupBy("event_month", "customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s"), F.count("amount").alias("k")
    )
    return by_customer.groupBy("event_month").agg(
        F.sum("n").alias("txn_count"), F.sum("s").alias("monthly_revenue"),
        F.try_divide(F.sum("s"), F.sum("k")).alias("avg_order_value"), F.count("customer_id").alias("active_customers"),
    )


def rows_per_month(sales: DataFrame) -> DataFrame:
    return sales.groupBy("event_month").agg(F.count(F.lit(1)).alias("row_count"))


def top_by(df: DataFrame, column: str, key: str, k: int = 5) -> DataFrame:
    """The k largest rows; ties by key."""
    return df.orderBy(F.desc(column), F.asc(key)).limit(k)
