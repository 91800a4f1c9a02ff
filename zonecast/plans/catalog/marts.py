"""Sales marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonecast.operators import marts, sketches
from zonecast.plans.adapters import product_sales, sales
from zonecast.plans.catalog.base import query, sql_table
from zonecast.session import scratch_path

sql_table("sales", "", """SELECT l_orderkey * 10 + l_linenumber AS transaction_id, o_custkey AS customer_id, l_partkey AS product_id, l_extendedprice AS amount, l_quantity AS quantity,
 p_type AS category, o_orderdate AS timestamp, o_orderstatus AS status FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey""")
sql_table("sales_typed", "sales", """SELECT *, amount * quantity AS total_value, CASE WHEN status = 'F' THEN 1 ELSE 0 END AS is_completed, strftime(timestamp, '%Y-%m') AS event_month FROM sales""")
SPEC = "transaction_id:l customer_id:l product_id:l amount:f quantity:f category:s timestamp:t status:s total_value:f is_completed:i event_month:s"


@query(
    "sales_silver",
    SPEC,
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY customer_id, product_id, amount, quantity, category, timestamp, status) AS rn FROM sales_typed) WHERE rn = 1""",
    "sales_typed",
)
def _(spark, sf_dir):
    return marts.sales_silver(sales(spark, sf_dir))


def _typed(spark, sf_dir):
    return marts.sales_silver(sales(spark, sf_dir, category=False), dedupe=False)


CUSTOMER = "SELECT customer_id, count(*) AS txn_count, sum(amount) AS total_spent, avg(is_completed) AS completion_rate FROM sales_typed GROUP BY 1"


@query("mart_customers", "customer_id:l txn_count:l total_spent:d4 completion_rate:d", CUSTOMER, "sales_typed")
def _(spark, sf_dir):
    return marts.customer_mart(_typed(spark, sf_dir))


@query("mart_customers_top", "customer_id:l txn_count:l total_spent:d4 completion_rate:d", CUSTOMER + " ORDER BY total_spent DESC, customer_id LIMIT 5", "sales_typed")
def _(spark, sf_dir):
    return marts.top_by(marts.customer_mart(_typed(spark, sf_dir)), "total_spent", "customer_id")


@query("mart_products", "product_id:l total_revenue:d4", "SELECT product_id, sum(amount) AS total_revenue FROM sales GROUP BY 1", "sales")
def _(spark, sf_dir):
    return marts.product_mart(product_sales(spark, sf_dir))


@query("mart_products_top", "product_id:l total_revenue:d4", "SELECT product_id, sum(amount) AS total_revenue FROM sales GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5", "sales")
def _(spark, sf_dir):
    return marts.top_by(marts.product_mart(product_sales(spark, sf_dir)), "total_revenue", "product_id")


@query(
    "mart_months",
    "event_month:s txn_count:l monthly_revenue:d4 avg_order_value:d4 active_customers:l",
    "SELECT event_month, count(*) AS txn_count, sum(amount) AS monthly_revenue, avg(amount) AS avg_order_value, count(DISTINCT customer_id) AS active_customers FROM sales_typed GROUP BY 1",
    "sales_typed",
)
def _(spark, sf_dir):
    return marts.monthly_mart(_typed(spark, sf_dir))


@query(
    "mart_months_approximate",
    "event_month:s txn_count:l monthly_revenue:d4 avg_order_value:d4 exact_customers:l close:b",
    """SELECT event_month, count(*) AS txn_count, sum(amount) AS monthly_revenue, avg(amount) AS avg_order_value, count(DISTINCT customer_id) AS exact_customers, TRUE AS close
     FROM sales_typed GROUP BY 1""",
    "sales_typed",
)
def _(spark, sf_dir):
    """The sketch's count must lie within four of its relative standard deviations (5 %) of the exact one, or one customer."""
    typed = _typed(spark, sf_dir)
    exact = marts.monthly_mart(typed).select("event_month", F.col("active_customers").alias("exact_customers"))
    both = marts.monthly_mart(typed, approximate=True).join(exact, "event_month")
    away = F.abs(F.col("active_customers") - F.col("exact_customers"))
    return both.withColumn("close", away <= F.greatest(F.lit(1.0), F.lit(4 * 0.05) * F.col("exact_customers")))


@query(
    "mart_months_deduplicated",
    "event_month:s txn_count:l active_customers:l",
    """SELECT event_month, count(*) AS txn_count, count(DISTINCT customer_id) AS active_customers FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id
     ORDER BY customer_id, product_id, amount, quantity, category, timestamp, status) AS rn FROM sales_typed) WHERE rn = 1 GROUP BY 1""",
    "sales_typed",
)
def _(spark, sf_dir):
    return marts.monthly_mart(marts.sales_silver(sales(spark, sf_dir)))


@query("sales_rows_per_month", "event_month:s row_count:l", "SELECT event_month, count(*) AS row_count FROM sales_typed GROUP BY 1", "sales_typed")
def _(spark, sf_dir):
    return marts.rows_per_month(_typed(spark, sf_dir)).orderBy(F.col("event_month"))


PROBS = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


@query(
    "mart_months_from_days",
    "event_month:s days:l txn_count:l monthly_revenue:d4 avg_order_value:d4 exact_customers:l customers_close:b p50_close:b p90_close:b p99_close:b",
    """SELECT event_month, count(DISTINCT CAST(timestamp AS DATE)) AS days, count(*) AS txn_count, sum(amount) AS monthly_revenue, avg(amount) AS avg_order_value,
     count(DISTINCT customer_id) AS exact_customers, TRUE AS customers_close, TRUE AS p50_close, TRUE AS p90_close, TRUE AS p99_close FROM sales_typed GROUP BY 1""",
    "sales_typed",
)
def _(spark, sf_dir):
    """Months from stored daily sketches. Counts and sums are exact; the number of customers lies within four standard deviations, and the
    exact ranks around a quantile within twice the 99 % bound of its rank.
    """
    typed = _typed(spark, sf_dir)
    path = scratch_path(spark, "daily-sketches")
    sketches.store(sketches.daily(typed, "timestamp", "amount", "customer_id"), path)
    rolled = sketches.rolled_up(sketches.stored(spark, path), {"event_month": F.date_format("day", "yyyy-MM")}, PROBS)
    exact = marts.monthly_mart(typed).select("event_month", F.col("active_customers").alias("exact_customers"))
    ranks = typed.join(rolled.select("event_month", *PROBS), "event_month").groupBy("event_month").agg(
        *[F.avg((F.col("amount") < F.col(p)).cast("int")).alias(f"{p}_below") for p in PROBS], *[F.avg((F.col("amount") <= F.col(p)).cast("int")).alias(f"{p}_upto") for p in PROBS]
    )
    both = rolled.join(exact, "event_month").join(ranks, "event_month")
    away = F.abs(F.col("distinct") - F.col("exact_customers"))
    slack = 2 * sketches.rank_error()
    near = {p: (F.col(f"{p}_below") <= q + slack) & (F.col(f"{p}_upto") >= q - slack) for p, q in PROBS.items()}
    return both.select(
        "event_month", "days", F.col("n").alias("txn_count"), F.col("value_sum").alias("monthly_revenue"), F.col("value_mean").alias("avg_order_value"), "exact_customers",
        (away <= F.greatest(F.lit(1.0), 4 * sketches.distinct_error() * F.col("exact_customers"))).alias("customers_close"), *[near[p].alias(f"{p}_close") for p in PROBS],
    )
