"""Writing tables, and reading them back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from zonecast.functions import scalar


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> dict:
    """Replaces the whole table, schema included; returns the number of rows written.

    The count is observed while writing, so no second pass is made.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static").options(**options).save(path)
    return {"rows": seen.get["rows"], "columns": len(df.columns)}


def overwrite_partitions(df: DataFrame, path: str, keys: Sequence[str], fmt: str = "parquet") -> dict:
    """Replaces only the partitions present in ``df``.

    Rows are rebalanced by the partition keys: AQE splits a month that holds most rows over many tasks, and
    no task opens every partition.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    spread = counted.hint("rebalance", *keys)
    spread.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).save(path)
    return {"rows": seen.get["rows"], "columns": len(df.columns)}


#: Rows of a report that is one file.
REPORT_ROWS = 100_000


def write_csv(df: DataFrame, path: str) -> None:
    """Report table as CSV with a header: one file up to ``REPORT_ROWS`` rows, else as many as there are tasks.

    Looking at one row more than that decides, so a large table is never sent to one task.
    """
    small = df.limit(REPORT_ROWS + 1).count() <= REPORT_ROWS
    (df.coalesce(1) if small else df).write.mode("overwrite").option("header", True).csv(path)


def all_null_columns(df: DataFrame) -> DataFrame:
    """One row with a flag per column: TRUE where no row holds a value. One aggregate for all."""
    return df.agg(*[(F.count(F.col(f"`{c}`")) == 0).alias(c) for c in df.columns])


def null_safe(df: DataFrame, empty_columns: Sequence[str]) -> DataFrame:
    """Columns without any value become empty text, NULL text becomes empty text, zoned
    timestamps become zone-less ones. Other columns keep type and NULLs.
    """
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if field.name in empty_columns:
            col = F.lit("")
        elif isinstance(field.dataType, T.StringType):
            col = F.coalesce(col, F.lit(""))
        elif isinstance(field.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        out.append(col.alias(field.name))
    return df.select(out)


def write_null_safe(df: DataFrame, path: str) -> DataFrame:
    """Null-safe table write. The empty columns decide the schema, so they are looked up first."""
    flags = all_null_columns(df).first().asDict()
    safe = null_safe(df, [c for c, empty in flags.items() if empty])
    overwrite(safe, path)
    return safe


def read_back(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row about a written table: number of rows, number of columns, column list, schema text."""
    table = spark.read.format(fmt).load(path)
    return table.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows",
        F.lit(len(table.columns)).alias("columns"),
        F.lit(",".join(table.columns)).alias("column_list"),
        F.lit(table.schema.simpleString()).alias("schema"),
    )


def latest_rows(df: DataFrame, order: Sequence[str], columns: Sequence[str], limit: int = 8) -> DataFrame:
    """The newest rows for display: timestamps as text, NULLs kept (top-k, no full sort)."""
    newest = df.orderBy(*[F.desc(c) for c in order]).limit(limit)
    out = []
    for name in columns:
        col = F.col(name)
        if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
            col = scalar.display_time(col)
        out.append(col.alias(name))
    return newest.select(out)
