"""Looking into stored layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from zonecast.functions.scalar import rounded


def unpivot(row: DataFrame, names: list[str], name_col: str, value_col: str) -> DataFrame:
    """Columns of a frame as (name, value) rows."""
    pairs = F.array(*[F.struct(F.lit(n).alias(name_col), F.col(f"`{n}`").alias(value_col)) for n in names])
    return row.select(F.explode(pairs).alias("p")).select(f"p.{name_col}", f"p.{value_col}")


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs and row count per column, from one aggregate."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    items = [
        F.struct(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("__rows").alias("row_count"), F.col(f"`{f.name}`").alias("null_count"),
        )
        for f in df.schema.fields
    ]
    return counts.select(F.explode(F.array(*items)).alias("c")).select("c.*")


def describe_numeric(df: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of every numeric column, one pass."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]

    def stats(name: str):
        c = F.col(f"`{name}`").cast("double")
        return F.struct(
            F.lit(name).alias("column_name"), F.count(c).alias("count"), rounded(F.avg(c), 4).alias("mean"),
            rounded(F.stddev_samp(c), 4).alias("std"), rounded(F.min(c), 4).alias("min"), rounded(F.max(c), 4).alias("max"),
        )

    return df.agg(F.array(*[stats(n) for n in numeric]).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def file_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows and bytes per file below ``paths``; file sizes come from the scan's metadata."""
    files = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(paths).select("path", "length")
    return files.withColumn("file_name", F.element_at(F.split("path", "/"), -1))


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows per source file of a frame read straight from files."""
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count(F.lit(1)).alias("row_count"))


def layer_files(spark: SparkSession, root: str, depth: int = 1) -> DataFrame:
    """Number of files and bytes per folder below ``root`` (folder cut at ``depth``)."""
    files = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(root).select("path", "length")
    # The scan names a root with its scheme, which the caller's text may lack: cut after the root's last occurrence of itself.
    inner = root.rstrip("/").split("://")[-1].removeprefix("file:") + "/"
    relative = F.expr("substring(path, position(root, path) + length(root))")
    files = files.withColumn("root", F.lit(inner))
    parts = F.split(relative, "/")
    folder = F.array_join(F.slice(parts, 1, depth), "/")
    return files.groupBy(folder.alias("prefix")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
