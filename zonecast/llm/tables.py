"""Tables written once in the shared folder, and columns every corpus operator reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.session import scratch_path

#: Row number added by ``numbered``; the name is not one a corpus table would use.
ROW = "_zc_row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` written once with a unique row number.

    Numbers drawn in a plan that is run twice need not agree; those of a written table do. The
    number, unlike ``doc_id``, is unique and never null. Texts are the bulk of it, so it is packed tightly.
    """
    path = scratch_path(docs.sparkSession, "numbered")
    rows = docs.withColumn(ROW, F.monotonically_increasing_id())
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def kind(df: DataFrame, name: str) -> str:
    """The DDL type of a column."""
    return df.schema[name].dataType.simpleString()
