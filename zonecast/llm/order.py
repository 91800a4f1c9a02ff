"""Places of rows in the order of their group, without a task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.session import materialize

_PART, _TIE, _BEFORE = "_zc_part", "_zc_tie", "_zc_before"


def placed(rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with their place, from 0, in the ascending order (nulls first) of their group; ``keys`` are not null.

    A range exchange deals out (keys, order), so that a large group spreads over many tasks. Rows of a group in one task are ranked
    there, after the rows of the group in earlier tasks, of which a table with a row per group and task gives the number. Rows equal
    in everything get neighbouring places; a number breaks their tie, so that they need not share a task either.
    """
    tied = materialize(rows.withColumn(_TIE, F.monotonically_increasing_id()), "tied")
    dealt = tied.repartitionByRange(_tasks(rows), *keys, *order, _TIE).withColumn(_PART, F.spark_partition_id())
    dealt = materialize(dealt, "dealt")
    counts = dealt.groupBy(*keys, _PART).agg(F.count(F.lit(1)).alias("_zc_n"))
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    # Only groups that go on from an earlier task have an offset: about one a task.
    offsets = counts.withColumn(_BEFORE, F.sum("_zc_n").over(earlier)).where(F.col(_BEFORE) > 0).drop("_zc_n")
    inside = Window.partitionBy(*keys, _PART).orderBy(*order, _TIE)
    ranked = dealt.withColumn(name, F.row_number().over(inside).cast("long") - 1)
    place: Column = F.col(name) + F.coalesce(F.col(_BEFORE), F.lit(0))
    return ranked.join(offsets, [*keys, _PART], "left").withColumn(name, place).select(*rows.columns, name)


def _tasks(rows: DataFrame) -> int:
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
