"""Labelled rows, the only data models are fitted on: all of them, or a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.tables import kind


def _single(labels: DataFrame, column: str, allowed: Column | None = None) -> DataFrame:
    """(doc_id, label), one row a document."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & (allowed if allowed is not None else F.lit(True)))
    return usable.groupBy("doc_id").agg(F.min(column).cast("int").alias("label"))


def labelled(rows: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """All ``rows`` with label 0 or 1, with their ``label``. Null labels and null ids are left out; of several labels of one document the smallest counts."""
    return rows.join(_single(labels, column).where("label IN (0, 1)"), "doc_id")


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, bound: int, allowed: Column | None = None) -> DataFrame:
    """(doc_id, text, label) of at most ``bound`` rows of either label.

    The sample is the rows of the smallest hash of ``doc_id``, so it does not depend on the order of
    the table. Null labels and null ids are left out; of several labels of one document the smallest
    counts. The picked ids, at most ``2 * bound``, are broadcast; the texts are not shuffled.
    """
    single = _single(labels, column, allowed)
    picked = []
    for value in (0, 1):
        rows = single.where(F.col("label") == value).orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id").limit(bound).collect()
        picked += [(r["doc_id"], value) for r in rows]
    chosen = docs.sparkSession.createDataFrame(picked, f"doc_id {kind(labels, 'doc_id')}, label int")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
