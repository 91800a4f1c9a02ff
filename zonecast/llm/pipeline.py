"""The corpus pipeline: each stage is a function of (spark, docs, sf_dir) and works on all its predecessor kept.

All stages but the last return the columns of ``documents``, rows unchanged. Stages that look at several rows
number them first (``numbered``), so that null and repeated ids never decide which row is meant; their decisions come back to the
rows by that number, which is unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import bpe, mixing, near_copies, quality_rules
from zonecast.llm.exact_dedup import exact_duplicates
from zonecast.llm.tables import ROW, numbered, table
from zonecast.session import materialize


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go. The forest is fitted on labelled rows of this stage's own input."""
    forest = quality_rules.fit_rules(docs, table(spark, sf_dir, "labels"))
    return quality_rules.passing(docs, forest)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays: the longest, then the one with the smallest id."""
    rows = numbered(docs)
    kept = exact_duplicates(rows, row=ROW).where("kept").select(ROW)
    return rows.join(kept, ROW, "left_semi").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies (five words, similarity 0.8 or more) stays: the one with the smallest id (null last).

    SimHash classes are checked by whole sets of shingles; what lies further apart is found by ``near_copies`` from there.
    """
    rows = numbered(docs)
    return rows.join(near_copies.gone(rows, ROW), ROW, "left_anti").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    rows = numbered(docs)
    copies = mixing.mix(rows, carried=(ROW,)).where("copies > 0").select(ROW, F.col("copies").alias("_zc_copies"))
    taken = rows.join(copies, ROW)
    return taken.select(*docs.columns, F.explode(F.sequence(F.lit(1), "_zc_copies")).alias("_zc_copy")).drop("_zc_copy")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every row."""
    return bpe.Codec(docs).round_trip(docs)


STAGES = [
    ("quality_rules", rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixture),
    ("bpe", encode),
]

#: The forest and the automaton have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
