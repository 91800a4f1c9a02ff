"""Sharding: a two-pass external shuffle.

Pass one scatters the records: the shard is the rendezvous choice of ``doc_id`` among the shards (the largest
of one seeded hash per shard), so it depends on nothing but the id and the number of shards, and one more shard takes
records only into itself. A second seeded hash picks a bucket inside the shard; there are as many as it takes for a
bucket to hold about ``bucket_bytes``. One exchange by bucket moves the records.

Pass two shuffles each bucket. Its records stand in a fixed order (sorted outside memory if need be); a
Fisher-Yates permutation of the bucket's length, drawn once per bucket with ``shuffle``, gives each its slot.
The permutation, one integer per record, is all of a bucket that is held in memory at once. Buckets of a shard follow
each other, so slots run without a gap from 0. ``write_shards`` writes the records in slot order.

No Python runs on the data. Null text has no bytes. A null ``doc_id`` hashes like any other value. Rows that agree in id and
text share a bucket and take neighbouring places before the shuffle. An empty table gives an empty result. Other columns pass
through; those the operator adds replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.tables import text_or_empty
from zonecast.session import materialize

OVERHEAD = 8


def record_size() -> Column:
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long")


def rendezvous(key: str, shards: int, seed: int) -> Column:
    """The shard whose seeded hash of the key is largest."""
    draws = [F.struct(F.xxhash64(F.lit(seed), F.lit(s), key).alias("draw"), F.lit(s).alias("shard")) for s in range(shards)]
    return (F.greatest(*draws) if shards > 1 else draws[0])["shard"]


def placed(docs: DataFrame, shards: int, buckets: int, seed: int) -> DataFrame:
    """``docs`` with their shard, bucket (over all shards) and place in the fixed order of a bucket."""
    line = F.xxhash64(F.lit(seed + 1), "doc_id", text_or_empty())
    return docs.withColumn("shard", rendezvous("doc_id", shards, seed)).withColumn("_zc_order", line).withColumn(
        "_zc_bucket", F.col("shard").cast("long") * buckets + F.pmod("_zc_order", F.lit(buckets))
    )


def permutations(counts: DataFrame, buckets: int, seed: int, tasks: int) -> DataFrame:
    """Each bucket's first slot in its shard and a random permutation of 0 .. n - 1.

    ``shuffle`` draws from one stream per task; fixed tasks and a fixed order in them make reruns agree.
    """
    before = Window.partitionBy(F.floor(F.col("_zc_bucket") / buckets)).orderBy("_zc_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.withColumn("_zc_first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    dealt = first.repartition(tasks, "_zc_bucket").sortWithinPartitions("_zc_bucket")
    return dealt.select(
        F.col("_zc_bucket").alias("_zc_of"), "_zc_first", F.shuffle(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")), seed + 2).alias("_zc_slots")
    )


def shard(docs: DataFrame, shards: int = 24, bucket_bytes: int = 32 << 20, seed: int = 1) -> DataFrame:
    """``docs`` with shard, slot and grown_shard (the shard if there were one more)."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(record_size())).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = placed(docs, shards, buckets, seed)
    counts = materialize(rows.groupBy("_zc_bucket").agg(F.count(F.lit(1)).alias("n")), "buckets")
    slots = materialize(permutations(counts, buckets, seed, min(tasks, shards * buckets)), "permutations")
    scattered = rows.repartition(min(shards * buckets, max(tasks, shards * buckets // 8)), "_zc_bucket")
    inside = Window.partitionBy("_zc_bucket").orderBy("_zc_order", "doc_id")
    standing = scattered.withColumn("_zc_at", F.row_number().over(inside))
    joined = standing.join(slots, standing["_zc_bucket"] == slots["_zc_of"])
    slot = (F.col("_zc_first") + F.element_at("_zc_slots", F.col("_zc_at"))).cast("long")
    return (
        joined.withColumn("slot", slot)
        .withColumn("grown_shard", rendezvous("doc_id", shards + 1, seed))
        .drop("_zc_bucket", "_zc_order", "_zc_at", "_zc_of", "_zc_first", "_zc_slots")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """A folder per shard, records in slot order inside each file."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("errorifexists").parquet(path)
