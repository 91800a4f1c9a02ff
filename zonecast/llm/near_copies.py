"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

Linked are all such pairs; classes are the connected components.

SimHash comes first: the classes of ``simhash`` (fingerprints of the same shingles at most two bits apart, by the generalised pigeonhole)
are candidates, each text of a class with the first one of it, and whole sets decide on them (``of_classes``). SimHash alone does not find all:
pairs of similarity 0.8 lie up to 14 of 64 bits apart, and a pigeonhole search that far sends each text to hundreds of buckets. The pairs
beyond two bits are found exactly by the steps below, which start from the components that the first links make.

1. Signatures: ``BANDS`` x ``WIDTH`` least values of differently keyed hashes of a text's shingles. Two texts of similarity s share the
   values of a whole band with probability s^3, and so miss each other in all 24 bands with (1 - s^3)^24: 3e-8 at s = 0.8, the
   worst case. Texts that share a band with another one are the members; only they go on. Equal sets are one member.
2. Order: the shingles of a member are ordered by the number of members that hold them, rarest first.
3. Prefixes: two sets of similarity 0.8 share one of the first ``n - ceil(0.8 n) + 1`` shingles of either, exactly. In a family of copies that
   were edited apart these are the edits, held by one member alone, and bring it together with none; shingles that very many texts
   share stand last. A member is sent once for each prefix shingle that another one has. The place of the shared shingle bounds the
   overlap that is left, which drops most of the other pairs.
4. Stars: in each bucket all members are compared with the one that has the least part of shingles of its own. Links make components.
5. Pairs of a bucket that lie in different components are compared. No pair is dropped.

A pair is linked by its whole shingle sets, value by value. Keys that hold more than one row in ``OFTEN`` (of which there are fewer than
``OFTEN``) are looked up in a broadcast table, and members that many pairs name are salted, so no exchange is uneven.

Words are maximal runs without white space, ASCII letters lower-cased. Texts of fewer than five words have one shingle; null text counts
as empty, and texts without words are copies of each other. Repeated rows and ties are copies of each other; of a class the smallest
``doc_id`` (null last), then the smallest row number stays. Very long texts are compared whole; the set of one text is one array. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm import simhash
from zonecast.llm.components import components
from zonecast.llm.text import U, mix, slices, word_hashes, words
from zonecast.session import materialize

SHINGLE = 5
#: Bits that SimHash fingerprints of one class lie apart at most, link by link.
DISTANCE = 2
#: Least similarity of a link, as a fraction of whole numbers: no rounding decides.
LEAST = (4, 5)
BANDS, WIDTH = 24, 3
#: A key is frequent if it holds more than one row in this many.
OFTEN = 1 << 16
#: Pairs that name one member, about, in one group of a join.
SALT = 4096
#: Bits of the filter that keeps texts of other documents out of the exchange of members: a power of two.
FILTER_BITS = 1 << 25
#: Text whose shingles are made at once.
SLICE_BYTES = 2 << 20
_K = U(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, one text after the other, and the place where each text begins (one more at the end)."""
    w = words([t.lower() for t in texts])
    h = word_hashes(w)
    counts = np.diff(w.first)
    pieces = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    owner = np.repeat(np.arange(len(texts)), pieces)
    at = w.first[:-1][owner] + np.arange(len(owner)) - (np.cumsum(pieces) - pieces)[owner]
    last = w.first[1:][owner]
    out = np.zeros(len(owner), U)
    for i in range(shingle):
        inside = at + i < last
        out[inside] = mix(out[inside] * _K + h[at[inside] + i])
    order = np.lexsort((out, owner))
    out, owner = out[order], owner[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def bands(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The band keys of each text, one row a text; texts without words share all of theirs."""
    out = np.zeros((len(first) - 1, BANDS), U)
    full = np.flatnonzero(np.diff(first))
    for band in range(BANDS):
        key = np.full(len(full), band, U)
        for i in range(WIDTH if len(full) else 0):
            salt = mix(np.array([band * WIDTH + i + 1], U))
            key = mix(key * _K + np.minimum.reduceat(mix(values ^ salt), first[full]))
        out[:, band] = mix(np.array([band], U))
        out[full, band] = key
    return out


def _column(batch: pa.RecordBatch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def _signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches, limit=SLICE_BYTES):
        values, first = shingle_sets(texts)
        keys = bands(values, first).view(np.int64).ravel()
        offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS)
        same = [xxhash.xxh3_128_digest(values[a:b].tobytes()) for a, b in zip(first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays(
            [_column(batch, "node"), pa.array(same, pa.binary()), pa.array(np.diff(first)), pa.ListArray.from_arrays(offsets, pa.array(keys))], ["node", "same", "size", "keys"]
        )


def _filtered(bits):
    """Rows whose node may be among the members: all members are, and few others."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = _place(_column(batch, "node").to_numpy(zero_copy_only=False))
            there = bits.value[place >> 3] >> (place & 7).astype(np.uint8) & 1
            yield batch.filter(pa.array(there.astype(bool)))

    return run


def _place(node: np.ndarray) -> np.ndarray:
    return (mix(node.view(U) + _K) & U(FILTER_BITS - 1)).astype(np.int64)


def _places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place = np.unique(_place(_column(batch, "node").to_numpy(zero_copy_only=False)))
        yield pa.RecordBatch.from_arrays([pa.array(place >> 5), pa.array(1 << (place & 31))], ["word", "bit"])


def _texts_of(rows: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of members. A filter of fixed size drops nearly all others where they are read; the join decides."""
    found = members.select("node").mapInArrow(_places, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()  # FILTER_BITS / 32 rows at most
    bits = np.zeros(FILTER_BITS // 32, "<u4")
    for r in found:
        bits[r["word"]] = r["bits"]
    shared = rows.sparkSession.sparkContext.broadcast(bits.view(np.uint8))
    return rows.mapInArrow(_filtered(shared), rows.schema).join(members.select("node"), "node", "left_semi")


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches, limit=SLICE_BYTES):
        values, first = shingle_sets(texts)
        lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))
        yield pa.RecordBatch.from_arrays([_column(batch, "node"), pa.array(np.diff(first)), lists], ["node", "size", "shingles"])


def _looked_up(rows: DataFrame, table: DataFrame, key: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has a row per key and ``n``, the number of rows with it; ``total`` rows in all."""
    often = F.broadcast(table.where(F.col("n") > total / OFTEN))
    rest = table.where(F.col("n") <= total / OFTEN)
    return rows.join(often, key).unionByName(rows.join(often.select(key), key, "left_anti").join(rest, key, how))


def _near(size: Column, other: Column) -> Column:
    return F.least(size, other) * LEAST[1] >= F.greatest(size, other) * LEAST[0]


def _reach(size: Column, pos: Column, other: Column) -> Column:
    """Whether the shingles from ``pos`` on suffice for the overlap that a set of ``other`` shingles needs."""
    return (size - pos) * (LEAST[0] + LEAST[1]) >= (size + other) * LEAST[0]


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough; ``b`` may be named by very many pairs."""
    pairs = materialize(pairs.distinct(), "pairs")
    named = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    total = pairs.count()
    often = materialize(named.where((F.col("n") > SALT) & (F.col("n") > total / OFTEN)).select("b", F.ceil(F.col("n") / SALT).alias("salts")), "often")
    salted = pairs.join(F.broadcast(often), "b", "left").withColumn("salt", F.pmod(F.xxhash64("a"), F.coalesce("salts", F.lit(1)).cast("long")))
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")).join(F.broadcast(often), "b", "left")
    b = b.select("b", "of_b", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)).cast("long") - 1)).alias("salt"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    enough = both * LEAST[1] >= (F.size("of_a") + F.size("of_b") - both) * LEAST[0]
    return salted.join(a, "a").join(b, ["b", "salt"]).where(enough).select("a", "b")


def prefixes(sets: DataFrame) -> DataFrame:
    """(key, node, size, pos, own): the prefix shingles that other members hold; ``own`` is the part that no other one holds."""
    rows = sets.select("node", "size", F.explode("shingles").alias("key"))
    held = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "held")
    total = held.agg(F.sum("n")).first()[0] or 0
    counted = _looked_up(rows, held, "key", total, "left").select("node", "size", F.struct(F.coalesce("n", F.lit(1)).alias("n"), "key").alias("item"))
    ordered = counted.groupBy("node", "size").agg(F.array_sort(F.collect_list("item")).alias("items"), F.avg((F.col("item.n") == 1).cast("int")).alias("own"))
    length = F.col("size") - F.ceil(F.col("size") * LEAST[0] / LEAST[1]) + 1
    cut = ordered.select("node", "size", "own", F.posexplode(F.slice("items", F.lit(1), length.cast("int"))).alias("pos", "item"))
    return cut.where("item.n > 1").select(F.col("item.key").alias("key"), "node", "size", "pos", "own")


def of_classes(sole: DataFrame, classes: DataFrame) -> DataFrame:
    """Candidates (a, b): each node of a class (node, root) with the smallest node of it; a class of any size is one star."""
    nodes = materialize(sole.select("node").join(classes, "node"), "classes")
    heads = materialize(nodes.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("b")).where("n > 1"), "heads")
    total = heads.agg(F.sum("n")).first()[0] or 0
    return materialize(_looked_up(nodes, heads, "root", total).where("node != b").select(F.col("node").alias("a"), "b"), "candidates")


def links(members: DataFrame, sets: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Edges (a, b) whose components are those of all similar pairs that share a key; ``members`` as ``prefixes`` gives them, ``known`` links are part of them."""
    state = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("size").alias("least"), F.min(F.struct("own", "node", "size", "pos")).alias("p")
    ).where("n > 1")
    state = materialize(state.select("key", "n", "least", F.col("p.node").alias("b"), F.col("p.size").alias("b_size"), F.col("p.pos").alias("b_pos")), "buckets")
    total = state.agg(F.sum("n")).first()[0] or 0
    size, pos = F.col("size"), F.col("pos")
    # A member that is too short from here on even for the smallest one of the bucket has no partner in it.
    met = _looked_up(members, state, "key", total).where(_reach(size, pos, F.col("least")))
    met = materialize(met.drop("own", "n", "least"), "members")
    stars = met.where((F.col("node") != F.col("b")) & _near(size, F.col("b_size")) & _reach(size, pos, F.col("b_size")) & _reach(F.col("b_size"), F.col("b_pos"), size))
    edges = _verified(stars.select(F.col("node").alias("a"), "b"), sets)
    edges = materialize(edges if known is None else edges.unionByName(known), "links")
    root = materialize(components(edges), "roots")

    now = met.select("key", "node", "size", "pos").join(root, "node", "left").withColumn("of", F.coalesce("root", "node")).drop("root")
    parts = now.groupBy("key", "of").agg(F.count(F.lit(1)).alias("c"))
    mixed = parts.groupBy("key").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("parts"), F.max_by("of", F.struct("c", "of")).alias("main")).where("parts > 1").drop("parts")
    mixed = materialize(mixed, "mixed")
    total = mixed.agg(F.sum("n")).first()[0] or 0
    now = materialize(_looked_up(now, mixed, "key", total).drop("n"), "crossing")
    # Every pair of two components has a member outside of the largest one; a pair outside of it is met once.
    outside = now.where("of != main").select(
        F.col("key").alias("k"), F.col("node").alias("other"), F.col("size").alias("other_size"), F.col("pos").alias("other_pos"), F.col("of").alias("other_of")
    )
    crossing = (F.col("of") != F.col("other_of")) & ((F.col("of") == F.col("main")) | (F.col("node") < F.col("other")))
    fits = _near(size, F.col("other_size")) & _reach(size, pos, F.col("other_size")) & _reach(F.col("other_size"), F.col("other_pos"), size)
    pairs = now.join(outside, (F.col("key") == F.col("k")) & crossing & fits)
    found = materialize(_verified(pairs.select(F.col("node").alias("a"), F.col("other").alias("b")), sets), "links")
    return edges.unionByName(found)


def near_copies(docs: DataFrame, row: str) -> tuple[DataFrame, DataFrame]:
    """(node, same) of each row, ``row`` numbering them and ``same`` telling equal sets, and (same, root) of the sets that have a near copy."""
    alike = simhash.near_duplicates(docs, carried=(row,), shingle=SHINGLE, distance=DISTANCE).select(F.col(row).alias("node"), "root")
    rows = docs.select(F.col(row).alias("node"), "text")
    signed = materialize(rows.mapInArrow(_signed, "node long, same binary, size long, keys array<long>"), "signatures")
    sole = signed.groupBy("same").agg(F.min(F.struct("node", "size", "keys")).alias("m")).select("same", "m.node", "m.size", "m.keys")
    sole = materialize(sole, "sole")
    probes = sole.select("node", F.explode("keys").alias("key"))
    shared = materialize(probes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    total = shared.agg(F.sum("n")).first()[0] or 0
    candidates = of_classes(sole, alike)
    named = candidates.select(F.col("a").alias("node")).unionByName(candidates.select(F.col("b").alias("node")))
    members = materialize(_looked_up(probes, shared, "key", total).select("node").unionByName(named).distinct(), "members")
    sets = materialize(_texts_of(rows, members).mapInArrow(_sets, "node long, size long, shingles array<long>"), "shingles")
    known = materialize(_verified(candidates, sets), "known")
    root = components(links(materialize(prefixes(sets), "prefixes"), sets, known))
    return signed.select("node", "same"), sole.join(root, "node").select("same", "root")


def gone(docs: DataFrame, row: str) -> DataFrame:
    """(row) of the rows that go: of each class the smallest ``doc_id`` (null last), then the smallest number, stays."""
    nodes, root = near_copies(docs, row)
    named = materialize(nodes.join(docs.select(F.col(row).alias("node"), "doc_id"), "node"), "named")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node"))
    # One row a set, then one a class; classes are many sets only where there are links.
    sets = named.groupBy("same").agg(first.alias("first"), F.count(F.lit(1)).alias("rows")).join(root, "same", "left")
    sets = materialize(sets, "sets")
    alone = sets.where("root IS NULL AND rows > 1").select("same", F.col("rows").alias("n"), "first.node")
    linked = sets.where("root IS NOT NULL")
    classes = materialize(linked.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("stays")), "classes")
    found = _looked_up(linked.select("root", "same", "rows"), classes, "root", linked.count())
    table = materialize(alone.unionByName(found.select("same", F.col("rows").alias("n"), "stays.node")).withColumnRenamed("node", "stays"), "stays")
    total = table.agg(F.sum("n")).first()[0] or 0
    return _looked_up(named.select("node", "same"), table, "same", total).where("node != stays").select(F.col("node").alias(row))
