"""Prefix trie of conversations, screened by a count-min sketch.

A node is a distinct sequence of first turns, compared by role and text; the root is the empty sequence. Its members are the
conversations that start with it, and the smallest member names it.

1. Digests: a turn is hashed once (SHA-256 of role and text) where it is read; texts are not sent. The digest of a prefix is the sum of
   hashes of (place, turn) in four lanes of 32 bits, a running sum over a conversation: blocks of ``BLOCK`` places are summed
   first, so that a conversation of any length spreads.
2. Screening: tasks count prefix digests in a count-min sketch, which are added up block by block. A cell never counts too little, so an
   estimate of one proves that a prefix has one member. All there is to know about its node is known where it stands: it is emitted there.
3. Exact grouping: only prefixes whose estimate is above one are sent and grouped by their digest.
4. Trees without climbing: the smallest member of a node, its owner, owns all its nodes from some depth on. With that depth known for each
   conversation, every member tells each of its shared prefixes whether it starts a child there, whether it stands for a leaf, and
   the words below that another member owns. Subtree figures are sums of these, whatever the depth of the tree.
5. Parents are looked up by digest. The estimate of a prefix is known wherever its digest is, so prefixes of many members are
   salted on both sides alike.
6. The ids that end at a node are ranked by ``order.placed``, joined in pieces of ``PIECE`` ids, and hashed piece by piece.

The sketch has at most ``CELLS`` cells a row, whatever the input, and three rows. Beyond about ``CELLS`` prefixes its estimates grow too large and
more prefixes are grouped exactly; results never depend on it.

Turns stand in order of ``turn`` (null first), equal ones in order of their digests; repeated rows are separate turns. Null role or text is
empty. Rows without a ``conv_id`` belong to no conversation. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.order import placed
from zonecast.llm.text import U, mix
from zonecast.session import materialize

#: Places of a conversation that one window holds.
BLOCK = 1024
#: Most cells of a row of the sketch, and its rows.
CELLS, ROWS = 1 << 24, 3
#: Cells that are sent and added up together.
PART = 1 << 16
#: Touched cells a task holds before it sends them.
HELD = 1 << 20
#: Members a salted key has, about, and ids in a piece of a digest.
SALT, PIECE = 4096, 8192
#: Counts up to here are kept as they are; larger ones as half powers of two, rounded up.
PLAIN = 200
_LANES = 4
_KEY = ["depth", "p1", "p2"]


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def turns(conversations: DataFrame) -> DataFrame:
    """(c, pos, turn_hash, words) of every turn, ``pos`` from 1 in the order of the conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), "turn", F.unhex(F.sha2(content, 256)).alias("turn_hash"), word_count(text).alias("words")
    )
    ranked = placed(rows, ["c"], ["turn", "turn_hash"], "at")
    return ranked.select("c", (F.col("at") + 1).alias("pos"), "turn_hash", "words")


def plain_rebuild(own: DataFrame) -> DataFrame:
    """(c, depth, block, turn_hash, words, length) of conversations as they are, with a row of depth 0 for each."""
    sizes = own.groupBy("c").agg(F.max("pos").alias("length"))
    return _laid(own.select("c", F.col("pos").alias("depth"), "turn_hash", "words"), sizes)


def _laid(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows (c, depth, ...) with their block, and a start row with the length for each conversation of ``sizes``."""
    block = F.floor(F.col("depth") / BLOCK)
    start = sizes.select("c", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("turn_hash"), F.lit(0).cast("long").alias("words"))
    return rows.unionByName(start).withColumn("block", block)


def shared_heads(own: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose first ``h`` turns are replaced by those of conversation ``c - c % group``; h = crc32(c) % most."""
    base = F.col("c") - F.col("c") % group
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % most).cast("long")
    sizes = own.groupBy("c").agg(F.max("pos").alias("n")).withColumn("h", h).withColumn("base", base)
    first = own.where((F.col("c") == base) & (F.col("pos") < most))
    heads = first.groupBy(F.col("c").alias("base")).agg(F.array_sort(F.collect_list(F.struct("pos", "turn_hash", "words"))).alias("head"))
    heads = sizes.join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,turn_hash:binary,words:bigint>>")), 1, F.col("h").cast("int")))
    sizes = materialize(heads.withColumn("k", F.size("head").cast("long")), "conversations")
    taken = sizes.select("c", F.explode("head").alias("t")).select("c", F.col("t.pos").alias("depth"), "t.turn_hash", "t.words")
    # A conversation's size goes to each of its blocks, so that a long one is not joined in one task.
    spread = sizes.select("c", "h", "k", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / BLOCK))).alias("part"))
    kept = own.withColumn("part", F.floor(F.col("pos") / BLOCK)).join(spread, ["c", "part"]).where("pos > h")
    kept = kept.select("c", (F.col("k") + F.col("pos") - F.col("h")).alias("depth"), "turn_hash", "words")
    return _laid(taken.unionByName(kept), sizes)


def prefixes(laid: DataFrame) -> DataFrame:
    """(c, depth, p1, p2, q1, q2, words, below, ends): digest of the prefix and of the one before, words before this turn, last or not."""
    low = F.lit(0xFFFFFFFF).cast("long")
    lanes = [F.coalesce(F.xxhash64(F.lit(i), "depth", "turn_hash").bitwiseAND(low) * (F.col("depth") > 0).cast("long"), F.lit(0)).alias(f"l{i}") for i in range(_LANES)]
    rows = laid.select("c", "depth", "block", "words", *lanes)
    summed = [f"l{i}" for i in range(_LANES)] + ["words"]
    totals = rows.groupBy("c", "block").agg(*[F.sum(x).alias(x) for x in summed], F.max("depth").alias("last"))
    earlier = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("c").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("c", "block", *[F.sum(x).over(earlier).alias(f"{x}_b") for x in summed], F.max("last").over(later).alias("more"))
    # Conversations of one block have no offsets; the others are few.
    offsets = offsets.where(f"{summed[0]}_b IS NOT NULL OR more IS NOT NULL")
    inside = Window.partitionBy("c", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("c", "block")
    rows = rows.select("*", *[F.sum(x).over(inside).alias(f"{x}_s") for x in summed], F.max("depth").over(whole).alias("last"))
    rows = rows.join(offsets, ["c", "block"], "left")
    rows = rows.select("c", "depth", "block", *summed, *[(F.col(f"{x}_s") + F.coalesce(f"{x}_b", F.lit(0))).alias(f"{x}_s") for x in summed], (F.col("more").isNull() & (F.col("depth") == F.col("last"))).alias("ends"))

    def packed(i: int, less: bool) -> Column:
        a, b = ((F.col(f"l{j}_s") - F.col(f"l{j}") if less else F.col(f"l{j}_s")).bitwiseAND(low) for j in (i, i + 1))
        return F.shiftleft(a, 32).bitwiseOR(b)

    return rows.select(
        "c", "depth", "block", packed(0, False).alias("p1"), packed(2, False).alias("p2"), packed(0, True).alias("q1"), packed(2, True).alias("q2"),
        "words", (F.col("words_s") - F.col("words")).alias("below"), "ends",
    )


def _cells(p1: np.ndarray, p2: np.ndarray, depth: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of each prefix in each row of the sketch."""
    seed = p1.view(U) ^ mix(p2.view(U) + depth.astype(U))
    return [(mix(seed + U((r + 1) * 0x9E3779B97F4A7C15 % 2**64)) & U(width - 1)).astype(np.int64) + r * width for r in range(ROWS)]


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]


def _touched(width: int):
    def emit(held: list[np.ndarray]) -> pa.RecordBatch:
        cells, n = np.unique(np.concatenate(held), return_counts=True)
        parts, first = np.unique(cells // PART, return_index=True)
        ends = np.append(first[1:], len(cells))
        at = [(cells[a:b] % PART).astype("<u2").tobytes() for a, b in zip(first, ends)]
        counts = [n[a:b].astype("<u4").tobytes() for a, b in zip(first, ends)]
        return pa.RecordBatch.from_arrays([pa.array(parts), pa.array(at, pa.binary()), pa.array(counts, pa.binary())], ["part", "at", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            p1, p2, depth = _numbers(batch, "p1", "p2", "depth")
            held += _cells(p1, p2, depth, width)
            size += ROWS * len(p1)
            if size >= HELD:
                yield emit(held)
                held, size = [], 0
        if size:
            yield emit(held)

    return run


def coded(n: np.ndarray) -> np.ndarray:
    """Counts as one byte: plain up to ``PLAIN``, then half powers of two, rounded up."""
    steps = np.ceil(2 * np.log2(np.maximum(n, PLAIN) / PLAIN)).astype(np.int64)
    return np.where(n <= PLAIN, n, np.minimum(PLAIN + steps, 255)).astype(np.uint8)


def decoded(code: Column) -> Column:
    """The largest count a code stands for."""
    return F.when(code <= PLAIN, code.cast("double")).otherwise(F.ceil(F.lit(float(PLAIN)) * F.pow(F.lit(2.0), (code - PLAIN) / 2)))


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up rows sorted by part; one part is held."""
    now, total = None, None

    def emit():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([coded(total).tobytes()], pa.binary())], ["part", "codes"])

    for batch in batches:
        for part, at, n in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            if part != now:
                if now is not None:
                    yield emit()
                now, total = part, np.zeros(PART, np.int64)
            total[np.frombuffer(at, "<u2")] += np.frombuffer(n, "<u4")
    if now is not None:
        yield emit()


def sketch(rows: DataFrame, n: int, cells: int = CELLS) -> tuple[np.ndarray, int]:
    """The codes of all cells of a count-min sketch of prefixes (depth, p1, p2), and the cells of a row."""
    width = min(cells, max(PART, 1 << (4 * max(n, 1) - 1).bit_length()))
    tasks = max(1, min(ROWS * width // PART, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    touched = rows.select(*_KEY).mapInArrow(_touched(width), "part long, at binary, n binary")
    parts = touched.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(_added, "part long, codes binary")
    out = np.zeros(-(-ROWS * width // PART) * PART, np.uint8)
    for r in parts.collect():  # ROWS * CELLS bytes at most
        out[r["part"] * PART : (r["part"] + 1) * PART] = np.frombuffer(r["codes"], np.uint8)
    return out, width


def _screened(shared, width: int):
    """Adds the estimates of a prefix (est) and of the one before it (est_q); 0 stands for the root, of which all are members."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = shared.value
        for batch in batches:
            depth = _numbers(batch, "depth")[0]
            out = []
            for a, b, d in (("p1", "p2", depth), ("q1", "q2", depth - 1)):
                least = reduce(np.minimum, [codes[c] for c in _cells(*_numbers(batch, a, b), d, width)])
                out.append(pa.array(np.where(d > 0, least, 0).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], [*batch.schema.names, "est", "est_q"])

    return run


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of comma-joined pieces; rows are sorted by node and piece."""
    now, state = None, None

    def emit():
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array([now[2]], pa.int64()), pa.array([state.hexdigest()])], [*_KEY, "ends_sha256"])

    for batch in batches:
        for depth, p1, p2, ids in zip(*[batch.column(batch.schema.get_field_index(x)).to_pylist() for x in (*_KEY, "ids")]):
            if (depth, p1, p2) != now:
                if now is not None:
                    yield emit()
                now, state = (depth, p1, p2), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
    if now is not None:
        yield emit()


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256) of the ids ``c`` that end at each node."""
    ranked = placed(ends.select(*_KEY, "c"), _KEY, ["c"], "at")
    pieces = ranked.groupBy(*_KEY, F.floor(F.col("at") / PIECE).alias("piece")).agg(F.array_sort(F.collect_list("c")).alias("ids"))
    pieces = pieces.select(*_KEY, "piece", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    tasks = max(1, int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return pieces.repartition(tasks, *_KEY).sortWithinPartitions(*_KEY, "piece").select(*_KEY, "ids").mapInArrow(_hashed, "depth long, p1 long, p2 long, ends_sha256 string")


def trie(laid: DataFrame, cells: int = CELLS) -> DataFrame:
    """A row per node of conversations (c, depth, block, turn_hash, words), of which each has a row of depth 0.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    spark = laid.sparkSession
    rows = materialize(prefixes(laid), "prefixes")
    n, convs = rows.agg(F.count(F.lit(1)), F.sum((F.col("depth") == 0).cast("long"))).first()
    codes, width = sketch(rows.where("depth > 0"), n, cells)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    screened = materialize(rows.mapInArrow(_screened(spark.sparkContext.broadcast(codes), width), f"{schema}, est int, est_q int"), "screened")

    alone = screened.where("est = 1")
    # The first turn known to be alone hangs on a node that may be shared; what follows hangs on its own conversation.
    tops = alone.where("est_q != 1")
    shared = screened.where("est != 1")
    nodes = shared.groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("c"), F.sum(F.col("ends").cast("long")).alias("n_ends"), F.max("words").alias("words"),
        F.max("below").alias("below"), F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.max("est").alias("est"), F.max("est_q").alias("est_q"),
    )
    nodes = materialize(nodes, "nodes")

    # From which depth a conversation owns its nodes, the words before that, and whether it stands for a leaf.
    after = (F.col("below") + F.col("words")).alias("stop")
    owners = nodes.select("c", F.col("depth").alias("own"), F.col("below").alias("stop"), (F.col("n_convs") == F.col("n_ends")).alias("leaf"))
    owners = owners.unionByName(tops.select("c", F.col("depth").alias("own"), F.col("below").alias("stop"), F.lit(True).alias("leaf")))
    owners = owners.unionByName(shared.where("ends").select("c", (F.col("depth") + 1).alias("own"), after, F.lit(False).alias("leaf")))
    owners = owners.groupBy("c").agg(F.min("own").alias("own"), F.min("stop").alias("stop"), F.max("leaf").alias("leaf"))
    owners = materialize(owners, "owners")
    # Further blocks of long conversations get their owner's row each.
    further = shared.where("block > 0").select("c", "block").distinct()
    owners = owners.withColumn("block", F.lit(0).cast("long")).unionByName(further.join(owners, "c").select("c", "own", "stop", "leaf", "block"))
    told = shared.select(*_KEY, "c", "block", "below", "ends").join(owners, ["c", "block"])
    told = told.groupBy(*_KEY).agg(
        F.sum((~F.col("ends") & (F.col("own") <= F.col("depth") + 1)).cast("long")).alias("n_children"),
        F.sum(F.col("leaf").cast("long")).alias("n_leaves"),
        F.sum(F.greatest(F.col("stop") - F.col("below"), F.lit(0))).alias("saved_tokens"),
    )

    # Parents: both sides know the estimate of the parent's digest.
    def salts(code: str) -> Column:
        members = F.when(F.col(code) == 0, F.lit(float(convs or 0))).otherwise(decoded(F.col(code)))
        return F.greatest(F.ceil(members / SALT), F.lit(1)).cast("long")

    # A node below one that is known to be alone has the same single member.
    children = nodes.where("depth > 0 AND est_q != 1").select("c", "depth", "q1", "q2", "est_q").unionByName(tops.select("c", "depth", "q1", "q2", "est_q"))
    asked = children.select("c", "depth", "q1", "q2", F.pmod(F.xxhash64("c"), salts("est_q")).alias("salt"))
    answers = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("c").alias("parent"), F.explode(F.sequence(F.lit(0).cast("long"), salts("est") - 1)).alias("salt"))
    parents = materialize(asked.join(answers, ["depth", "q1", "q2", "salt"]).select("c", "depth", "parent"), "parents")

    ends = ends_digests(shared.where("ends"))
    figures = nodes.select(*_KEY, "c", "n_convs", "est_q").join(told, _KEY).join(ends, _KEY, "left").join(parents, ["c", "depth"], "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    out = figures.select(
        F.col("c").alias("conv_id"), "depth", F.when(F.col("est_q") == 1, F.col("c")).otherwise(F.col("parent")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )

    def tail(rows: DataFrame, parent: Column) -> DataFrame:
        one = F.lit(1).cast("long")
        return rows.select(
            F.col("c").alias("conv_id"), "depth", parent.alias("parent_conv_id"), one.alias("n_convs"), (~F.col("ends")).cast("long").alias("n_children"),
            one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), F.when(F.col("ends"), F.sha2(F.col("c").cast("string"), 256)).otherwise(nothing).alias("ends_sha256"),
        )

    hung = tops.select("c", "depth", "ends").join(parents, ["c", "depth"])
    return out.unionByName(tail(hung, F.col("parent"))).unionByName(tail(alone.where("est_q = 1"), F.col("c")))


def conversation_trie(conversations: DataFrame, cells: int = CELLS) -> DataFrame:
    """The trie of conversations as they are."""
    return trie(plain_rebuild(materialize(turns(conversations), "turns")), cells)


def rebuilt_trie(conversations: DataFrame, group: int = 20, most: int = 4, cells: int = CELLS) -> DataFrame:
    """The trie of conversations rebuilt with shared heads (``shared_heads``)."""
    return trie(shared_heads(materialize(turns(conversations), "turns"), group, most), cells)
