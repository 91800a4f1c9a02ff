"""SimHash near-duplicates by a generalised pigeonhole search.

Fingerprints that differ in at most ``distance`` bits are linked; classes are the connected components.

1. Fingerprints: the bit-wise majority of the XXH64 hashes of a text's word shingles. Equal fingerprints are one
   node from here on, so a group of copies costs one row.
2. Partitions: the co-occurrence of all bit pairs over all nodes gives their correlation; bits that go together share a partition, so that
   skew is gathered where a threshold can avoid it.
3. Thresholds: with ``m`` partitions, any linked pair has a partition ``i`` in which it differs in at most ``t[i]`` bits as soon as
   ``sum(t) = distance - m + 1``; -1 skips a partition. For each ``m`` a dynamic programme takes the cheapest such thresholds by estimated
   rows and candidates (pairs with equal partition values counted over all nodes; one more bit estimated from bit shares), and
   the cheapest ``m`` wins. Larger inputs get fewer, wider partitions.
4. Probe: each node is sent to its own value in every used partition, and to the values one bit away where the threshold is 1.
5. Verify: nodes of a bucket are compared by their whole fingerprints. A bucket gives its links as a spanning forest, so that a
   bucket of n nodes makes fewer than n edges and never all pairs.

Buckets of more than ``hot`` nodes go another exact way: two fingerprints differ in two bits or less if and only if they share a fingerprint
at distance one or less from both, so every node is sent to the 65 fingerprints around it, where at most 65 nodes meet.

Null text counts as empty; a text without words has fingerprint zero and is linked like any other. Rows with a null ``doc_id`` do not
name a component unless it has no other id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.components import components
from zonecast.llm.tables import kind
from zonecast.llm.text import U, mix, slices, words, xxh64
from zonecast.session import materialize

BITS = 64
SEED = 42
#: Largest bucket whose nodes are compared with each other.
HOT = 8192
#: Cost of sending one row, in comparisons of two fingerprints.
ROW_COST = 100.0
#: Links held at once while a bucket's forest is built.
LINKS_HELD = 1 << 21
_LANES = np.uint64(0x0101010101010101)


def fingerprints(texts: list[bytes], shingle: int = 3) -> np.ndarray:
    """The 64-bit fingerprint of each text, over all its shingles with repeats."""
    # ASCII letters are lower-cased, white space becomes one space: shingles are then byte ranges.
    w = words([b" ".join(t.lower().split()) for t in texts])
    counts = np.diff(w.first)
    out = np.zeros(len(texts), U)
    pieces = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    if not pieces.sum():
        return out
    owner = np.repeat(np.arange(len(texts)), pieces)
    begin = np.cumsum(pieces) - pieces
    first = w.first[:-1][owner] + np.arange(len(owner)) - begin[owner]
    last = np.minimum(first + shingle, w.first[1:][owner]) - 1
    h = xxh64(w.data, w.start[first], w.end[last] - w.start[first], SEED)
    # Eight counters of one byte per integer count up to 255 hashes; blocks of 255 are added up after that.
    inside = np.arange(len(owner)) - begin[owner]
    blocks = np.flatnonzero(inside % 255 == 0)
    of = owner[blocks]
    heads = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    full = of[heads]
    for bit in range(8):
        lanes = np.add.reduceat((h >> U(bit)) & _LANES, blocks)
        ones = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8), heads, axis=0, dtype=np.int64)
        major = 2 * ones > pieces[full][:, None]
        for byte in range(8):
            out[full] |= major[:, byte].astype(U) << U(8 * byte + bit)
    return out


def _fingerprinted(shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            column = batch.schema.get_field_index("text")
            rest = [i for i in range(batch.num_columns) if i != column]
            fp = pa.array(fingerprints(texts, shingle).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in rest] + [fp], [batch.schema.names[i] for i in rest] + ["fp"])

    return run


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BITS, BITS))
    for batch in batches:
        ones = _bits(batch.column(0).to_numpy(zero_copy_only=False).view(U)).astype(np.float32)
        total += ones.T @ ones
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS)), pa.array(total.ravel().astype(np.int64))], ["pair", "n"])


def co_occurrence(nodes: DataFrame) -> np.ndarray:
    """How often each pair of bits is set together: 64 x 64 sums, whatever the input."""
    sums = nodes.select("fp").mapInArrow(_together, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BITS * BITS)
    out[sums["pair"].to_numpy()] = sums["n"].to_numpy()
    return out.reshape(BITS, BITS)


def correlation(together: np.ndarray, n: int) -> np.ndarray:
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return np.abs(together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread) * (spread > 1e-5) * (spread > 1e-5)[:, None]


def grouped_bits(corr: np.ndarray, m: int) -> list[list[int]]:
    """``m`` partitions of near equal width; each starts with the most correlated bit left and takes its nearest ones."""
    left = list(range(BITS))
    out = []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        tied = corr[np.ix_(left, left)].sum(axis=1) - 1
        group = [left.pop(int(np.argmax(tied)))]
        while len(group) < width:
            group.append(left.pop(int(np.argmax(corr[np.ix_(left, group)].sum(axis=1)))))
        out.append(sorted(group))
    return out


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """The cheapest thresholds with the given sum; ``costs[i][t]`` is the cost of threshold ``t`` in partition ``i``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, c in options.items():
                if spent + t not in nxt or cost + c < nxt[spent + t][0]:
                    nxt[spent + t] = (cost + c, [*chosen, t])
        best = nxt
    return best[total]


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def plan(nodes: DataFrame, n: int, distance: int = 2, choices: tuple[int, ...] = (2, 3, 4), hot: int = HOT) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition in use.

    A bucket costs its comparisons, or, where it is too large for them, the rows it is sent as instead.
    """
    together = co_occurrence(nodes)
    corr = correlation(together, n)
    share = np.diag(together) / max(n, 1)
    agree = share**2 + (1 - share) ** 2
    tries = {m: grouped_bits(corr, m) for m in choices}
    values = [F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_mask(bits))).alias("v")) for m in tries for i, bits in enumerate(tries[m])]
    sizes = nodes.select(F.explode(F.array(*values)).alias("x")).groupBy("x.m", "x.i", "x.v").agg(F.count(F.lit(1)).alias("c"))
    work = F.when(F.col("c") <= hot, F.col("c").cast("double") * (F.col("c") - 1) / 2).otherwise(ROW_COST * (BITS + 1) * F.col("c"))
    pairs = sizes.groupBy("m", "i").agg(F.sum(work).alias("pairs")).collect()
    equal = {(r["m"], r["i"]): r["pairs"] for r in pairs}
    best = None
    for m, groups in tries.items():
        costs = []
        for i, bits in enumerate(groups):
            near = 1 + float(np.sum((1 - agree[bits]) / agree[bits]))
            found = equal.get((m, i), 0.0)
            costs.append({-1: 0.0, 0: ROW_COST * n + found, 1: ROW_COST * n * (len(bits) + 1) + found * near})
        cost, chosen = allocate(costs, distance - m + 1)
        if best is None or cost < best[0]:
            best = (cost, [(bits, t) for bits, t in zip(groups, chosen) if t >= 0])
    return best[1]


def _probes(partitions: list[tuple[list[int], int]]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(U)
            for i, (bits, threshold) in enumerate(partitions):
                value = fp & U(sum(1 << b for b in bits))
                for flip in [0] + [1 << b for b in bits] * (threshold > 0):
                    key = mix((value ^ U(flip)) + U(i * 0x9E3779B97F4A7C15 % 2**64))
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], ["key", "fp"])

    return run


def roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest index connected with each of 0 .. n - 1."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        if np.array_equal(before, label):
            return label


def forest(key: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is linked inside each bucket; rows are sorted by key."""
    n = len(key)
    u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = np.arange(n)
    d = held = 0
    while len(at):
        # Rows that have another one of their bucket d places on.
        d += 1
        at = at[at + d < n]
        at = at[key[at] == key[at + d]]
        close = at[np.bitwise_count(fp[at] ^ fp[at + d]) <= distance]
        u.append(close), v.append(close + d)
        held += len(close)
        if held > LINKS_HELD:  # a forest says the same with fewer links
            label = roots(n, np.concatenate(u), np.concatenate(v))
            moved = np.flatnonzero(label != np.arange(n))
            u, v, held = [moved], [label[moved]], len(moved)
    u, v = np.concatenate(u), np.concatenate(v)
    label = roots(n, u, v)
    moved = np.flatnonzero(label != np.arange(n))
    return fp[moved], fp[label[moved]]


def _verify(distance: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64)]

        def emit(key, fp):
            a, b = forest(key, fp.view(U), distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            new = [np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held)]
            if not len(new[0]):
                continue
            cut = int(np.searchsorted(new[0], new[0][-1]))  # the last bucket may go on in the next batch
            yield emit(new[0][:cut], new[1][:cut])
            held = [x[cut:] for x in new]
        if len(held[0]):
            yield emit(*held)

    return run


def around(nodes: DataFrame) -> DataFrame:
    """Edges between fingerprints of one component through the fingerprints at distance one or less from both."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_mask([b])).cast("long") for b in range(BITS)])
    points = nodes.select("fp", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("point"))
    met = points.groupBy("point").agg(F.min("fp").alias("b"), F.collect_set("fp").alias("members")).where(F.size("members") > 1)
    return met.select(F.explode("members").alias("a"), "b").where("a != b").distinct()


def links(nodes: DataFrame, distance: int = 2, hot: int = HOT) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of nodes within ``distance`` bits."""
    if distance > 2:
        raise ValueError("the way for hot buckets holds for distances up to 2")
    partitions = plan(nodes, nodes.count(), distance, hot=hot)
    probes = materialize(nodes.select("fp").mapInArrow(_probes(partitions), "key long, fp long"), "probes")
    sizes = materialize(probes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    cold = probes.join(sizes.where(F.col("n") <= hot).select("key"), "key")
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = cold.repartition(tasks, "key").sortWithinPartitions("key", "fp").select("key", "fp").mapInArrow(_verify(distance), "a long, b long")
    crowded = probes.join(sizes.where(F.col("n") > hot).select("key"), "key").select("fp").distinct()
    return found.unionByName(around(crowded))


def near_duplicates(docs: DataFrame, carried: tuple[str, ...] = (), shingle: int = 3, distance: int = 2) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed integer), root (a number of the component), component_id and ``carried`` of each document."""
    keep = ["doc_id", "text", *carried]
    ids = ", ".join(f"`{c}` {kind(docs, c)}" for c in keep if c != "text")
    rows = materialize(docs.select(*keep).mapInArrow(_fingerprinted(shingle), f"{ids}, fp long"), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = components(links(nodes, distance))
    placed = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = materialize(placed, "placed")
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(names, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "root", "component_id", *carried)


def hexadecimal(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
