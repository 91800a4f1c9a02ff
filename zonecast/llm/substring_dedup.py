"""Substring duplicates: windows repeated at one length alone are extended to twice that length.

A window is ``window`` consecutive words of one document. A word goes if a window covers it whose words also start earlier: in a
smaller ``doc_id``, or earlier in the same document.

1. Documents are packed into chunks of about ``CHUNK_BYTES`` of text, written once; a chunk is the unit that is sent and
   addressed from here on. Documents with equal word sequences are found first, inside a chunk and then, by the first of them in each chunk,
   between chunks: all but the earliest go whole and are no source.
2. The lengths double from ``SHORTEST`` words or a little more up to the window: 5, 10, 20 for a window of 20 (``levels``). Inside a chunk the
   windows whose first words occur again at one length alone are extended to the next; those that repeat at full length are settled there.
3. Between chunks the same lengths are gone through. Below the full length a window is looked at through its anchor: of the runs of that length
   inside the window the one with the least hash. Equal windows have equal anchors, so nothing is lost. A chunk sends each distinct anchor
   of its surviving windows once; windows survive whose anchor is seen twice, in one chunk or in several.
4. At full length a chunk sends the first place of each distinct window that survived. Of the places of a window all but the
   first are marked. No window survives to a next length, as the marks are what is asked for.
5. Marks go back to their chunk, which removes the covered words.

What all documents share is one row of a few bytes per chunk; such a group is streamed past its least place and never held.
Windows are compared by 128 bits.

Null text has no words. Null ids come last; documents with equal ids are in the order in which they were packed. Texts of fewer words
than a window lose nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.tables import kind
from zonecast.llm.text import U, Words, mix, slices, word_hashes, words
from zonecast.session import materialize

CHUNK_BYTES = 4 << 20
#: Chunks one task handles after an exchange.
TOGETHER = 4
#: Lengths are halved while the half has this many words.
SHORTEST = 5
_K = U(0x9E3779B97F4A7C15)


def _pack(chunk_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, limit=chunk_bytes):
            yield _packed(batch, texts)

    return run


def _packed(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
    """Some documents as one row: ids in order, compressed words, digests of distinct sequences with their first places, places of copies."""
    ids = batch.column(batch.schema.get_field_index("doc_id"))
    order = pc.sort_indices(ids, null_placement="at_end")
    ids = ids.take(order)
    bare = [b" ".join(texts[i].split()) for i in order.to_pylist()]
    first: dict[bytes, int] = {}
    own = [at for at, b in enumerate(bare) if first.setdefault(xxhash.xxh3_128_digest(b), at) != at]
    row = [
        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        pa.array([list(first)], pa.list_(pa.binary())),
        pa.array([list(first.values())], pa.list_(pa.int32())),
        pa.array([own], pa.list_(pa.int32())),
        pa.array([zstandard.ZstdCompressor(level=3).compress(b"\n".join(bare))]),
    ]
    return pa.RecordBatch.from_arrays(row, ["ids", "seqs", "firsts", "own", "packed"])


def _sliding(a: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` over a[i] .. a[i + width - 1], by doubling; the last width - 1 places look at fewer."""
    span = 1
    a = a.copy()
    while span < width:
        step = min(span, width - span)
        a[:-step] = least(a[:-step], a[step:])
        span += step
    return a


def _doubled(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of ``length`` consecutive words from hashes of one word."""
    plan = [length]
    while plan[-1] > 1:
        plan.append((plan[-1] + 1) // 2)
    now, at = h, 1
    for size in reversed(plan[:-1]):
        step = size - at
        now = mix(now[: len(now) - step] * _K + now[step:])
        at = size
    return now


def levels(window: int) -> list[int]:
    """Lengths from the shortest to the window, each at most twice the one before."""
    lengths = [window]
    while lengths[0] >= 2 * SHORTEST:
        lengths.insert(0, (lengths[0] + 1) // 2)
    return lengths


def _repeated(h: np.ndarray) -> np.ndarray:
    """Whether each value occurs again."""
    out = np.zeros(len(h), bool)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


class Chunk:
    """Words, anchors and windows of a packed chunk."""

    def __init__(self, row: dict, window: int):
        self.bare = zstandard.ZstdDecompressor().decompress(row["packed"]).split(b"\n")
        self.w: Words = words(self.bare)
        self.window = window
        self.levels = levels(window)
        n = len(self.w.start)
        owner = self.w.owner()
        self.owner = owner[: max(n - window + 1, 0)]
        self.valid = self.owner == owner[window - 1 :]
        skip = np.zeros(len(self.bare), bool)
        skip[np.array((row["own"] or []) + (row["copies"] or []), np.int64)] = True
        self.skipped = skip[self.owner]
        h = word_hashes(self.w)
        self.short = _doubled(h, self.levels[0]) if n >= window else h[:0]
        self.other = _doubled(mix(h + U(0x5851F42D4C957F2D)), self.levels[0]) if n >= window else h[:0]

    def extended(self, base: np.ndarray, level: int, at: np.ndarray) -> np.ndarray:
        """Hashes of the runs of a level's length that start at some places."""
        if level == 0:
            return base[at]
        step = self.levels[level] - self.levels[level - 1]
        return mix(self.extended(base, level - 1, at) * _K + self.extended(base, level - 1, at + step))

    def _runs(self, level: int, usable: np.ndarray) -> np.ndarray:
        """Hashes of the level's runs inside usable windows; the largest number elsewhere."""
        span = self.window - self.levels[level] + 1
        edge = np.zeros(len(usable) + span, np.int64)
        at = np.flatnonzero(usable)
        edge[at] += 1
        edge[at + span] -= 1
        inside = np.flatnonzero(np.cumsum(edge)[:-1] > 0)
        out = np.full(len(usable) + span - 1, ~U(0))
        out[inside] = self.extended(self.short, level, inside)
        return out

    def anchors(self, level: int, usable: np.ndarray) -> np.ndarray:
        """The anchor of every usable window."""
        return _sliding(self._runs(level, usable), self.window - self.levels[level] + 1, np.minimum)[: len(usable)]

    def distinct_anchors(self, level: int, usable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors of usable windows, and whether each has several places here."""
        if not usable.any():
            return self.short[:0], np.zeros(0, bool)
        span = self.window - self.levels[level] + 1
        runs = self._runs(level, usable)
        reach = np.where(usable, self.anchors(level, usable), U(0))
        # A run is an anchor if it is the least one of a window around it: of those windows' anchors it is the largest.
        padded = np.concatenate([np.zeros(span - 1, U), reach, np.zeros(span - 1, U)])
        largest = _sliding(padded, span, np.maximum)[: len(runs)]
        found, n = np.unique(runs[largest == runs], return_counts=True)
        return found, n > 1

    def surviving(self, row: dict) -> np.ndarray:
        """Windows whose anchors were seen twice at all lengths so far."""
        alive = self.valid & ~self.skipped
        level = 0
        while f"known{level}" in row and alive.any():
            known = np.array(row[f"known{level}"] or [], np.int64).view(U)
            alive &= np.isin(self.anchors(level, alive), known)
            level += 1
        return alive

    def whole(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        last = len(self.levels) - 1
        return self.extended(self.short, last, at), self.extended(self.other, last, at)

    def later(self) -> np.ndarray:
        """Valid windows that occur earlier in this chunk: what repeats at one length is extended to the next."""
        at = np.flatnonzero(self.valid)
        for level in range(len(self.levels)):
            at = at[_repeated(self.extended(self.short, level, at))]
        h1, h2 = self.whole(at)
        order = np.lexsort((h2, h1))  # stable: places stay in order
        again = (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
        out = np.zeros(len(self.valid), bool)
        out[at[order[1:][again]]] = True
        return out


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _anchors(window: int, level: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            c = Chunk(row, window)
            found, several = c.distinct_anchors(level, c.surviving(row))
            chunk = pa.array(np.full(len(found), row["chunk"], np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), chunk, pa.array(several)], ["anchor", "chunk", "several"])

    return run


def _places(window: int, id_type: pa.DataType):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            c = Chunk(row, window)
            send = np.flatnonzero(c.surviving(row) & ~c.later())
            h1, h2 = c.whole(send)
            ids = pa.array(row["ids"], id_type).take(pa.array(c.owner[send]))
            columns = [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), ids, pa.array(np.full(len(send), row["chunk"], np.int64)), pa.array(send.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "doc_id", "chunk", "place"])

    return run


def _kept(window: int, id_type: pa.DataType, texts: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            c = Chunk(row, window)
            n = len(c.w.start)
            marked = c.later() | (c.valid & c.skipped)
            marked[np.array(row["places"] or [], np.int64)] = True
            edge = np.zeros(n + 1, np.int64)
            at = np.flatnonzero(marked)
            edge[at] += 1
            np.add.at(edge, at + window, -1)
            gone = np.cumsum(edge)[:n] > 0
            total = np.concatenate([[0], np.cumsum(gone)])
            removed = total[c.w.first[1:]] - total[c.w.first[:-1]]
            left = []
            for d, text in enumerate(c.bare):
                if removed[d]:
                    split = text.split(b" ")
                    text = b" ".join([split[i] for i in np.flatnonzero(~gone[c.w.first[d] : c.w.first[d + 1]])])
                left.append(text)
            out = [pa.array(row["ids"], id_type), pa.array(np.diff(c.w.first).astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array([hashlib.sha256(t).hexdigest() for t in left])]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if texts:
                out.append(pa.array(left, pa.binary()).cast(pa.string()))
                names.append("text")
            yield pa.RecordBatch.from_arrays(out, names)

    return run


def _not_first(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """The places of each chunk (column ``name``) whose key has an earlier place.

    Both branches read whole places, so one exchange serves the least place of a key and the join with it; the
    join holds one least place at a time.
    """
    at = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "chunk", "place").alias("at")
    rows = rows.select(*key, at).repartition(*key)
    ends = rows.groupBy(*key).agg(F.min("at").alias("first"), F.max("at").alias("end")).where("NOT (first <=> end)")
    later = rows.join(ends.select(*key, "first"), key).where("NOT (at <=> first)")
    return later.groupBy("at.chunk").agg(F.collect_list("at.place").alias(name))


def _seen_twice(anchors: DataFrame, name: str) -> DataFrame:
    """The anchors of each chunk (column ``name``) that have several places or are in several chunks."""
    rows = anchors.select("anchor", F.struct("several", "chunk").alias("at")).repartition("anchor")
    ends = rows.groupBy("anchor").agg(F.min("at").alias("first"), F.max("at").alias("end")).where("end.several OR first != end")
    # True of every row of such an anchor; as above, both branches read whole rows.
    again = rows.join(ends, "anchor").where("end.several OR at != first OR at != end")
    return again.groupBy("at.chunk").agg(F.collect_list("anchor").alias(name))


def repeated_passages(docs: DataFrame, window: int = 20, texts: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document, and with ``texts`` the kept words."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_kind, id_type = kind(docs, "doc_id"), to_arrow_type(docs.schema["doc_id"].dataType)
    schema = f"ids array<{id_kind}>, seqs array<binary>, firsts array<int>, own array<int>, packed binary"
    packed = docs.select("doc_id", "text").mapInArrow(_pack(chunk_bytes), schema)
    work = materialize(packed.withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    tasks = max(1, -(-work.count() // TOGETHER))

    # Copies between chunks: the first of each word sequence in a chunk, if another chunk has an earlier one.
    single = work.select("chunk", "ids", F.explode(F.arrays_zip("seqs", "firsts")).alias("one")).select(
        F.col("one.seqs").alias("seq"), "chunk", F.col("one.firsts").alias("place"), F.get("ids", F.col("one.firsts")).alias("doc_id")
    )
    copies = materialize(_not_first(single, ["seq"], "copies"), "copies")
    chunks = work.join(copies, "chunk", "left").drop("seqs", "firsts")

    # Below the full length: anchors seen twice.
    met = chunks
    for level in range(len(levels(window)) - 1):
        sent = met.mapInArrow(_anchors(window, level), "anchor long, chunk long, several boolean")
        known = _seen_twice(sent, f"known{level}")
        met = (met if level else chunks.repartition(tasks, "chunk")).join(materialize(known, "anchors"), "chunk")

    # Full length: whole windows.
    places = met.mapInArrow(_places(window, id_type), f"h1 long, h2 long, doc_id {id_kind}, chunk long, place int")
    marks = materialize(_not_first(places, ["h1", "h2"], "places"), "marks")

    final = chunks.repartition(tasks, "chunk").join(marks, "chunk", "left")
    schema = f"doc_id {id_kind}, n_words long, n_removed long, kept_sha256 string" + ", text string" * texts
    return final.mapInArrow(_kept(window, id_type, texts), schema)
