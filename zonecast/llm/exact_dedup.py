"""Exact duplicates: counting quotient filters per partition, merged by sorted remainders.

1. One pass turns each text into a 64-bit fingerprint of its normalised bytes (and the digests the
   report needs). Nothing else of the text is stored.
2. Every task builds a counting quotient filter of its fingerprints: the top bits choose a block, the
   next ``QUOTIENT_BITS`` the quotient, the rest is the remainder; runs are sorted, and a repeated
   fingerprint is one remainder with a counter. A group of copies that fills a third of the rows is
   therefore one entry per task.
3. The filters of a block are merged losslessly: runs are sorted, equal remainders add their counters.
   The number of blocks follows the number of rows, so a block fits a task at any size.
4. Fingerprints with a count above one are routed to verification: their texts, and only theirs, are
   grouped by all their bytes. Two texts with one fingerprint but other bytes part ways here.

The occupancy bits of the repeated fingerprints, ``2 ** filter_bits`` at any size, are broadcast to keep
the texts of unique fingerprints from being sent; what passes them by chance is removed by an exact join.

Null text counts as empty. A null ``doc_id`` is larger than any other. Rows that agree in everything
are told apart by their row number: one of them stays. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.tables import ROW, kind
from zonecast.llm.text import SPACES, slices
from zonecast.session import materialize

QUOTIENT_BITS = 10
#: Fingerprints a task gathers before it packs a filter.
GATHERED = 1 << 21
U = np.uint64
#: A group of copies is frequent if it holds more than one copied row in this many.
OFTEN = 1 << 16


def normalised(text: bytes) -> bytes:
    return text.translate(None, SPACES)


def fingerprint(bare: bytes, bits: int) -> int:
    """The top ``bits`` of a 64-bit hash; fewer bits only send more texts to verification."""
    return xxhash.xxh64_intdigest(bare) >> (64 - bits) << (64 - bits)


def pack(fingerprints: np.ndarray, counts: np.ndarray, block_bits: int) -> Iterator[dict]:
    """The filter of sorted distinct fingerprints, a record per block.

    ``occupied`` has a bit per quotient, ``runs`` the length of each occupied quotient's run,
    ``remainders`` the low bits in order and ``counters`` how often each was seen.
    """
    low = 64 - block_bits - QUOTIENT_BITS
    width = -(-low // 8)
    block = (fingerprints >> U(64 - block_bits)) if block_bits else np.zeros(len(fingerprints), U)
    edges = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]]) if len(block) else np.zeros(1, int)
    for a, b in zip(edges[:-1], edges[1:]):
        part = fingerprints[a:b]
        quotient = ((part >> U(low)) & U((1 << QUOTIENT_BITS) - 1)).astype(np.int64)
        runs = np.bincount(quotient, minlength=1 << QUOTIENT_BITS)
        remainder = (part & U((1 << low) - 1)).astype("<u8")
        yield {
            "block": int(block[a]),
            "occupied": np.packbits(runs > 0).tobytes(),
            "runs": runs[runs > 0].astype("<u4").tobytes(),
            "remainders": np.ascontiguousarray(remainder.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes(),
            "counters": counts[a:b].astype("<u8").tobytes(),
        }


def unpack(record: dict, block_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and counts of a packed block."""
    low = 64 - block_bits - QUOTIENT_BITS
    width = -(-low // 8)
    quotients = np.flatnonzero(np.unpackbits(np.frombuffer(record["occupied"], np.uint8)))
    runs = np.frombuffer(record["runs"], "<u4").astype(np.int64)
    held = np.frombuffer(record["remainders"], np.uint8).reshape(-1, width)
    wide = np.zeros((len(held), 8), np.uint8)
    wide[:, :width] = held
    high = np.repeat(quotients, runs).astype(U) << U(low)
    if block_bits:
        high |= U(record["block"]) << U(64 - block_bits)
    return high | wide.view("<u8").ravel(), np.frombuffer(record["counters"], "<u8").astype(np.int64)


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted fingerprints of all parts; equal ones add their counts."""
    fingerprints, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(fingerprints, kind="stable")
    fingerprints, counts = fingerprints[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], fingerprints[1:] != fingerprints[:-1]]))
    return fingerprints[first], np.add.reduceat(counts, first)


_FILTER = pa.schema(
    [("block", pa.int64()), ("occupied", pa.binary()), ("runs", pa.binary()), ("remainders", pa.binary()), ("counters", pa.binary())]
)


def _build(block_bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def emit():
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            for record in pack(found, counts, block_bits):
                yield pa.RecordBatch.from_pylist([record], schema=_FILTER)

        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(U))
            size += len(held[-1])
            if size >= GATHERED:
                yield from emit()
                held, size = [], 0
        if size:
            yield from emit()

    return run


def _repeated(block_bits: int):
    def run(block: pa.Table) -> pa.Table:
        fingerprints, counts = merge([unpack(r, block_bits) for r in block.to_pylist()])
        twice = counts > 1
        return pa.table({"fp": fingerprints[twice].view(np.int64), "seen": counts[twice]})

    return run


def repeated_fingerprints(fingerprints: DataFrame, rows: int, block_rows: int = 1 << 18) -> DataFrame:
    """(fp, seen) of all values of the one column that occur more than once."""
    block_bits = max(4, math.ceil(math.log2(max(1, rows) / block_rows)) if rows > block_rows else 4)
    filters = fingerprints.mapInArrow(_build(block_bits), "block long, occupied binary, runs binary, remainders binary, counters binary")
    return filters.groupBy("block").applyInArrow(_repeated(block_bits), "fp long, seen long")


def _digest(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            yield _digested(batch, texts, bits)

    return run


def _digested(batch: pa.RecordBatch, texts: list[bytes], bits: int) -> pa.RecordBatch:
    bare = [normalised(t) for t in texts]
    column = batch.schema.get_field_index("text")
    rest = [i for i in range(batch.num_columns) if i != column]
    return pa.RecordBatch.from_arrays(
        [batch.column(i) for i in rest]
        + [
            pc.fill_null(pc.utf8_length(batch.column(column)), 0).cast(pa.int64()),
            pa.array(np.fromiter((fingerprint(b, bits) for b in bare), U, len(bare)).view(np.int64)),
            pa.array([hashlib.sha256(b).hexdigest() for b in bare]),
        ],
        [batch.schema.names[i] for i in rest] + ["points", "fp", "text_sha256"],
    )


def _route(occupied, filter_bits: int, bits: int):
    """Normalised texts whose fingerprint has its occupancy bit set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches):
            found, kept = [], []
            for text in texts:
                bare = normalised(text)
                fp = fingerprint(bare, bits)
                at = fp >> (64 - filter_bits)
                if (int(occupied.value[at >> 6]) >> (at & 63)) & 1:
                    found.append(fp)
                    kept.append(bare)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(found, U).view(np.int64)), pa.array(kept, pa.binary())], ["fp", "bare"])

    return run


def _occupancy(repeated: DataFrame, filter_bits: int) -> np.ndarray:
    """Occupancy bits of the repeated fingerprints: ``2 ** (filter_bits - 6)`` integers, whatever the input."""
    word = F.shiftrightunsigned("fp", 64 - filter_bits + 6)
    bit = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(fp, {64 - filter_bits}) & 63 AS INT))")
    rows = repeated.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
    out = np.zeros(1 << (filter_bits - 6), np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def exact_duplicates(docs: DataFrame, row: str | None = None, filter_bits: int = 24, block_rows: int = 1 << 18, bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 and the row number.

    ``row`` names a unique column; without one the digests are numbered as they are written.
    """
    spark = docs.sparkSession
    keep = ["doc_id", "text"] + ([row] if row else [])
    ids = ", ".join(f"`{c}` {kind(docs, c)}" for c in keep if c != "text")
    digests = docs.select(*keep).mapInArrow(_digest(bits), f"{ids}, points long, fp long, text_sha256 string")
    digests = materialize(digests if row else digests.withColumn(ROW, F.monotonically_increasing_id()), "digests")
    row = row or ROW
    repeated = materialize(repeated_fingerprints(digests.select("fp"), digests.count(), block_rows), "repeated")
    occupied = spark.sparkContext.broadcast(_occupancy(repeated, filter_bits))
    routed = docs.select("text").mapInArrow(_route(occupied, filter_bits, bits), "fp long, bare binary")
    verified = (
        routed.join(repeated.select("fp"), "fp", "left_semi")
        .groupBy("fp", "bare").agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("fp", F.sha2("bare", 256).alias("text_sha256"))
    )
    first = F.min(F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("last"), "doc_id", F.col(row).alias("row")))
    # Copies meet as one row per task before they are sent.
    groups = (
        digests.groupBy("fp", "text_sha256").agg(F.count(F.lit(1)).alias("n"), first.alias("first"))
        .join(materialize(verified, "verified"), ["fp", "text_sha256"], "left_semi")
    )
    groups = materialize(groups, "groups")
    alone = F.col("n").isNull()
    # Groups that hold more than one copied row in OFTEN, fewer than OFTEN, go to every task: no group of copies lands in one.
    total = groups.agg(F.sum("n")).first()[0] or 0
    often, rest = F.broadcast(groups.where(F.col("n") > total / OFTEN)), groups.where(F.col("n") <= total / OFTEN)
    same = ["fp", "text_sha256"]
    joined = digests.join(often, same).unionByName(digests.join(often.select(*same), same, "left_anti").join(rest, same, "left"))
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.when(alone, F.lit(1).cast("long")).otherwise(F.col("n")).alias("group_size"),
        (alone | (F.col("first.row") == F.col(row))).alias("kept"),
        "text_sha256",
        F.col(row).alias(row),
    )
