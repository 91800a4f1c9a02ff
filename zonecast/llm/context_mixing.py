"""Language-model scores by online logistic context mixing.

A text is scored as its words (runs of characters other than white space, A-Z lower-cased) and one end. If ``whole``, a token is told by the bits of
its code, the first bits of a hash of the word, one by one: the code ends where at most one word learned from is left (at ``code_bits`` at
the latest), and the token's share of what is left there follows. Else it is told by the 8 bits of its class and by its share of the class alone.
So every text has a probability, in which all words never seen at the end of a code count as one word seen zero times, as in the base score.

1. Packing: documents are packed into chunks of about ``CHUNK_BYTES`` of such text, written once, in buckets by chunk.
2. Counts: four contexts (none, the word before, the two words before, the word before the last) predict each bit from the counts of the words seen
   after them in all documents to be learned from. A chunk sends its words and the codes seen after each of its contexts to the part of their
   hash; a part adds up the chunks and tells each the counts and log odds it needs, each up to the bit after which one word is left, and
   nothing of contexts that no other chunk has learned from. Parts follow the corpus. In a hot bin a context has the first ``BITS`` bits only and each
   class a context of its own, so no context is a hot key. Contexts are told apart by 64 bits of a hash of one word, 56 of a pair.
3. If not ``whole``, a small corpus has slots in place of exact counts. Each chunk counts its distinct words once; sums over all chunks are the
   counts of the corpus. The ``FREQUENT`` most frequent counts go to every task; of all other words each chunk is told the counts that differ from its
   own. A hash of context and place in the class picks a slot, which counts the zeros and ones seen there; contexts that share a slot share its counts.
4. Mixing: a predictor gives the log odds of its counts. Weights, one set for each gate (the place of the bit), combine them:
   p = 1 / (1 + exp(-sum of weight * log odds)). After every bit the weights of its gate move along the gradient of its cost, online.
   Weights start anew every ``SEGMENT`` tokens of a document; all segments run side by side, and a score depends on its own text
   and the model alone, not on the documents beside it.

``score`` is the sum of log10 p over all bits and shares; ``bits_per_byte`` is the same in bits, over the bytes of the words with one
space between and an end. Words are told apart by 96 bits of hashes.

Null text counts as empty: one token, the end. Whether a document is held out is told by the caller; null counts as not held out. Rows with equal
ids are separate documents. A very long text is a chunk of its own; with slots it is scored in pieces of ``PIECE`` tokens.
If there is nothing to learn from, all counts are 0. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.tables import kind
from zonecast.llm.text import U, Words, mix, slices, word_hashes, words
from zonecast.session import materialize, scratch_path

#: Text of a chunk, and of one whose contexts predict whole words, which take about twice the memory.
CHUNK_BYTES, WHOLE_BYTES = 24 << 20, 12 << 20
#: Text that is compressed at once; where contexts have exact counts, also hashed at once.
RUN_BYTES = 2 << 20
#: Words whose counts every task gets.
FREQUENT = 1 << 16
#: Bits of a class, and the token that ends a text.
BITS, END = 8, U(0x9E3779B97F4A7C15)
#: Tokens of a segment, and about of a piece that is worked on at once.
SEGMENT, PIECE = 256, 1 << 18
PREDICTORS = 4
#: Least and most bits of a slot number; tokens learned from for one slot.
SLOT_BITS, SLOT_TOKENS = (14, 20), 4
#: Slots that are sent and added up together.
BLOCK = 1 << 14
#: Tokens learned from for one part of the words, and for one part of the pairs.
PART_TOKENS = 1 << 21
#: Log odds are kept as whole parts of this many to one.
SCALE = 16
PRIOR = 0.4
#: Bits of a hash of two words that tell pairs apart; first bits of a code whose sums every task gets.
PAIR_BITS, PREFIX = 56, 16
#: Tokens of a chunk after contexts of one bin that make the bin a hot one; first bits of a hash that are the bin.
HOT, BIN_BITS = 1 << 10, 20
START_WEIGHT, RATE = 0.3, 0.02
MOST = 9.0


# -- packing ---------------------------------------------------------------------------------------------------------------------


def _packed(limit: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, limit=limit):
            ids, held = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "held_out"))
            packed, run, size, learned = [], [], 0, 0
            for i, (t, h) in enumerate(zip(texts, held.to_pylist()), 1):
                found = t.split()
                learned += 0 if h else len(found) + 1
                run.append(b" ".join(found).lower())
                size += len(run[-1]) + 1
                if size >= RUN_BYTES or i == len(texts):
                    packed.append(zstandard.ZstdCompressor(level=3).compress(b"\n".join(run)))
                    run, size = [], 0
            one = pa.array([0, len(ids)], pa.int32())
            row = [pa.ListArray.from_arrays(one, ids), pa.ListArray.from_arrays(one, held), pa.array([learned], pa.int64()), pa.array([packed], pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(row, ["ids", "held", "learned", "packed"])

    return run


def chunks(docs: DataFrame, held_out: Column, limit: int = CHUNK_BYTES) -> DataFrame:
    """Documents in chunks (chunk, ids, held, learned, packed), written once, in buckets by chunk; ``learned`` counts the tokens to learn from."""
    rows = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    packed = rows.mapInArrow(_packed(limit), f"ids array<{kind(docs, 'doc_id')}>, held array<boolean>, learned long, packed array<binary>")
    return bucketed(packed.withColumn("chunk", F.monotonically_increasing_id()), "chunk")


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df``, written once to the shared folder in buckets by ``key``: what is grouped by it later need not be exchanged."""
    spark = df.sparkSession
    name = f"zonecast_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("path", scratch_path(spark, key)).bucketBy(buckets, key).saveAsTable(name)
    table = spark.table(name)
    # The table keeps its files; only its name goes.
    spark.sql(f"DROP TABLE {name}")
    return table


@dataclass
class Chunk:
    """The words of a chunk; ``token`` has all words and ends in order, ``first`` the first token of each text (one more at the end)."""

    words: Words | None
    token: np.ndarray
    first: np.ndarray
    held: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def read(row: pa.RecordBatch) -> Chunk:
        return Chunk.of([t for run in _cell(row, "packed") for t in _texts(run)], np.array(_cell(row, "held"), bool))

    @staticmethod
    def of(texts: list[bytes], held: np.ndarray) -> Chunk:
        w = words(texts)
        first = w.first + np.arange(len(w.first))
        token = np.empty(first[-1], U)
        token[first[1:] - 1] = END
        token[_inner(first)] = word_hashes(w)
        return Chunk(w, token, first, held, np.array([len(t) + 1 for t in texts]))

    @staticmethod
    def hashed(row: pa.RecordBatch, second: bool = False) -> tuple[Chunk, np.ndarray | None]:
        """The chunk without its words, and if asked for a second hash of each token (0: an end)."""
        held = np.array(_cell(row, "held"), bool)
        token, first, sizes, seconds = [], [np.zeros(1, np.int64)], [], []
        for run in _cell(row, "packed"):
            texts = _texts(run)
            part = Chunk.of(texts, np.zeros(len(texts), bool))
            token.append(part.token)
            first.append(first[-1][-1] + part.first[1:])
            sizes.append(part.sizes)
            if second:
                seconds.append(np.zeros(len(part.token), np.uint32))
                seconds[-1][_inner(part.first)] = word_hashes(part.words, 1).astype(np.uint32)
        return Chunk(None, np.concatenate(token), np.concatenate(first), held, np.concatenate(sizes)), np.concatenate(seconds) if second else None

    def text(self) -> np.ndarray:
        """The text of each token."""
        return np.repeat(np.arange(len(self.held)), np.diff(self.first))

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words by two hashes, which one each word of the chunk is, and how often each is in texts to be learned from."""
        inner = _inner(self.first)
        h1, at, which = np.unique(self.token[inner], return_index=True, return_inverse=True)
        h2 = word_hashes(Words(self.words.data, self.words.start[at], self.words.end[at], self.words.first), 1).astype(np.uint32)
        learned = ~self.held[self.text()[inner]]
        return h1, h2, which, np.bincount(which[learned], minlength=len(h1))


def _texts(run: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(run).split(b"\n")


def _inner(first: np.ndarray) -> np.ndarray:
    """Which tokens are words."""
    inner = np.ones(first[-1], bool)
    inner[first[1:] - 1] = False
    return inner


def _cell(row: pa.RecordBatch, name: str):
    return row.column(row.schema.get_field_index(name))[0].as_py()


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1)


def _chunk_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Chunk]]:
    for row in _rows(batches):
        yield row, Chunk.read(row)


# -- word counts -----------------------------------------------------------------------------------------------------------------


def _local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row, chunk in _chunk_rows(batches):
        h1, h2, _, c = chunk.distinct()
        of = pa.array(np.full(len(h1), _cell(row, "chunk"), np.int64))
        yield pa.RecordBatch.from_arrays([of, pa.array(h1.view(np.int64)), pa.array(h2.view(np.int32)), pa.array(c.astype(np.int64))], ["chunk", "h1", "h2", "c"])


def word_counts(work: DataFrame) -> DataFrame:
    """(chunk, h1, h2, c, total, one) of the distinct words of each chunk: counts here and in all chunks; ``one`` marks a row per word."""
    local = work.select("chunk", "held", "packed").mapInArrow(_local, "chunk long, h1 long, h2 int, c long")
    word = Window.partitionBy("h1", "h2")
    one = F.col("chunk") == F.min("chunk").over(word)
    return materialize(local.select("chunk", "h1", "h2", "c", F.sum("c").over(word).alias("total"), one.alias("one")), "words")


def classes(token: np.ndarray) -> np.ndarray:
    return (token >> U(64 - BITS)).astype(np.int64)


# -- predictors ------------------------------------------------------------------------------------------------------------------


def _code() -> tuple[np.ndarray, np.ndarray]:
    """Of each class the bits and a hash of the place in the class before each bit."""
    c = np.arange(1 << BITS)[:, None]
    j = np.arange(BITS)[None, :]
    node = (1 << j) | (c >> (BITS - j))
    return ((c >> (BITS - 1 - j)) & 1).astype(np.uint8), mix(node.astype(U) * END).astype(np.uint32)


BIT, NODE = _code()


def context(token: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the contexts of each token but the first two for predictor ``k``; nothing before the text counts."""
    before = lambda back: np.where(place[2:] >= back, token[2 - back : len(token) - back], U(0))
    if k == 0:
        return np.zeros(len(token) - 2, U)
    if k == 1:
        return mix(before(1) + U(1))
    if k == 2:
        return mix(mix(before(1) + U(2)) + before(2))
    return mix(before(2) + U(3))


def contexts(token: np.ndarray, place: np.ndarray) -> np.ndarray:
    """32 bits of the hashes of the contexts, one row a predictor."""
    return np.stack([(context(token, place, k) >> U(32)).astype(np.uint32) for k in range(PREDICTORS)])


def pieces(chunk: Chunk, wanted: np.ndarray | None = None, most: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of whole segments of about ``most`` tokens: tokens after two that stand before, contexts, and the first token of each segment."""
    counts = -(-np.diff(chunk.first) // SEGMENT)
    of = np.repeat(np.arange(len(counts)), counts)
    first = chunk.first[of] + (np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)) * SEGMENT
    last = np.minimum(first + SEGMENT, chunk.first[of + 1])
    padded = np.concatenate([np.zeros(2, U), chunk.token])
    a = 0
    while a < len(of):
        b = max(int(np.searchsorted(last, first[a] + most, "right")), a + 1)
        lo, hi = first[a], last[b - 1]
        text = np.repeat(of[a:b], (last - first)[a:b])
        place = np.concatenate([np.zeros(2, np.int64), np.arange(lo, hi) - chunk.first[text]])
        ctx = contexts(padded[lo : hi + 2], place)
        token, begin = chunk.token[lo:hi], first[a:b] - lo
        if wanted is not None:
            keep = wanted[text]
            token, ctx = token[keep], ctx[:, keep]
        yield token, ctx, begin
        a = b


def _slots(ctx: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    """The slot of every bit of each token."""
    return (ctx[:, None] + node) & np.uint32((1 << bits) - 1)


def _counted(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PREDICTORS, 2 << bits), np.uint32)
        one = np.uint32(1)
        for _, chunk in _chunk_rows(batches):
            for token, ctx, _ in pieces(chunk, ~chunk.held):
                c = classes(token)
                node, bit = NODE[c], BIT[c]
                for k in range(PREDICTORS):
                    np.add.at(total[k], ((_slots(ctx[k], node, bits) << np.uint32(1)) | bit).ravel(), one)
        flat = total.reshape(-1, 2 * BLOCK)
        for block in np.flatnonzero(flat.any(axis=1)):
            data = zstandard.ZstdCompressor(level=1).compress(flat[block].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([data])], ["block", "data"])

    return run


def log_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The log odds of a one, in parts of ``SCALE``."""
    return np.clip(np.rint(SCALE * np.log((ones + PRIOR) / (zeros + PRIOR))), -127, 127).astype(np.int8)


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up rows sorted by block; one block is held."""
    now, total = None, None

    def emit():
        pair = total.reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([log_odds(pair[:, 0], pair[:, 1]).tobytes()])], ["block", "odds"])

    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if block != now:
                if now is not None:
                    yield emit()
                now, total = block, np.zeros(2 * BLOCK, np.float64)
            total += np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u4")
    if now is not None:
        yield emit()


# -- exact counts of contexts ----------------------------------------------------------------------------------------------------


def _changes(x: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    return np.concatenate([np.ones(min(len(x), 1), bool), x[1:] != x[:-1]])


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and which one each is; ``x`` is overwritten."""
    bits = len(x).bit_length()
    which = np.empty(len(x), np.int32)
    if len(x) and int(x.max()) >> (64 - bits) == 0:
        # Value and place fit in one number: sorting those is several times faster than sorting places.
        x <<= U(bits)
        x |= np.arange(len(x), dtype=U)
        x.sort()
        order = (x & U((1 << bits) - 1)).astype(np.uint32)
        x >>= U(bits)
    else:
        order = np.argsort(x)
        x = x[order]
    begins = _changes(x)
    which[order] = np.cumsum(begins, dtype=np.int32) - 1
    return x[begins], which


def _merged(x: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_distinct`` of both together, where ``x`` is in order and far longer."""
    line = np.argsort(more)
    both = np.concatenate([x, more[line]])
    order = np.argsort(both, kind="stable")  # two runs in order: one merge
    both = both[order]
    begins = _changes(both)
    which = np.empty(len(both), np.int32)
    order[order >= len(x)] = len(x) + line
    which[order] = np.cumsum(begins, dtype=np.int32) - 1
    return both[begins], which


def code_bits(tokens: int) -> int:
    """Bits of a code that tells the words of so many tokens apart: of random codes, fewer than one word in 32 has that of another word."""
    return min(max(tokens.bit_length() + 5, 24), 40)


@dataclass
class Seen:
    """The distinct tokens of a chunk (0: nothing before the text), which one each token is and the two tokens before it, the distinct codes (first
    bits of the hashes), which one each distinct token has, and whether a token is learned from."""

    names: np.ndarray
    which: np.ndarray
    one: np.ndarray
    two: np.ndarray
    codes: np.ndarray
    code: np.ndarray
    learned: np.ndarray
    bits: int

    @staticmethod
    def of(chunk: Chunk, bits: int) -> Seen:
        names, which = _distinct(np.append(chunk.token, U(0)))
        which = which[:-1]
        one, two = np.zeros(len(which), np.int32), np.zeros(len(which), np.int32)
        one[1:], two[2:] = which[:-1], which[:-2]
        one[chunk.first[:-1]] = two[chunk.first[:-1]] = two[np.minimum(chunk.first[:-1] + 1, len(which) - 1)] = 0
        codes = names >> U(64 - bits)
        begins = _changes(codes)
        return Seen(names, which, one, two, codes[begins], np.cumsum(begins, dtype=np.int32) - 1, np.repeat(~chunk.held, np.diff(chunk.first)), bits)

    def counts(self) -> np.ndarray:
        """How often each distinct token is in texts to be learned from."""
        return np.bincount(self.which[self.learned], minlength=len(self.names))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes of two tokens, and which one stands before each token."""
        x = self.two.astype(U)
        x *= U(len(self.names))
        x += self.one.view(np.uint32)
        pairs, pair = _distinct(x)
        hashes, number = _distinct(mix(mix(self.names[pairs % U(len(self.names))] + U(2)) + self.names[pairs // U(len(self.names))]) >> U(64 - PAIR_BITS))
        return hashes, number[pair]

    def rows(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct rows (number of the context, code) in order, which one each token is, and how often each is in texts to be learned from."""
        n = len(self.codes).bit_length()
        x = context.astype(U)
        x <<= U(n)
        x |= self.code.view(np.uint32)[self.which]
        rows, of = _distinct(x)
        counts = np.bincount(of[self.learned], minlength=len(rows)).astype(np.uint32)
        return (rows >> U(n)) << U(self.bits) | self.codes[rows & U((1 << n) - 1)], of, counts


def part_starts(parts: int) -> np.ndarray:
    """The first of the classes of ``PREFIX`` bits of each part of the words, and the end."""
    return np.array([(p << PREFIX) // parts for p in range(parts + 1)])


def word_cuts(names: np.ndarray, parts: int) -> np.ndarray:
    """Where each part of the sorted hashes of words begins, and the end; all words of a class are in one part."""
    return np.append(np.searchsorted(names, part_starts(parts)[:-1].astype(U) << U(64 - PREFIX)), len(names))


def pair_cuts(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each part of the sorted hashes of pairs begins, and the end."""
    return np.append(np.searchsorted(hashes, np.array([(p << PAIR_BITS) // parts for p in range(parts)], U)), len(hashes))


def _zipped(x: np.ndarray) -> bytes:
    """Compressed byte by byte: the lowest bytes of all numbers, then the next ones."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes())


def _unzipped(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _gaps(x: np.ndarray) -> bytes:
    return _zipped(np.diff(x, prepend=U(0)).astype("<u8"))


def _cut_rows(rows: np.ndarray, counts: np.ndarray, contexts: int, cut: np.ndarray, bits: int) -> list[list[bytes]]:
    """Rows of the contexts of each part: how many of each context, the gaps between their codes, and counts."""
    context = rows >> U(bits)
    several = np.bincount(context.view(np.int64), minlength=contexts).astype("<u4")
    gaps = rows & U((1 << bits) - 1)
    gaps[1:] -= np.where(context[1:] == context[:-1], gaps[:-1], U(0))
    gaps = gaps.astype("<u4" if bits <= 32 else "<u8")
    at = np.searchsorted(rows, cut.astype(U) << U(bits))
    parts = zip(cut[:-1], cut[1:], at[:-1], at[1:])
    return [[_zipped(several[a:b]), _zipped(gaps[c:d]), _zipped(counts[c:d].astype("<u4"))] for a, b, c, d in parts]


def _sent_rows(contexts: np.ndarray, data: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows and counts sent by ``_cut_rows``, with these numbers of the contexts."""
    several, gaps, counts = _unzipped(data[0], "<u4"), _unzipped(data[1], "<u4" if bits <= 32 else "<u8").astype(U), _unzipped(data[2], "<u4")
    total = np.cumsum(gaps, dtype=U)
    some = several > 0
    begin = (np.cumsum(several, dtype=np.int64) - several)[some]
    return np.repeat(contexts.astype(U), several) << U(bits) | (total - np.repeat(total[begin] - gaps[begin], several[some])), counts


def _often(least: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk, _ = Chunk.hashed(row)
            token = np.concatenate([np.zeros(2, U), chunk.token])
            place = np.concatenate([np.zeros(2, np.int64), np.arange(len(chunk.token)) - np.repeat(chunk.first[:-1], np.diff(chunk.first))])
            one, two = (np.where(place[2:] >= back, token[2 - back : len(token) - back], U(0)) for back in (1, 2))
            for pairs, hashes in ((False, one), (False, two), (True, context(token, place, 2))):
                bins = np.flatnonzero(np.bincount((hashes >> U(64 - BIN_BITS)).astype(np.int64)) >= least)
                yield pa.RecordBatch.from_arrays([pa.array([pairs] * len(bins), pa.bool_()), pa.array(bins, pa.int64())], ["pairs", "bin"])

    return run


def hot_bins(work: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The bins of words and of pairs that are hot in some chunk. They say where rows go, and change no count."""
    rows = work.select("held", "packed").mapInArrow(_often(HOT), "pairs boolean, bin long").distinct().collect()
    return tuple(np.array([r["bin"] for r in rows if r["pairs"] == pairs], np.int64) for pairs in (False, True))


@dataclass
class Laid:
    """The rows of a chunk as they go to the parts: of predictors 1 and 3 by word (rows, counts), of predictor 2 by hashes of pairs. In a hot bin a
    context has the first ``BITS`` bits of the codes only; each of these classes is a context of its own, told by a hash among those of pairs, so
    no context has many rows a chunk. If asked for, ``early`` and ``late`` have the row of each token by predictor, of all rows in order, before and after these bits."""

    words: list[tuple[np.ndarray, np.ndarray]]
    hashes: np.ndarray
    pairs: tuple[np.ndarray, np.ndarray]
    early: list[np.ndarray]
    late: list[np.ndarray]

    @staticmethod
    def of(seen: Seen, hot: tuple[np.ndarray, np.ndarray], tokens: bool = True) -> Laid:
        bits = U(seen.bits)
        is_hot = np.zeros((2, 1 << BIN_BITS), bool)
        for x, bins in zip(is_hot, hot):
            x[bins] = True
        hashes, before = seen.pairs()
        words, rest, early, late, place = [], [], [], [], 0
        for k, context, names, x in ((1, seen.one, seen.names, is_hot[0][seen.names >> U(64 - BIN_BITS)]), (3, seen.two, seen.names, is_hot[0][seen.names >> U(64 - BIN_BITS)]), (2, before, hashes, is_hot[1][hashes >> U(PAIR_BITS - BIN_BITS)])):
            rows, of, counts = seen.rows(context)
            split = x[(rows >> bits).view(np.int64)]
            cut = np.where(split, rows >> (bits - U(BITS)) << (bits - U(BITS)), rows)
            first = _changes(cut)
            number = np.cumsum(first, dtype=np.int32) - 1
            both = cut[first], np.add.reduceat(counts, np.flatnonzero(first))
            deep = rows[split]
            classes_ = deep >> (bits - U(BITS))
            begins = _changes(classes_)
            each = classes_[begins]
            sub = mix(mix(names[each >> U(BITS)] + U(3 + k)) + (each & U((1 << BITS) - 1))) >> U(64 - PAIR_BITS)
            rest.append((split, sub, np.cumsum(begins) - 1, deep & U((1 << seen.bits) - 1), counts[split], number, of if tokens else None))
            del rows, of, cut, first
            if k == 2:
                pairs = both
            else:
                words.append(both)
        every, at = _merged(hashes, np.concatenate([r[1] for r in rest]))
        at = at.astype(U) << bits
        keys, n = [], len(hashes)
        for _, sub, of_sub, code, *_ in rest:
            keys.append(at[n : n + len(sub)][of_sub] | code)
            n += len(sub)
        rows, which = _merged(at[pairs[0] >> bits] | pairs[0] & U((1 << seen.bits) - 1), np.concatenate(keys))
        counts = np.bincount(which, weights=np.concatenate([pairs[1], *(r[4] for r in rest)]), minlength=len(rows)).astype(np.uint32)
        if not tokens:
            return Laid(words, every, (rows, counts), [], [])
        starts = np.cumsum([0] + [len(x) for x, _ in words])
        which += np.int32(starts[-1])
        n = len(pairs[0])
        for i, (split, _, _, code, _, number, of) in enumerate(rest):
            number = number + np.int32(starts[i]) if i < 2 else which[number]
            early.append(number[of])
            number[split] = which[n : n + len(code)]
            late.append(number[of] if len(code) else early[-1])
            n += len(code)
        # The order of the predictors.
        return Laid(words, every, (rows, counts), [early[i] for i in (0, 2, 1)], [late[i] for i in (0, 2, 1)])


def _messages(row: pa.RecordBatch, parts: int, bits: int, hot: tuple[np.ndarray, np.ndarray]) -> list[list[bytes]]:
    chunk, other = Chunk.hashed(row, second=True)
    seen = Seen.of(chunk, bits)
    second = np.zeros(len(seen.names), "<u4")
    second[seen.which] = other
    del chunk, other
    laid = Laid.of(seen, hot, tokens=False)
    cut = word_cuts(seen.names, parts)
    words = zip(cut[:-1], cut[1:], *(_cut_rows(*x, len(seen.names), cut, bits) for x in laid.words))
    counts = seen.counts().astype("<u4")
    sent = [[_gaps(seen.names[a:b]), _zipped(second[a:b]), _zipped(counts[a:b]), *one, *two] for a, b, one, two in words]
    cut = pair_cuts(laid.hashes, parts)
    return sent + [[_gaps(laid.hashes[a:b]), *x] for a, b, x in zip(cut[:-1], cut[1:], _cut_rows(*laid.pairs, len(laid.hashes), cut, bits))]


def _sent(parts: int, bits: int, hot: tuple[np.ndarray, np.ndarray]):
    """What each chunk knows, to each part: words (gaps between their hashes, second hashes, counts) with the rows of predictors 1 and 3, and
    to as many other parts pairs of words with the rows of predictor 2."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk, data = _cell(row, "chunk"), _messages(row, parts, bits, hot)
            for p in range(0, 2 * parts, 16):
                some = data[p : p + 16]
                of = pa.array([chunk] * len(some), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(range(p, p + len(some)), pa.int64()), of, pa.array(some, pa.list_(pa.binary()))], ["part", "chunk", "data"])

    return run


def _places(rows: np.ndarray, j: int, bits: int) -> np.ndarray:
    """Where the rows of each place before bit ``j`` of the code begin."""
    return _changes(rows >> U(bits - j))


def _bit(rows: np.ndarray, j: int, bits: int) -> np.ndarray:
    return (rows >> U(bits - 1 - j) & U(1)).astype(bool)


Level = tuple[np.ndarray, np.ndarray, np.ndarray]


def counted_levels(rows: np.ndarray, counts: np.ndarray, bits: int, begin: int = 0) -> Iterator[Level]:
    """By bit, of the sorted distinct rows that are not closed: which they are, the log odds of their own bit, and whether they close. A row closes when
    it is alone at its place, as nothing changes after that."""
    open_ = np.arange(len(rows), dtype=np.int32)
    for j in range(begin, bits):
        first, bit = _places(rows, j, bits), _bit(rows, j, bits)
        at = np.flatnonzero(first)
        both, ones = (np.add.reduceat(x, at) if len(at) else np.zeros(0) for x in (counts, np.where(bit, counts, 0)))
        place = np.cumsum(first, dtype=np.int32) - 1
        odds = log_odds(both - ones, ones)[place]
        closed = (np.diff(np.append(at, len(rows))) == 1)[place]
        yield open_, np.where(bit, odds, -odds), closed
        del first, bit, at, both, ones, place, odds
        open_, rows, counts = open_[~closed], rows[~closed], counts[~closed]


def told_levels(rows: np.ndarray, part: np.ndarray, told: list[list[bytes]], bits: int, begin: int = 0) -> Iterator[Level]:
    """The same of rows whose counts the parts know, from what each part tells; ``part`` is where the rows of each part begin, and the end."""
    odds, closes = [_unzipped(x[1], "i1") for x in told], [_unzipped(x[2], "u1") for x in told]
    at = np.cumsum([0] + [len(x) for x in odds])[:-1]
    closes = np.concatenate([np.unpackbits(x, count=len(y)) for x, y in zip(closes, odds)]).astype(bool)
    odds = np.concatenate(odds)
    open_ = np.arange(len(rows), dtype=np.int32)
    for j in range(begin, bits):
        first, bit = _places(rows, j, bits), _bit(rows, j, bits)
        begins = np.flatnonzero(first)
        ends = np.searchsorted(open_[begins], part)
        n = np.diff(ends)
        here = np.arange(len(begins)) + np.repeat(at - ends[:-1], n)
        at = at + n
        place = np.cumsum(first, dtype=np.int32) - 1
        values, closed = odds[here][place], closes[here][place]
        yield open_, np.where(bit == bit[begins][place], values, -values), closed
        del first, bit, begins, here, place, values
        open_, rows = open_[~closed], rows[~closed]


def _told_rows(keys: list[np.ndarray], n: list[np.ndarray], bits: int, begin: int = 0) -> list[list[bytes]]:
    """To each chunk which of its contexts no other chunk has learned from, and of the others by bit the log odds of the bit of the first open row
    at each place, and whether that place closes. ``keys`` has the rows of each chunk, ``n`` their counts."""
    rows, which = _distinct(np.concatenate(keys))
    counts = np.bincount(which, weights=np.concatenate(n), minlength=len(rows))
    total = np.bincount((rows >> U(bits)).astype(np.int64), weights=counts)
    out, mine, wanted = [], [], np.zeros(len(total), bool)
    at = 0
    for key, c in zip(keys, n):
        context = (key >> U(bits)).astype(np.int64)
        first = _changes(context)
        own = np.bincount(np.cumsum(first) - 1, weights=c) if len(key) else np.zeros(0)
        alone = own == total[context[first]]
        wanted[context[first][~alone]] = True
        out.append([_zipped(np.packbits(alone)), [], []])
        mine.append(which[at : at + len(key)][~np.repeat(alone, np.diff(np.append(np.flatnonzero(first), len(key))))])
        at += len(key)
    keep = wanted[(rows >> U(bits)).astype(np.int64)]
    number = np.cumsum(keep) - 1
    rows, counts, mine = rows[keep], counts[keep], [number[m] for m in mine]
    own = [rows[m] for m in mine]
    odds, closed = np.empty(len(rows), np.int8), np.empty(len(rows), bool)
    for j, (open_, odds_, closed_) in enumerate(counted_levels(rows, counts, bits, begin), begin):
        odds[open_], closed[open_] = odds_, closed_
        for i, m in enumerate(mine):
            if len(m):
                first, stays = m[_places(own[i], j, bits)], ~closed[m]
                out[i][1].append(odds[first])
                out[i][2].append(closed[first])
                mine[i], own[i] = m[stays], own[i][stays]
    return [[a, *(_zipped(f(np.concatenate(x))) if x else _zipped(np.zeros(0, np.uint8)) for f, x in ((np.asarray, v), (np.packbits, c)))] for a, v, c in out]


def _common(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """How many first bits two codes share."""
    return bits - np.frexp((a ^ b).astype(np.float64))[1]


def code_ends(codes: np.ndarray, learned: np.ndarray, bits: int) -> np.ndarray:
    """After how many bits each code ends: at most one of the sorted learned words is left there, or no bit."""
    if len(learned) < 2:
        return np.zeros(len(codes), np.int64)
    at = np.searchsorted(learned, codes)
    near = []
    for k in range(-2, 2):
        there = at + k
        ok = (there >= 0) & (there < len(learned))
        near.append(np.where(ok, _common(codes, learned[np.clip(there, 0, len(learned) - 1)], bits), -1))
    return np.minimum(np.sort(near, axis=0)[-2] + 1, bits)


def _told_words(sent: list[list[bytes]], part: int, parts: int, bits: int) -> list[list[bytes]]:
    """To each chunk, of its words: the counts in other chunks, after how many bits each code ends, if after ``PREFIX`` or more, and the size of what is
    left there; the size and the number of words of each class of ``PREFIX`` bits of this part; and the rows."""
    hashes = [np.cumsum(_unzipped(data[0], "<u8"), dtype=U) for data in sent]
    names, number = _distinct(np.concatenate(hashes))
    second, counts = (np.concatenate([_unzipped(data[i], "<u4") for data in sent]) for i in (1, 2))
    words, which = _distinct(number.astype(U) << U(32) | second)
    total = np.bincount(which, weights=counts, minlength=len(words)).astype(np.int64)
    others = (total[which] - counts).astype("<u8")
    known = total > 0
    hashed = names[words >> U(32)][known]
    low, high = part_starts(parts)[part : part + 2]
    of = (hashed >> U(64 - PREFIX)).astype(np.int64) - low
    sums = [np.bincount(of, weights=x, minlength=high - low).astype("<u8") for x in (total[known], np.ones(len(of)))]
    codes, learned = names >> U(64 - bits), hashed >> U(64 - bits)
    ends = code_ends(codes, learned, bits)
    ends[ends <= PREFIX] = 0
    rest = (bits - ends).astype(U)
    cumulated = np.concatenate([[0], np.cumsum(total[known] + 1)])
    a, b = (np.searchsorted(learned, ((codes >> rest) + U(k)) << rest) for k in (0, 1))
    size = np.where(ends > 0, cumulated[b] - cumulated[a], 0).astype("<u8")
    cut = np.cumsum([len(x) for x in hashes])[:-1]
    contexts = np.split(number, cut)
    told = []
    if bits > PREFIX:
        keys, n = [], []
        for x, data in zip(contexts, sent):
            code = codes[x]
            first = _changes(code)
            code = code[first]
            keys.append((code >> U(bits - PREFIX)) << U(bits) | code)
            n.append(np.add.reduceat(_unzipped(data[2], "<u4").astype(np.float64), np.flatnonzero(first)) if len(code) else np.zeros(0))
        told.append(_told_rows(keys, n, bits, PREFIX))
    else:
        told.append([[]] * len(sent))
    for i in (3, 6):
        told.append(_told_rows(*zip(*(_sent_rows(x, data[i : i + 3], bits) for x, data in zip(contexts, sent))), bits))
    each = zip(np.split(others, cut), contexts, *told)
    return [[*map(_zipped, (x, ends[y].astype(np.uint8), size[y], *sums)), *one, *two, *none] for x, y, none, one, two in each]


def _told_pairs(sent: list[list[bytes]], bits: int) -> list[list[bytes]]:
    hashes = [np.cumsum(_unzipped(data[0], "<u8"), dtype=U) for data in sent]
    _, number = _distinct(np.concatenate(hashes))
    contexts = np.split(number, np.cumsum([len(x) for x in hashes])[:-1])
    return _told_rows(*zip(*(_sent_rows(x, data[1:], bits) for x, data in zip(contexts, sent))), bits)


def _told(parts: int, bits: int):
    """Adds up rows sorted by part; one part is held."""

    def emit(part, sent):
        data = [x for _, x in sent]
        data = _told_words(data, part, parts, bits) if part < parts else _told_pairs(data, bits)
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in sent], pa.int64()), pa.array([part] * len(sent), pa.int64()), pa.array(data, pa.list_(pa.binary()))], ["chunk", "part", "data"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sent = None, []
        for batch in batches:
            for part, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now and sent:
                    yield emit(now, sent)
                    sent = []
                now = part
                sent.append(row)
        if sent:
            yield emit(now, sent)

    return run


def told_chunks(work: DataFrame, parts: int, bits: int, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(chunk, part, data): what each part tells each chunk of its words and contexts, over all chunks."""
    sent = work.select("chunk", "held", "packed").mapInArrow(_sent(parts, bits, hot), "part long, chunk long, data array<binary>")
    return sent.repartition(2 * parts, "part").sortWithinPartitions("part").mapInArrow(_told(parts, bits), "chunk long, part long, data array<binary>")


def exact_odds(rows: np.ndarray, counts: np.ndarray, cut: np.ndarray, told: list[list[bytes]], bits: int, begin: int = 0) -> Iterator[np.ndarray]:
    """By bit, of a predictor the log odds of the own bit of each row; ``cut`` is where the rows of each part begin, and the end."""
    first = _changes(rows >> U(bits))
    sizes = np.diff(np.append(np.flatnonzero(first), len(rows)))
    contexts = np.diff(np.concatenate([[0], np.cumsum(first)])[cut])
    alone = np.concatenate([np.unpackbits(_unzipped(x[0], "u1"), count=n) for x, n in zip(told, contexts.tolist())]).astype(bool)
    alone = np.repeat(alone, sizes)
    here, there = np.flatnonzero(alone).astype(np.int32), np.flatnonzero(~alone).astype(np.int32)
    odds = np.empty(len(rows), np.int8)
    levels = zip(counted_levels(rows[here], counts[here], bits, begin), told_levels(rows[there], np.searchsorted(there, cut), told, bits, begin))
    del rows, counts, first, sizes, alone
    for (a, x, _), (b, y, _) in levels:
        odds[here[a]], odds[there[b]] = x, y
        yield odds


def prefix_odds(codes: np.ndarray, sizes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """By bit, the log odds of the own bit of each code without a context, as far as the sizes of classes of ``PREFIX`` bits tell."""
    for j in range(min(PREFIX, bits)):
        zeros, ones = sizes.reshape(2 << j, -1).sum(axis=1).reshape(-1, 2).T
        odds = log_odds(zeros, ones)[codes >> U(bits - j)]
        yield np.where(_bit(codes, j, bits), odds, -odds)


def _ends(seen: Seen, told: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each distinct token its count in all chunks, after how many bits its code ends and the size of what is left there; the size and the number of
    words of each class of ``PREFIX`` bits."""
    others, ends, left, n, v = (np.concatenate([_unzipped(x[i], kind) for x in told]).astype(np.int64) for i, kind in enumerate(("<u8", "u1", "<u8", "<u8", "<u8")))
    for j in range(min(PREFIX, seen.bits) + 1):
        at = np.flatnonzero(ends == j)
        place = seen.names[at] >> U(64 - j) if j else np.zeros(len(at), U)
        left[at] = (n + v).reshape(1 << j, -1).sum(axis=1)[place]
        if j < seen.bits:
            ends[at] += v.reshape(1 << j, -1).sum(axis=1)[place] > 1
    return seen.counts() + others, ends, left, n, v


def _by_bit(seen: Seen, hot: tuple[np.ndarray, np.ndarray], told: list[list[bytes]], n: np.ndarray) -> Iterator[tuple[list[np.ndarray], list[np.ndarray]]]:
    """By bit, the log odds of each row and which row each token is, by predictor."""
    parts, bits, laid = len(told) // 2, seen.bits, Laid.of(seen, hot)
    cut, at = word_cuts(seen.names, parts), part_starts(parts)[:-1].astype(U)
    each = [(*x, cut, [t[i : i + 3] for t in told[:parts]]) for x, i in zip(laid.words, (5, 8))] + [(*laid.pairs, pair_cuts(laid.hashes, parts), told[parts:])]
    levels = [exact_odds(rows, c, np.append(np.searchsorted(rows, x[:-1].astype(U) << U(bits)), len(rows)), data, bits) for rows, c, x, data in each]
    none = prefix_odds(seen.codes, n, bits)
    if bits > PREFIX:
        c = np.bincount(seen.code, weights=seen.counts(), minlength=len(seen.codes))
        rows = (seen.codes >> U(bits - PREFIX)) << U(bits) | seen.codes
        cut = np.append(np.searchsorted(seen.codes, at << U(bits - PREFIX)), len(seen.codes))
        none = itertools.chain(none, exact_odds(rows, c, cut, [t[11:14] for t in told[:parts]], bits, PREFIX))
    code = seen.code[seen.which]
    early, late = [code, *laid.early], [code, *laid.late]
    # What is not needed again is let go, as these are the largest arrays of a task.
    del seen, laid, each
    for j in range(bits):
        odds = np.concatenate([next(x) for x in levels])
        if j == BITS:
            early = None
        yield [next(none), odds, odds, odds], early if j < BITS else late


def _scored_exactly(parts: int, bits: int, hot: tuple[np.ndarray, np.ndarray]):
    def run(work: pa.Table, told: pa.Table) -> pa.Table:
        data = dict(zip(told.column("part").to_pylist(), told.column("data").to_pylist()))
        data = [data[p] for p in range(2 * parts)]
        row = work.to_batches()[0]
        chunk, _ = Chunk.hashed(row)
        seen = Seen.of(chunk, bits)
        chunk.token, which = np.zeros(0, U), seen.which
        counts, ends, left, n, v = _ends(seen, data[:parts])
        depth, by_bit = ends.astype(np.uint8)[which], _by_bit(seen, hot, data, n)
        del data, seen
        logs = code_scores(chunk.first, depth, by_bit)
        logs -= np.log10(left + 1.0)[which]
        made = figures(chunk, counts[which], int(n.sum()), int(v.sum()), logs)
        ids = {"doc_id": row.column(row.schema.get_field_index("ids")).flatten(), "held_out": pa.array(chunk.held)}
        return pa.table(ids | {name: pa.array(x) for name, x in made.items()})

    return run


@dataclass
class Model:
    """Log odds of all slots (at most ``2 ** SLOT_BITS[1]`` bytes a predictor), log10 of the size of each class, and sums over all counts."""

    bits: int
    odds: np.ndarray
    weight: np.ndarray
    tokens: int
    distinct: int
    ends: int


def slot_bits(tokens: int) -> int:
    """Bits of a slot number that many tokens ask for."""
    return max(math.ceil(math.log2(max(tokens, 1) / SLOT_TOKENS)), SLOT_BITS[0])


def learn(work: DataFrame, counts: DataFrame) -> Model:
    """The model of all chunks and the words counted in them."""
    ends = work.select(F.explode("held").alias("h")).agg(F.sum((~F.col("h")).cast("long"))).first()[0] or 0
    of = F.shiftrightunsigned("h1", 64 - BITS)
    sums = counts.where("one AND total > 0").groupBy(of.alias("class")).agg(F.sum("total").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    n, v = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for r in sums:
        n[r["class"]], v[r["class"]] = r["n"], r["v"]
    end = classes(np.array([END]))[0]
    n[end] += ends
    v[end] += ends > 0
    tokens = int(n.sum())
    sums = np.log10(n + v + 1), tokens, int(v.sum()), int(ends)
    bits = min(slot_bits(tokens), SLOT_BITS[1])
    blocks = (PREDICTORS << bits) // BLOCK
    tasks = max(1, min(blocks, int(work.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    parts = work.select("held", "packed").mapInArrow(_counted(bits), "block long, data binary")
    odds = np.zeros(PREDICTORS << bits, np.int8)
    for r in parts.repartition(tasks, "block").sortWithinPartitions("block").mapInArrow(_summed, "block long, odds binary").collect():
        odds[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["odds"], np.int8)
    return Model(bits, odds.reshape(PREDICTORS, -1), *sums)


# -- mixing ----------------------------------------------------------------------------------------------------------------------


def mixed(x: np.ndarray, bit: np.ndarray, active: np.ndarray) -> np.ndarray:
    """log10 of the probability of the bits of each token.

    Tokens stand step by step, of each segment its next one; ``active[t]`` segments, the first ones, have a token in step ``t``. ``x``
    has the log odds by bit, predictor and token.
    """
    weights = np.full((BITS, PREDICTORS, int(active[0])), START_WEIGHT, np.float32)
    dots = np.empty(bit.shape, np.float32)
    at = 0
    for n in active.tolist():
        to = at + n
        for j in range(BITS):
            odds = x[j, :, at:to] * np.float32(1 / SCALE)
            w = weights[j, :, :n]
            dot = (w * odds).sum(axis=0)
            np.clip(dot, -MOST, MOST, out=dot)
            dots[j, at:to] = dot
            error = (bit[j, at:to] - 1 / (1 + np.exp(-dot))) * np.float32(RATE)
            w += error * odds
        at = to
    total = np.zeros(bit.shape[1])
    for j in range(BITS):
        total += np.log1p(np.exp(np.where(bit[j] > 0, -dots[j], dots[j]).astype(np.float64)))
    return total / -math.log(10)


def steps(size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens step by step, of each segment its next one, longest segments first so that the ones still running are the first ones: how many are
    active in each step, and the segment and the number in it of each token."""
    line = np.argsort(-size, kind="stable")
    active = np.searchsorted(-size[line], -np.arange(size.max(initial=0)), "left")
    rank = np.arange(size.sum()) - np.repeat(np.cumsum(active) - active, active)
    return active, line[rank], np.repeat(np.arange(len(active)), active)


def class_scores(chunk: Chunk, model: Model) -> np.ndarray:
    """log10 of the probability of the class of each token."""
    out = []
    for token, ctx, first in pieces(chunk):
        active, segment, step = steps(np.diff(np.append(first, len(token))))
        order = first[segment] + step
        c = classes(token[order])
        x = np.empty((BITS, PREDICTORS, len(order)), np.int8)
        for k in range(PREDICTORS):
            x[:, k] = model.odds[k][_slots(ctx[k][order], NODE[c], model.bits)].T
        logs = np.empty(len(token))
        logs[order] = mixed(x, np.ascontiguousarray(BIT[c].T), active)
        out.append(logs)
    return np.concatenate(out) if out else np.zeros(0)


def mixed_bit(x: np.ndarray, active: np.ndarray) -> np.ndarray:
    """As ``mixed`` for one bit; ``x`` has the log odds of the own bit by predictor and token. Returns the mixed log odds."""
    weights = np.full((PREDICTORS, int(active[0])), START_WEIGHT, np.float32)
    dots = np.empty(x.shape[1], np.float32)
    at = 0
    for n in active.tolist():
        odds = x[:, at : at + n] * np.float32(1 / SCALE)
        w = weights[:, :n]
        dot = np.clip((w * odds).sum(axis=0), -MOST, MOST, out=dots[at : at + n])
        w += np.float32(RATE) / (1 + np.exp(dot)) * odds
        at += n
    return dots


def code_scores(first: np.ndarray, depth: np.ndarray, by_bit: Iterator[tuple[list[np.ndarray], list[np.ndarray]]]) -> np.ndarray:
    """log10 of the probability of the code of each token, of ``depth`` bits; ``first`` has the first token of each text (one more at the end),
    ``by_bit`` by predictor the log odds of each row and which row each token is."""
    several = -(-np.diff(first) // SEGMENT)
    begin = np.repeat(first[:-1], several) + (np.arange(several.sum()) - np.repeat(np.cumsum(several) - several, several)) * SEGMENT
    out = np.zeros(len(depth), np.float32)
    least, order, known, rows, cost = int(depth.min(initial=255)), np.zeros(0, np.int32), None, [], np.zeros(0, np.float32)
    for j, (odds, which) in zip(range(int(depth.max(initial=0))), by_bit):
        if j >= least or not j:
            out[order] = cost
            tokens = np.flatnonzero(depth > j)
            active, segment, step = steps(np.add.reduceat(depth > j, begin, dtype=np.int64))
            order = tokens[np.searchsorted(tokens, begin)[segment] + step].astype(np.int32)
            known, cost = None, out[order]
        if known is not which:
            # While all tokens have a bit the same rows are looked up again and again.
            rows = []
            known, rows = which, [x[order] for x in which]
        x = np.empty((PREDICTORS, len(order)), np.int8)
        for k in range(PREDICTORS):
            np.take(odds[k], rows[k], out=x[k])
        del odds, which
        cost += np.log(1 + np.exp(-mixed_bit(x, active)))
    out[order] = cost
    return out.astype(np.float64) / -math.log(10)


def scored(chunk: Chunk, counts: np.ndarray, which: np.ndarray, model: Model) -> dict[str, np.ndarray]:
    """Figures of each text; ``counts`` of the distinct words, ``which`` one each word is."""
    seen = np.full(len(chunk.token), model.ends, np.int64)
    seen[_inner(chunk.first)] = counts[which]
    return figures(chunk, seen, model.tokens, model.distinct, class_scores(chunk, model) - model.weight[classes(chunk.token)])


def figures(chunk: Chunk, seen: np.ndarray, tokens: int, distinct: int, logs: np.ndarray) -> dict[str, np.ndarray]:
    """Figures of each text; ``seen`` are the counts of each token, ``logs`` is log10 of what one count weighs there."""
    n, text = len(chunk.held), chunk.text()
    share = np.log10(seen + 1.0)
    total = lambda x: np.bincount(text, weights=x, minlength=n)
    score = total(logs + share)
    return {
        "n_tokens": np.diff(chunk.first),
        "n_known": total(seen > 0).astype(np.int64),
        "train_tokens": np.full(n, tokens),
        "base_score": total(share - math.log10(tokens + distinct + 1)),
        "score": score,
        "bits_per_byte": -score / math.log10(2) / chunk.sizes,
    }


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are among the sorted ``keys``, and where."""
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool), at


def _scored(model, frequent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        for row, chunk in _chunk_rows(batches):
            h1, h2, which, counts = chunk.distinct()
            told = row.column(row.schema.get_field_index("told"))[0].values
            if told is not None and len(told):
                key, total = (told.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                # Only words of this chunk are told, so all of them are found.
                counts[np.searchsorted(h1, key.view(U))] = total
            there, at = _found(often["h1"], often["total"], h1)
            there[there] = often["h2"][at[there]] == h2[there]
            counts[there] = often["total"][at[there]]
            made = {"doc_id": row.column(row.schema.get_field_index("ids")).flatten(), "held_out": pa.array(chunk.held)}
            made |= {name: pa.array(x) for name, x in scored(chunk, counts, which, model.value).items()}
            yield pa.RecordBatch.from_arrays(list(made.values()), list(made))

    return run


def score(docs: DataFrame, held_out: Column, chunk_bytes: int = CHUNK_BYTES, whole: bool = False) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of each document. The contexts predict whole words with exact
    counts, whatever the size of the corpus, if ``whole``; else the classes of the words, with slots in a small corpus."""
    context = docs.sparkSession.sparkContext
    columns = f"doc_id {kind(docs, 'doc_id')}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    work = chunks(docs, held_out, chunk_bytes)
    tokens = work.agg(F.sum("learned")).first()[0] or 0
    if whole or slot_bits(tokens) > SLOT_BITS[1]:
        parts, bits = max(-(-tokens // PART_TOKENS), 1), code_bits(tokens) if whole else BITS
        hot = hot_bins(work) if whole else (np.zeros(0, np.int64),) * 2
        told = told_chunks(work, parts, bits, hot).groupBy("chunk")
        return work.select("chunk", "ids", "held", "packed").groupBy("chunk").cogroup(told).applyInArrow(_scored_exactly(parts, bits, hot), columns)
    counts = word_counts(work)
    often = materialize(counts.where("one AND total > 1").orderBy(F.desc("total"), "h1", "h2").limit(FREQUENT).select("h1", "h2", "total"), "frequent")
    rows = often.toPandas()  # FREQUENT rows of 20 bytes at most
    rows = rows.iloc[np.argsort(rows["h1"].to_numpy(np.int64).view(U), kind="stable")]
    frequent = {"h1": rows["h1"].to_numpy(np.int64).view(U), "h2": rows["h2"].to_numpy(np.int32).view(np.uint32), "total": rows["total"].to_numpy(np.int64)}
    rare = counts.where("total != c").join(F.broadcast(often.select("h1", "h2")), ["h1", "h2"], "left_anti")
    told = rare.groupBy("chunk").agg(F.collect_list(F.struct("h1", "total")).alias("told"))
    model = learn(work, counts)
    tasks = max(1, work.count())
    asked = work.repartition(tasks, "chunk").join(told, "chunk", "left").select("ids", "held", "packed", "told")
    return asked.mapInArrow(_scored(context.broadcast(model), context.broadcast(frequent)), columns)
