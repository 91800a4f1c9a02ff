"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

1. The pieces of all texts are counted over the whole corpus; the ``entries`` most frequent are merged once each.
2. They are compiled into a minimal acyclic automaton over bytes: equal suffixes share their states. Each transition puts out a
   number; along a word these add up to the word's rank, which points at its ids.
3. The automaton is one byte string of a bounded size, sent to every worker and memory-mapped there. A piece it knows costs one walk,
   any other piece is merged exactly by the merge ranks. A bounded memory of recent pieces stands before both.
4. Decoding joins the byte strings of the ids.

The tokenizer file is a parameter (byte-level BPE with its merges); nothing of it is stored here. Special tokens of the file that
occur in a text become their own id, as the file's own library does it; none are added.

Null text counts as empty and gives no ids. Rows are encoded one by one, so ties, repeated rows and null ids change nothing. An
empty table gives an empty result. Other columns pass through ``encode`` where they are named.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.tables import kind
from zonecast.llm.text import slices
from zonecast.session import materialize

#: Fixed value: how byte-level BPE splits a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters of a plain text, and what a plain text does not hold; in it the same rule needs no tables of Unicode.
_LATIN = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_NOT_PLAIN = re.compile(rf"[^\t-\r -~{_LATIN}]")
_PLAIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^\t-\r 0-9{_LATIN}]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)
_ANY = regex.compile(PIECES)
ENTRIES = 1 << 15
REMEMBERED = 1 << 17
#: Longest piece that is remembered and merged with others, in bytes.
SHORT = 48
#: Text that is cut into pieces at once.
ENCODED_BYTES = 2 << 20
#: Pieces a task counts before it sends the counts on.
COUNTED = 1 << 18


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut(text: str) -> list[str]:
    """The pieces of a text without special tokens."""
    return (_ANY if _NOT_PLAIN.search(text) else _PLAIN).findall(text)


def _alphabet() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes stand for themselves, the rest follow from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    letters = {chr(b): b for b in shown}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    return letters


class Vocabulary:
    """Ids, merges and special tokens of a tokenizer file."""

    def __init__(self, content: str):
        held = json.loads(content)
        byte = _alphabet()
        model = held["model"]
        self.ids = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.bytes: list[bytes] = [b""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for token, i in self.ids.items():
            self.bytes[i] = token
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.letter = [self.ids[bytes([b])] for b in range(256)]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []  # by rank
        for rank, pair in enumerate(model["merges"]):
            a, b = (bytes(byte[c] for c in x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.ranks[self.ids[a] << 32 | self.ids[b]] = rank
            self.merged.append(self.ids[a + b])
        self.letters, self.merged_ids = np.array(self.letter, np.int32), np.array(self.merged, np.int32)
        pairs = np.fromiter(self.ranks, np.int64, len(self.ranks))
        order = np.argsort(pairs)
        self.pair_keys, self.pair_ranks = pairs[order], np.fromiter(self.ranks.values(), np.int32, len(pairs))[order]
        self.letter_ranks = self._ranks_of(self.letters[:, None], self.letters[None, :])

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece: always the pair of the lowest rank, from the left."""
        parts = [self.letter[b] for b in piece]
        if len(parts) > SHORT:
            return self._merge_long(parts)
        rank, none = self.ranks.get, len(self.merged)
        found = [rank(a << 32 | b, none) for a, b in zip(parts, parts[1:])]
        while found:
            best = min(found)
            if best == none:
                break
            i = found.index(best)
            parts[i : i + 2] = [self.merged[best]]
            del found[i]
            if i:
                found[i - 1] = rank(parts[i - 1] << 32 | parts[i], none)
            if i < len(found):
                found[i] = rank(parts[i] << 32 | parts[i + 1], none)
        return parts

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of many short pieces as little-endian 32-bit integers; a step merges one pair of each piece."""
        if not pieces:
            return []
        none = len(self.merged)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out: list[bytes] = [b""] * len(pieces)
        order = np.argsort(sizes, kind="stable")
        for part in np.array_split(order, max(1, -(-len(order) // 2048))):
            width = int(sizes[part].max())
            held = np.zeros((len(part), width), np.uint8)
            inside = np.arange(width) < sizes[part][:, None]
            held[inside] = np.frombuffer(b"".join([pieces[i] for i in part.tolist()]), np.uint8)
            ids = np.where(inside, self.letters[held], -1)
            ranks = np.where(inside[:, 1:], self.letter_ranks[held[:, :-1], held[:, 1:]], none)
            rows = part
            while width > 1:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(rows)), at]
                done = best == none
                if done.any():
                    self._put(out, rows[done], ids[done])
                    rows, ids, ranks, at, best = rows[~done], ids[~done], ranks[~done], at[~done], best[~done]
                n = len(rows)
                if not n:
                    break
                ids[np.arange(n), at] = self.merged_ids[best]
                columns = np.arange(width)
                width -= 1
                ids = ids[columns != at[:, None] + 1].reshape(n, width)
                ranks = ranks[columns[:width] != at[:, None]].reshape(n, width - 1)
                for row, first in ((np.flatnonzero(at < width - 1), 0), (np.flatnonzero(at > 0), -1)):
                    i = at[row] + first
                    ranks[row, i] = self._ranks_of(ids[row, i], ids[row, i + 1])
            self._put(out, rows, ids)
        return out

    @staticmethod
    def _put(out: list[bytes], rows: np.ndarray, ids: np.ndarray) -> None:
        held = ids.astype("<u4").tobytes()
        step = 4 * ids.shape[1]
        for i, (row, n) in enumerate(zip(rows.tolist(), (ids >= 0).sum(axis=1).tolist())):
            out[row] = held[i * step : i * step + 4 * n]

    def _ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; as many as there are merges if it has none."""
        key = np.where(b >= 0, a.astype(np.int64) << 32 | b, -1)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], np.int32(len(self.merged)))

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same with a queue: n log n for a piece of n bytes."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.ranks.get
        queue = [(m, i, parts[i], parts[i + 1]) for i in range(n - 1) if (m := rank(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            best, i, a, b = heapq.heappop(queue)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = self.merged[best], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (m := rank(parts[x] << 32 | parts[y])) is not None:
                    heapq.heappush(queue, (m, x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]


@lru_cache(maxsize=2)
def _vocabulary(content: str) -> Vocabulary:
    return Vocabulary(content)


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The minimal acyclic transducer of the words, and the ids by rank, as one byte string.

    Words are added in order. When a word leaves the path of the one before it, the states below are complete: a state with the
    same finality and transitions as an earlier one is replaced by it.
    """
    ordered = sorted(entries)
    known: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    path: list[list] = [[False, []]]  # open states: [final, [(byte, state)]], the last transition of each still open
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, edges = path.pop()
            key = (final, tuple(edges))
            if key not in known:
                known[key] = len(states)
                states.append(key)
            byte, _ = path[-1][1].pop()
            path[-1][1].append((byte, known[key]))

    for word in ordered:
        shared = next((i for i, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
        close(shared)
        for b in word[shared:]:
            path[-1][1].append((b, -1))
            path.append([False, []])
        path[-1][0] = True
        last = word
    close(0)
    states.append((path[0][0], tuple(path[0][1])))
    below: list[int] = []  # words that end at or below each state
    key, target, output = [], [], []
    for state, (final, edges) in enumerate(states):
        held = int(final)
        for byte, to in edges:
            key.append(state << 8 | byte), target.append(to), output.append(held)
            held += below[to]
        below.append(held)
    ends = np.cumsum([0] + [len(entries[w]) for w in ordered])
    ids = [i for w in ordered for i in entries[w]]
    arrays = [np.array(x, "<u4") for x in ([f for f, _ in states], key, target, output, ends, ids)]
    return np.array([len(x) for x in arrays], "<u4").tobytes() + b"".join(x.tobytes() for x in arrays)


class Lexicon:
    """A compiled lexicon, memory-mapped from an unnamed file of this worker.

    A transition is found by its key, state and byte, in the sorted keys of all transitions; many words walk side by side.
    """

    def __init__(self, compiled: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(compiled)
            file.flush()
            mapped = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        at, out = 24, []
        for n in np.frombuffer(mapped, "<u4", 6).tolist():
            out.append(np.frombuffer(mapped, "<u4", n, at))
            at += 4 * n
        self.final, self.key, self.target, self.output, self.ends, self.ids = out

    def find_all(self, found: list[bytes]) -> list[bytes | None]:
        """The ids of each known word as little-endian 32-bit integers; of others None."""
        out: list[bytes | None] = [None] * len(found)
        if not found or not len(self.key):
            return out
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        begin = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(found) + b"\0", np.uint8)
        live = np.arange(len(found))
        state = np.full(len(found), len(self.final) - 1, np.int64)
        rank = np.zeros(len(found), np.int64)
        depth = 0
        while len(live):
            ended = sizes[live] == depth
            known = ended & (self.final[state] > 0)
            for i, r in zip(live[known].tolist(), rank[known].tolist()):
                out[i] = self.ids[self.ends[r] : self.ends[r + 1]].tobytes()
            live, state, rank = live[~ended], state[~ended], rank[~ended]
            key = (state << 8 | data[begin[live] + depth]).astype("<u4")
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            there = self.key[at] == key
            live, state, rank = live[there], self.target[at[there]].astype(np.int64), rank[there] + self.output[at[there]]
            depth += 1
        return out

    def find(self, word: bytes) -> bytes | None:
        return self.find_all([word])[0]


class Encoder(dict):
    """Ids of pieces; those not remembered are looked up in the lexicon or merged."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        specials = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None

    def __missing__(self, piece: str) -> bytes:
        """A piece that is not remembered, by itself; too long ones are never remembered."""
        return np.array(self.vocabulary.merge(piece.encode()), "<u4").tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Ids of all new pieces: from the lexicon where it has them, merged together where not."""
        if len(self) >= REMEMBERED:
            self.clear()
        fresh = [p for p in pieces - self.keys() if len(p) <= SHORT]
        words = [p.encode() for p in fresh]
        found = self.lexicon.find_all(words) if self.lexicon else [None] * len(words)
        open_ = [i for i, ids in enumerate(found) if ids is None and len(words[i]) <= SHORT]
        for i, ids in zip(open_, self.vocabulary.merge_all([words[i] for i in open_])):
            found[i] = ids
        self.update((p, ids) for p, ids in zip(fresh, found) if ids is not None)

    def encode(self, texts: list[str]) -> list[bytes]:
        """All ids of each text as little-endian 32-bit integers."""
        held, seen = [], set()
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            pieces = [part if i % 2 else cut(part) for i, part in enumerate(parts)]
            for part in pieces[::2]:
                seen.update(part)
            held.append(pieces)
        self.learn(seen)
        out = []
        for pieces in held:
            ids = [np.array([self.vocabulary.special[x]], "<u4").tobytes() if i % 2 else b"".join(map(self.__getitem__, x)) for i, x in enumerate(pieces)]
            out.append(b"".join(ids))
        return out

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _count(special: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart = regex.compile("|".join(map(regex.escape, special))) if special else None
        seen: Counter = Counter()

        def emit():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["piece", "n"])

        for _, texts in slices(batches):
            for text in texts:
                for part in apart.split(text.decode()) if apart else [text.decode()]:
                    seen.update(cut(part))
                if len(seen) >= COUNTED:
                    yield emit()
                    seen.clear()
        if seen:
            yield emit()

    return run


def frequent_pieces(docs: DataFrame, special: list[str], entries: int = ENTRIES) -> list[str]:
    """The most frequent pieces of all texts, at most ``entries``; of those with the count at the border none is taken.

    The border comes from the number of pieces per count, a table with few rows; only the pieces above it come to the driver.
    """
    counts = docs.select("text").mapInArrow(_count(special), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "pieces")
    spread = counts.groupBy("n").agg(F.count(F.lit(1)).alias("pieces"))
    held, border = 0, None
    for r in spread.orderBy(F.desc("n")).limit(entries).collect():
        held += r["pieces"]
        if held > entries:
            break
        border = r["n"]
    if border is None:
        return []
    return [r["piece"] for r in counts.where(F.col("n") >= border).select("piece").collect()]


def _encoded(content, lexicon, carried: list[str], ids: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_vocabulary(content.value), Lexicon(lexicon.value) if lexicon.value else None)
        for batch, texts in slices(batches, limit=ENCODED_BYTES):
            made = encoder.encode([t.decode() for t in texts])
            out = {c: batch.column(batch.schema.get_field_index(c)) for c in carried}
            out["n_tokens"] = pa.array([len(m) // 4 for m in made], pa.int64())
            out["ids_sha256"] = pa.array([hashlib.sha256(m).hexdigest() for m in made])
            if ids:
                offsets = np.concatenate([[0], np.cumsum([len(m) // 4 for m in made])]).astype(np.int32)
                out["ids"] = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(made), "<i4")))
            else:
                decoded = (encoder.decode(np.frombuffer(m, "<u4")) for m in made)
                out["decoded_sha256"] = pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded])
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return run


def _decoded(content, carried: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_vocabulary(content.value), None)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            out = {c: batch.column(batch.schema.get_field_index(c)) for c in carried}
            out["text"] = pa.array([encoder.decode(np.array(x or [], np.int64)) for x in column.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return run


class Codec:
    """A tokenizer file with a lexicon of the corpus it was prepared on."""

    def __init__(self, docs: DataFrame, tokenizer: str | None = None, entries: int = ENTRIES):
        with open(tokenizer or default_tokenizer(), encoding="utf-8") as file:
            content = file.read()
        vocabulary = _vocabulary(content)
        words = [p.encode() for p in frequent_pieces(docs, list(vocabulary.special), entries)]
        compiled = compile_lexicon({w: vocabulary.merge(w) for w in words}) if words else b""
        context = docs.sparkSession.sparkContext
        self.content, self.lexicon = context.broadcast(content), context.broadcast(compiled)

    def encode(self, docs: DataFrame, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
        """``carried`` columns with n_tokens, ids_sha256 and the ids themselves."""
        schema = "".join(f"`{c}` {kind(docs, c)}, " for c in carried)
        return docs.select(*carried, "text").mapInArrow(
            _encoded(self.content, self.lexicon, list(carried), True), f"{schema}n_tokens long, ids_sha256 string, ids array<int>"
        )

    def decode(self, encoded: DataFrame, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
        """``carried`` columns with the text of the ``ids``; null ids give an empty text."""
        schema = "".join(f"`{c}` {kind(encoded, c)}, " for c in carried)
        return encoded.select(*carried, "ids").mapInArrow(_decoded(self.content, list(carried)), f"{schema}text string")

    def round_trip(self, docs: DataFrame, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
        """``carried`` columns with n_tokens and the digests of the ids and of the text decoded from them."""
        schema = "".join(f"`{c}` {kind(docs, c)}, " for c in carried)
        return docs.select(*dict.fromkeys((*carried, "text"))).mapInArrow(
            _encoded(self.content, self.lexicon, list(carried), False), f"{schema}n_tokens long, ids_sha256 string, decoded_sha256 string"
        )
