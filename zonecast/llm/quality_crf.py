"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line with a word is labelled good or bad. Its features are its own statistics and those of the lines before and after it;
a transition matrix links neighbouring labels. The model is fitted by gradient ascent on the likelihood of a bounded sample of
labelled documents (``bound`` of either label), whose lines carry the label of their document.

Forward-backward marginals of a line being good, weighted by the words of the line, are averaged to the share of good text. The
score is that share raised to a power fitted on the same sample, so that the best cut between the labels lies at ``CUT``.

Only the text enters a score. Null text counts as empty; a text without words is scored as one line without any feature. Rows are scored one by one,
so ties, repeated rows and null ids change nothing. Without labelled rows of both kinds every score is 0.5. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.labels import labelled_sample
from zonecast.llm.quality_rules import _IS_LETTER, _IS_MARK, _IS_SYMBOL, _IS_UPPER, in_repeated_window
from zonecast.llm.tables import kind
from zonecast.llm.text import U, mix, slices, word_hashes, words

CUT = 0.3
FOLDS = 5
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[48:58] = True


@dataclass
class Lines:
    """Features of all lines with a word, in order; ``first[d]`` is the first line of text ``d``."""

    features: np.ndarray
    weight: np.ndarray
    first: np.ndarray


def lines(texts: list[bytes]) -> Lines:
    w = words(texts)
    feeds = np.flatnonzero(w.data[:-8] == 10)
    begin, end = feeds[:-1] + 1, feeds[1:]
    bounds = np.searchsorted(w.start, np.concatenate([begin, [len(w.data)]]))
    full = np.flatnonzero(np.diff(bounds) > 0)
    n_docs = len(texts)
    if not len(full):
        return Lines(np.zeros((n_docs, WIDTH)), np.ones(n_docs), np.arange(n_docs + 1))
    heads, n = bounds[:-1][full], np.diff(bounds)[full].astype(float)
    owner_of_word = w.owner()
    owner = owner_of_word[heads]

    def bytes_of(table: np.ndarray) -> np.ndarray:
        return np.add.reduceat(table[w.data[:-8]], begin, dtype=np.int64)[full].astype(float)

    def words_of(mask: np.ndarray) -> np.ndarray:
        # Words between two full lines belong to the former; there are none.
        return np.add.reduceat(mask, heads, dtype=np.int64).astype(float)

    h = word_hashes(w)
    again = np.concatenate([[False], (h[1:] == h[:-1]) & (owner_of_word[1:] == owner_of_word[:-1])])
    inside = np.arange(len(h)) - np.repeat(heads, n.astype(int))
    whole = mix(np.add.reduceat(mix(h * U(3) + inside.astype(U)), heads) + owner.astype(U))
    _, which, seen = np.unique(whole, return_inverse=True, return_counts=True)
    letters = np.maximum(bytes_of(_IS_LETTER), 1)
    size = (end - begin)[full].astype(float)
    telling = np.stack(
        [
            np.minimum(bytes_of(_IS_SYMBOL) / n, 1.0),
            np.minimum(bytes_of(_IS_MARK) / n, 1.0),
            bytes_of(_IS_UPPER) / letters,
            words_of(in_repeated_window(w, h)) / n,
            words_of(again) / n,
            (seen[which] > 1).astype(float),
        ],
        axis=1,
    )
    before, after = np.zeros_like(telling), np.zeros_like(telling)
    linked = owner[1:] == owner[:-1]
    before[1:][linked] = telling[:-1][linked]
    after[:-1][linked] = telling[1:][linked]
    ends = np.stack([np.concatenate([[True], ~linked]), np.concatenate([~linked, [True]])], axis=1).astype(float)
    plain = np.stack([np.ones(len(n)), np.log1p(n) / 6, np.minimum(size / n / 20, 1.0), np.minimum(bytes_of(_IS_DIGIT) / size, 1.0)], axis=1)
    made = np.concatenate([plain, telling, before, after, ends], axis=1)
    # A text without words is one line of features zero.
    first = np.searchsorted(owner, np.arange(n_docs + 1))
    empty = np.flatnonzero(np.diff(first) == 0)
    made = np.insert(made, first[empty], 0.0, axis=0)
    weight = np.insert(n, first[empty], 1.0)
    return Lines(made, weight, first + np.searchsorted(empty, np.arange(n_docs + 1)))


WIDTH = 4 + 3 * 6 + 2


@dataclass
class Crf:
    """``weights`` score the label good of a line; ``links[a, b]`` scores label ``b`` after ``a``."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH))
    links: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    power: float = 1.0

    def marginals(self, x: Lines) -> tuple[np.ndarray, np.ndarray]:
        """Per line the probabilities of bad and good; summed over all pairs of neighbours those of their labels.

        Texts are walked side by side, the longest first, so that one step of the recursion covers a line of each.
        """
        length = np.diff(x.first)
        order = np.argsort(-length, kind="stable")
        start, length = x.first[:-1][order], length[order]
        score = np.clip(x.features @ self.weights, -30, 30)
        here = np.stack([1 / (1 + np.exp(score)), 1 / (1 + np.exp(-score))], axis=1)
        step = np.exp(self.links - self.links.max())
        ahead, back = np.empty_like(here), np.empty_like(here)
        live = [int(np.searchsorted(-length, -t, "left")) for t in range(int(length[0]) if len(length) else 0)]
        now = None
        for t, k in enumerate(live):
            at = start[:k] + t
            now = here[at] if t == 0 else (now[:k] @ step) * here[at]
            now = now / now.sum(axis=1, keepdims=True)
            ahead[at] = now
        pairs = np.zeros((2, 2))
        for t in reversed(range(len(live))):
            k = live[t]
            more = live[t + 1] if t + 1 < len(live) else 0
            at = start[:k] + t
            back[at[more:]] = 0.5
            if more:
                nxt = at[:more] + 1
                coming = back[nxt] * here[nxt]
                b = coming @ step.T
                back[at[:more]] = b / b.sum(axis=1, keepdims=True)
                joint = ahead[at[:more]][:, :, None] * step * coming[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        both = ahead * back
        return both / both.sum(axis=1, keepdims=True), pairs

    def shares(self, x: Lines) -> np.ndarray:
        """Per text the share of good words."""
        good = self.marginals(x)[0][:, 1] * x.weight
        return np.add.reduceat(good, x.first[:-1]) / np.add.reduceat(x.weight, x.first[:-1]) if len(x.first) > 1 else np.zeros(0)

    def scores(self, x: Lines) -> np.ndarray:
        return np.clip(self.shares(x), 0.0, 1.0) ** self.power


def fit(x: Lines, labels: np.ndarray, steps: int = 300, rate: float = 0.1, ridge: float = 1e-3) -> Crf:
    """Maximum likelihood with the labels of documents as the labels of their lines, by Adam."""
    crf = Crf()
    y = np.repeat(labels, np.diff(x.first)).astype(float)
    linked = np.ones(len(y), bool)
    linked[x.first[:-1]] = False
    at = np.flatnonzero(linked)
    told = np.zeros((2, 2))
    np.add.at(told, (y[at - 1].astype(int), y[at].astype(int)), 1)
    total = max(len(y), 1)
    flat = np.zeros(WIDTH + 4)
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    for i in range(1, steps + 1):
        crf.weights, crf.links = flat[:WIDTH], flat[WIDTH:].reshape(2, 2)
        p, pairs = crf.marginals(x)
        slope = np.concatenate([x.features.T @ (y - p[:, 1]), (told - pairs).ravel()]) / total - ridge * flat
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        flat = flat + rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    crf.weights, crf.links = flat[:WIDTH].copy(), flat[WIDTH:].reshape(2, 2).copy()
    share = crf.shares(x)
    cuts = np.unique(np.quantile(share, np.linspace(0, 1, 401)))
    cuts = (cuts[1:] + cuts[:-1]) / 2
    right = [(share[labels == 1] >= c).mean() + (share[labels == 0] < c).mean() for c in cuts]
    if len(cuts):
        best = np.flatnonzero(np.array(right) >= max(right) - 1e-9)
        middle = float(np.clip(cuts[best[len(best) // 2]], 1e-3, 1 - 1e-3))
        crf.power = float(np.log(CUT) / np.log(middle))
    return crf


def fit_quality(docs: DataFrame, labels: DataFrame, bound: int = 3000) -> Crf | None:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    rows = labelled_sample(docs, labels, "quality", bound, fold != 0).select("text", "label").orderBy("label", F.xxhash64("text")).toPandas()
    if rows["label"].nunique() < 2:
        return None
    return fit(lines([(t or "").encode() for t in rows["text"]]), rows["label"].to_numpy())


def _scored(crf: Crf | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            scores = crf.scores(lines(texts)) if crf else np.full(len(texts), 0.5)
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays([ids, pa.array(scores), pa.array((scores >= CUT).astype(np.int32))], ["doc_id", "score", "predicted"])

    return run


def score(docs: DataFrame, crf: Crf | None) -> DataFrame:
    """doc_id, score and predicted label of each document."""
    return docs.select("doc_id", "text").mapInArrow(_scored(crf), f"doc_id {kind(docs, 'doc_id')}, score double, predicted int")


def _labelled(crf: Crf):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            x = lines(texts)
            good = crf.marginals(x)[0][:, 1]
            ids = batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(np.repeat(np.arange(len(texts)), np.diff(x.first))))
            place = np.arange(len(good)) - np.repeat(x.first[:-1], np.diff(x.first))
            yield pa.RecordBatch.from_arrays([ids, pa.array(place), pa.array(x.weight.astype(np.int64)), pa.array(good)], ["doc_id", "line", "n_words", "good"])

    return run


def line_labels(docs: DataFrame, crf: Crf) -> DataFrame:
    """The probability of being good for each line with a word (numbered from 0) of each document."""
    return docs.select("doc_id", "text").mapInArrow(_labelled(crf), f"doc_id {kind(docs, 'doc_id')}, line long, n_words long, good double")
