"""Quality rules: an isolation forest on rule statistics.

1. One pass counts the rule statistics of each whole text.
2. Each statistic gets an allowance, calibrated on all labelled rows like the threshold below; what counts is the excess over it, so
   that the usual variety of good text isolates nobody. A statistic that no bad row exceeds is not looked at.
3. A forest of random trees: each splits ``subsample`` rows, drawn by their place in the order of all labelled rows, at random values of
   random statistics until its points stand alone. Then all labelled rows run down the trees, and a leaf adds the path that the rows in it
   would still take. An unusual document stands alone after few splits; the mean path length gives its anomaly score.
4. The threshold is calibrated on all labelled rows: the score that best separates the labels (sensitivity
   plus specificity), among those that reject at most ``spoiled`` of the rows labelled good (or two of them).

Calibration counts every distinct value: a histogram and its running totals, spread over tasks by value. The driver sees the cuts,
the drawn rows (``trees`` times ``subsample``) and the rows a leaf.

A document is kept if it passes the base rules (50 words or more, at most half of its words in repeated
three-word windows) and its score does not pass the threshold.

Null text counts as empty: no words, so the base rule rejects it. Rows are judged one by one, so repeated
rows and null ids change nothing. Without labelled rows of both kinds only the base rules decide. Windows
are compared by 64-bit hashes within a text; lines are compared exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.stats import running_totals, value_histogram
from zonecast.llm.labels import labelled
from zonecast.llm.order import placed
from zonecast.llm.tables import kind
from zonecast.llm.text import U, Words, mix, slices, word_hashes, words
from zonecast.session import materialize

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
FEWEST_WORDS = 50
REPEATED_PERCENT = 50
#: Text measured at once.
MEASURED_BYTES = 2 << 20

#: Trees of the forest, rows that each of them splits, and the seed of both.
TREES, SUBSAMPLE, SEED = 64, 256, 11

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What ``rule_values`` gives.
VALUES = ["symbols", "dup_lines", "repeats", "upper", "marks"]
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[65:91] = _IS_LETTER[97:123] = True
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(b"!?;:=\"'()[]{}+@~^\\/_")] = True
_IN_WORD = np.ones(256, bool)
_IN_WORD[list(b" \t\n\x0b\x0c\r")] = False
_IN_WORD[0x80:0xC0] = False  # later bytes of a code point


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier one."""
    full = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(full), len(full) - len(set(full))


def in_repeated_window(w: Words, h: np.ndarray) -> np.ndarray:
    """Per word, whether it lies in a three-word window that its text has twice or more."""
    n = len(h)
    covered = np.zeros(n + 2, bool)
    if n > 2:
        owner = w.owner()
        at = np.flatnonzero(owner[:-2] == owner[2:])
        if len(at):
            key = mix(mix(mix(h[at] + owner[at].astype(U)) + h[at + 1]) + h[at + 2])
            order = np.argsort(key)
            same = key[order][1:] == key[order][:-1]
            twice = at[order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]]
            for k in range(3):
                covered[twice + k] = True
    return covered[:n]


def repeated_words(w: Words) -> np.ndarray:
    """Per text, the words inside three-word windows that the text has twice or more."""
    total = np.concatenate([[0], np.cumsum(in_repeated_window(w, word_hashes(w)))])
    return total[w.first[1:]] - total[w.first[:-1]]


def statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Rule statistics of each text, as integers."""
    w = words(texts)
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    begins = 1 + np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)

    def count(table: np.ndarray) -> np.ndarray:
        # The line feed that ends each text belongs to none of the tables.
        return np.add.reduceat(table[w.data[:-8]], begins, dtype=np.int64) if len(begins) else np.zeros(0, np.int64)

    lines = np.array([_lines(t) for t in texts], np.int64).reshape(-1, 2)
    return {
        "n_words": np.diff(w.first),
        "word_chars": count(_IN_WORD),
        "n_symbols": count(_IS_SYMBOL),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": repeated_words(w),
        "n_lines": lines[:, 0],
        "n_upper": count(_IS_UPPER),
        "n_letters": count(_IS_LETTER),
        "n_marks": count(_IS_MARK),
    }


def rule_values(s: dict[str, np.ndarray]) -> np.ndarray:
    """What the forest splits on: shares, free of the text's length."""
    n = np.maximum(s["n_words"], 1)
    return np.stack(
        [
            np.log1p(s["n_symbols"] / n * 20),
            s["n_dup_lines"] / np.maximum(s["n_lines"], 1),
            s["n_repeat_words"] / n,
            s["n_upper"] / np.maximum(s["n_letters"], 1),
            np.log1p(s["n_marks"] / n * 20),
        ],
        axis=1,
    )


@dataclass
class Forest:
    """Trees in arrays: ``feature`` -1 marks a leaf, whose ``value`` is its whole path length."""

    feature: np.ndarray
    value: np.ndarray
    child: np.ndarray
    usual: float
    allowance: np.ndarray
    threshold: float = np.inf

    def leaves(self, points: np.ndarray) -> Iterator[np.ndarray]:
        """Of each tree the leaf of every point."""
        points = np.maximum(points - self.allowance, 0)
        for feature, value, child in zip(self.feature, self.value, self.child):
            node = np.zeros(len(points), np.int64)
            while True:
                inner = np.flatnonzero(feature[node] >= 0)
                if not len(inner):
                    break
                now = node[inner]
                node[inner] = child[now] + (points[inner, feature[now]] >= value[now])
            yield node

    def scores(self, points: np.ndarray) -> np.ndarray:
        """Near 1: isolated after few splits."""
        total = np.zeros(len(points))
        for value, node in zip(self.value, self.leaves(points)):
            total += value[node]
        return 2.0 ** (-total / len(self.feature) / self.usual)

    def weighed(self, rows: list[np.ndarray], n: int) -> Forest:
        """The same splits, with path lengths for ``n`` points of which ``rows`` fall into each leaf of each tree."""
        values = []
        for feature, value, child, held in zip(self.feature, self.value, self.child, rows):
            value, level = value.copy(), np.zeros(len(value))
            for node in range(len(value)):  # children come after their parent
                if feature[node] < 0:
                    value[node] = level[node] + expected_path(int(held[node]))
                else:
                    level[child[node] : child[node] + 2] = level[node] + 1
            values.append(value)
        return replace(self, value=values, usual=max(expected_path(n), 1e-9))


def expected_path(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` points."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def fit_forest(points: np.ndarray, allowance: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> Forest:
    size = min(subsample, len(points))
    return grown(lambda rng, tree: points[rng.choice(len(points), size, replace=False)], size, allowance, trees, seed)


def grown(drawn: Callable[[np.random.Generator, int], np.ndarray], size: int, allowance: np.ndarray, trees: int = TREES, seed: int = SEED) -> Forest:
    """A forest whose trees split the points that ``drawn`` gives for each, ``size`` of them."""
    rng = np.random.default_rng(seed)
    depth = int(np.ceil(np.log2(max(size, 2))))
    features, values, children = [], [], []
    for tree in range(trees):
        feature, value, child = [0], [0.0], [0]
        stack = [(0, np.maximum(drawn(rng, tree) - allowance, 0), 0)]
        while stack:
            node, held, level = stack.pop()
            low, high = held.min(axis=0), held.max(axis=0)
            open_ = np.flatnonzero(high > low)
            if level >= depth or not len(open_):
                feature[node], value[node] = -1, level + expected_path(len(held))
                continue
            f = rng.choice(open_)
            v = rng.uniform(low[f], high[f])
            right = held[:, f] >= v
            feature[node], value[node], child[node] = int(f), v, len(feature)
            for part in (held[~right], held[right]):
                stack.append((len(feature), part, level + 1)) if len(part) else None
                feature.append(-1), value.append(float(level + 1)), child.append(0)
        features.append(np.array(feature)), values.append(np.array(value)), children.append(np.array(child))
    return Forest(features, values, children, max(expected_path(size), 1e-9), allowance)


def calibrate(scores: np.ndarray, labels: np.ndarray, spoiled: float) -> float:
    """The threshold with the best sensitivity plus specificity that rejects at most ``spoiled`` of the good rows, or two of them."""
    good = np.sort(scores[labels == 1])
    bad = np.sort(scores[labels == 0])
    cuts = np.unique(scores)
    lost = 1 - np.searchsorted(good, cuts, "right") / len(good)
    caught = 1 - np.searchsorted(bad, cuts, "right") / len(bad)
    allowed = lost * len(good) <= max(spoiled * len(good), 2) + 1e-9
    best = np.argmax(np.where(allowed, caught - lost, -np.inf))
    following = cuts[min(best + 1, len(cuts) - 1)]
    return float((cuts[best] + following) / 2)


def calibrated(rows: DataFrame, spoiled: float) -> dict[int, tuple[float, bool]]:
    """By ``stat`` what ``calibrate`` gives for all its rows (stat, value, label), and whether a bad row lies above; no row is left out."""
    good, bad = F.sum(F.col("label").cast("long")), F.sum(1 - F.col("label").cast("long"))
    hist = value_histogram(rows, ["stat"], "value", {"good": good, "bad": bad})
    cuts = running_totals(hist, ["stat"], ["good", "bad"])
    cuts = materialize(cuts.select("stat", "value", "bad", (F.col("good_before") + F.col("good")).alias("kept"), (F.col("bad_before") + F.col("bad")).alias("missed")), "cuts")
    totals = cuts.groupBy("stat").agg(F.max("kept").alias("g"), F.max("missed").alias("b"))
    lost, whole = F.col("g") - F.col("kept"), lambda c: c.cast("decimal(19,0)")
    gain = whole(F.col("b") - F.col("missed")) * whole(F.col("g")) - whole(lost) * whole(F.col("b"))
    allowed = lost <= F.greatest(F.col("g") * F.lit(spoiled), F.lit(2.0)) + F.lit(1e-9)
    best = cuts.join(F.broadcast(totals), "stat").where(allowed).groupBy("stat").agg(F.max(F.struct(gain.alias("gain"), (-F.col("value")).alias("v"))).alias("best"))
    at = {r["stat"]: -r["v"] for r in best.select("stat", "best.v").collect()}
    if not at:
        return {}
    chosen = F.element_at(F.create_map(*[F.lit(x) for pair in at.items() for x in pair]), F.col("stat"))
    above = F.col("value") > chosen
    near = cuts.groupBy("stat").agg(F.min(F.when(above, F.col("value"))).alias("next"), F.max(F.when(F.col("bad") > 0, F.col("value"))).alias("worst")).collect()
    out = {}
    for r in near:
        cut = float((at[r["stat"]] + (at[r["stat"]] if r["next"] is None else r["next"])) / 2)
        out[r["stat"]] = cut, r["worst"] is not None and r["worst"] > cut
    return out


def _points(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(VALUES))], axis=1)


def _leaf_rows(forest: Forest):
    sizes = [len(f) for f in forest.feature]
    first = np.cumsum([0, *sizes])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(first[-1], np.int64)
        for batch in batches:
            for tree, node in enumerate(forest.leaves(_points(batch))):
                total[first[tree] : first[tree + 1]] += np.bincount(node, minlength=sizes[tree])
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["leaf", "n"])

    return run


def _scores(forest: Forest):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(batch.schema.get_field_index("label"))
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(label), np.int32)), pa.array(forest.scores(_points(batch))), label], ["stat", "value", "label"])

    return run


def fit_rules(docs: DataFrame, labels: DataFrame, spoiled: float = 0.002, trees: int = TREES, subsample: int = SUBSAMPLE) -> Forest | None:
    """The forest and its threshold, from all labelled rows of ``docs`` that pass the base rules; None without rows of both labels."""
    ids = f"doc_id {kind(docs, 'doc_id')}"
    measured = docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(_measured(None, ["doc_id"], values=True), _schema(ids, True))
    # The base rules decide first; the forest is calibrated on what they leave.
    left = labelled(measured.where("NOT base_failed"), labels, "quality")
    rows = materialize(left.select(*[F.col("values")[i].alias(v) for i, v in enumerate(VALUES)], "label"), "measured")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    n = sum(counts.values())
    single = rows.select(F.posexplode(F.array(*VALUES)).alias("stat", "value"), "label")
    cuts = calibrated(single, spoiled)
    allowance = np.array([cuts[i][0] if cuts[i][1] else np.inf for i in range(len(VALUES))])

    size, rng = min(subsample, n), np.random.default_rng(SEED)
    places = np.stack([rng.choice(n, size, replace=False) for _ in range(trees)])
    order = [*VALUES, "label"]
    wanted = docs.sparkSession.createDataFrame([(int(x),) for x in np.unique(places)], "place long")
    ordered = placed(rows.select(F.lit(0).alias("all"), *order), ["all"], order, "place")
    picked = ordered.join(F.broadcast(wanted), "place").select("place", *VALUES).orderBy("place").toPandas()  # trees * subsample rows at most
    points, at = picked[VALUES].to_numpy(), np.searchsorted(picked["place"].to_numpy(), places)
    forest = grown(lambda _, tree: points[at[tree]], size, allowance, trees)

    total = np.zeros(sum(len(f) for f in forest.feature), np.int64)
    for r in rows.select(*VALUES).mapInArrow(_leaf_rows(forest), "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).collect():
        total[r["leaf"]] = r["n"]
    forest = forest.weighed(np.split(total, np.cumsum([len(f) for f in forest.feature])[:-1]), n)
    forest.threshold = calibrated(rows.mapInArrow(_scores(forest), "stat int, value double, label int"), spoiled)[0][0]
    return forest


def _schema(ids: str, values: bool = False) -> str:
    return f"{ids}, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, kept boolean, anomaly double" + ", values array<double>" * values


def _measured(forest: Forest | None, carried: list[str], rows_only: bool = False, values: bool = False):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, limit=MEASURED_BYTES):
            s = statistics(texts)
            failed = (s["n_words"] < FEWEST_WORDS) | (100 * s["n_repeat_words"] > REPEATED_PERCENT * s["n_words"])
            points = rule_values(s)
            anomaly = forest.scores(points) if forest else np.zeros(len(texts))
            kept = ~failed & (anomaly <= (forest.threshold if forest else np.inf))
            if rows_only:
                yield batch.filter(pa.array(kept))
                continue
            out = {c: batch.column(batch.schema.get_field_index(c)) for c in carried}
            out |= {c: pa.array(s[c].astype(np.int64)) for c in COUNTS}
            out |= {"base_failed": pa.array(failed), "kept": pa.array(kept), "anomaly": pa.array(anomaly)}
            if values:
                out["values"] = pa.array(list(points), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return run


def judge(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the anomaly score of each document."""
    return docs.select("doc_id", "text").mapInArrow(_measured(forest, ["doc_id"]), _schema(f"doc_id {kind(docs, 'doc_id')}"))


def passing(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns unchanged."""
    return docs.mapInArrow(_measured(forest, [], rows_only=True), docs.schema)
