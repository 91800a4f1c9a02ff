import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from zonecast.llm import catalog, quality_crf, quality_rules

from .conftest import ODD_ROWS, WORD


def plain_counts(text):
    w = WORD.findall(text)
    c = Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i in range(len(w) - 2):
        if c[tuple(w[i : i + 3])] > 1:
            covered.update((i, i + 1, i + 2))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_of_documents(spark, sf_dir, texts):
    rows = catalog.op9_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, *_, repeated = expected = plain_counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in quality_rules.COUNTS) == expected
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
        assert not (r["base_failed"] and r["kept"])


def test_verdicts_follow_the_labels(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{big}/labels.parquet").collect()}
    rows = [r for r in catalog.op9_quality_rules(spark, big).collect() if r["doc_id"] in labels and not r["base_failed"]]
    good = [r["kept"] for r in rows if labels[r["doc_id"]] == 1]
    bad = [r["kept"] for r in rows if labels[r["doc_id"]] == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.1


def test_odd_rows_rules(odd, none, no_labels):
    assert quality_rules.fit_rules(odd, no_labels) is None
    rows = quality_rules.judge(odd, None).collect()
    assert len(rows) == len(ODD_ROWS)
    assert sorted(tuple(r[c] for c in quality_rules.COUNTS) for r in rows) == sorted(plain_counts(t or "") for _, t, *_ in ODD_ROWS)
    assert quality_rules.judge(none, None).count() == 0
    assert quality_rules.passing(odd, None).columns == odd.columns and quality_rules.passing(odd, None).count() == 0


def test_paths_of_a_forest_by_walking():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(0, 1, (300, 3)), [[9.0, 9, 9]]])
    forest = quality_rules.fit_forest(points, np.full(3, -10.0), trees=16, subsample=64)

    def length(tree, p):
        node = 0
        while forest.feature[tree][node] >= 0:
            node = forest.child[tree][node] + int(p[forest.feature[tree][node]] >= forest.value[tree][node])
        return forest.value[tree][node]

    shifted = points + 10
    for i in (0, 7, 300):
        mean = np.mean([length(t, shifted[i]) for t in range(16)])
        assert math.isclose(forest.scores(points)[i], 2 ** (-mean / forest.usual))
    assert forest.scores(points).argmax() == 300


def test_threshold_keeps_nearly_all_good_rows():
    scores = np.concatenate([np.linspace(0.1, 0.4, 1000), np.linspace(0.39, 0.9, 100)])
    labels = np.array([1] * 1000 + [0] * 100)
    cut = quality_rules.calibrate(scores, labels, 0.002)
    assert (scores[labels == 1] > cut).mean() <= 0.002 and (scores[labels == 0] > cut).mean() > 0.9


def test_cuts_over_all_rows_against_an_array(spark):
    """Ties, a constant, one distinct value a row, and a statistic without a bad row above its cut."""
    rng = np.random.default_rng(5)
    n = 6000
    label = (rng.random(n) < 0.8).astype(int)
    columns = [rng.normal(label, 1.0), rng.integers(0, 9, n) / 8 - label / 8, np.full(n, 0.5), np.where(label == 1, 1.0, 0.0)]
    rows = [(i, float(v), int(b)) for i, c in enumerate(columns) for v, b in zip(c, label)]
    got = quality_rules.calibrated(spark.createDataFrame(rows, "stat int, value double, label int").repartition(7), 0.01)
    for i, c in enumerate(columns):
        cut = quality_rules.calibrate(c, label, 0.01)
        assert got[i] == (cut, bool((c[label == 0] > cut).any()))


def test_every_labelled_row_counts(spark, no_labels):
    """More rows of a label than any sample took: the last ones move the threshold, and all rows weigh the leaves."""
    words_ = " ".join(f"w{i}" for i in range(60))
    def text(i, signs):
        return f"{words_} n{i} " + "# " * signs
    rows = [(i, text(i, i % 7), 1) for i in range(4500)] + [(10000 + i, text(i, 12 + i % 20), 0) for i in range(4500)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(d, q, 0) for d, _, q in rows], no_labels.schema)
    forest = quality_rules.fit_rules(docs, labels)
    assert math.isclose(forest.usual, quality_rules.expected_path(9000))
    points = quality_rules.rule_values(quality_rules.statistics([t.encode() for _, t, _ in rows]))
    truth = np.array([q for *_, q in rows])
    assert forest.threshold == quality_rules.calibrate(forest.scores(points), truth, 0.002)
    assert forest.allowance[0] == quality_rules.calibrate(points[:, 0], truth, 0.002)
    for feature, value, node in zip(forest.feature, forest.value, forest.leaves(points)):
        n = np.bincount(node, minlength=len(feature))
        level = value - [quality_rules.expected_path(int(x)) for x in n]
        leaf = (feature < 0) & (n > 0)
        assert np.allclose(level[leaf], np.rint(level[leaf])) and (level[leaf] >= 0).all() and math.isclose((2.0 ** -level[leaf]).sum(), 1)
    again = quality_rules.fit_rules(docs.repartition(3).unionByName(docs.limit(0)), labels)
    assert again.threshold == forest.threshold and all((a == b).all() for a, b in zip(again.value, forest.value))


@pytest.fixture(scope="module")
def crf():
    rng = np.random.default_rng(2)
    texts, labels = [], []
    for i in range(80):
        bad = i % 2
        word = (lambda: "x#$%") if bad else (lambda: "".join(rng.choice(list("abcde"), 5)))
        texts.append("\n".join(" ".join(word() for _ in range(rng.integers(1, 9))) for _ in range(rng.integers(1, 7))).encode())
        labels.append(1 - bad)
    return quality_crf.fit(quality_crf.lines(texts), np.array(labels), steps=60)


def test_marginals_by_enumeration(crf):
    texts = [b"a b c\nx#$% x#$%\nd e\nf g h i", b"one", b"", b"A\n\n b b b"]
    x = quality_crf.lines(texts)
    p, pairs = crf.marginals(x)
    expected_pairs = np.zeros((2, 2))
    for a, b in zip(x.first[:-1], x.first[1:]):
        score = np.clip(x.features[a:b] @ crf.weights, -30, 30)
        weights = {}
        for code in range(2 ** (b - a)):
            y = [(code >> i) & 1 for i in range(b - a)]
            weights[tuple(y)] = math.exp(sum(s for s, v in zip(score, y) if v) + sum(crf.links[u, v] for u, v in zip(y, y[1:])))
        z = sum(weights.values())
        for i in range(b - a):
            assert math.isclose(p[a + i, 1], sum(w for y, w in weights.items() if y[i]) / z, rel_tol=1e-6)
        for y, w in weights.items():
            for u, v in zip(y, y[1:]):
                expected_pairs[u, v] += w / z
    assert np.allclose(pairs, expected_pairs)
    good = p[:, 1]
    assert math.isclose(crf.shares(x)[3], (good[-2] * 1 + good[-1] * 3) / 4)


def test_neighbours_enter_the_features():
    x = quality_crf.lines([b"a b\nx#$%", b"c d"])
    alone = quality_crf.lines([b"a b", b"c d"])
    assert not np.allclose(x.features[0], alone.features[0]) and np.allclose(x.features[2], alone.features[1])
    assert quality_crf.lines([b"", b"a\n\nb", b" ", b"c"]).first.tolist() == [0, 1, 3, 4, 5]


def test_held_out_accuracy(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{big}/labels.parquet").collect()}
    rows = catalog.op2_quality_crf(spark, big).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in held]) >= 0.93 and len(held) > 50


def test_odd_rows_crf(odd, none, no_labels, crf):
    assert quality_crf.fit_quality(odd, no_labels) is None
    assert {r["score"] for r in quality_crf.score(odd, None).collect()} == {0.5}
    rows = quality_crf.score(odd, crf).collect()
    assert len(rows) == len(ODD_ROWS) and len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert quality_crf.score(none, crf).count() == 0
    assert quality_crf.line_labels(odd, crf).where("doc_id = 7").count() == 2
