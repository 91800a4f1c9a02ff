import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.llm import catalog, context_mixing as cm
from zonecast.llm.text import word_hashes, words

from .conftest import ODD_ROWS, WORD


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def by_id():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def plain_base(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) of each row."""
    counts = Counter()
    for d, t in rows:
        if not held(d):
            counts.update(["w" + x for x in tokens(t)] + ["end"])
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        mine = ["w" + x for x in tokens(t)] + ["end"]
        base = math.fsum(math.log10((counts[x] + 1) / (n + v + 1)) for x in mine)
        out.append((d, held(d), len(mine), sum(counts[x] > 0 for x in mine), n, base))
    return out


def plain_score(text, counts, m):
    """Bit by bit, token by token, without any array; ``counts`` of the words."""
    found = tokens(text)
    w = words([x.encode() for x in found])
    hashes = [int(x) for x in word_hashes(w)] + [int(cm.END)]
    total = 0.0
    for i, h in enumerate(hashes):
        if i % cm.SEGMENT == 0:
            weights = [[np.float32(cm.START_WEIGHT)] * cm.PREDICTORS for _ in range(cm.BITS)]
        one = np.array([hashes[i - 2] if i > 1 else 0, hashes[i - 1] if i else 0, h], np.uint64)
        ctx = cm.contexts(one, np.array([0, 0, i]))[:, 0]
        c = h >> (64 - cm.BITS)
        for j in range(cm.BITS):
            bit = c >> (cm.BITS - 1 - j) & 1
            x = [np.float32(m.odds[k][(int(ctx[k]) + int(cm.NODE[c, j])) % (1 << m.bits)]) / cm.SCALE for k in range(cm.PREDICTORS)]
            dot = max(-cm.MOST, min(cm.MOST, sum(a * b for a, b in zip(weights[j], x))))
            p = 1 / (1 + math.exp(-dot))
            total += math.log10(p if bit else 1 - p)
            for k in range(cm.PREDICTORS):
                weights[j][k] += np.float32((bit - p) * cm.RATE) * x[k]
        n = counts[found[i]] if i < len(found) else m.ends
        total += math.log10(n + 1) - m.weight[c]
    return total


def compare(spark, rows, df):
    got = sorted(map(tuple, cm.score(df, by_id()).collect()), key=str)
    want = sorted(plain_base(rows), key=str)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (str(r[:5]), r[5])), sorted(want, key=lambda r: (str(r[:5]), r[5]))):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9)
        assert g[6] < 0 and math.isfinite(g[6])
    return got


def test_base_against_plain(spark, sf_dir, texts):
    rows = list(texts.items())
    got = {r["doc_id"]: r for r in catalog.queries()["op13_context_mixing"](spark, sf_dir).collect()}
    for d, h, n, known, total, base in plain_base(rows):
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (h, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)


def test_odd_rows(spark, odd, none, monkeypatch):
    compare(spark, [r[:2] for r in ODD_ROWS], odd)
    monkeypatch.setattr(cm, "FREQUENT", 2)  # nearly all words go back to their chunks
    compare(spark, [r[:2] for r in ODD_ROWS], odd)
    assert cm.score(none, by_id()).count() == 0


def test_nothing_to_learn_from(spark):
    rows = [(i, f"text {i}") for i in range(200) if held(i)]
    compare(spark, rows, spark.createDataFrame(rows, "doc_id long, text string"))


def model(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    work = cm.chunks(docs, F.lit(False))
    return cm.learn(work, cm.word_counts(work))


def chunk_of(texts):
    return cm.Chunk.of([" ".join(tokens(t)).encode() for t in texts], np.zeros(len(texts), bool))


def scores(texts, counts, m):
    chunk = chunk_of(texts)
    h1, _, which, _ = chunk.distinct()
    known = {}
    for word, h in zip([x for t in texts for x in tokens(t)], which):
        known[h] = counts[word]
    return cm.scored(chunk, np.array([known[i] for i in range(len(h1))], np.int64), which, m)["score"]


def test_scores_against_plain(spark, texts):
    learned = list(texts.values())[:60]
    m = model(spark, learned)
    counts = Counter(x for t in learned for x in tokens(t))
    some = [t for t in texts.values() if len(t) < 3000][:12] + ["", "One", "é 東京 " * 500]
    assert scores(some, counts, m) == pytest.approx([plain_score(t, counts, m) for t in some], rel=1e-4)


def test_probabilities_of_all_next_tokens_sum_to_one(spark, texts):
    """Any known word, the end, or an unknown word of any class may come next."""
    learned = list(texts.values())[:40]
    m = model(spark, learned)
    counts = Counter(x for t in learned for x in tokens(t))
    chunk = chunk_of(learned)
    h1, _, which, c = chunk.distinct()
    of = np.bincount(cm.classes(h1), weights=c + 1.0, minlength=1 << cm.BITS) + 1
    of[cm.classes(np.array([cm.END]))[0]] += m.ends + 1
    assert of == pytest.approx(10**m.weight) and sum(counts.values()) + m.ends == m.tokens and len(counts) + 1 == m.distinct
    ctx = cm.contexts(np.array([0, 5, 7], np.uint64), np.array([0, 0, 1]))[:, 0]
    total = 0.0
    for k in range(1 << cm.BITS):
        p = 1.0
        for j in range(cm.BITS):
            dot = sum(cm.START_WEIGHT * m.odds[i][(int(ctx[i]) + int(cm.NODE[k, j])) % (1 << m.bits)] / cm.SCALE for i in range(cm.PREDICTORS))
            q = 1 / (1 + math.exp(-dot))
            p *= q if cm.BIT[k, j] else 1 - q
        total += p
    assert total == pytest.approx(1)


def test_pieces_and_neighbours_do_not_change_scores(spark, texts, monkeypatch):
    m = model(spark, list(texts.values())[:60])
    some = list(texts.values())[:30] + ["x " * 5000, "ab cd ef " * 4000]
    whole = cm.class_scores(chunk_of(some), m)
    alone = np.concatenate([cm.class_scores(chunk_of([t]), m) for t in some])
    assert (whole == alone).all()
    plain = cm.pieces
    monkeypatch.setattr(cm, "pieces", lambda c, w=None, most=512: plain(c, w, most))
    assert (cm.class_scores(chunk_of(some), m) == whole).all()


def test_held_out_texts_are_scored_better_than_by_base(spark, sf_dir):
    rng = random.Random(3)
    known = ["".join(rng.choices("abcde", k=rng.randint(2, 6))) for _ in range(300)]
    nexts = {w: rng.choices(known, k=3) for w in known}

    def text():
        out = [rng.choice(known)]
        while len(out) < 200:
            out.append(rng.choice(nexts[out[-1]]))
        return " ".join(out)

    docs = spark.createDataFrame([(i, text()) for i in range(300)], "doc_id long, text string")
    got = [r for r in cm.score(docs, by_id()).collect() if r["held_out"]]
    assert len(got) > 20 and sum(r["score"] for r in got) > 0.7 * sum(r["base_score"] for r in got)


def test_words_of_several_chunks(spark, texts):
    rows = list(texts.items())[:80]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    small = {r["doc_id"]: r for r in cm.score(df, by_id(), chunk_bytes=2000).collect()}
    for d, h, n, known, total, base in plain_base(rows):
        r = small[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (h, n, known, total) and r["base_score"] == pytest.approx(base, rel=1e-9)
    for r in cm.score(df.coalesce(1), by_id()).collect():
        assert r["score"] == small[r["doc_id"]]["score"]


def exact_scores(rows):
    """Scores with counts of each context of its own, in plain dictionaries."""

    def steps(text):
        found = tokens(text)
        hashes = [int(x) for x in word_hashes(words([x.encode() for x in found]))] + [int(cm.END)]
        for i, h in enumerate(hashes):
            one, two = hashes[i - 1] if i else None, hashes[i - 2] if i > 1 else None
            c = h >> (64 - cm.BITS)
            yield i, "w" + found[i] if i < len(found) else "end", c, [(k, ctx, j, c >> (cm.BITS - j)) for j in range(cm.BITS) for k, ctx in enumerate((0, one, (one, two), two))]

    places, counts, sizes = {}, Counter(), Counter()
    for d, t in rows:
        for _, word, c, at in [] if held(d) else steps(t):
            sizes[c] += 1 + (word not in counts)
            counts[word] += 1
            for p in at:
                places.setdefault(p, [0, 0])[c >> (cm.BITS - 1 - p[2]) & 1] += 1
    out = {}
    for d, t in rows:
        total = 0.0
        for i, word, c, at in steps(t):
            if i % cm.SEGMENT == 0:
                weights = [[cm.START_WEIGHT] * cm.PREDICTORS for _ in range(cm.BITS)]
            for j in range(cm.BITS):
                bit = c >> (cm.BITS - 1 - j) & 1
                x = [int(cm.log_odds(*map(np.float64, places.get(p, (0, 0))))) / cm.SCALE for p in at[j * cm.PREDICTORS : (j + 1) * cm.PREDICTORS]]
                p = 1 / (1 + math.exp(-max(-cm.MOST, min(cm.MOST, sum(a * b for a, b in zip(weights[j], x))))))
                total += math.log10(p if bit else 1 - p)
                weights[j] = [w + (bit - p) * cm.RATE * y for w, y in zip(weights[j], x)]
            total += math.log10((counts[word] + 1) / (sizes[c] + 1))
        out[d] = total
    return out


def test_contexts_of_a_corpus_beyond_the_slots_have_exact_counts(spark, texts, monkeypatch):
    monkeypatch.setattr(cm, "SLOT_BITS", (12, 12))
    monkeypatch.setattr(cm, "PART_TOKENS", 12000)
    rows = [(d, t) for d, t in texts.items() if t is None or len(t) < 20000][:90] + [(-1, None), (-2, ""), (-3, "One"), (-4, "é 東京 " * 500)]
    want = exact_scores(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in cm.score(df, by_id(), chunk_bytes=20000).collect()}
    assert len(got) == len(rows) and next(iter(got.values()))["train_tokens"] > cm.SLOT_TOKENS << 12
    assert {d: r["score"] for d, r in got.items()} == pytest.approx(want, rel=1e-4)
    for d, h, n, known, total, base in plain_base(rows):
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (h, n, known, total) and r["base_score"] == pytest.approx(base, rel=1e-9)
    for r in cm.score(df.coalesce(1), by_id()).collect():
        assert r["score"] == got[r["doc_id"]]["score"]


def test_texts_of_a_corpus_beyond_the_slots_are_not_exchanged(spark, texts, monkeypatch):
    monkeypatch.setattr(cm, "SLOT_BITS", (2, 2))
    df = spark.createDataFrame([(d, t) for d, t in texts.items() if t and len(t) < 2000][:20], "doc_id long, text string")
    plan = cm.score(df, by_id())._jdf.queryExecution().executedPlan().toString()
    held = [line for line in plan.splitlines() if "Scan parquet" in line and "ids" in line]
    assert len(held) == 1 and "Bucketed: true" in held[0]
    assert plan.count("Exchange hashpartitioning") == 2  # to the parts, and back to the chunks


def whole_scores(rows, bits):
    """Scores with codes that end where at most one learned word is left, and counts of each context of its own, in plain dictionaries."""

    def steps(text):
        found = tokens(text)
        hashes = [int(x) for x in word_hashes(words([x.encode() for x in found]))] + [int(cm.END)]
        for i, h in enumerate(hashes):
            one, two = hashes[i - 1] if i else None, hashes[i - 2] if i > 1 else None
            yield i, "w" + found[i] if i < len(found) else "end", h >> (64 - bits), (0, one, (one, two), two)

    places, counts, left = {}, Counter(), {}
    for d, t in rows:
        for _, word, c, ctx in [] if held(d) else steps(t):
            for j in range(bits + 1):
                n, v = left.get((j, c >> (bits - j)), (0, 0))
                left[j, c >> (bits - j)] = (n + 1, v + (word not in counts))
            counts[word] += 1
            for j in range(bits):
                for k, x in enumerate(ctx):
                    places.setdefault((k, x, j, c >> (bits - j)), [0, 0])[c >> (bits - 1 - j) & 1] += 1
    out = {}
    for d, t in rows:
        total = 0.0
        for i, word, c, ctx in steps(t):
            if i % cm.SEGMENT == 0:
                weights = [[cm.START_WEIGHT] * cm.PREDICTORS for _ in range(bits)]
            end = next((j for j in range(bits) if left.get((j, c >> (bits - j)), (0, 0))[1] < 2), bits)
            for j in range(end):
                bit = c >> (bits - 1 - j) & 1
                x = [int(cm.log_odds(*map(np.float64, places.get((k, y, j, c >> (bits - j)), (0, 0))))) / cm.SCALE for k, y in enumerate(ctx)]
                p = 1 / (1 + math.exp(-max(-cm.MOST, min(cm.MOST, sum(a * b for a, b in zip(weights[j], x))))))
                total += math.log10(p if bit else 1 - p)
                weights[j] = [w + (bit - p) * cm.RATE * y for w, y in zip(weights[j], x)]
            total += math.log10((counts[word] + 1) / (sum(left.get((end, c >> (bits - end)), (0, 0))) + 1))
        out[d] = total
    return out


@pytest.mark.parametrize("hot, bits", [(1 << 10, None), (3, None), (3, 12), (1, 18)])
def test_contexts_predict_whole_words(spark, texts, monkeypatch, hot, bits):
    monkeypatch.setattr(cm, "PART_TOKENS", 4000)
    monkeypatch.setattr(cm, "HOT", hot)
    if bits:  # several words have one code
        monkeypatch.setattr(cm, "code_bits", lambda tokens: bits)
    rows = [(d, t) for d, t in texts.items() if t is None or len(t) < 20000][:50] + [(-1, None), (-2, ""), (-3, "One"), (-4, "é 東京 " * 300), (-5, "One")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in cm.score(df, by_id(), chunk_bytes=20000, whole=True).collect()}
    tokens_ = next(iter(got.values()))["train_tokens"]
    assert {d: r["score"] for d, r in got.items()} == pytest.approx(whole_scores(rows, bits or cm.code_bits(tokens_)), rel=1e-4)
    for d, h, n, known, total, base in plain_base(rows):
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (h, n, known, total) and r["base_score"] == pytest.approx(base, rel=1e-9)
    if not bits:
        for r in cm.score(df.coalesce(1), by_id(), whole=True).collect():
            assert r["score"] == got[r["doc_id"]]["score"]


def test_whole_words_of_odd_rows(spark, odd, none):
    got = sorted(map(tuple, cm.score(odd, by_id(), whole=True).collect()), key=lambda r: (str(r[:5]), r[5]))
    want = sorted(plain_base([r[:2] for r in ODD_ROWS]), key=lambda r: (str(r[:5]), r[5]))
    assert [g[:5] for g in got] == [w[:5] for w in want] and [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)
    assert all(g[6] <= 0 and math.isfinite(g[6]) for g in got)
    assert cm.score(none, by_id(), whole=True).count() == 0
    rows = [(i, f"text {i}") for i in range(200) if held(i)]
    assert all(r["score"] == 0 for r in cm.score(spark.createDataFrame(rows, "doc_id long, text string"), by_id(), whole=True).collect())  # all words are one


def test_op13_predicts_the_word_inside_its_class(spark, tmp_path):
    """Two words of one class that stand after different words: their class tells nothing, their contexts tell all."""
    by_class = {}
    for i in range(2000):
        word = f"w{i}"
        by_class.setdefault(int(word_hashes(words([word.encode()]))[0]) >> 56, []).append(word)
    left, right = [x for x in by_class.values() if len(x) > 1][0][:2]
    spark.createDataFrame([(i, f"on {left} off {right} " * 100) for i in range(60)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.queries()["op13_context_mixing"](spark, str(tmp_path)).collect()
    # A share of one half for each of the 200 words of a class would cost 200 * log10(2) = 60.
    assert len(got) == 60 and all(r["score"] > -40 for r in got)
