import random
import re

import pytest

from zonecast.llm import near_copies, pipeline, simhash

from .conftest import ODD_ROWS, WORD


def plain_shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1)))


def alike(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def plain_kept(rows):
    """The smallest id of each class, by comparing all pairs."""
    rows = sorted(rows)
    sets = [plain_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return sorted({rows[top(i)][0] for i in range(len(rows))})


def planted(n=40, copies=4):
    rng = random.Random(11)
    known = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(n):
        base = rng.choices(known, k=rng.randint(50, 200))
        rows.append(base)
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(1, 5)):
                i = rng.randrange(len(w))
                w[i : i + rng.randint(0, 1)] = rng.choices(known, k=rng.randint(0, 2))
            rows.append(w)
    rows += [[], [], ["one"], ["One"], ["two", "three"]]
    rng.shuffle(rows)
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


def family(n=160, edits=12):
    """Copies of one text that were edited apart: some pairs reach 0.8, most do not, and hubs link many."""
    rng = random.Random(4)
    known = [f"w{i}" for i in range(4000)]
    base = rng.choices(known, k=150)
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = rng.choice(known)
        rows.append((i, " ".join(w)))
    return rows


def stage(spark, rows, sf_dir, tasks=4):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(tasks)
    return sorted(r["doc_id"] for r in pipeline.near_dedup(spark, docs, sf_dir).collect())


def test_planted_edits_against_all_pairs(spark, sf_dir):
    rows = planted()
    sets = [plain_shingles(t) for _, t in rows]
    assert sum(alike(a, b) for i, a in enumerate(sets) for b in sets[:i]) > 100
    found = stage(spark, rows, sf_dir)
    assert found == plain_kept(rows) and len(found) < len(rows) - 60


def test_documents_against_all_pairs(spark, sf_dir, docs, texts):
    found = [r["doc_id"] for r in pipeline.near_dedup(spark, docs, sf_dir).collect()]
    assert sorted(found) == plain_kept(texts.items())


@pytest.mark.parametrize("often, salt", [(1 << 16, 4096), (2, 3)])
def test_family_of_near_copies_against_all_pairs(spark, sf_dir, monkeypatch, often, salt):
    """Also with keys and members that go the ways of frequent ones."""
    monkeypatch.setattr(near_copies, "OFTEN", often)
    monkeypatch.setattr(near_copies, "SALT", salt)
    rows = family() + [(1000 + i, "a b c d e f g") for i in range(20)] + [(2000 + i, f"only {i} here and nowhere else {i * i}") for i in range(20)]
    found = stage(spark, rows, sf_dir)
    assert found == plain_kept(rows) and 25 < len(found) < 150


def test_chain(spark, sf_dir):
    """Each text is like its neighbours, and the ends share nothing."""
    known = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(known[3 * i : 3 * i + 100])) for i in range(12)]
    sets = [plain_shingles(t) for _, t in rows]
    assert alike(sets[0], sets[1]) and not alike(sets[0], sets[9])
    assert stage(spark, rows, sf_dir) == [0]


def test_pairs_grow_with_the_family_and_not_with_its_square(spark):
    """What is compared: about a few texts for each copy."""
    compared = []
    for n in (100, 200, 400):
        df = spark.createDataFrame(family(n), "node long, text string")
        sets = df.mapInArrow(near_copies._sets, "node long, size long, shingles array<long>")
        held, seen = near_copies._verified, []

        def counting(pairs, s):
            seen.append(pairs.distinct().count())
            return held(pairs, s)

        near_copies._verified = counting
        try:
            near_copies.links(near_copies.prefixes(sets), sets).count()
        finally:
            near_copies._verified = held
        compared.append(sum(seen))
    assert compared[2] < 6 * compared[0] and compared[2] < 12 * 400


def test_nulls_ties_and_repeats(spark, sf_dir, odd, none):
    found = [r["doc_id"] for r in pipeline.near_dedup(spark, odd, sf_dir).collect()]
    rows = sorted(((d is None, d or 0, t or "") for d, t, *_ in ODD_ROWS))
    classes = {}
    for last, d, t in rows:
        classes.setdefault(plain_shingles(t) if WORD.search(t) else None, (last, d))
    assert sorted(map(str, found)) == sorted("None" if last else str(d) for last, d in classes.values())
    assert pipeline.near_dedup(spark, none, sf_dir).count() == 0


def test_simhash_classes_are_candidates_and_whole_sets_decide(spark, sf_dir, monkeypatch):
    """Long texts that differ in their last word are linked by SimHash; texts that share a long repetition are too, and are refused."""
    rng = random.Random(6)
    known = [f"w{i}" for i in range(3000)]
    bases = [rng.choices(known, k=2000) for _ in range(12)]
    rows = [(i, " ".join(w)) for i, w in enumerate(bases)] + [(100 + i, " ".join(w[:-1] + ["end"])) for i, w in enumerate(bases)]
    rows += [(200 + i, "a b c d e f g " * 200 + " ".join(rng.choices(known, k=30))) for i in range(4)]
    sets = {i: plain_shingles(t) for i, t in rows}
    seen, operator, verified = [], simhash.near_duplicates, near_copies._verified
    pairs = []

    def called(docs, *args, **kwargs):
        assert kwargs["shingle"] == near_copies.SHINGLE
        seen.append(operator(docs, *args, **kwargs))
        return seen[-1]

    def checked(candidates, s):
        out = verified(candidates, s)
        pairs.append(([tuple(r) for r in candidates.collect()], [tuple(r) for r in out.collect()]))
        return out

    monkeypatch.setattr(simhash, "near_duplicates", called)
    monkeypatch.setattr(near_copies, "_verified", checked)
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").repartition(4)
    found = sorted(r["doc_id"] for r in pipeline.near_dedup(spark, docs, sf_dir).collect())
    assert found == plain_kept(rows) == [*range(12), 200, 201, 202, 203]
    id_of = {r["_zc_row"]: r["doc_id"] for r in seen[0].collect()}
    candidates, linked = ({tuple(sorted((id_of[a], id_of[b]))) for a, b in x} for x in pairs[0])
    assert len([p for p in candidates if p[0] < 12 and p[1] == p[0] + 100]) >= 6 and any(p[0] >= 200 for p in candidates)
    assert linked == {(a, b) for a, b in candidates if alike(sets[a], sets[b])} and linked < candidates
