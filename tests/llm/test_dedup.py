import hashlib
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from zonecast.llm import catalog, components, exact_dedup, simhash, substring_dedup

from .conftest import ODD_ROWS, WORD


def plain_duplicates(rows):
    """(keep_id, group size) by normalised text, kept rows once each."""
    groups = {}
    for d, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), d is None, d or 0, d))
    return {k: (min(v, key=lambda x: x[:3])[3], len(v)) for k, v in groups.items()}


def check_duplicates(rows, found):
    groups = plain_duplicates(rows)
    bare = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    assert len(found) == len(rows)
    kept = [r["text_sha256"] for r in found if r["kept"]]
    assert sorted(kept) == sorted(bare)
    for r in found:
        assert (r["keep_id"], r["group_size"]) == bare[r["text_sha256"]]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]


def test_exact_duplicates_of_documents(docs, texts):
    check_duplicates(list(texts.items()), exact_dedup.exact_duplicates(docs).collect())


def test_exact_duplicates_of_odd_rows(odd, none):
    check_duplicates([r[:2] for r in ODD_ROWS], exact_dedup.exact_duplicates(odd).collect())
    assert exact_dedup.exact_duplicates(none).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=60), st.integers(4, 12), st.integers(1, 4))
def test_filters_merge_losslessly(values, block_bits, parts):
    values = values + values[:7]
    packed = {}
    for i in range(parts):
        found, counts = np.unique(np.array(values[i::parts], np.uint64), return_counts=True)
        for record in exact_dedup.pack(found, counts, block_bits):
            packed.setdefault(record["block"], []).append(exact_dedup.unpack(record, block_bits))
    merged = {}
    for block in packed.values():
        merged |= dict(zip(*(x.tolist() for x in exact_dedup.merge(block))))
    assert merged == {v: values.count(v) for v in set(values)}


def test_texts_with_one_fingerprint_part_in_verification(odd, docs, texts):
    check_duplicates(list(texts.items()), exact_dedup.exact_duplicates(docs, bits=3, filter_bits=10, block_rows=16).collect())
    check_duplicates([r[:2] for r in ODD_ROWS], exact_dedup.exact_duplicates(odd, bits=1).collect())


def plain_fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    parts = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(ids, fps, distance=2):
    parent = list(range(len(ids)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return [top(i) for i in range(len(ids))]


def test_simhash_of_documents(spark, sf_dir, texts):
    ids = sorted(texts)
    fps = [plain_fingerprint(texts[d]) for d in ids]
    roots = plain_components(ids, fps)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in catalog.op6_simhash(spark, sf_dir).collect()}
    assert found == {d: (format(f, "016x"), ids[r]) for d, f, r in zip(ids, fps, roots)}


@pytest.mark.parametrize("hot", [simhash.HOT, 3])
def test_links_among_crowded_fingerprints(spark, hot):
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres:
        for _ in range(60):
            x = int(c)
            for b in rng.choice(12, rng.integers(1, 4), replace=False):
                x ^= 1 << int(b * 5)
            fps.add(x)
    fps = sorted(fps)
    signed = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), hot=hot)
    root = {r["node"] & (2**64 - 1): r["root"] for r in components.components(edges).collect()}
    expected = plain_components(fps, fps)
    groups = {}
    for f, r in zip(fps, expected):
        groups.setdefault(r, set()).add(root.get(f, f"alone {f}"))
    assert all(len(g) == 1 for g in groups.values())
    assert len(set().union(*groups.values())) == len(groups)


def test_forest_of_many_links_is_built_in_parts(monkeypatch):
    monkeypatch.setattr(simhash, "LINKS_HELD", 50)
    fp = np.sort(np.array([sum(1 << b for b in range(8) if i >> b & 1) for i in range(256)] + [0xFFF << 40], np.uint64))
    a, b = simhash.forest(np.zeros(257, np.int64), fp, 2)
    assert len(a) == 255 and set(b.tolist()) == {0}


def test_allocation_is_the_cheapest():
    costs = [{-1: 0.0, 0: 5.0, 1: 9.0}, {-1: 0.0, 0: 1.0, 1: 2.0}, {-1: 0.0, 0: 30.0, 1: 31.0}]
    assert simhash.allocate(costs, 0) == (7.0, [0, 1, -1])


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [(7, 7)]
    root = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert root == {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 40)}


def test_simhash_of_odd_rows(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD_ROWS)
    blank = {r["component_id"] for r in rows if r["doc_id"] in (1, 2, 3)}
    assert blank == {1} and all(r["fp"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    assert simhash.near_duplicates(none).count() == 0


def plain_passages(rows, window=20):
    seen, out = set(), {}
    for d, text in rows:
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if k in seen:
                gone[i : i + window] = [True] * window
            seen.add(k)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.setdefault(d, []).append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


@pytest.mark.parametrize("chunk", [4 << 20, 20000])
def test_passages_of_documents(docs, texts, chunk):
    rows = substring_dedup.repeated_passages(docs, texts=True, chunk_bytes=chunk).collect()
    expected = plain_passages(sorted(texts.items()))
    assert {r["doc_id"]: [(r["n_words"], r["n_removed"], r["kept_sha256"], r["text"])] for r in rows} == expected
    assert sum(r["n_removed"] for r in rows) > 0


@pytest.mark.parametrize("window", [2, 3, 5, 10, 20, 27])
def test_passages_of_short_texts(spark, window):
    rng = np.random.default_rng(window)
    rows = [(i, " ".join(rng.choice(list("abc"), rng.integers(0, 60)))) for i in range(60)]
    found = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), window=window, chunk_bytes=300).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found} == {d: v[0][:3] for d, v in plain_passages(rows, window).items()}


def test_passages_pass_every_length(spark):
    assert substring_dedup.levels(20) == [5, 10, 20] and substring_dedup.levels(27) == [7, 14, 27] and substring_dedup.levels(9) == [9]
    rng = np.random.default_rng(8)
    unique = iter(range(10**6))
    passages = [[f"p{k}_{i}" for i in range(n)] for k, n in enumerate((4, 5, 9, 10, 19, 20, 21, 45))]
    rows = []
    for i in range(200):
        text = [f"u{next(unique)}" for _ in range(30)]
        for k in rng.choice(len(passages), 3):
            text += passages[k] + [f"u{next(unique)}" for _ in range(int(rng.integers(0, 12)))]
        rows.append((i, " ".join(text)))
    # A group of copies in every chunk, ids that repeat, ids that are null.
    rows += [(1000 + i, rows[7][1]) for i in range(150)] + [(5, rows[9][1]), (5, rows[9][1])]
    for size in (1500, 1 << 20):
        df = spark.createDataFrame(rows + [(None, rows[7][1])], "doc_id long, text string").repartition(6)
        found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in substring_dedup.repeated_passages(df, chunk_bytes=size).collect())
        plain = plain_passages(sorted(rows, key=lambda r: r[0]) + [(None, rows[7][1])])
        ties = {5}  # equal ids: which of them is first is open, what they lose together is not
        assert [f for f in found if f[1] not in ties] == sorted((d is None, d or 0, *v[:2]) for d, vs in plain.items() for v in vs if d not in ties)
        assert len([f for f in found if f[1] in ties]) == 3


def test_one_exchange_serves_least_place_and_join(spark):
    rows = spark.createDataFrame([(k, i, 0, i) for k in range(50) for i in range(k % 3 + 1)], "key long, doc_id long, chunk long, place int")
    out = substring_dedup._not_first(rows, ["key"], "places")
    assert sorted(out.first()["places"]) == sorted(i for k in range(50) for i in range(1, k % 3 + 1))


def test_passages_of_odd_rows(odd, none):
    rows = substring_dedup.repeated_passages(odd).collect()
    expected = plain_passages(sorted((r[:2] for r in ODD_ROWS), key=lambda r: (r[0] is None, r[0] or 0)))
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in rows) == sorted((str(d), *v[:2]) for d, vs in expected.items() for v in vs)
    assert substring_dedup.repeated_passages(none).count() == 0
