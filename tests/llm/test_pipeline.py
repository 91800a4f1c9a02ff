import hashlib
from collections import Counter

import corpus_pipeline
import pytest

from zonecast.llm import catalog, mixing, pipeline, quality_rules

from .conftest import ODD_ROWS, WORD
from .test_dedup import plain_duplicates
from .test_near_copies import plain_kept


@pytest.fixture(scope="module")
def stages(spark, sf_dir, docs, tmp_path_factory):
    out, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, now, sf_dir).write.parquet(path)
        out[name] = (now, spark.read.parquet(path))
        now = out[name][1]
    return out


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_order_and_columns(stages, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "bpe"]
    assert all(stages[n][1].columns == docs.columns for n in list(stages)[:-1])


def test_each_stage_against_brute_force(spark, sf_dir, stages):
    before, after = stages["quality_rules"]
    judged = quality_rules.judge(before, quality_rules.fit_rules(before, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    assert {d for d, _ in texts_of(after)} == {r["doc_id"] for r in judged.where("kept").collect()}

    before, after = (texts_of(x) for x in stages["exact_dedup"])
    assert sorted(d for d, _ in after) == sorted(k for k, _ in plain_duplicates(before).values())

    before, after = (texts_of(x) for x in stages["near_dedup"])
    assert sorted(d for d, _ in after) == plain_kept(before)

    before, after = stages["mixing"]
    taken = Counter(d for d, _ in texts_of(after))
    size = {d: len(WORD.findall(t)) for d, t in texts_of(before)}
    goal = {r["source"]: r["target"] for r in mixing.mix(before).collect()}
    got = Counter()
    for r in after.select("doc_id", "source").collect():
        got[r["source"]] += size[r["doc_id"]]
    assert max(taken.values()) <= 3 and all(abs(got[s] - t) <= 0.1 * t for s, t in goal.items())

    before, after = stages["bpe"]
    assert Counter(r["decoded_sha256"] for r in after.collect()) == Counter(hashlib.sha256(t.encode()).hexdigest() for _, t in texts_of(before))


def test_empty_tables(spark, sf_dir, none):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, sf_dir)
        assert out.count() == 0 and (name == "bpe" or out.columns == none.columns)


def rows_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_odd_rows_of_each_stage_against_plain(spark, sf_dir, odd):
    """Nulls, ties, repeated rows, long and empty texts, clashing columns."""
    judged = quality_rules.judge(odd, quality_rules.fit_rules(odd, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    out = pipeline.rules(spark, odd, sf_dir)
    assert out.columns == odd.columns and Counter(r["doc_id"] for r in out.collect()) == Counter(r["doc_id"] for r in judged.where("kept").collect())
    base = [(d, t) for d, t, *_ in ODD_ROWS if len(WORD.findall(t or "")) >= 50]
    assert set(rows_of(out)) <= set(base)

    out = pipeline.exact_dedup(spark, odd, sf_dir)
    want = plain_duplicates([r[:2] for r in ODD_ROWS])
    assert out.columns == odd.columns and out.count() == len(want)
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == sorted((k for k, _ in want.values()), key=str)

    # Mixing: every row as often as its rates say, words near the target of its source, no row more than three times a copy.
    out = pipeline.mixture(spark, odd, sf_dir)
    size = {t: len(WORD.findall(t or "")) for _, t, *_ in ODD_ROWS}
    taken, there = Counter(rows_of(out)), Counter((d, t) for d, t, *_ in ODD_ROWS)
    assert out.columns == odd.columns and all(n <= 3 * there[r] for r, n in taken.items()) and all(size[t] for _, t in taken)
    mixed = mixing.mix(odd).collect()
    assert sum(size[t] * n for (_, t), n in taken.items()) == sum(r["taken"] for r in mixed)

    out = pipeline.encode(spark, odd, sf_dir)
    want = Counter(hashlib.sha256((t or "").encode()).hexdigest() for _, t, *_ in ODD_ROWS)
    assert Counter(r["decoded_sha256"] for r in out.collect()) == want


def test_queries_and_sql():
    assert set(catalog.oracle_sql()) <= set(catalog.queries()) and len(catalog.queries()) == 14
