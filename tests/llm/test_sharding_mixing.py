import math
from collections import Counter

from pyspark.sql import functions as F

from zonecast.llm import catalog, mixing, sharding

from .conftest import ODD_ROWS, WORD


def check_shards(rows, shards):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], shards)
    assert all(0 <= s < shards for s in slots)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return slots


def test_shards_of_documents(spark, sf_dir, texts):
    rows = catalog.op1_sharding(spark, sf_dir).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(list(texts))
    check_shards(rows, 24)
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 8 for r in rows)


def test_key_decides_shard_and_a_new_shard_takes_only_into_itself(docs):
    small = {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in sharding.shard(docs, 5).collect()}
    grown = {r["doc_id"]: r["shard"] for r in sharding.shard(docs.where("doc_id % 3 = 0"), 6).collect()}
    assert all(small[d][1] == s for d, s in grown.items())


def test_many_buckets_are_shuffled(docs):
    rows = sharding.shard(docs, 3, bucket_bytes=2000).collect()
    slots = check_shards(rows, 3)
    assert any(v != sorted(v) for v in slots.values())
    again = {r["doc_id"]: r["slot"] for r in sharding.shard(docs, 3, bucket_bytes=2000).collect()}
    assert again == {r["doc_id"]: r["slot"] for r in rows}


def test_odd_rows_shards(odd, none, tmp_path, spark):
    out = sharding.shard(odd, 4)
    rows = out.collect()
    assert len(rows) == len(ODD_ROWS)
    check_shards(rows, 4)
    assert sharding.shard(none, 4).count() == 0
    sharding.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.groupBy("shard").count().count() == len({r["shard"] for r in rows}) and back.count() == len(rows)


def plain_targets(sizes, weights=(5.0, 2.0, 1.0), limit=3.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(limit * sizes[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[t] for t in order if t not in full) for s in order if s not in full}
        over = {s for s in share if share[s] > limit * sizes[s]}
        if not over:
            return {s: limit * sizes[s] if s in full else share[s] for s in order}
        full |= over


def test_targets_with_caps(spark):
    sizes = {"a": 10, "b": 1000, "c": 30, "d": 7, "B": 400, None: 50, "z": 900}
    rows = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    expected = plain_targets(sizes)
    assert all(math.isclose(r["target"], expected[r["source"]], rel_tol=1e-9) for r in rows) and len(rows) == len(sizes)


def test_targets_of_many_sources(spark):
    n = 100_000
    sizes = {f"host{i:06d}": (i * 7919) % 5000 + (10**7 if i % 9973 == 0 else 0) for i in range(n)}
    df = spark.createDataFrame([*sizes.items(), (None, 123)], "source string, source_size long").repartition(7)
    got = {r["source"]: (r["source_size"], r["target"]) for r in mixing.targets(df).collect()}
    assert got == {r["source"]: (r["source_size"], r["target"]) for r in mixing.targets(df.repartition(3)).collect()}
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate([*sorted(sizes), None])}
    assert {s: v[0] for s, v in got.items()} == sizes | {None: 123}
    assert math.isclose(math.fsum(t for _, t in got.values()), sum(sizes.values()) + 123, rel_tol=1e-9)
    levels = [t / weight[s] for s, (size, t) in got.items() if t < 3 * size]
    assert 0 < len(levels) < n and math.isclose(min(levels), max(levels), rel_tol=1e-12)
    assert all(t <= 3 * size and (t < 3 * size or t <= levels[0] * weight[s]) for s, (size, t) in got.items())


def test_targets_where_nothing_has_a_size(spark):
    empty = spark.createDataFrame([("a", 0), (None, 0)], "source string, source_size long")
    assert {(r["source"], r["target"]) for r in mixing.targets(empty).collect()} == {("a", 0.0), (None, 0.0)}
    assert mixing.targets(empty.limit(0)).count() == 0


def test_mix_of_documents(spark, sf_dir, docs, texts):
    rows = mixing.mix(docs).collect()
    sizes = {d: len(WORD.findall(t)) for d, t in texts.items()}
    by_source = Counter()
    for r in rows:
        by_source[r["source"]] += sizes[r["doc_id"]]
    expected = plain_targets(dict(by_source))
    taken = Counter()
    for r in rows:
        assert r["size"] == sizes[r["doc_id"]] and r["source_size"] == by_source[r["source"]]
        assert math.isclose(r["target"], expected[r["source"]], rel_tol=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - t) <= 0.05 * t for s, t in expected.items())
    again = {r["doc_id"]: r["taken"] for r in catalog.op5_mixing(spark, sf_dir).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_tilts_meet_the_targets(spark):
    cells = spark.createDataFrame([("a", s, n) for s, n in ((1, 50), (7, 30), (40, 10), (900, 2))] + [(None, 5, 100), (None, 6, 3)], "source string, size long, n long")
    goals = spark.createDataFrame([("a", 2460, 700.0), (None, 518, 1300.0)], "source string, source_size long, target double")
    tilts = {r["source"]: r for r in mixing.entropy_tilts(cells, goals).collect()}
    for source, goal in (("a", 700.0), (None, 1300.0)):
        t = tilts[source]
        got = sum(r["n"] * r["size"] * min(3.0, math.exp(t["tilt"] * r["size"] / t["scale"])) for r in cells.collect() if r["source"] == source)
        assert math.isclose(got, goal, rel_tol=1e-5)


def test_odd_rows_mix(odd, none):
    rows = mixing.mix(odd.select("doc_id", "text", "lang", "source", "n", "target")).collect()
    assert len(rows) == len(ODD_ROWS) and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mix(none).count() == 0


def test_a_hot_cell_is_ranked_in_bins(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("w w w").alias("text"), F.when(F.col("id") < 3000, "a").when(F.col("id") < 5900, "b").otherwise("c").alias("source"))
    rows = mixing.mix(df).groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("g"), F.max("copies").alias("m"), F.min("copies").alias("l")).collect()
    assert all(abs(r["t"] - r["g"]) <= 3 and r["m"] - r["l"] <= 1 for r in rows)


def test_no_python_on_the_data(docs):
    for df in (sharding.shard(docs), mixing.mix(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
