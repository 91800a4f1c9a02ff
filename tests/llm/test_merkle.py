import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from zonecast.llm import catalog, merkle, order

from .conftest import ODD_ROWS

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r):
    parts = ["-" if v is None else str(v) for v in r]
    return h(*[p if v is None else f"{len(p.encode())}:{p}" for p, v in zip(parts, r)])


def climb(nodes):
    """Root of a list of nodes, and for each of them the (left, right) siblings of every level."""
    ways = [[] for _ in nodes]
    of = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for d, at in enumerate(of):
            run = runs[at // 8]
            ways[d].append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
            of[d] = at // 8
        nodes = [h(*run) for run in runs]
    return (nodes[0] if nodes else None), ways


def plain(rows, tampered):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {x: [r for r in rows if r[2] == x] for x in langs}
    subs = {x: climb([leaf(r) for r in groups[x]]) for x in langs}
    root, upper = climb([subs[x][0] for x in langs])
    out = []
    for x, above in zip(langs, upper):
        for r, way in zip(groups[x], subs[x][1]):
            node = leaf(r)
            if tampered(r[0]):
                t = r[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
                node = leaf((*r[:4], t))
            for a, b in way + above:
                node = h(a, node, b)
            out.append((r[0], leaf(r), subs[x][0], root, h(*[a + b for a, b in way + above]), node, node == root))
    return sorted(out, key=str)


def by_id(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0


def found(spark, rows, **extra):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("tree", "node", "i", "n", "left", "path", "root", "leaf"):
        df = df.withColumn(name, F.lit("clash"))
    got = merkle.manifest(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    return sorted(map(tuple, got.collect()), key=str)


def test_odd_rows_against_plain(spark):
    rows = [(d, s, g, None if t is None else len(t), t) for d, t, g, s in ODD_ROWS]
    assert found(spark, rows) == plain(rows, by_id)


@pytest.mark.parametrize("langs", [1, 9, 70])
def test_runs_of_all_lengths(spark, langs):
    """Languages of 1, 2, ... rows: short last runs, lone leaves, trees of several heights, and a top tree of up to three levels."""
    rows = [(1000 * x + i, "s", None if x == 3 else f"é{x}", i, f"Text {i} OF {x}") for x in range(langs) for i in range(1 + 13 * (x % 12))]
    got = found(spark, rows)
    assert got == plain(rows, by_id)
    assert any(not r[-1] for r in got) or langs == 1


def test_one_row_and_none(spark):
    rows = [(3, None, None, None, None)]
    got = found(spark, rows)
    assert got == plain(rows, by_id) and got[0][1] == got[0][2] == got[0][3]
    assert found(spark, []) == []


def test_one_language_over_blocks(spark, monkeypatch):
    """Window blocks never cut a run."""
    monkeypatch.setattr(merkle, "BLOCK", 16)
    rows = [(i, "s", "en", i, f"A{i}") for i in range(601)]
    assert found(spark, rows) == plain(rows, by_id)


def test_documents_against_plain(spark, sf_dir, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = sorted((tuple(r) for r in catalog.queries()["op12_merkle"](spark, sf_dir).collect()), key=str)
    assert got == plain(rows, by_id)


def test_places_of_a_hot_group_of_equal_rows(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"), F.lit(1).alias("o"))
    got = order.placed(df, ["g"], ["o"], "i").groupBy("g").agg(F.count("i").alias("n"), F.countDistinct("i").alias("d"), F.max("i").alias("m")).collect()
    assert len(got) == 8 and all(r["n"] == r["d"] == r["m"] + 1 for r in got)
