import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.llm import catalog, prefix_trie

from .conftest import WORD

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_order(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
    return (turn is not None, turn or 0, digest)


def plain_conversations(rows):
    out = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=turn_order):
        out[r[0]].append((r[2] or "", r[3] or ""))
    return out


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    """Every node by its sequence; subtrees by looking at all pairs of nodes and prefixes."""
    members = defaultdict(list)
    for c, own in convs.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, of in members.items():
        words = len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children.get(node)
            saved[node[:d]] += (len(of) - 1) * words
    out = []
    for node, of in members.items():
        ends = sorted(c for c in of if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((min(of), len(node), parent, len(of), children.get(node, 0), leaves[node], saved[node], digest))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=str)


def made(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("c", "depth", "p1", "est", "own", "block", "words", "n", "parent"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


def random_rows(n=160, seed=5):
    """Few distinct turns, so that prefixes of all lengths are shared, copies are many, and some conversations are prefixes of others."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        turns = [(rng.choice(["user", "bot"]), rng.choice(["a b", "a  b", "", "x\ny z"])) for _ in range(rng.randint(1, 7))]
        if rng.random() < 0.3:
            turns = [("user", "same first")] * rng.randint(1, 6)
        if rng.random() < 0.2:
            turns += [("user", f"only {c}"), ("bot", "tail")]
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    return rows


ODD = [
    (None, 0, "user", "no conversation"), (7, None, "user", "first"), (7, 0, None, None), (7, 0, "", ""), (7, 1, "user", "x" * 50000), (7, 1, "user", "x" * 50000),
    (20, 0, "user", "a"), (21, 5, "user", "a"), (21, 5, "bot", "a"), (33, None, None, None), (40, 0, "us", "era"), (41, 0, "use", "ra"), (-3, 0, "user", "é 東京 b"),
]


@pytest.mark.parametrize("cells", [64, 1 << 24])
def test_shared_prefixes_against_plain(spark, cells):
    """A sketch that is far too small screens little and changes nothing."""
    rows = random_rows()
    convs = plain_conversations(rows)
    assert result(prefix_trie.conversation_trie(made(spark, rows), cells)) == plain_trie(convs)
    assert result(prefix_trie.rebuilt_trie(made(spark, rows), cells=cells)) == plain_trie(rebuilt(convs))


def test_odd_rows_against_plain(spark):
    convs = plain_conversations(ODD)
    assert result(prefix_trie.conversation_trie(made(spark, ODD))) == plain_trie(convs)
    assert result(prefix_trie.rebuilt_trie(made(spark, ODD))) == plain_trie(rebuilt(convs))


def test_empty_table_and_no_conversation(spark):
    assert result(prefix_trie.rebuilt_trie(made(spark, []))) == []
    assert result(prefix_trie.conversation_trie(made(spark, ODD[:1]))) == []


def test_long_conversations_and_hot_nodes_split(spark, monkeypatch):
    """Blocks, salts and pieces far smaller than the conversations, nodes and lists of ids."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    monkeypatch.setattr(prefix_trie, "SALT", 8)
    monkeypatch.setattr(prefix_trie, "PIECE", 5)
    rows = random_rows(60, 9)
    rows += [(c, i, "user", f"long {i // 3}") for c in (100, 101, 120) for i in range(50 + c % 7)]
    rows += [(c, i, "user", "copy") for c in range(200, 290) for i in range(3)]
    convs = plain_conversations(rows)
    assert result(prefix_trie.conversation_trie(made(spark, rows))) == plain_trie(convs)
    assert result(prefix_trie.rebuilt_trie(made(spark, rows), cells=256)) == plain_trie(rebuilt(convs))


def test_registered_query_against_plain(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(catalog.queries()["op11_prefix_trie"](spark, sf_dir)) == plain_trie(rebuilt(plain_conversations(rows)))


def test_sketch_never_counts_too_little(spark):
    rows = spark.range(3000).select((F.col("id") % 5 + 1).alias("depth"), (F.col("id") % 700).alias("p1"), F.lit(7).cast("long").alias("p2"))
    codes, width = prefix_trie.sketch(rows, 3000, cells=4096)
    counts = rows.groupBy("depth", "p1", "p2").count().toPandas()
    cells = prefix_trie._cells(counts["p1"].to_numpy(), counts["p2"].to_numpy(), counts["depth"].to_numpy(), width)
    assert (np.min([codes[c] for c in cells], axis=0) >= prefix_trie.coded(counts["count"].to_numpy())).all()
    large = np.array([1, 200, 201, 10**4, 10**9])
    code = prefix_trie.coded(large)
    back = spark.createDataFrame([(int(c),) for c in code], "x int").select(prefix_trie.decoded(F.col("x")).alias("n")).toPandas()["n"].to_numpy()
    assert (back >= large).all() and (back <= 2 * large).all()
