"""Merkle manifest of a dataset: a tree of digests per language, a tree over these trees, and a proof for every row.

H is the lower-case hex SHA-256 of its inputs put together, digests as hex text. A leaf is H of the row's fields, each ``-`` if null and else
its number of UTF-8 bytes, ``:`` and the value. Per ``lang`` the leaves stand in order of ``doc_id``. While several nodes
remain, every 8 consecutive ones (the last run may be shorter) become their H. What remains is the language's subroot; the subroots, in
order of the language (null first, then by bytes), give the root in the same way.

1. Places: leaves get their place in the language by a range exchange (``order.placed``), so that a language that holds most rows spreads.
2. Levels: lag and lead at the fixed offsets 1 to 7, in windows over blocks of ``BLOCK`` places, masked by the slot in the run (places to the
   left) and by the length of the run (to the right), give each node its siblings. The first child of a run hashes itself and what stands
   to its right into the parent. A level is an eighth of the one before; the number of levels follows from the largest language.
3. Proofs: siblings go down the levels, parents to at most 8 children each, so each row gets the siblings of all levels up to the root.
4. Verification: a leaf, possibly that of a changed row, is folded with its proof and compared with the root.

Equal ids stand in the order of their leaves; a null id comes first. Rows equal in everything are separate leaves. A null id is not tampered
with by the rule on ids. Very long texts are hashed whole. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.order import placed
from zonecast.session import materialize

RUN = 8
#: Places of a window; a multiple of the run, so that no run is cut.
BLOCK = RUN**4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(data: Column) -> Column:
    """H as 32 bytes."""
    return F.unhex(F.sha2(data, 256))


def hexadecimal(data: Column) -> Column:
    return F.lower(F.hex(data))


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The digest of a row, with some of its columns replaced."""
    return digest(F.concat(*[field(changed.get(c, F.col(c))) for c in FIELDS]))


def lower_cased(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _siblings(nodes: DataFrame) -> DataFrame:
    """(tree, i, n, left, right, up) of nodes (tree, i, n, node); ``up`` is the parent's digest, in first children alone."""
    line = Window.partitionBy("tree", F.floor(F.col("i") / BLOCK)).orderBy("i")
    slot = F.col("i") % RUN
    length = F.least(F.lit(RUN), F.col("n") - (F.col("i") - slot))
    nothing = F.lit(b"")
    left = [F.when(slot >= k, F.lag("node", k).over(line)).otherwise(nothing) for k in range(RUN - 1, 0, -1)]
    right = [F.when(slot + k < length, F.lead("node", k).over(line)).otherwise(nothing) for k in range(1, RUN)]
    rows = nodes.select("tree", "i", "n", "node", F.concat(*left).alias("left"), F.concat(*right).alias("right"))
    up = F.when(slot == 0, digest(hexadecimal(F.concat("node", "right"))))
    return rows.select("tree", "i", "n", "left", "right", up.alias("up"))


def _levels(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The levels with siblings, from the leaves of nodes (tree, i, n, node) on, and (tree, node) of the roots."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, roots = [], nodes.where("n = 1").select("tree", "node")
    while most > 1:
        # Trees of one node are done: what is left of them is their root.
        level = materialize(_siblings(nodes.where("n > 1")), "level")
        levels.append(level)
        parents = level.where("up IS NOT NULL")
        nodes = parents.select("tree", F.floor(F.col("i") / RUN).alias("i"), F.ceil(F.col("n") / RUN).alias("n"), F.col("up").alias("node"))
        roots = roots.unionByName(nodes.where("n = 1").select("tree", "node"))
        most = -(-most // RUN)
    return levels, roots


def _path(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(tree, i, path) of the nodes of the lowest level, from (tree, path) of the trees; a path lists (left, right) from the node up."""
    above = None
    for level in reversed(levels):
        own = F.array(F.struct("left", "right"))
        rows = level.select("tree", "i", F.floor(F.col("i") / RUN).alias("of"), "n", own.alias("own"))
        # The top run of a tree hangs on the tree's own path; trees end at different levels.
        top = rows.where(F.col("n") <= RUN).join(tops, "tree")
        if above is not None:
            parents = above.select("tree", F.col("i").alias("of"), "path")
            top = top.unionByName(rows.where(F.col("n") > RUN).join(parents, ["tree", "of"]))
        above = materialize(top.select("tree", "i", F.concat("own", "path").alias("path")), "paths")
    return above


def proofs(leaves: DataFrame) -> DataFrame:
    """``leaves`` (tree, i, n, node and others; place ``i`` in a tree of ``n``) with subroot, root and path; digests are bytes."""
    levels, roots = _levels(leaves.select("tree", "i", "n", "node"))
    ranked = placed(roots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "node"), ["tree"], ["of"], "i")
    ranked = materialize(ranked, "subroots")
    ranked = ranked.withColumn("n", F.lit(ranked.count()).cast("long"))
    upper, root = _levels(ranked.select("tree", "i", "n", "node"))
    nothing = F.array().cast("array<struct<left:binary,right:binary>>")
    root = root.select("tree", F.col("node").alias("root"), nothing.alias("path"))
    paths = _path(upper, root.select("tree", "path")) if upper else root.select("tree", F.lit(0).cast("long").alias("i"), "path")
    tops = ranked.select("tree", "i", "of", F.col("node").alias("subroot")).join(paths, ["tree", "i"]).join(root.drop("path"), "tree")
    tops = materialize(tops.select(F.col("of").alias("tree"), "subroot", "root", "path"), "tops")
    paths = leaves.where("n = 1").select("tree", "i").join(tops.select("tree", "path"), "tree")
    if levels:
        paths = paths.unionByName(_path(levels, tops.select("tree", "path")))
    return leaves.join(paths, ["tree", "i"]).join(tops.drop("path"), "tree")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, s: digest(hexadecimal(F.concat(s["left"], node, s["right"]))))


def proof_digest(path: Column) -> Column:
    """H of all siblings, from the leaf's level up, left to right."""
    siblings = F.aggregate(path, F.lit(b""), lambda held, s: F.concat(held, s["left"], s["right"]))
    return F.sha2(hexadecimal(siblings), 256)


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of each row.

    ``tampered`` tells which rows are folded from a leaf whose text is lower-cased; the tree is that of the rows as they are.
    """
    tree = F.when(F.col("lang").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("lang")))
    changed = F.when(F.coalesce(tampered, F.lit(False)), leaf(text=lower_cased(F.col("text")))) if tampered is not None else F.lit(None).cast("binary")
    rows = docs.select(tree.alias("tree"), "doc_id", leaf().alias("node"), changed.alias("changed"))
    rows = placed(rows, ["tree"], ["doc_id", "node"], "i")
    rows = materialize(rows, "leaves")
    sizes = rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    leaves = materialize(rows.join(sizes, "tree"), "leaves")
    found = proofs(leaves)
    folded = fold(F.coalesce("changed", "node"), F.col("path"))
    return found.select(
        "doc_id",
        hexadecimal(F.col("node")).alias("leaf"),
        hexadecimal(F.col("subroot")).alias("subroot"),
        hexadecimal(F.col("root")).alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        hexadecimal(folded).alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )
