"""Mixing sources to target weights by entropy balancing.

Each source gets a target number of words: the weights, capped at ``limit`` times what the source has, the
excess shared again by weight until no source is above (``targets``). Among all rates ``r`` between 0 and
``limit`` with ``sum(size * r) = target`` per source, entropy balancing takes the one nearest to taking each
document once (least Kullback-Leibler divergence). Its rates are exponentially tilted in the balanced
quantity, ``r = min(limit, exp(lambda * z))`` with ``z`` the size over the source's mean word's document size, and
``lambda`` minimises the convex dual ``sum(integral of r) - lambda * target``. Newton steps on the dual run as aggregates
over (source, size) cells, kept inside a bracket that every step narrows.

Documents of one source and size share a rate, so everything after the first aggregate works on cells; how
many there are follows the number of distinct sizes. A cell's rate times its documents is rounded down to whole
copies, the copies lost this way are dealt out evenly in order of size, and ``repair`` steps then move the
source's remaining gap into the one cell that closes it best. Inside a cell the copies differ by one at most; which documents get
the extra one follows a seeded hash, ranked in bins so that a cell of any size is spread over many tasks.

No Python runs on the data. Null text has size 0; a document of size 0 takes nothing and counts for nothing. A null source
is the last one; their number is not bounded. Rows that agree in everything are separate documents. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.order import placed
from zonecast.llm.tables import text_or_empty
from zonecast.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
LIMIT = 3
BIN_ROWS = 2048


def word_count(text: Column) -> Column:
    """Runs of characters other than white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(source, source_size) with the ``target`` of each source, for any number of sources.

    Sources in order of code point (null last) weigh ``weights``, repeating. Sharing a total by weight
    with caps means ``target = min(limit * size, level * weight)``. The level rises from the plain share: each step
    caps the sources whose share is above their cap and shares what they leave, until no further one is above. A step
    is one aggregate of whole numbers (what is capped, and how many of each weight are not), so reruns agree to the last bit.
    """
    named = sources.select(F.lit(0).alias("all"), F.col("source").isNull().alias("last"), "source", "source_size")
    kind = (F.col("place") % len(weights)).cast("int")
    ranked = placed(named, ["all"], ["last", "source"], "place").select("source", "source_size", kind.alias("kind"))
    rows = materialize(ranked, "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("kind") + 1)
    cap = F.lit(float(limit)) * F.col("source_size")
    total, level, capped = None, 0.0, -1
    while True:
        below = F.lit(level) * weight <= cap
        open_ = [F.count(F.when(below & (F.col("kind") == i), 1)) for i in range(len(weights))]
        found = rows.agg(F.sum("source_size"), F.count(F.when(~below, 1)), F.coalesce(F.sum(F.when(~below, F.col("source_size"))), F.lit(0)), *open_).first()
        total = found[0] or 0
        left = sum(n * w for n, w in zip(found[3:], weights))
        if found[1] == capped or not left:
            break
        capped, level = found[1], (total - limit * found[2]) / left
    return rows.select("source", "source_size", F.least(cap, F.lit(level) * weight).alias("target"))


def _exact(x: Column) -> Column:
    return x.cast("decimal(18,0)")


def _fixed(x: Column) -> Column:
    """Decimals, whose sum does not depend on the order in which rows arrive: sums that decide roundings use them."""
    return x.cast("decimal(28,6)")


def _tilted(z: Column, tilt: Column, limit: float) -> Column:
    return F.least(F.lit(float(limit)), F.exp(F.least(tilt * z, F.lit(50.0))))


def entropy_tilts(cells: DataFrame, goals: DataFrame, limit: float = LIMIT, tolerance: float = 1e-6, most_steps: int = 60) -> DataFrame:
    """``goals`` with the ``tilt`` and ``scale`` of each source.

    The table has a row per source and is written after each step, so no plan grows with the steps. The
    driver sees one number a step: how far the worst source is from its target.
    """
    spark = cells.sparkSession
    own = cells.where("size > 0").groupBy("source").agg(
        (F.sum(_exact(F.col("n") * F.col("size")) * F.col("size")).cast("double") / F.sum(F.col("n") * F.col("size"))).alias("scale"),
        F.min("size").alias("least"),
    )
    share = F.col("target") / F.col("source_size")
    reach = F.col("scale") / F.col("least")
    state = goals.join(own, goals["source"].eqNullSafe(own["source"])).drop(own["source"]).select(
        "source", "source_size", "target", "scale",
        # At these ends the rates of all documents are below or above the share.
        (F.least(F.log(share), F.lit(-1e-3)) * reach).alias("low"),
        (F.lit(math.log(limit) + 1e-3) * reach).alias("high"),
        F.log(share).alias("tilt"),
    )
    for _ in range(most_steps):
        state = materialize(state, "tilts")
        s = state.select(F.col("source").alias("of"), "scale", "target", "tilt")
        z = F.col("size") / F.col("scale")
        raw = _tilted(z, F.col("tilt"), limit)
        sums = (
            cells.where("size > 0").join(s, cells["source"].eqNullSafe(s["of"])).groupBy("of").agg(
                F.sum(_fixed(F.col("n") * F.col("size") * raw)).cast("double").alias("taken"),
                F.sum(F.when(raw < limit, _fixed(F.col("n") * F.col("size") * z * raw)).otherwise(F.lit(0))).cast("double").alias("slope"),
            )
        )
        step = materialize(state.join(sums, state["source"].eqNullSafe(sums["of"])).withColumn("gap", F.col("taken") - F.col("target")), "step")
        off = F.abs(F.col("gap")) / F.col("target")
        open_ = (off > tolerance) & (F.col("high") - F.col("low") > 1e-9 * F.abs("high"))
        if step.agg(F.max(F.when(open_, off))).first()[0] is None:
            break
        low = F.when(F.col("gap") < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("gap") >= 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - F.col("gap") / F.when(F.col("slope") > 0, F.col("slope"))
        inside = newton.isNotNull() & (newton > low) & (newton < high)
        state = step.select(
            "source", "source_size", "target", "scale", low.alias("low"), high.alias("high"),
            F.when(~open_, F.col("tilt")).when(inside, newton).otherwise((low + high) / 2).alias("tilt"),
        )
    return materialize(state, "tilts")


def cell_copies(cells: DataFrame, tilts: DataFrame, limit: int = LIMIT, repair: int = 4) -> DataFrame:
    """(source, size, n, copies): whole copies for each cell, near the targets."""
    t = tilts.select(F.col("source").alias("of"), "scale", "target", "tilt")
    full = F.col("target") >= F.lit(float(limit)) * F.col("source_size") * (1 - 1e-12)
    t = tilts.select(F.col("source").alias("of"), "scale", "target", "tilt", full.alias("full"))
    rate = F.when(F.col("full"), F.lit(float(limit))).otherwise(_tilted(F.col("size") / F.col("scale"), F.col("tilt"), limit))
    wanted = F.col("n") * rate
    rows = cells.where("size > 0").join(t, cells["source"].eqNullSafe(t["of"])).select("source", "size", "n", "target", wanted.alias("wanted"))
    # The running sum of what rounding down loses crosses whole numbers evenly along the sizes.
    along = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, 0)
    lost = F.col("wanted") - F.floor("wanted")
    run = F.sum(lost).over(along)
    copies = F.floor("wanted") + F.floor(run + 0.5) - F.floor(run - lost + 0.5)
    rows = rows.withColumn("copies", F.least(copies, F.lit(limit) * F.col("n")).cast("long")).drop("wanted")
    for _ in range(repair):
        rows = materialize(rows, "cells")
        gaps = rows.groupBy("source").agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
        gaps = gaps.withColumnRenamed("source", "of")
        room = rows.join(gaps, rows["source"].eqNullSafe(gaps["of"])).withColumn(
            "move", F.greatest(F.least(F.round(F.col("gap") / F.col("size")), F.lit(limit) * F.col("n") - F.col("copies")), -F.col("copies")).cast("long")
        )
        left = F.abs(F.col("gap") - F.col("move") * F.col("size"))
        best = room.groupBy(F.col("source").alias("of")).agg(F.min(F.struct(left.alias("left"), "size", "move")).alias("best"))
        rows = rows.join(best, rows["source"].eqNullSafe(best["of"])).select(
            "source", "size", "n", "target",
            (F.col("copies") + F.when(F.col("size") == F.col("best.size"), F.col("best.move")).otherwise(0)).alias("copies"),
        )
    return materialize(rows, "cells")


def sized(docs: DataFrame, carried: list[str], seed: int) -> DataFrame:
    """doc_id, source, size and a seeded draw of each document, and ``carried``."""
    draw = F.xxhash64(F.lit(seed), "doc_id", text_or_empty())
    return docs.select("doc_id", "source", word_count(text_or_empty()).alias("size"), draw.alias("draw"), *carried)


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: int = LIMIT, seed: int = 5, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken words of every document."""
    rows = materialize(sized(docs, list(carried), seed), "sizes")
    cells = materialize(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    goals = materialize(targets(cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, limit), "targets")
    copies = cell_copies(cells, entropy_tilts(cells, goals.where("source_size > 0"), limit), limit)
    # Rank of a document in its cell: the documents of smaller bins, and its rank inside its bin.
    c = copies.select(F.col("source").alias("c_source"), F.col("size").alias("c_size"), F.col("n").alias("c_n"), "copies")
    here = rows["source"].eqNullSafe(c["c_source"]) & (rows["size"] == c["c_size"])
    placed = rows.join(c, here, "left").withColumn("bin", F.expr(f"pmod(draw, ceil(coalesce(c_n, 1) / {BIN_ROWS}))"))
    keys = ["source", "size", "bin"]
    bins = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("held"))
    earlier = Window.partitionBy("source", "size").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(*[F.col(k).alias("b_" + k) for k in keys], F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    match = F.lit(True)
    for k in keys:
        match = match & placed[k].eqNullSafe(bins["b_" + k])
    ranked = placed.join(bins, match).withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy(*keys).orderBy("draw", "doc_id")))
    extra = F.when(F.col("rank") <= F.col("copies") % F.col("c_n"), 1).otherwise(0)
    number = F.coalesce(F.floor(F.col("copies") / F.col("c_n")) + extra, F.lit(0)).cast("int")
    g = goals.select(F.col("source").alias("g_source"), "source_size", "target")
    return ranked.join(g, ranked["source"].eqNullSafe(g["g_source"])).select(
        "doc_id", "source", "size", "source_size", "target", number.alias("copies"), (number * F.col("size")).alias("taken"), *carried
    )
