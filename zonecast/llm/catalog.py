"""Registered queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import bpe, context_mixing, exact_dedup, language, merkle, mixing, pipeline, prefix_trie, quality_crf, quality_rules, sharding, simhash, substring_dedup, surrogates
from zonecast.llm.tables import ROW, table

#: The registered query's key; a real one comes from the caller.
SURROGATE_KEY = b"registered query"
Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard(table(spark, sf_dir, "documents"), shards=24)
    return sharded.select(
        "doc_id",
        sharding.record_size().alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard", "slot", "grown_shard",
    )


def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality_crf.score(docs, quality_crf.fit_quality(docs, table(spark, sf_dir, "labels")))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % quality_crf.FOLDS == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop(ROW)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.Codec(docs).round_trip(docs)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit_rules(docs, table(spark, sf_dir, "labels")))


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_personal_data(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered)


def op13_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return context_mixing.score(table(spark, sf_dir, "documents"), held_out, context_mixing.WHOLE_BYTES, whole=True)


#: CRC-32 of the decimal digits of a column, bit by bit, as 64-bit integers.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda x, y: list_reduce(list_prepend(xor(x, y), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, 3988292384::BIGINT * (v & 1)))), 4294967295::BIGINT)"""

OP4 = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents
), g AS (
  SELECT bare, count(*) AS group_size FROM t GROUP BY bare
), k AS (
  SELECT bare, doc_id AS keep_id FROM t
  QUALIFY row_number() OVER (PARTITION BY bare ORDER BY points DESC, doc_id NULLS LAST) = 1
)
SELECT t.doc_id, k.keep_id, g.group_size, t.doc_id = k.keep_id AS kept, sha256(t.bare) AS text_sha256
FROM t JOIN g ON t.bare = g.bare JOIN k ON t.bare = k.bare
"""


OP11 = rf"""
WITH t AS (
  SELECT conv_id AS c, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS turn_hash,
    len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS words, turn
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, turn_hash) AS pos, turn_hash, words FROM t
), convs AS (
  SELECT v.c, v.h, least(v.h, coalesce(b.n, 0)) AS k, v.base
  FROM (SELECT c, {CRC32.format("c")} % 4 AS h, c - c % 20 AS base FROM own GROUP BY c) v
  LEFT JOIN (SELECT c, count(*) AS n FROM own GROUP BY c) b ON b.c = v.base
), turns AS (
  SELECT c, 0 AS d, '' AS turn_hash, 0 AS words FROM convs
  UNION ALL
  SELECT v.c, b.pos, b.turn_hash, b.words FROM convs v JOIN own b ON b.c = v.base AND b.pos <= v.h
  UNION ALL
  SELECT v.c, v.k + o.pos - v.h, o.turn_hash, o.words FROM convs v JOIN own o ON o.c = v.c AND o.pos > v.h
), member AS (
  SELECT c, d, words, sha256(string_agg(turn_hash, ',') OVER (PARTITION BY c ORDER BY d)) AS k, d = max(d) OVER (PARTITION BY c) AS ends FROM turns
), up AS (
  SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS parent FROM member
), node AS (
  SELECT k, d, min(c) AS c, count(*) AS n, any_value(words) AS words, any_value(parent) AS parent,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM up GROUP BY k, d
), child AS (
  SELECT parent AS k, count(*) AS n FROM node WHERE parent IS NOT NULL GROUP BY parent
), below AS (
  SELECT m.k, sum((v.n - 1) * v.words) AS saved, count(*) FILTER (WHERE h.k IS NULL) AS leaves
  FROM node v JOIN member m ON m.c = v.c AND m.d <= v.d LEFT JOIN child h ON h.k = v.k GROUP BY m.k
)
SELECT v.c AS conv_id, v.d::BIGINT AS depth, p.c AS parent_conv_id, v.n AS n_convs, coalesce(h.n, 0) AS n_children, b.leaves AS n_leaves,
  b.saved::BIGINT AS saved_tokens, v.ends_sha256
FROM node v JOIN below b ON b.k = v.k LEFT JOIN child h ON h.k = v.k LEFT JOIN node p ON p.k = v.parent
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


OP12 = f"""
WITH RECURSIVE t AS (
  SELECT row_number() OVER () AS r, doc_id, lang, {_leaf("text")} AS leaf,
    CASE WHEN {CRC32.format("doc_id")} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents
), placed AS (
  SELECT *, coalesce('1' || lang, '0') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n FROM t
), low AS (
  SELECT tree, 0 AS lvl, i, leaf AS node, n FROM placed
  UNION ALL
  SELECT tree, lvl + 1, i // 8, sha256(string_agg(node, '' ORDER BY i)), (n + 7) // 8 FROM low WHERE n > 1 GROUP BY tree, lvl, i // 8, n
), sub AS (
  SELECT tree, lvl AS depth, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1
), high AS (
  SELECT 0 AS lvl, i, subroot AS node, n FROM sub
  UNION ALL
  SELECT lvl + 1, i // 8, sha256(string_agg(node, '' ORDER BY i)), (n + 7) // 8 FROM high WHERE n > 1 GROUP BY lvl, i // 8, n
), steps AS (
  SELECT p.r, l.lvl, l.node, l.i < p.i // power(8, l.lvl)::BIGINT AS earlier, l.i AS place
  FROM placed p JOIN low l ON l.tree = p.tree AND l.n > 1 AND l.i // 8 = p.i // power(8, l.lvl + 1)::BIGINT
  WHERE l.i <> p.i // power(8, l.lvl)::BIGINT
  UNION ALL
  SELECT p.r, s.depth + h.lvl, h.node, h.i < s.i // power(8, h.lvl)::BIGINT, h.i
  FROM placed p JOIN sub s ON s.tree = p.tree JOIN high h ON h.n > 1 AND h.i // 8 = s.i // power(8, h.lvl + 1)::BIGINT
  WHERE h.i <> s.i // power(8, h.lvl)::BIGINT
), proof AS (
  SELECT r, lvl, coalesce(string_agg(node, '' ORDER BY place) FILTER (WHERE earlier), '') AS l, coalesce(string_agg(node, '' ORDER BY place) FILTER (WHERE NOT earlier), '') AS h
  FROM steps GROUP BY r, lvl
), whole AS (
  SELECT r, string_agg(l || h, '' ORDER BY lvl) AS siblings FROM proof GROUP BY r
), height AS (
  SELECT p.r, s.subroot, s.depth + (SELECT max(lvl) FROM high) AS levels FROM placed p JOIN sub s ON s.tree = p.tree
), folded AS (
  SELECT r, 0 AS lvl, coalesce(changed, leaf) AS node FROM placed
  UNION ALL
  SELECT f.r, f.lvl + 1, sha256(coalesce(p.l, '') || f.node || coalesce(p.h, ''))
  FROM folded f JOIN height g ON g.r = f.r AND f.lvl < g.levels LEFT JOIN proof p ON p.r = f.r AND p.lvl = f.lvl
)
SELECT p.doc_id, p.leaf, g.subroot, o.node AS root, sha256(coalesce(w.siblings, '')) AS proof_sha256, f.node AS folded_root, f.node = o.node AS verified
FROM placed p JOIN height g ON g.r = p.r JOIN folded f ON f.r = p.r AND f.lvl = g.levels JOIN high o ON o.n = 1 LEFT JOIN whole w ON w.r = p.r
"""


def queries() -> dict[str, Query]:
    return {
        "op1_sharding": op1_sharding,
        "op2_quality_crf": op2_quality_crf,
        "op3_language": op3_language,
        "op4_exact_dedup": op4_exact_dedup,
        "op5_mixing": op5_mixing,
        "op6_simhash": op6_simhash,
        "op7_bpe": op7_bpe,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_quality_rules": op9_quality_rules,
        "op10_surrogates": op10_surrogates,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_merkle": op12_merkle,
        "op13_context_mixing": op13_context_mixing,
        "pipeline": pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    stated = {"op4_exact_dedup": OP4, "op11_prefix_trie": OP11, "op12_merkle": OP12}
    if pipeline.ORACLE_SQL:
        stated["pipeline"] = pipeline.ORACLE_SQL
    return stated
