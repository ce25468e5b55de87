"""Registered queries of the conversation trie, the structure repair and the shingle Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from grove.llm import jaccard_join, prefix_trie, register, repair
from grove.llm.common import read


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of an ASCII text, bit by bit (DuckDB has no such function)."""
    byte = f"ascii({text}[i // 8 + 1])"
    step = "xor({x} >> 1, CASE WHEN ({x} & 1) = 1 THEN 3988292384 ELSE 0 END)"
    first = step.format(x=f"xor(c, {byte})")
    return f"xor(list_reduce(range(8 * strlen({text})), lambda c, i: CASE WHEN i % 8 = 0 THEN {first} ELSE {step.format(x='c')} END, 4294967295::BIGINT), 4294967295)"


OP11_SQL = f"""WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS position,
  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
 ids AS (SELECT conv_id, max(position) AS length FROM t GROUP BY conv_id),
 w AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {crc32_sql('CAST(conv_id AS VARCHAR)')} % 9 AS h FROM ids),
 wl AS (SELECT w.*, least(h, coalesce(b.length, 0)) AS taken FROM w LEFT JOIN ids b ON b.conv_id = w.base),
 r AS (SELECT wl.conv_id, t.position, t.role, t.text FROM wl JOIN t ON t.conv_id = wl.base AND t.position <= wl.h
  UNION ALL SELECT wl.conv_id, t.position - wl.h + wl.taken, t.role, t.text FROM wl JOIN t ON t.conv_id = wl.conv_id AND t.position > wl.h),
 rl AS (SELECT i.conv_id, count(r.position) AS len FROM ids i LEFT JOIN r ON r.conv_id = i.conv_id GROUP BY i.conv_id),
 p AS (SELECT conv_id, position AS depth, octet_length(encode(text)) AS bytes,
  string_agg(md5(role) || md5(text), '' ORDER BY position) OVER (PARTITION BY conv_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix FROM r),
 paths AS (SELECT conv_id, 0 AS depth, '' AS prefix, 0 AS bytes FROM ids UNION ALL SELECT conv_id, depth, prefix, bytes FROM p),
 nodes AS (SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM paths GROUP BY depth, prefix),
 kids AS (SELECT a.depth, a.prefix, count(b.prefix) AS n_children FROM nodes a LEFT JOIN nodes b ON b.depth = a.depth + 1 AND starts_with(b.prefix, a.prefix)
  GROUP BY a.depth, a.prefix),
 nk AS (SELECT n.*, k.n_children FROM nodes n JOIN kids k USING (depth, prefix)),
 sub AS (SELECT a.depth, a.prefix, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.bytes) AS saved_tokens
  FROM nk a JOIN nk b ON b.depth >= a.depth AND starts_with(b.prefix, a.prefix) GROUP BY a.depth, a.prefix),
 ends AS (SELECT p.depth, p.prefix, string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) AS e FROM paths p JOIN rl ON rl.conv_id = p.conv_id AND rl.len = p.depth
  GROUP BY p.depth, p.prefix)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, par.conv_id AS parent_conv_id, CAST(f.n_convs AS BIGINT) AS n_convs,
 CAST(f.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
 sha256(coalesce(e.e, '')) AS ends_sha256
FROM nk f JOIN sub s USING (depth, prefix) LEFT JOIN ends e USING (depth, prefix)
 LEFT JOIN nodes par ON par.depth = f.depth - 1 AND par.prefix = left(f.prefix, 64 * (f.depth - 1))"""


@register("op11_prefix_trie", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations, one row per node."""
    return prefix_trie.trie(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


@register("op12_structure_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of every damaged conversation."""
    return repair.audit_conversations(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


@register("op13_jaccard_join")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under 3-word shingle sets linked at a Jaccard likeness of 0.9 or more."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return jaccard_join.jaccard_components(docs, words=3, percent=90).select("doc_id", "n_shingles", "component_id", "n_links")
