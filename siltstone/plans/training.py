"""Queries that assemble training sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assemble
from ..operators.rank import row_numbers
from .registry import query, uniform

SPLIT = f"""n AS (SELECT doc_id, source, count(*) OVER (PARTITION BY source) AS n, row_number() OVER (PARTITION BY source ORDER BY {uniform('split', 'doc_id')}, doc_id) AS r FROM documents),
v AS (SELECT *, greatest(0, least(floor(n * 0.13::DOUBLE) + CASE WHEN {uniform('split-frac', 'source')} < n * 0.13::DOUBLE - floor(n * 0.13::DOUBLE) THEN 1 ELSE 0 END, n - 1)) AS k FROM n),
s AS (SELECT doc_id, source, CASE WHEN r <= n - k THEN 'train' ELSE 'val' END AS split FROM v)"""


def _split(load):
    return assemble.stratified_split(load("documents").select("doc_id", "source"), "source", "doc_id", 0.13, "split")


@query(f"WITH {SPLIT} SELECT * FROM s")
def stratified_split(load):
    return _split(load)


@query(f"WITH {SPLIT} SELECT split, source, count(*) AS n FROM s GROUP BY ROLLUP (split, source)")
def split_summary(load):
    return _split(load).rollup("split", "source").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT key, array_to_string(list_slice(string_split(key, '_'), 1, 2), '_') AS origin, array_to_string(list_slice(string_split('raft_' || key, '_'), 1, 3), '_') AS derived_origin "
    "FROM (SELECT 'chunk_' || substr(sha256(source), 1, 12) || '_' || doc_id AS key FROM documents)"
)
def origin_keys(load):
    key = F.concat(F.lit("chunk_"), F.substring(F.sha2("source", 256), 1, 12), F.lit("_"), "doc_id")
    rows = load("documents").select(key.alias("key"))
    return rows.select("key", assemble.origins(F.col("key")).alias("origin"), assemble.origins(F.concat(F.lit("raft_"), "key"), True).alias("derived_origin"))


_PLAIN = "SELECT doc_id, i, {s} AS style FROM r WHERE NOT c AND {w}"


@query(
    f"""WITH r AS (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, lang <> 'en' AS c FROM documents),
    x AS (SELECT doc_id, i, 'naturalistic' AS style FROM r WHERE NOT c AND i % 4 <> 0 UNION ALL SELECT doc_id, i, 'casual' FROM r WHERE NOT c AND (i + 1) % 5 <> 0
      UNION ALL SELECT doc_id, i, 'formal' FROM r WHERE NOT c AND (i + 2) % 4 <> 0 UNION ALL SELECT doc_id, i, 'multi-hop' FROM r WHERE NOT c
      UNION ALL SELECT doc_id, i, 'multi-hop-unanswerable' FROM r WHERE NOT c AND i % 2 = 0
      UNION ALL SELECT doc_id, i, CASE WHEN i % 3 = 0 THEN 'multi-hop' ELSE ['naturalistic', 'casual', 'formal'][(floor({uniform('style', 'i')} * 3) + 1)::INT] END FROM r WHERE c
      UNION ALL SELECT doc_id, i, 'multi-hop-unanswerable' FROM r WHERE c AND (i + 1) % 6 = 0)
    SELECT doc_id, i::INT AS i, style, it::INT AS iteration, 'chunk_' || doc_id || '_' || style || '_' || it AS styled_hash FROM x, range(0, 2) t(it)"""
)
def style_schedule(load):
    rows = row_numbers(load("documents").select("doc_id", "lang", "source"), "source", "i", ["doc_id"])
    out = assemble.style_schedule(rows.select("doc_id", F.col("i").cast("int").alias("i"), "lang"), "i", F.col("lang") != "en", iterations=2)
    key = assemble.styled_key(F.concat(F.lit("chunk_"), "doc_id"), F.col("style"), F.col("iteration"))
    return out.select("doc_id", "i", "style", "iteration", key.alias("styled_hash"))


@query(
    "SELECT origin, count(*) AS n, min(key) AS first, max(key) AS last, count(DISTINCT lang) AS langs FROM (SELECT lang, key, array_to_string(list_slice(string_split(key, '_'), 1, 2), '_') AS origin "
    "FROM (SELECT lang, 'chunk_' || substr(sha256(source), 1, 12) || '_' || doc_id AS key FROM documents)) GROUP BY origin"
)
def origin_groups(load):
    """What the pairs of each origin have in common."""
    key = F.concat(F.lit("chunk_"), F.substring(F.sha2("source", 256), 1, 12), F.lit("_"), "doc_id")
    rows = load("documents").select("lang", key.alias("key")).withColumn("origin", assemble.origins(F.col("key")))
    return rows.groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first"), F.max("key").alias("last"), F.count_distinct("lang").alias("langs"))
