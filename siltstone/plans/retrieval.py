"""Retrieval queries over embeddings and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assemble, neighbours, retrieve
from ..sources.shared import written
from .registry import query, uniform

SCORES = """s AS (SELECT q.vec_id AS query, c.vec_id AS item,
  round(list_dot_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS score
  FROM embeddings q, embeddings c WHERE q.vec_id % 50 = 0)"""


def _queries(load):
    """The stated query set: every vector whose id divides by 50."""
    return load("embeddings").where("vec_id % 50 = 0")


@query(f"WITH {SCORES}, r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, item)::INT AS rank FROM s) SELECT * FROM r WHERE rank <= 10")
def retrieve_topk(load):
    return retrieve.top_k(_queries(load), load("embeddings"), 10)


@query(
    f"""WITH {SCORES}, r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, item) AS w FROM s),
    k AS (SELECT query, item, score FROM r WHERE w <= 10 AND query <> item)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, item)::INT AS rank FROM k) WHERE rank <= 4"""
)
def retrieve_topk_excluding_golden(load):
    q = _queries(load)
    golden = q.select(F.col("vec_id").alias("query"), F.col("vec_id").alias("item"))
    return retrieve.excluding(retrieve.top_k(q, load("embeddings"), 10), golden, 4, 1)


@query(f"WITH {SCORES}, r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score, item)::INT AS rank FROM s) SELECT * FROM r WHERE rank <= 5")
def distractors_tail(load):
    return retrieve.tail_k(_queries(load), load("embeddings"), 5)


@query(
    f"""WITH p AS (SELECT source AS grp, doc_id AS id, row_number() OVER (PARTITION BY source ORDER BY {uniform('pad', 'doc_id')}, doc_id) - 1 AS r,
      count(*) OVER (PARTITION BY source) AS n FROM documents)
    SELECT a.grp, a.id, s.step::INT AS step, b.id AS other FROM p a, range(1, 5) s(step), p b
    WHERE s.step < a.n AND b.grp = a.grp AND b.r = (a.r + s.step) % a.n"""
)
def distractors_random_pad(load):
    return retrieve.pad_random(load("documents"), "source", "doc_id", 4, "pad")


@query("SELECT label, count(*) AS n, string_agg(vec_id::VARCHAR, ',' ORDER BY vec_id) AS members FROM embeddings GROUP BY label HAVING count(*) >= 2")
def min_cluster(load):
    g = load("embeddings").groupBy("label").agg(F.sort_array(F.collect_list("vec_id")).alias("docs"))
    return g.where(F.size("docs") >= 2).select("label", F.size("docs").cast("long").alias("n"), F.array_join(F.transform("docs", lambda x: x.cast("string")), ",").alias("members"))


@query(
    f"""WITH {SCORES}, r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, item) AS rank FROM s),
    l AS (SELECT query, list(item ORDER BY rank) AS items FROM r WHERE rank <= 5 GROUP BY query)
    SELECT query, len(list_filter([1, 3, 9], lambda i: i <= len(items))) AS n_valid, items[1] AS first_doc, items[3] AS third_doc FROM l"""
)
def ordinal_lookup(load):
    top = retrieve.top_k(_queries(load), load("embeddings"), 5)
    rows = top.groupBy("query").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "item"))), lambda x: x["item"]).alias("items"))
    picks = F.filter(F.array(F.lit(1), F.lit(3), F.lit(9)), lambda i: (i >= 1) & (i <= F.size("items")))
    return rows.select("query", F.size(picks).cast("long").alias("n_valid"), F.get("items", F.lit(0)).alias("first_doc"), F.get("items", F.lit(2)).alias("third_doc"))


_POOL = f"""d AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {uniform('pad', 'doc_id')}, doc_id) - 1 AS r,
  count(*) OVER (PARTITION BY source) AS n FROM documents),
o AS (SELECT a.doc_id, b.doc_id AS other FROM d a, range(1, 5) s(step), d b WHERE s.step < a.n AND b.source = a.source AND b.r = (a.r + s.step) % a.n),
g AS (SELECT d.doc_id, count(o.other) AS k FROM d LEFT JOIN o USING (doc_id) GROUP BY 1),
p AS (SELECT doc_id, {uniform('ctx-golden', 'doc_id')} < 0.8 OR k = 0 AS present, k FROM g),
m AS (SELECT doc_id, other AS d FROM o UNION ALL SELECT doc_id, doc_id FROM p WHERE present),
s AS (SELECT doc_id, d, row_number() OVER (PARTITION BY doc_id ORDER BY sha256('ctx|' || doc_id || '|' || d)) - 1 AS i FROM m)"""


def _assembled(load):
    pads = retrieve.pad_random(load("documents"), "source", "doc_id", 4, "pad").groupBy("id").agg(F.collect_list("other").alias("others"))
    rows = load("documents").select("doc_id").join(pads.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    rows = rows.withColumn("others", F.coalesce("others", F.array().cast("array<bigint>")))
    return rows.withColumns(assemble.assembled(F.col("doc_id"), F.col("others"), F.col("doc_id"), 0.8, "ctx"))


@query(
    f"""WITH {_POOL} SELECT p.doc_id, p.present AS golden_present, coalesce((SELECT s.i FROM s WHERE s.doc_id = p.doc_id AND s.d = p.doc_id), -1)::INT AS golden_index,
    p.k::INT AS num_distractors FROM p"""
)
def golden_inclusion(load):
    return _assembled(load).select("doc_id", "golden_present", "golden_index", F.size("others").alias("num_distractors"))


@query(
    f"""WITH {_POOL} SELECT s.doc_id, sha256(string_agg('<DOCUMENT>' || t.text || '</DOCUMENT>' || chr(10), '' ORDER BY s.i)) AS context_sha256
    FROM s JOIN documents t ON t.doc_id = s.d GROUP BY s.doc_id"""
)
def context_assembly(load):
    rows = _assembled(load).select("doc_id", F.posexplode("docs").alias("i", "d"))
    texts = load("documents").select(F.col("doc_id").alias("d"), "text")
    docs = rows.join(texts, "d").groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "text"))), lambda x: x["text"]).alias("texts"))
    return docs.select("doc_id", F.sha2(assemble.context(F.col("texts")), 256).alias("context_sha256"))


@query(
    f"""WITH {SCORES}, r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, item) AS rank FROM s), g AS (SELECT query, string_agg(item::VARCHAR, ',' ORDER BY rank) AS golden FROM r WHERE rank <= 3 GROUP BY query)
    SELECT vec_id, label, golden FROM embeddings JOIN g ON vec_id = query"""
)
def golden_join(load):
    """Seeds with the golden documents that an earlier step stored for them."""
    top = retrieve.top_k(_queries(load), load("embeddings"), 3)
    stored = top.groupBy(F.col("query").alias("vec_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "item"))), lambda x: x["item"].cast("string")), ",").alias("golden"))
    return retrieve.with_golden(load("embeddings").select("vec_id", "label"), stored, "vec_id")


@query(
    """WITH s AS (SELECT q.vec_id AS query, c.vec_id AS item, round(list_dot_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS score FROM embeddings q, embeddings c),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, item)::INT AS rank FROM s) SELECT * FROM r WHERE rank <= 6"""
)
def all_neighbours(load):
    """The nearest vectors of every vector, by cells."""
    return neighbours.knn_join(load("embeddings"), 6, lambda df: written(df, "cells")).found
