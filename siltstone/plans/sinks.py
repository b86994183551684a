"""Queries through files and streams: what is written comes back whole."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import urls
from ..operators import assemble
from ..sources import files, pages, recorded, stages
from ..sources.shared import shared_dir
from ..streaming import state
from .registry import STRIP, query
from .training import SPLIT


#: Files of a folder of an own tree.
FOLDER = 50_000


def _folder(df) -> str:
    return f"{shared_dir(df.sparkSession)}/siltstone-sink-{uuid.uuid4().hex}"


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def jsonl_round_trip(load):
    """Documents as JSON lines, one folder of which is ignored, gathered again."""
    docs, at = load("documents"), _folder(load("documents"))
    files.write_jsonl(docs, f"{at}/kept")
    files.write_jsonl(docs.limit(1), f"{at}/logs/old")
    return files.gather_jsonl(docs.sparkSession, at, docs.schema, ignore=("logs",))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 1")
def json_combined(load):
    """The objects of JSON lists below the chosen folders; other items, and files elsewhere, are left out."""
    nations, at = load("nation"), _folder(load("nation"))
    item = F.to_json(F.struct("n_nationkey", "n_name"))
    lists = nations.groupBy("n_regionkey").agg(F.concat(F.lit('[1, "x", '), F.array_join(F.collect_list(item), ", "), F.lit(", [2]]")).alias("value"))
    for folder, rows in (("qa", "n_regionkey <> 1"), ("logs", "n_regionkey = 1")):
        lists.where(rows).select("n_regionkey", "value").write.partitionBy("n_regionkey").option("compression", "none").text(f"{at}/{folder}")
    return files.combine_json(nations.sparkSession, at, "n_nationkey int, n_name string", ("qa",), "*.txt")


@query(f"WITH {SPLIT} SELECT doc_id, source, split FROM s WHERE split = 'val'")
def published_split(load):
    """The published validation rows, loaded in a seeded order."""
    rows, at = assemble.stratified_split(load("documents").select("doc_id", "source"), "source", "doc_id", 0.13, "split"), _folder(load("documents"))
    files.publish(rows, at)
    return files.load_split(rows.sparkSession, at, "val", "seed").select("doc_id", "source", "split")


@query(f"SELECT doc_id, sha256({STRIP.format('text')}) AS text_hash, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 2 END AS round FROM documents")
def cached_stage(load):
    """A stage run on a third of the documents, then on all: only what it lacks is computed the second time."""
    from ..functions.keys import text_hash

    docs, at = load("documents"), _folder(load("documents"))
    stage = files.Stage(docs.sparkSession, at, "doc_id")
    compute = lambda n: lambda rows: rows.select("doc_id", text_hash(F.col("text")).alias("text_hash"), F.lit(n).alias("round"))
    stage.run(docs.where("doc_id % 3 = 0"), compute(1))
    return stage.run(docs, compute(2))


@query("SELECT DISTINCT event_id, event_type, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS round FROM events")
def ingested_stream(load):
    """Events read as a stream into a table, which holds the even ones before."""
    events, at = load("events").select("event_id", "event_type"), _folder(load("events"))
    spark = events.sparkSession
    events.write.parquet(f"{at}/in")
    events.where("event_id % 2 = 0").withColumn("round", F.lit(1)).write.parquet(f"{at}/out")
    stream = spark.readStream.schema(events.schema).parquet(f"{at}/in")
    state.ingest(stream, "event_id", f"{at}/out", lambda rows: rows.withColumn("round", F.lit(2)), f"{at}/offsets").awaitTermination()
    return spark.read.parquet(f"{at}/out")


@query(
    """SELECT page_id, body, status FROM (SELECT page_id, url, html AS body, 200 AS status FROM pages WHERE NOT regexp_matches(lower(url), '\\.(css|js|png|jpg|jpeg|gif|svg|ico|webp|atom)([?#]|$)'))"""
)
def fetched_pages(load):
    """Every page through a fetcher that knows the snapshot's addresses; suffixes that are never fetched are left out. An address is asked for once, however many pages have it."""
    own = load("pages")
    got = pages.fetched(own.select("url").distinct(), lambda u: (200, "text/html", u))
    return got.join(own, "url").select("page_id", F.when(F.col("body") == F.col("url"), F.col("html")).alias("body"), "status")


@query("SELECT s_suppkey::VARCHAR AS code, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE s_suppkey || ' - none' END AS body FROM supplier")
def placeholder_rows(load):
    codes = load("supplier").select(F.col("s_suppkey").cast("string").alias("code"))
    known = load("supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("body"))
    return pages.placeholders(codes, known, "none")


def _steps():
    """Cleaned texts, their hashes, a count of each source, and a report that reads the first two."""
    from ..functions.keys import strip, text_hash

    clean = lambda t: t["documents"].select("doc_id", "source", strip(F.col("text")).alias("text"))
    hashed = lambda t: t["cleaned"].select("doc_id", "source", text_hash(F.col("text")).alias("hash"))
    by_source = lambda t: t["hashed"].groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.max("hash").alias("top"))
    report = lambda t: t["cleaned"].select("doc_id", F.length("text").alias("size")).join(t["hashed"].select("doc_id", "hash"), "doc_id").select("doc_id", "size", "hash")
    return [
        stages.Step("report", "doc_id", {"cleaned": "doc_id", "hashed": "doc_id"}, report),
        stages.Step("by_source", "source", {"hashed": "source"}, by_source),
        stages.Step("hashed", "doc_id", {"cleaned": "doc_id"}, hashed),
        stages.Step("cleaned", "doc_id", {"documents": "doc_id"}, clean),
    ]


@query(
    """WITH d AS (SELECT doc_id, source, doc_id % 100 = 0 AS changed, doc_id % 100 = 50 AS padded, doc_id % 100 = 75 AS fresh FROM documents WHERE doc_id IS NOT NULL)
    SELECT 'cleaned' AS stage, doc_id::VARCHAR AS key, CASE WHEN changed OR padded OR fresh THEN 2 ELSE 1 END AS round FROM d
    UNION ALL SELECT unnest(['hashed', 'report']), doc_id::VARCHAR, CASE WHEN changed OR fresh THEN 2 ELSE 1 END FROM d
    UNION ALL SELECT 'by_source', source, CASE WHEN bool_or(changed OR fresh) THEN 2 ELSE 1 END FROM d WHERE source IS NOT NULL GROUP BY source"""
)
def staged_rounds(load):
    """The run that worked out each row of a graph of stages: before the second, some texts changed, some only in white space around them, some came in."""
    docs = load("documents").select("doc_id", "source", "text")
    graph = stages.Graph(docs.sparkSession, _folder(docs), _steps())
    odd = F.col("doc_id") % 100
    old = F.when(odd == 0, F.concat(F.lit("old "), F.coalesce("text", F.lit("")))).when(odd == 50, F.concat(F.lit(" "), "text", F.lit("\n"))).otherwise(F.col("text"))
    graph.run({"documents": docs.where(odd != 75).withColumn("text", old)})
    graph.run({"documents": docs})
    parts = [graph.table(n).select(F.lit(n).alias("stage"), F.col(graph.steps[n].key).cast("string").alias("key"), F.col("_round").alias("round")) for n in graph.order]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("SELECT doc_id, n_chars, CASE WHEN doc_id // 50 % 3 = 0 THEN 2 ELSE 1 END AS round FROM documents")
def batches_written_again(load):
    """Batches of fifty ids as files named by their keys; a second run writes every third batch again."""
    docs, at = load("documents").select("doc_id", "n_chars", F.expr("doc_id div 50").alias("batch_no")), _folder(load("documents"))
    files.write_batches(docs.withColumn("round", F.lit(1)), at, "batch_no", "doc_id")
    files.write_batches(docs.where("batch_no % 3 = 0").withColumn("round", F.lit(2)), at, "batch_no", "doc_id")
    return files.gather_jsonl(docs.sparkSession, at, "doc_id long, n_chars long, round int")


@query(
    """SELECT lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) AS dir, page_id || '.html' AS name, strlen(html) AS length, sha256(html) AS body, url AS original_url, CASE WHEN page_id % 2 = 0 THEN 'from ' || page_id END AS source_page_url
    FROM pages WHERE page_id % 5 > 0 AND strlen(html) > 2000"""
)
def recorded_round_trip(load):
    """Pages as files with their records, some with another suffix, read again by suffix and length."""
    own, at = load("pages"), _folder(load("pages"))
    name = F.concat("page_id", F.when(F.col("page_id") % 5 == 0, ".txt").otherwise(".html"))
    rows = own.select(F.concat_ws("/", urls.host(F.col("url")), name).alias("path"), F.encode("html", "utf-8").alias("content"), F.col("url").alias("original_url"), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("from "), "page_id")).alias("source_page_url"))
    recorded.record(rows.select("path", "content", "original_url", "source_page_url"), at)
    got = recorded.recorded(own.sparkSession, at).where("ext = '.html' AND length > 2000")
    return got.select("dir", F.substring_index("path", "/", -1).alias("name"), "length", F.sha2(F.col("content"), 256).alias("body"), "original_url", "source_page_url")


@query(
    """SELECT source || '/' || doc_id AS name, strlen(text) AS length, CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN CASE WHEN length(text) > 2000 THEN '' ELSE trim(text) END ELSE text END AS text
    FROM documents WHERE strlen(text) > 0 AND source IS NOT NULL AND doc_id % 4 < 3"""
)
def extracted_tree(load):
    """Documents as a tree of files of four kinds: one is not looked for, one has no reader, long papers are left empty. Folders hold about ``FOLDER`` files, and one of them is listed at a time."""
    docs, at = load("documents").where("source IS NOT NULL"), _folder(load("documents"))
    kind = F.element_at(F.array(F.lit(".bin"), F.lit(".pdf"), F.lit(".Txt"), F.lit(".log")), (F.col("doc_id") % 4 + 1).cast("int"))
    part = F.pmod(F.xxhash64("source", "doc_id"), F.lit(-(-docs.count() // FOLDER) or 1)).cast("string")
    recorded.record(docs.select(F.concat(part, F.lit("/"), "source", F.lit("/"), "doc_id", kind).alias("path"), F.encode("text", "utf-8").alias("content")), at)
    name = F.regexp_extract("path", r"([^/]+/[^/]+)\.[^./]*$", 1)
    texts = lambda tree: files.extract_text(tree, 2000, lambda b: b.decode(), keep=("length",)).select(name.alias("name"), "length", "text")
    return files.by_folder(docs.sparkSession, files.Config(at, extensions=(".bin", ".pdf", ".txt")), texts, f"{at}-texts")
