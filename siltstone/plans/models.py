"""Queries on the model-backed steps with the offline stub, whose replies SQL can work out from the same prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chunks, generate, history
from .registry import STRIP, query


def _prompt(contract: str, body: str, **context: str) -> str:
    """SQL for a prompt; context values must not be empty."""
    named = "".join(f" || '{k.upper()}: ' || {v} || chr(10)" for k, v in context.items())
    return f"('{generate.CONTRACTS[contract]}' || chr(10) || 'FORMAT: {contract}' || chr(10){named} || 'INPUT:' || chr(10) || {body})"


def _mark(prompt: str) -> str:
    return f"substr(sha256({prompt}), 1, 8)"


BODY = STRIP.format("text")
QUOTED = "'<REASON>From the text: <quote>' || substr({0}, 1, 80) || '</quote></REASON><ANSWER>' || {1} || '</ANSWER>'"
BATCHES = """n AS (SELECT doc_id, source, text, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 5 AS b FROM documents),
  p AS (SELECT *, row_number() OVER (PARTITION BY source, b ORDER BY doc_id) AS i FROM n)"""


def _batched(load):
    """batch, docs: five documents of a source at a time."""
    own = chunks.batches(load("documents"), "source", "doc_id", 5).select(F.concat_ws("/", "source", "batch").alias("batch"), F.posexplode("keys").alias("i", "doc_id"))
    rows = own.join(load("documents").select("doc_id", "text"), "doc_id")
    return rows.groupBy("batch").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "text"))), lambda x: x["text"]).alias("docs"))


@query(
    f"""WITH {BATCHES}, q AS (SELECT source, b, {_mark(_prompt('questions', "string_agg('[' || i || '] ' || text, chr(10) ORDER BY i)"))} AS h, count(*) AS n FROM p GROUP BY source, b),
    a AS (SELECT source, b, h, {_mark(_prompt('answers', "string_agg('[' || i || '] Question ' || i || ' (' || h || ')?', chr(10) ORDER BY i)"))} AS ha FROM p JOIN q USING (source, b) GROUP BY source, b, h)
    SELECT source || '/' || b AS batch, (i - 1)::INT AS pos, sha256(text) AS doc_sha256, 'Question ' || i || ' (' || h || ')?' AS question, 'Answer ' || i || ' (' || ha || ').' AS answer FROM p JOIN a USING (source, b)"""
)
def default_pairs(load):
    got = generate.default_pairs(_batched(load), "batch", "docs")
    return got.select("batch", "pos", F.sha2("doc", 256).alias("doc_sha256"), "question", "answer")


@query(
    f"""WITH {BATCHES} SELECT source || '/' || b AS batch, 'What links them (' || {_mark(_prompt('multihop', "string_agg('[' || i || '] ' || text, chr(10) ORDER BY i)"))} || ')?' AS question, sha256(string_agg(text, '|' ORDER BY i)) AS chosen_sha256
    FROM p GROUP BY source, b HAVING count(*) >= 2"""
)
def multihop_question(load):
    got = generate.multihop_question(_batched(load), "batch", "docs")
    return got.select("batch", "question", F.sha2(F.array_join("chosen", "|"), 256).alias("chosen_sha256"))


@query(
    f"""WITH {BATCHES} SELECT source || '/' || b AS batch, 'What is not said about it (' || {_mark(_prompt('unanswerable', "string_agg('[' || i || '] ' || text, chr(10) ORDER BY i)", entity="source"))} || ')?' AS question
    FROM p GROUP BY source, b"""
)
def unanswerable_question(load):
    return generate.unanswerable_question(_batched(load), "batch", F.substring_index("batch", "/", 1), "docs")


@query(f"SELECT doc_id, ltrim(substr(string_split({BODY}, chr(10))[1], 1, 120), '*- ') AS styled_question FROM documents WHERE {BODY} <> ''")
def styled_question(load):
    rows = load("documents").where(F.btrim("text", F.lit(" \n\t\r")) != "")
    return generate.styled_question(rows, "doc_id", F.col("lang"), F.col("text"), F.lit(""))


@query(f"SELECT doc_id, {QUOTED.format(BODY, _mark(_prompt('tagged', 'text', question='source')))} AS reply, NULL::VARCHAR AS error FROM documents")
def reasoned_answer(load):
    return generate.reasoned_answer(load("documents"), "doc_id", F.col("source"), F.col("text")).select("doc_id", "reply", "error")


_FIRST = "'{\"qa_pairs\": [{\"question\": \"Question 1 (' || " + _mark(_prompt("qa_pairs", "text")) + " || ')?\", \"answer\": \"Answer 1.\", \"topics\": null, \"course\": null}]}'"


@query(f"SELECT doc_id, 'Question 1 (' || {_mark(_prompt('qa_pairs', 'text', previous=_FIRST))} || ')?' AS question, 'Answer 1.' AS answer FROM documents")
def extract_faq(load):
    return generate.extract_faq(load("documents"), "doc_id", "text").select("doc_id", "question", "answer")


@query(f"SELECT doc_id, 'Question 1 (' || {_mark(_prompt('qa_pairs', 'text'))} || ')?' AS question, 'Answer 1.' AS answer FROM documents")
def component_pairs(load):
    return generate.component_pairs(load("documents"), "doc_id", "text")


@query(
    rf"""WITH s AS (SELECT doc_id, {STRIP.format('unnest(regexp_split_to_array(text, chr(10) || chr(10)))')} AS chunk, unnest(range(len(regexp_split_to_array(text, chr(10) || chr(10))))) AS pos FROM (SELECT doc_id, replace({BODY}, chr(10), chr(10) || chr(10)) AS text FROM documents)),
    c AS (SELECT doc_id, pos, chunk, substr(string_split(chunk, '.')[1], 1, 60) AS topic FROM s WHERE chunk <> '')
    SELECT doc_id::VARCHAR AS doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1)::INT AS ordinal, chunk, topic FROM c WHERE topic <> ''"""
)
def model_chunks(load):
    """Lines as the passages that a model cuts; only passages with a topic count."""
    rows = load("documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.replace(F.btrim("text", F.lit(" \n\t\r")), F.lit("\n"), F.lit("\n\n")).alias("text"))
    items = generate.chunk_texts(rows, "doc_id", "text").withColumn("part", F.lit(0))
    return chunks.chunk_rows(items, "doc_id", "part", "items").select("doc_id", "ordinal", "chunk", "topic")


@query(r"SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(t, '\b([A-Z]{3}[0-9]{4})\b'))), ',') AS codes FROM (SELECT doc_id, 'MAT' || lpad((doc_id % 10000)::VARCHAR, 4, '0') || ' ' || text || ' FIS1001' AS t FROM documents)")
def offerings_extract(load):
    text = F.concat(F.lit("MAT"), F.lpad((F.col("doc_id") % 10000).cast("string"), 4, "0"), F.lit(" "), F.col("text"), F.lit(" FIS1001"))
    got = generate.extract_offerings(load("documents").select("doc_id", text.alias("t")), "doc_id", "t")
    return got.select("doc_id", F.array_join(F.array_sort(F.map_keys("offerings")), ",").alias("codes"))


USERS = "SELECT conv_id || '/' || turn AS k, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before, role FROM conversations"


def _asked(load):
    """k, text, history: user turns with the six messages before."""
    rows = load("conversations").join(history.last_messages(load("conversations"), 6), ["conv_id", "turn"]).where("role = 'user'")
    return rows.select(F.concat_ws("/", "conv_id", "turn").alias("k"), "text", "history")


@query(f"SELECT k, CASE WHEN regexp_matches(text, '^\\s*(hi|hello|oi|ol[aá])\\b', 'i') THEN 'small_talk' ELSE 'domain_query' END AS label FROM ({USERS}) WHERE role = 'user'")
def intent(load):
    return generate.intent(_asked(load), "k", F.col("text"))


@query(f"SELECT k, CASE WHEN before IS NULL THEN text ELSE coalesce(nullif({BODY}, ''), text) END AS query FROM ({USERS}) WHERE role = 'user'")
def contextualize(load):
    return generate.contextualize(_asked(load), "k", F.col("text"), F.col("history"))


@query(f"SELECT k, trim(array_to_string(list_transform([0, 1, 2], lambda i: {BODY} || ' (' || {_mark(_prompt('variants', 'text'))} || i || ')'), chr(10)), ' ') AS expansion FROM ({USERS}) WHERE role = 'user'")
def expand_query(load):
    return generate.expand_query(_asked(load), "k", F.col("text"))


@query(f"SELECT doc_id, nullif(ltrim(substr(string_split({BODY}, chr(10))[1], 1, 120), '*- '), 'N/A') AS label FROM documents WHERE {BODY} <> ''")
def entity_label(load):
    return generate.entity_label(load("documents").where(F.btrim("text", F.lit(" \n\t\r")) != ""), "doc_id", F.col("text"))


@query(f"SELECT doc_id, sha256(coalesce(nullif({BODY}, ''), text)) AS revised_sha256 FROM documents")
def revised_text(load):
    return generate.revised_text(load("documents"), "doc_id", "text").select("doc_id", F.sha2("text", 256).alias("revised_sha256"))
