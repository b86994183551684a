"""Queries on conversations and events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import assemble, history, rank
from ..streaming import state
from .registry import STRIP, query

FLAG = "contains(lower(text), 'er')"


def _history(n):
    return f"""SELECT conv_id, turn, coalesce(string_agg(role || ': "' || text || '"', chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), '') AS history FROM conversations"""


@query(_history(6))
def history_last6(load):
    return history.last_messages(load("conversations"), 6)


@query(_history(4))
def history_last4(load):
    return history.last_messages(load("conversations"), 4)


@query(
    f"""WITH b AS (SELECT *, role = 'user' AND {FLAG} AS flagged FROM conversations WHERE {STRIP.format('text')} <> ''),
    a AS (SELECT *, lag(role) OVER w = 'user' AS replied, lag(flagged) OVER w AS asked FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    SELECT conv_id, turn, role, text FROM a WHERE NOT flagged AND NOT (role = 'assistant' AND coalesce(replied, false) AND coalesce(asked, false))"""
)
def domain_history(load):
    return history.domain_history(load("conversations"), F.lower("text").contains("er")).select("conv_id", "turn", "role", "text")


@query(
    """WITH p AS (SELECT *, role = 'user' AND lead(role) OVER w = 'assistant' AS pair, lead(text) OVER w AS reply FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    SELECT conv_id, turn, last_value(CASE WHEN pair THEN text END IGNORE NULLS) OVER v AS question, last_value(CASE WHEN pair THEN reply END IGNORE NULLS) OVER v AS answer
    FROM p WINDOW v AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) QUALIFY role = 'user'"""
)
def previous_exchange(load):
    return history.previous_exchange(load("conversations"))


@query("SELECT conv_id, turn, coalesce(string_agg(text, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS previous FROM conversations WHERE role = 'user'")
def previous_questions(load):
    return history.previous_questions(load("conversations"))


_MARK = "'<start_of_turn>' || CASE WHEN role = 'assistant' THEN 'model' ELSE role END || chr(10) || text || '<end_of_turn>'"


@query(
    f"""WITH h AS (SELECT *, string_agg({_MARK}, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS history FROM conversations WHERE role <> 'system'),
    l AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM h WHERE role = 'user')
    SELECT conv_id, concat_ws(chr(10), history, '<start_of_turn>user' || chr(10) || 'Answer from the documents.' || chr(10) || chr(10) || '<DOCUMENT>' || conv_id || '</DOCUMENT>' || chr(10) || chr(10) || text
      || '<end_of_turn>' || chr(10) || '<start_of_turn>model' || chr(10)) AS prompt FROM l WHERE r = 1"""
)
def chat_prompt(load):
    docs = F.concat(F.lit("<DOCUMENT>"), "conv_id", F.lit("</DOCUMENT>"))
    return history.chat_prompt(load("conversations"), docs, "Answer from the documents.")


@query(
    f"""SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN {STRIP.format('text')} WHEN 1 THEN coalesce(nullif({STRIP.format('text')}, ''), {STRIP.format("'<REASON>r</REASON><ANSWER>' || text")}) ELSE {STRIP.format("text")} END AS answer,
    CASE turn % 3 WHEN 2 THEN NULL ELSE 'r' END AS reason FROM conversations"""
)
def parse_response(load):
    whole = F.concat(F.lit("<REASON> r </REASON>\n<ANSWER>"), "text", F.lit("</ANSWER>"))
    open_end = F.concat(F.lit("<REASON>r</REASON><ANSWER>"), "text")
    s = F.when(F.col("turn") % 3 == 0, whole).when(F.col("turn") % 3 == 1, open_end).otherwise(F.col("text"))
    return load("conversations").select("conv_id", "turn", text.answer_of(s).alias("answer"), text.reason_of(s).alias("reason"))


@query("SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'small_talk' ELSE 'domain_query' END AS label FROM conversations")
def intent_label(load):
    s = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("Tipo:  SMALL_TALK "), "text")).otherwise(F.replace(F.lower("text"), F.lit("tipo"), F.lit("")))
    return load("conversations").select("conv_id", "turn", text.intent_label(s).alias("label"))


@query(
    """WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n FROM conversations WHERE role IN ('user', 'assistant')),
    ok AS (SELECT conv_id FROM n GROUP BY conv_id HAVING count(*) FILTER (role = 'user') = count(*) FILTER (role = 'assistant'))
    SELECT conv_id, n::INT AS n, max(text) FILTER (role = 'user') AS question, max(text) FILTER (role = 'assistant') AS answer FROM n WHERE conv_id IN (SELECT conv_id FROM ok) GROUP BY conv_id, n"""
)
def positional_zip(load):
    return history.positional_pairs(load("conversations"))


@query(
    """WITH p AS (SELECT conv_id, turn, text AS q, lead(text) OVER w AS a, lead(role) OVER w AS r, role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    SELECT conv_id, turn, 'user: ' || q || ' | assistant: ' || a AS messages, -1 AS golden_index, 'default_' || substr(sha256(conv_id || q), 1, 12) AS qa_pair_hash FROM p
    WHERE role = 'user' AND r = 'assistant' AND q <> '' AND a <> ''"""
)
def chat_messages(load):
    by = Window.partitionBy("conv_id").orderBy("turn")
    rows = load("conversations").withColumn("answer", F.lead("text").over(by)).withColumn("next", F.lead("role").over(by)).where("role = 'user' AND next = 'assistant'")
    key = assemble.pair_key(F.col("conv_id").cast("string"), F.col("text"))
    none = F.lit(None).cast("string")
    rows = rows.select(F.col("text").alias("question"), "answer", F.concat_ws("/", "conv_id", "turn").alias("file_url"), none.alias("url"), F.lit(None).cast("int").alias("golden_index"), key.alias("qa_pair_hash"))
    shown = F.array_join(F.transform("messages", lambda x: F.concat_ws(": ", x["role"], x["content"])), " | ")
    ids = F.split("url", "/")
    return assemble.chat_records(rows).select(ids[0].cast("long").alias("conv_id"), ids[1].cast("long").alias("turn"), shown.alias("messages"), "golden_index", "qa_pair_hash")


@query(f"SELECT conv_id, role = 'user' AND {STRIP.format('text')} <> '' AS valid FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) WHERE r = 1")
def request_validation(load):
    return history.valid_requests(load("conversations"))


@query("SELECT event_id, count(*) OVER w AS n_60s, 60 - (epoch(date_trunc('second', ts))::BIGINT - min(epoch(date_trunc('second', ts))::BIGINT) OVER w) AS wait_s FROM events WINDOW w AS (PARTITION BY event_type ORDER BY epoch(date_trunc('second', ts))::BIGINT RANGE BETWEEN 59 PRECEDING AND CURRENT ROW)")
def trailing_60s(load):
    s = F.unix_timestamp(F.col("ts").cast("timestamp"))
    rows = history.trailing(load("events").select("event_id", "event_type", s.alias("s")), "event_type", "s", 60)
    return rows.select("event_id", F.col("n").alias("n_60s"), (60 - (F.col("s") - F.col("first"))).alias("wait_s"))


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh, event_id FROM events),
    s AS (SELECT user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g)
    SELECT user_id, k::BIGINT AS session, count(*) AS n FROM s GROUP BY 1, 2"""
)
def session_activity(load):
    rows = rank.sessions(load("events"), "user_id", ["ts", "event_id"], F.expr("INTERVAL 30 MINUTE"), "session")
    return rows.groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_purchase FROM events"""
)
def asof_last_event(load):
    bought = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    return rank.last_before(load("events"), "user_id", ["ts", "event_id"], bought, "last_purchase").select("event_id", "last_purchase")


@query(
    """WITH w AS (SELECT event_type, (epoch(date_trunc('second', ts))::BIGINT // 10 - k) * 10 AS s FROM events, range(0, 6) t(k))
    SELECT strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS since, event_type, count(*) AS n FROM w GROUP BY s, event_type"""
)
def request_rate(load):
    """Requests in sliding minutes; ``since`` is a window's first second."""
    got = state.request_rate(load("events"), "event_type")
    return got.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("since"), "event_type", "n")


@query(f"SELECT DISTINCT conv_id, sha256({STRIP.format('text')}) AS text_hash FROM conversations WHERE role = 'user' AND {FLAG}")
def flagged_questions(load):
    return state.flagged_questions(load("conversations"), F.lower("text").contains("er"))
