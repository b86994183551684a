"""Queries on tables that are fed as streams, in several batches."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources.shared import shared_dir
from ..streaming import processors
from .registry import STRIP, query


def _fed(parts, schema, at: str, run):
    """What ``run`` makes of a stream of tables, through files of the shared folder: it goes on with each, as a batch of its own, once all its files are there."""
    for p in parts:
        p.write.mode("append").parquet(f"{at}/in")
        out = run(p.sparkSession.readStream.schema(schema).parquet(f"{at}/in"))
    return out


def _folder(df) -> str:
    return f"{shared_dir(df.sparkSession)}/siltstone-stream-{uuid.uuid4().hex}"


@query(
    f"""WITH b AS (SELECT conv_id, turn, role, text, sha256({STRIP.format('text')}) AS hash, role = 'user' AND turn % 4 = 0 AND contains(lower(text), 'er') AS flagged,
        coalesce(sum((role <> 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM conversations WHERE {STRIP.format('text')} <> ''),
    p AS (SELECT t.conv_id, t.turn, m.turn AS since, m.role, m.text, m.run, m.role = 'user' AND EXISTS (SELECT 1 FROM b f WHERE f.conv_id = t.conv_id AND f.turn < t.turn AND f.flagged AND f.hash = m.hash) AS hidden
        FROM b t JOIN b m ON m.conv_id = t.conv_id AND m.turn < t.turn WHERE t.role = 'user'),
    q AS (SELECT *, bool_or(hidden) OVER (PARTITION BY conv_id, turn, run) AS after_hidden FROM p),
    k AS (SELECT conv_id, turn, since, role || ': "' || text || '"' AS line FROM q WHERE NOT CASE WHEN role = 'user' THEN hidden ELSE after_hidden END QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY since DESC) <= 4)
    SELECT b.conv_id, b.turn, coalesce(string_agg(line, chr(10) ORDER BY since), '') AS history FROM b LEFT JOIN k ON k.conv_id = b.conv_id AND k.turn = b.turn WHERE role = 'user' GROUP BY b.conv_id, b.turn"""
)
def streamed_domain_history(load):
    """Histories without flagged questions, whose set grows with the stream, over three batches of turns."""
    rows = load("conversations")
    last = F.col("turn")
    at = _folder(rows)
    flagged = (last % 4 == 0) & F.lower("text").contains("er")
    parts = [rows.where(last < 2), rows.where((last >= 2) & (last < 5)), rows.where(last >= 5)]
    return _fed(parts, rows.schema, at, lambda stream: processors.drained(processors.domain_histories(stream, flagged, 4), at))


@query(
    """WITH RECURSIVE e AS (SELECT event_type, event_id, epoch_us(ts) AS since, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM events WHERE ts IS NOT NULL),
    r AS (SELECT event_type, event_id, since, i, [since] AS times, 0::BIGINT AS wait FROM e WHERE i = 1
      UNION ALL SELECT event_type, event_id, since, i, list_append(times, since + wait)[-3:] AS times, wait
      FROM (SELECT e.event_type, e.event_id, e.since, e.i, r.times, CASE WHEN len(r.times) < 3 THEN 0 ELSE greatest(0, r.times[-3] + 1800000000 - e.since) END AS wait FROM r JOIN e ON e.event_type = r.event_type AND e.i = r.i + 1))
    SELECT event_type, event_id, wait, wait = 0 AS admitted FROM r"""
)
def limited_requests(load):
    """At most three requests of a type in half an hour, over four batches, each of which holds some requests of the time of the one before."""
    rows = load("events").select("event_type", "event_id", "ts")
    at = _folder(rows)
    spark = rows.sparkSession
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    if first is None:
        return spark.createDataFrame([], "event_type string, event_id long, wait long, admitted boolean")
    span = (last - first) / 4
    cuts = [first + k * span for k in range(1, 4)]
    late = F.when(F.col("event_id") % 5 == 0, F.expr("INTERVAL 20 MINUTES")).otherwise(F.expr("INTERVAL 0 MINUTES"))
    batch = sum(((F.col("ts") + late >= F.lit(c)).cast("int") for c in cuts), F.lit(0))
    parts = [rows.where(batch == k) for k in range(4)]
    end = rows.agg(F.max("ts").alias("ts")).select(F.lit(None).cast("string").alias("event_type"), F.lit(-1).cast("long").alias("event_id"), (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("ts"))
    out = _fed([*parts, end], rows.schema, at, lambda stream: processors.limited_table(stream, at, "event_type", 3, 1800, 1800))
    return out.select(F.col("key").alias("event_type"), "event_id", "wait", "admitted")
