"""Exact dedup by a heavy-hitter split.

Texts are equal when identical after each run of white space (0x20, 0x09-0x0D) becomes one space; the
SHA-256 of that form stands for the text. Misra-Gries summaries of ``counters`` entries, one for each
partition and then merged, hold every digest with more than 2/(counters+1) of the rows. Their exact counts and
smallest ids are taken in one map-side aggregation; the verified winners, at most ``counters`` rows, are
broadcast and their rows never enter the shuffle. All other digests go through an ordinary aggregation, in which
no group holds more than that share of the rows.

Defined results: null text equals the empty text; a null doc_id is never the smallest unless all of its group
are null; rows that repeat the smallest doc_id of a group are all kept; an empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from heapq import nlargest

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import materialize, table

COUNTERS = 1024


def shrink(counts: Counter, counters: int) -> Counter:
    """Misra-Gries decrement: take the next largest count off all, keep what is left."""
    if len(counts) <= counters:
        return counts
    least = nlargest(counters + 1, counts.values())[-1]
    return Counter({k: n - least for k, n in counts.items() if n > least})


def summarise(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            held.update({x["values"]: x["counts"] for x in b.column("text_sha256").value_counts().to_pylist()})
            held = shrink(held, counters)
        rows = [(k, n) for k, n in held.items() if n > 1]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["text_sha256", "n"])

    return run


def digest(text: Column) -> Column:
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)


def digests(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", digest(F.col("text")).alias("text_sha256"))


def frequent(keys: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The digests that Misra-Gries retains (at most ``counters``), with exact group_size and keep_id."""
    local = keys.select("text_sha256").mapInArrow(summarise(counters), "text_sha256 string, n long")
    top = local.groupBy("text_sha256").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "text_sha256").limit(counters)
    return (
        keys.join(F.broadcast(top.select("text_sha256")), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.count(F.lit(1)).alias("group_size"), F.min("doc_id").alias("keep_id"))
        .where("group_size > 1")
    )


def exact_dedup(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    keys = materialize(digests(docs), "digests")
    winners = materialize(frequent(keys, counters).coalesce(1), "winners")
    hot = keys.join(F.broadcast(winners), "text_sha256")
    rest = keys.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    groups = (
        rest.groupBy("text_sha256")
        .agg(F.count(F.lit(1)).alias("group_size"), F.min("doc_id").alias("keep_id"))
        .where("group_size > 1")
    )
    cold = rest.join(groups, "text_sha256", "left").select(
        "doc_id",
        "text_sha256",
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
    )
    return hot.unionByName(cold).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact_dedup keeps, with all their columns.

    A row is known by its doc_id (null is a value of its own) and its digest, so rows that share a doc_id are judged
    each by its own text.
    """
    gone = exact_dedup(docs).where("NOT kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (digest(F.col("text")) == F.col("_sha")), "left_anti")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = r"""
WITH k AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
FROM k WINDOW g AS (PARTITION BY text_sha256)
"""
