"""Exact inner-product retrieval over unit vectors, and the choices of context built on it.

Queries are the small side: they are broadcast up to ``BROADCAST`` rows and otherwise taken in blocks of that many, so
that each block is one pass over the corpus, in matrix products over Arrow batches. Each task keeps the top k of
each query, so no more than k rows a query and task move.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.keys import seeded_uniform
from .rank import row_numbers

BROADCAST, SCORES = 2000, 1 << 20  # queries sent at once, and products held at once


def ranked(scored: DataFrame, k: int, descending: bool = True) -> DataFrame:
    """query, item, score, rank for the k best (or worst) items of each query; ties by item."""
    by = Window.partitionBy("query").orderBy(F.desc("score") if descending else F.asc("score"), "item")
    return scored.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def best(queries: DataFrame, corpus: DataFrame, k: int, qid: str = "vec_id", cid: str = "vec_id", vector: str = "embedding", descending: bool = True) -> DataFrame:
    """query, item, score, rank for the k best (or worst) items of each query; ties by item.

    Each task multiplies its Arrow batches with a block of queries and keeps k items a query, so a task emits at
    most k rows for each query; those are ranked. Queries are read ``BROADCAST`` at a time, one pass over the corpus each.
    """
    spark, sign = queries.sparkSession, 1.0 if descending else -1.0
    q = queries.select(F.col(qid).alias("query"), F.col(vector).cast("array<double>").alias("qv")).where("query IS NOT NULL AND qv IS NOT NULL")
    c = corpus.select(F.col(cid).alias("item"), F.col(vector).cast("array<double>").alias("cv")).where("item IS NOT NULL AND cv IS NOT NULL")
    schema = f"query {q.schema['query'].dataType.simpleString()}, item {c.schema['item'].dataType.simpleString()}, score double"
    item_kind = to_arrow_type(c.schema["item"].dataType)
    blocks = max(1, -(-q.count() // BROADCAST))

    def one(part: DataFrame) -> DataFrame:
        got = part.toArrow()
        held = spark.sparkContext.broadcast((got["query"].combine_chunks(), np.array(got["qv"].to_pylist(), np.float64)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, vectors = held.value
            kept = [(np.zeros(0), np.zeros(0, np.int64))] * len(ids)  # of each query: signed scores and places in ``items``
            items: list = []
            worst = np.full(len(ids), -np.inf)  # of each query: what a score must reach to be kept
            step = max(1, SCORES // max(1, len(ids)))
            for b in (b.slice(at, step) for b in batches for at in range(0, len(b), step)):
                if not len(ids):
                    continue
                flat = b.column("cv").flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1)
                scores = np.round(flat @ vectors.T, 6) * sign
                base = len(items)
                items += b.column("item").to_pylist()
                for j in np.flatnonzero(scores.max(0) >= worst).tolist():
                    s = np.concatenate([kept[j][0], scores[:, j]])
                    at = np.concatenate([kept[j][1], base + np.arange(len(b))])
                    if len(s) > k:
                        near = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
                        near = np.array(sorted(near.tolist(), key=lambda x: (-s[x], items[at[x]]))[:k], np.int64)
                        s, at = s[near], at[near]
                    kept[j] = s, at
                    worst[j] = s.min() if len(s) == k else -np.inf
                used = np.unique(np.concatenate([at for _, at in kept]))
                items = [items[x] for x in used.tolist()]
                kept = [(s, np.searchsorted(used, at)) for s, at in kept]
            rows = [np.full(len(s), j) for j, (s, _) in enumerate(kept)]
            if items:
                at = np.concatenate([at for _, at in kept])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.concatenate(rows))), pa.array([items[x] for x in at.tolist()], item_kind), pa.array(np.concatenate([s for s, _ in kept]) * sign)], ["query", "item", "score"]
                )

        return c.mapInArrow(run, schema)

    parts = [one(q.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == n) if blocks > 1 else q) for n in range(blocks)]
    return ranked(reduce(DataFrame.unionByName, parts), k, descending)


def top_k(queries: DataFrame, corpus: DataFrame, k: int, qid: str = "vec_id", cid: str = "vec_id", vector: str = "embedding") -> DataFrame:
    return best(queries, corpus, k, qid, cid, vector)


def excluding(found: DataFrame, golden: DataFrame, k: int, n_golden: int) -> DataFrame:
    """Over-fetch max(k + n_golden, 10), take golden items (query, item) out, rank anew and cut to k."""
    wide = found.where(F.col("rank") <= max(k + n_golden, 10)).drop("rank")
    return ranked(wide.join(golden, ["query", "item"], "left_anti"), k)


def tail_k(queries: DataFrame, corpus: DataFrame, k: int, qid: str = "vec_id", cid: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The last k of each ranked list."""
    return best(queries, corpus, k, qid, cid, vector, descending=False)


def with_golden(rows: DataFrame, golden: DataFrame, key: str) -> DataFrame:
    """Rows with the stored golden documents of their seed; rows without any are dropped, as none can be answered."""
    return rows.join(golden, key)


def pad_random(items: DataFrame, group: str, key: str, k: int, seed: str) -> DataFrame:
    """For each item k others of its group: those that follow it in a seeded circular order of the group.

    No pairs are formed: an item's others are its successors, wrapping round; a group
    of n has at most n - 1 others.
    """
    u = seeded_uniform(seed, F.col(key))
    place = row_numbers(items.select(group, key), group, "r", [u, key], spread=u, total="n")
    place = place.select(F.col(group).alias("grp"), F.col(key).alias("id"), "r", "n")
    steps = place.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k)))).where(F.col("step") < F.col("n"))
    want = steps.select("grp", "id", "step", F.pmod(F.col("r") + F.col("step"), F.col("n")).alias("r"))
    return want.join(place.select("grp", "r", F.col("id").alias("other")), ["grp", "r"]).select("grp", "id", "step", "other")
