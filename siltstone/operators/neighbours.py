"""Exact nearest neighbours of every row of a table of unit vectors, with pruning by cells.

Vectors are dealt to the cells of pivots, which are drawn from a bounded sample. Of each cell the largest distance from its pivot is known.
Distances are those between the points themselves, so for a query in cell a and rows in cell b the triangle inequality gives
``|q - x| >= |pivot_a - pivot_b| - radius_a - radius_b``, and ``<= |pivot_a - pivot_b| + radius_a + radius_b``. A cell's k-th neighbour is at most
as far as the nearest cells with k rows in all reach; cells whose lower bound is beyond that cannot hold any of the k, and are not paired.
Cells are packed into blocks of at most ``BLOCK`` rows, and larger cells cut, so a pair of blocks is bounded however the rows are spread; each block is sent to
the blocks that need it, in which only the pairs of cells above are compared. What is shuffled is thus each row once for every block, ``LEAST`` times or the number of
rows over ``BLOCK``, whichever is more. Scores are worked out in single precision first; what may be among the best is scored again in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

PIVOTS, BLOCK, LEAST = 1024, 32768, 16
SLACK = 1e-5
STEP, PIECE = 1024, 1 << 16  # rows that are compared at once, and products that are worked out anew at once


@dataclass
class Neighbours:
    """found: query, item, score, rank; pairs and all_pairs: pairs of cells that were compared, and that there are."""

    found: DataFrame
    pairs: int
    all_pairs: int


def cells(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """id, v, copy, cell (the nearest pivot), far (the distance from it)."""
    sc = vectors.sparkSession.sparkContext
    held = sc.broadcast(pivots)
    kind, vector = (vectors.schema[c].dataType.simpleString() for c in ("id", "v"))

    def run(frames):
        for f in frames:
            for at in range(0, len(f), STEP):
                g = f.iloc[at : at + STEP]
                x = np.array(g["v"].tolist(), np.float64)
                d = np.sqrt(np.maximum(((x**2).sum(1)[:, None] - 2 * x @ held.value.T + (held.value**2).sum(1)), 0))
                near = d.argmin(1)
                yield pd.DataFrame({"id": g["id"], "v": g["v"], "copy": g["copy"], "cell": near.astype(np.int32), "far": d[np.arange(len(near)), near]})

    return vectors.mapInPandas(run, f"id {kind}, v {vector}, copy int, cell int, far double")


def plan(sizes: pd.DataFrame, pivots: np.ndarray, k: int) -> np.ndarray:
    """Of each pair (query cell, row cell), by their places in ``sizes``, whether it may hold one of the ``k`` best. ``sizes`` has cell, n and radius of the cells that have rows."""
    c, n, r = (sizes[x].to_numpy() for x in ("cell", "n", "radius"))
    p = pivots[c]
    between = np.sqrt(np.maximum((p**2).sum(1)[:, None] - 2 * p @ p.T + (p**2).sum(1), 0))
    near, reach = between - r[:, None] - r, between + r[:, None] + r
    out = np.zeros(near.shape, bool)
    for i in range(len(c)):
        order = np.argsort(reach[i])
        enough = np.searchsorted(np.cumsum(n[order]), k)
        limit = reach[i][order[min(enough, len(order) - 1)]] if n.sum() >= k else np.inf
        out[i] = near[i] <= limit + SLACK
    return out


def packed(sizes: pd.DataFrame, pivots: np.ndarray, block: int) -> tuple[list[int], list[int]]:
    """Of each cell its first block and the number of blocks that it is cut into; cells share a block with others at a like distance from the first."""
    far = ((pivots[sizes["cell"]] - pivots[sizes["cell"].iloc[0]]) ** 2).sum(1)
    first, parts = [0] * len(sizes), [1] * len(sizes)
    block_no, room = -1, 0
    for i in np.argsort(far, kind="stable").tolist():
        n = int(sizes["n"].iloc[i])
        if n > room:
            parts[i] = -(-n // block)
            block_no, room = block_no + 1, block if parts[i] == 1 else 0
        first[i] = block_no
        room -= n if parts[i] == 1 else 0
        block_no += parts[i] - 1
    return first, parts


def nearest(x: np.ndarray, y: np.ndarray, order: np.ndarray, k: int, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``x``, rows of ``y`` and rounded products of the ``k`` best rows of ``y`` for each of ``x``; ties by ``order``."""
    longest = np.sqrt(max((x**2).sum(1).max(), 1) * max((y**2).sum(1).max(), 1))
    margin = np.float32(x.shape[1] * 2.0**-22 * longest + 2 * 10.0**-digits)
    small, large = x.astype(np.float32), y.astype(np.float32)
    best = np.full((len(x), k), -np.inf, np.float32)  # the k best so far, the worst of them first
    found = []
    for at in range(0, len(y), 4 * STEP):
        s = small @ large[at : at + 4 * STEP].T
        hit = np.flatnonzero(s.max(1) >= best[:, 0] - margin)
        if not len(hit):
            continue
        own = s[hit]
        top = np.partition(own, own.shape[1] - k, axis=1)[:, -k:] if own.shape[1] > k else own
        best[hit] = np.partition(np.concatenate([best[hit], top], axis=1), top.shape[1], axis=1)[:, top.shape[1] :]
        best[hit] = np.sort(best[hit], axis=1)
        r, c = np.nonzero(own >= best[hit, 0][:, None] - margin)
        found.append((hit[r], at + c, own[r, c]))
    r, c, s = (np.concatenate(z) for z in zip(*found))
    keep = s >= best[r, 0] - margin
    r, c = r[keep], c[keep]
    s = np.round(np.concatenate([np.einsum("ij,ij->i", x[r[i : i + PIECE]], y[c[i : i + PIECE]]) for i in range(0, len(r), PIECE)]), digits)
    by = np.lexsort((order[c], -s, r))
    r, c, s = r[by], c[by], s[by]
    keep = np.arange(len(r)) - np.searchsorted(r, r) < k
    return r[keep], c[keep], s[keep]


def knn_join(df: DataFrame, k: int, truncate, key: str = "vec_id", vector: str = "embedding", pivots: int | None = None, block: int | None = None, digits: int = 6) -> Neighbours:
    """The ``k`` rows with the largest inner product (rounded to ``digits``) of every row of ``df``, itself among them; ties by key.

    Vectors have unit length; rows with a null key or vector are left out. Of equal vectors only the ``k`` smallest keys can be found, and one of them
    asks for all, so groups of copies are searched once. ``truncate`` writes a table and reads it back. The pivots (at most ``PIVOTS``, by
    default about the root of the number of rows) and the table of cells are all that the driver sees.
    """
    spark = df.sparkSession
    single = df.schema[vector].dataType.simpleString() == "array<float>"
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    kind = rows.schema["id"].dataType.simpleString()
    none = spark.createDataFrame([], f"query {kind}, item {kind}, score double, rank int")
    copy = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = truncate(rows.withColumn("copy", copy).where(F.col("copy") <= k))
    n = few.count()
    pivots = pivots or min(PIVOTS, max(1, int(n**0.5)))
    sample = few.where("copy = 1").orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    if not sample:
        return Neighbours(none, 0, 0)
    centres = np.array([r["v"] for r in sample], np.float64)
    placed = truncate(cells(few, centres))
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius")).orderBy("cell").toPandas()
    wanted = plan(sizes, centres, k)
    first, parts = packed(sizes, centres, block or min(BLOCK, max(1, -(-n // LEAST))))
    shape = spark.createDataFrame([(int(c), i, f, m) for i, (c, f, m) in enumerate(zip(sizes["cell"], first, parts))], "cell int, place int, first int, parts int")
    blocks = placed.join(F.broadcast(shape), "cell").select((F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("block"), F.struct("place", "id", "v", "copy").alias("r"))
    blocks = blocks.groupBy("block").agg(F.sort_array(F.collect_list("r")).alias("rows"))
    blocks = truncate(blocks.select("block", F.col("rows.place").alias("place"), F.col("rows.id").alias("id"), F.flatten("rows.v").alias("v"), F.col("rows.copy").alias("copy")))
    own = [range(f, f + m) for f, m in zip(first, parts)]
    need = np.zeros((max(r.stop for r in own),) * 2, bool)
    for i, j in np.argwhere(wanted):
        need[own[i].start : own[i].stop, own[j].start : own[j].stop] = True
    both = spark.createDataFrame([(n, int(a), int(b)) for n, (a, b) in enumerate(np.argwhere(need))], "pair int, a int, b int")
    left = blocks.join(F.broadcast(both), F.col("block") == F.col("a")).select("pair", F.struct("place", "id", "v", "copy").alias("own"))
    right = blocks.join(F.broadcast(both), F.col("block") == F.col("b")).select("pair", F.struct("place", "id", "v").alias("other"))
    held = spark.sparkContext.broadcast(wanted)
    item_kind = to_arrow_type(rows.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                yield from compared(b.column("own")[i], b.column("other")[i])

    def compared(a: pa.StructScalar, b: pa.StructScalar) -> Iterator[pa.RecordBatch]:
        matrix = lambda s: s["v"].values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(s["id"]), -1)
        ids, items = a["id"].values, b["id"].values
        asks = np.flatnonzero(a["copy"].values.to_numpy() == 1)
        at, there = a["place"].values.to_numpy()[asks], b["place"].values.to_numpy()
        order = np.empty(len(items), np.int64)
        order[pc.sort_indices(items).to_numpy()] = np.arange(len(items))
        x, y = matrix(a), matrix(b)
        for place in np.unique(at):
            near = np.flatnonzero(held.value[place, there])
            mine = asks[at == place]
            z, rank = (y, order) if len(near) == len(y) else (y[near], order[near])
            for lo in range(0, len(mine) if len(near) else 0, STEP):
                r, c, s = nearest(x[mine[lo : lo + STEP]], z, rank, k, digits)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(mine[lo + r])).cast(item_kind), items.take(pa.array(near[c])).cast(item_kind), pa.array(s)], ["query", "item", "score"])

    scored = left.join(right, "pair").select("own", "other").mapInArrow(run, f"query {kind}, item {kind}, score double")
    by = Window.partitionBy("query").orderBy(F.desc("score"), "item")
    found = truncate(scored.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k))
    one = few.where("copy = 1").select(F.col("id").alias("_one"), "v")
    members = rows.join(one, "v").select("id", "_one")
    found = members.join(found, members["_one"] == found["query"]).select(F.col("id").alias("query"), "item", "score", "rank")
    return Neighbours(found, int(wanted.sum()), wanted.size)
