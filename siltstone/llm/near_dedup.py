"""Near-duplicate components by bottom-k sketches of one hash function.

A document's set is its distinct shingles of ``width`` words; two documents are linked when
100 * |A and B| >= ``percent`` * |A or B|, which is confirmed on the full sets of the whole texts.

1. Every row gets its set's size, a signature (two 64-bit sums and the size) and the ``KEPT`` smallest hashes. Rows with
   equal sets form a class, a node of the graph, which one of its rows represents.
2. Inverted lists over the ``LISTED`` smallest hashes of the representatives give overlaps. A linked pair shares
   at least ``needed(n)`` listed values: exactly so for sets of up to 0.8 * LISTED, else but for a chance below 1e-6.
   Values in at most ``HOT`` representatives generate pairs, whose overlaps are counted; the most frequent values are
   counted by broadcast, so no list meets its count in one task.
3. Pairs whose shared values are mostly hot can only be among representatives with ``needed(n)`` hot values
   ("hot documents"). Each is compared with the ``PIVOTS`` pivots of its family (its most frequent value); after
   the links so found, those outside the main component of some list are a query set that is compared, in
   blocks, with the hot documents of the lists that several components share. No list is expanded into its pairs, none
   is capped. Within a block only rows that share one of the rarest 20 % of a query's values (any linked row does) are
   compared, by full sets in numpy, and only links come out.
4. The union-sketch estimate of every other candidate filters at ``ESTIMATE``; what passes is verified exactly.
5. Components by star contraction.

Defined results: null, empty or blank texts have no shingles and link with nothing; a null doc_id links with
nothing, has a null component_id and is kept; doc_ids of any type, which need not be unique: each row is linked by its
own text, and its component_id is the smallest doc_id among the rows that it reaches, so rows of one doc_id with
texts that are not alike can be of several components; rows that repeat the smallest doc_id of a component are all kept;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.skew import most_frequent, split_join
from .components import components
from .store import discard, materialize, table, tidy
from .textkit import U, chunks, mix, shingles, words

KEPT = 64
LISTED = 40
HOT = 32
PIVOTS = 6
ESTIMATE = 0.5
BLOCK = 4_000_000
BROADCAST = 500_000
SHARED = 18


def needed(n: Column, percent: int) -> Column:
    """Least number of listed values that a document with ``n`` shingles shares with one it is linked with."""
    whole = F.ceil(n * percent / 100)
    most = LISTED * percent // 100
    return F.when(n <= most, whole).otherwise(F.lit(SHARED * percent // 80)).cast("int")


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """row, doc_id, h (hash of the text), n_shingles, sig, sketch (the smallest hashes, ascending, as little-endian binary) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last, data, offsets in chunks(b.column("text")):
                d, h = shingles(*words(data, offsets), width)
                cut = np.searchsorted(d, np.arange(len(offsets)))
                n = np.diff(cut)
                sums = np.zeros((2, len(h) + 1), U)
                np.cumsum(h, out=sums[0, 1:])
                np.cumsum(mix(h ^ U(0x5851F42D4C957F2D)), out=sums[1, 1:])
                sig = np.concatenate([sums[:, cut[1:]] - sums[:, cut[:-1]], n[None].astype(U)]).T.astype("<u8")
                part = b.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("h"),
                        pa.array(n.astype(np.int64)),
                        pa.array([x.tobytes() for x in sig], pa.binary()),
                        pa.array([h[x : min(x + KEPT, y)].astype("<u8").tobytes() for x, y in zip(cut[:-1], cut[1:])], pa.binary()),
                    ],
                    ["doc_id", "h", "n_shingles", "sig", "sketch"],
                )

    found = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(run, f"doc_id {kind}, h long, n_shingles long, sig binary, sketch binary")
    return found.withColumn("row", F.monotonically_increasing_id())


def postings(reps: DataFrame) -> DataFrame:
    """value, doc, n: the listed values of each representative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = [np.frombuffer(x, "<i8")[:LISTED] for x in b.column("sketch").to_pylist()]
            if lists:
                rows = pa.array(np.repeat(np.arange(len(lists)), [len(x) for x in lists]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(lists)), b.column("node").take(rows), b.column("n_shingles").take(rows)], ["value", "doc", "n"]
                )

    return reps.select("node", "n_shingles", "sketch").mapInArrow(run, "value long, doc long, n long")


def like_sized(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def estimate(x: bytes, y: bytes) -> float:
    """Jaccard similarity as the union's smallest hashes show it."""
    p, q = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
    union = np.union1d(p, q)
    k = min(KEPT, len(union))
    low = union[:k]
    return float(np.isin(low, p, assume_unique=True)[np.isin(low, q, assume_unique=True)].sum()) / k if k else 0.0


def alike(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose union-sketch estimate passes."""
    both = pairs.join(reps.select(F.col("node").alias("a"), F.col("sketch").alias("x")), "a").join(
        reps.select(F.col("node").alias("b"), F.col("sketch").alias("y")), "b"
    )

    @F.arrow_udf("boolean")
    def passes(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([estimate(p, q) >= ESTIMATE for p, q in zip(x.to_pylist(), y.to_pylist())], pa.bool_())

    return both.where(passes("x", "y")).select("a", "b").distinct()


def texts_of(docs: DataFrame, reps: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, text of some representatives; their keys are broadcast up to ``BROADCAST`` of them, else shuffled.

    The texts are written, so that joins of pairs with them are plain ones, whose hot keys Spark splits at run time.
    """
    keys = materialize(reps.select("node", "doc_id", "h").join(nodes, "node", "left_semi"), "keys")
    found = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).join(F.broadcast(keys) if keys.count() <= BROADCAST else keys, ["doc_id", "h"])
    out = materialize(found.groupBy("node").agg(F.first("text").alias("text")), "texts")  # a repeated row has its text once
    discard(keys)
    return out


def verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets, taken from the whole texts, are similar enough, as u, v."""
    texts = texts_of(docs, reps, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last, data, offsets in chunks(b.column("x")):
                n = last - first
                part = b.slice(first, n)
                d, h = shingles(*words(data, offsets), width)
                for lo, hi, data_y, offsets_y in chunks(part.column("y")):
                    e, g = shingles(*words(data_y, offsets_y), width)
                    mine = slice(*np.searchsorted(d, [lo, hi]))
                    who, val = np.concatenate([d[mine] - lo, e]), np.concatenate([h[mine], g])
                    order = np.lexsort((val, who))
                    who, val = who[order], val[order]
                    same = np.bincount(who[1:][(who[1:] == who[:-1]) & (val[1:] == val[:-1])], minlength=hi - lo)
                    union = np.bincount(who, minlength=hi - lo) - same
                    ok = (100 * same >= percent * union) & (union > 0)
                    sub = part.slice(lo, hi - lo).filter(pa.array(ok))
                    yield pa.RecordBatch.from_arrays([sub.column("a"), sub.column("b")], ["u", "v"])

    return both.select("a", "b", "x", "y").mapInArrow(run, "u long, v long")


def full_sets(docs: DataFrame, reps: DataFrame, own: DataFrame, width: int) -> DataFrame:
    """doc, comp, n, hashes (the full set, ascending, as little-endian binary) of the nodes in ``own`` (doc, comp)."""
    rows = texts_of(docs, reps, own.select(F.col("doc").alias("node"))).join(own.withColumnRenamed("doc", "node"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last, data, offsets in chunks(b.column("text")):
                d, h = shingles(*words(data, offsets), width)
                cut = np.searchsorted(d, np.arange(len(offsets)))
                part = b.slice(first, last - first)
                sets = pa.array([h[x:y].astype("<u8").tobytes() for x, y in zip(cut[:-1], cut[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("node"), part.column("comp"), pa.array(np.diff(cut)), sets], ["doc", "comp", "n", "hashes"])

    return rows.select("node", "comp", "text").mapInArrow(run, "doc long, comp long, n long, hashes binary")


class Block:
    """Rows of a block: their sets, and an index over the rarest values of each."""

    def __init__(self, rows: pa.Table, percent: int):
        self.doc, self.comp, self.n = (rows[c].to_numpy() for c in ("doc", "comp", "n"))
        self.sets, self.percent = [np.frombuffer(x, "<u8") for x in rows["hashes"].to_pylist()], percent
        values = np.concatenate(self.sets)
        who = np.repeat(np.arange(len(self.sets)), self.n)
        self.values, back, self.df = np.unique(values, return_inverse=True, return_counts=True)
        order = np.lexsort((values, self.df[back], who))  # each row's values, rarest first
        first = np.cumsum(self.n) - self.n
        keep = np.arange(len(values)) - np.repeat(first, self.n) < np.repeat(self.rare(self.n), self.n)
        values, who = values[order][keep], who[order][keep]
        order = np.argsort(values, kind="stable")
        self.listed, self.who = values[order], who[order]

    def rare(self, n):
        """How many of n values a linked set cannot all lack."""
        return n - -(-n * self.percent // 100) + 1

    def links(self, doc: int, comp: int, mine: np.ndarray) -> list[tuple[int, int]]:
        """The linked rows of other components, one for each."""
        spot = np.minimum(np.searchsorted(self.values, mine), len(self.values) - 1)
        df = np.where(self.values[spot] == mine, self.df[spot], 0)
        rare = mine[np.lexsort((mine, df))[: self.rare(len(mine))]]
        a, b = np.searchsorted(self.listed, rare, "left"), np.searchsorted(self.listed, rare, "right")
        near = np.unique(np.concatenate([self.who[x:y] for x, y in zip(a, b) if y > x] or [np.zeros(0, np.int64)]))
        m, n = len(mine), self.n[near]
        near = near[(self.comp[near] != comp) & (100 * np.minimum(n, m) >= self.percent * np.maximum(n, m))]
        out: dict[int, int] = {}
        for i in near.tolist():
            c = int(self.comp[i])
            if c not in out:
                same = len(np.intersect1d(self.sets[i], mine, assume_unique=True))
                if 100 * same >= self.percent * (m + len(self.sets[i]) - same):
                    out[c] = int(self.doc[i])
        return [(doc, v) for v in out.values()]


def against_blocks(queries: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between a query set and rows of other components, by exact comparison of full sets.

    Both have doc, comp, n, hashes. Either side is dealt into blocks of about ``BLOCK`` hashes; each query block
    meets each block of rows in one task. A query has at most one link to each component from each block.
    """
    blocks = lambda df: max(1, -(-(df.agg(F.sum("n")).first()[0] or 0) // BLOCK))
    q_blocks, r_blocks = blocks(queries), blocks(rows)
    spread = lambda n: F.pmod(F.xxhash64("doc"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select("*", spread(q_blocks).alias("qb"), every(r_blocks).alias("rb"))
    r = rows.select("*", spread(r_blocks).alias("rb"), every(q_blocks).alias("qb"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if len(left) and len(right):
            block = Block(right, percent)
            for d, c, s in zip(*(left[x].to_pylist() for x in ("doc", "comp", "hashes"))):
                found += block.links(d, c, np.frombuffer(s, "<u8"))
        return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})

    return q.groupBy("qb", "rb").cogroup(r.groupBy("qb", "rb")).applyInArrow(run, "u long, v long")


def link(docs: DataFrame, reps: DataFrame, width: int, percent: int) -> DataFrame:
    """node, component over the linked representatives."""
    posts = postings(reps)
    counts = materialize(posts.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "counts")
    listed = materialize(split_join(posts, counts, "value", most_frequent(counts, "value", "df")), "listed")
    discard(counts)
    tidy(listed.sparkSession)
    heat = listed.where(F.col("df") > HOT).groupBy("doc", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "value"))).alias("hot_values")
    )
    heat = heat.withColumns({"heat": F.size("hot_values"), "family": F.element_at("hot_values", -1)["value"]})
    heat = materialize(heat, "heat")
    cold = listed.where(F.col("df") <= HOT).join(heat.select("doc", "heat"), "doc", "left").select(
        "value", "doc", "n", F.coalesce("heat", F.lit(0)).alias("heat")
    )
    x, y = (cold.select("value", *[F.col(c).alias(f"{c}_{k}") for c in ("doc", "n", "heat")]) for k in "xy")
    counted = (
        x.join(y, "value")
        .where((F.col("doc_x") < F.col("doc_y")) & like_sized("n_x", "n_y", percent))
        .groupBy("doc_x", "doc_y", "n_x", "n_y", "heat_x", "heat_y")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    near = counted.where(
        F.col("shared") + F.least("heat_x", "heat_y") >= F.greatest(needed(F.col("n_x"), percent), needed(F.col("n_y"), percent))
    ).select(F.col("doc_x").alias("a"), F.col("doc_y").alias("b"))

    hot = materialize(heat.where(F.col("heat") >= needed(F.col("n"), percent)), "hot")
    any_hot = hot.count() > 0
    if any_hot:
        rank = F.row_number().over(Window.partitionBy("family").orderBy(F.xxhash64("doc"), "doc"))
        pivots = hot.select("family", F.col("doc").alias("pivot"), F.col("n").alias("m"), rank.alias("r")).where(F.col("r") <= PIVOTS)
        sizes = hot.groupBy("family").agg(F.count(F.lit(1)).alias("size"))
        stars = split_join(hot.select("family", "doc", "n"), pivots, "family", most_frequent(sizes, "family", "size"))
        stars = stars.where((F.col("doc") != F.col("pivot")) & like_sized("n", "m", percent))
        near = near.unionByName(stars.select(*pair("doc", "pivot")))
    first = materialize(alike(near.distinct(), reps), "pairs")
    edges = materialize(verified(first, docs, reps, width, percent), "links")
    tidy(edges.sparkSession)
    found = materialize(components(edges), "parts")
    if not any_hot:
        return found
    # The rest of the hot documents: those outside the main component of a list they are in.
    label = lambda df: df.join(found.select(F.col("node").alias("doc"), "component"), "doc", "left").withColumn(
        "comp", F.coalesce("component", "doc")
    ).drop("component")
    own = materialize(label(hot.select("doc")), "hot-parts")
    # Of a linked pair's shared values, the rarest is among the heat - needed + 1 rarest hot values of both.
    prefix = F.slice("hot_values", F.lit(1), F.col("heat") - needed(F.col("n"), percent) + 1)
    lists = materialize(hot.join(own, "doc").select("doc", "comp", F.explode(F.transform(prefix, lambda x: x["value"])).alias("value")), "lists")
    sizes = lists.groupBy("value", "comp").agg(F.count(F.lit(1)).alias("size"))
    main = sizes.groupBy("value").agg(F.max(F.struct("size", "comp"))["comp"].alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("size").alias("size"))
    main = materialize(main.where("parts > 1"), "main")
    mixed = split_join(lists, main.select("value", "main"), "value", most_frequent(main, "value", "size"))
    mixed = materialize(mixed.groupBy("doc", "comp").agg(F.max(F.col("comp") != F.col("main")).alias("outside")), "mixed")
    if mixed.where("outside").isEmpty():
        return found
    sets = materialize(full_sets(docs, reps, mixed.select("doc", "comp"), width), "hot-sets")
    asked = materialize(sets.join(mixed.where("outside"), "doc", "left_semi"), "query-sets")
    late = materialize(against_blocks(asked, sets, percent), "links")
    return materialize(components(edges.unionByName(late)), "parts")


def linked_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, h, n_shingles, component_id, kept of every row of ``docs``."""
    rows = materialize(sketches(docs, width), "sketches")
    live = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    groups = live.groupBy("sig").agg(F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("rep"), F.min("row").alias("node"))
    groups = materialize(groups.where("size > 1"), "classes")
    joined = split_join(live.select("row", "doc_id", "h", "n_shingles", "sig"), groups.select("sig", "rep", "node"), "sig", most_frequent(groups, "sig", "size"), "left")
    classed = materialize(
        joined.select("row", "doc_id", "h", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"), F.coalesce("node", "row").alias("node")), "classed"
    )
    copies = classed.where("row <> node").select("row")
    reps = materialize(live.join(copies, "row", "left_anti").select(F.col("row").alias("node"), "doc_id", "h", "n_shingles", "sketch"), "reps")
    parts = link(docs, reps, width, percent)
    discard(reps)
    least = classed.where("row = node").select("node", "rep").join(parts, "node")
    sums = materialize(least.groupBy("component").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("size")), "least")
    named = split_join(parts, sums.select("component", "component_id"), "component", most_frequent(sums, "component", "size")).select("node", "component_id")
    sizes = classed.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    out = split_join(classed, named, "node", most_frequent(sizes, "node", "size"), "left")
    out = out.select("doc_id", "h", "n_shingles", F.coalesce("component_id", "rep").alias("component_id"))
    dead = rows.where("NOT (n_shingles > 0 AND doc_id IS NOT NULL)").select("doc_id", "h", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(dead).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    return linked_rows(docs, width, percent).select("doc_id", "n_shingles", "component_id", "kept")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"), width=4, percent=80)


def drop_near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of each component those with its smallest doc_id; null doc_ids stay.

    A row is known by its doc_id and the hash of its text, so a text that is alone stays whatever else has its doc_id.
    """
    gone = linked_rows(docs, width, percent).where("NOT kept").select("doc_id", "h").distinct()
    return docs.join(gone.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")), (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_h")), "left_anti")
