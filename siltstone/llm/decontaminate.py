"""Benchmark decontamination by spaced-seed hashing.

Tokens are runs of letters and digits, A-Z lower-cased. Fixed masks pick some of the tokens at a position and
ignore the others; equal hashes of picked tokens in a test item and a document are a hit, and the tokens on
the hit's diagonal are then compared one by one. A document holds an item if some ``WINDOW`` successive tokens of
the diagonal (the whole item, if shorter) agree in at least ``PERCENT`` of 100. Any such window of 13 tokens with two
substitutions contains an unspoilt seed of one of the two masks, so none is missed; items of fewer tokens
use seeds of two (or one) successive tokens, which are as complete. Items of fewer than ``LEAST`` tokens are found only in
documents that consist of nothing else.

The items are broadcast in blocks of about ``BLOCK`` characters (or one item); each block is a pass over
the documents, whose hits are written before the next block is sent, so any number of items works in bounded memory.
Hits are unfolded and compared ``SLICE`` at a time. Defined results: null or blank texts and items match nothing; rows with
a null doc_id or item_id are reported under null; rows that share a doc_id are searched each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import materialize, table
from .textkit import LOWER, U, chunks, hash_runs, mix, runs, salts

#: Fixed masks; 1 is compared, 0 ignored.
MASKS = ("11101011", "110100111")
WINDOW = 13
PERCENT = 80
LEAST = 5
BLOCK = 8_000_000
BITS = 22
SLICE = 2_000_000

ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = runs(ALNUM[data], offsets)
    return hash_runs(LOWER[data], starts, ends), first


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The seed that begins at each token (too few at the end: none)."""
    size = len(hashes) - len(mask) + 1
    if size <= 0:
        return np.zeros(0, U)
    k = salts(len(mask))
    acc = np.full(size, len(mask), U) * k[0]
    for j, c in enumerate(mask):
        if c == "1":
            acc += hashes[j : j + size] * k[j]
    return mix(acc)


class Index:
    """Seeds of a block of items."""

    def __init__(self, texts: list[str | None]):
        self.items = []
        found: dict[str, list[tuple[np.ndarray, int]]] = {}
        for i, t in enumerate(texts):
            raw = np.frombuffer((t or "").encode(), np.uint8)
            h, _ = tokens(raw, np.array([0, len(raw)]))
            self.items.append(h)
            for mask in MASKS if len(h) >= WINDOW else ("11",) if len(h) > 1 else ("1",):
                found.setdefault(mask, []).append((seeds(h, mask), i))
        self.size = np.array([len(h) for h in self.items], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.tokens = np.concatenate([*self.items, np.zeros(0, U)])
        self.masks = {}
        for mask, rows in found.items():
            value = np.concatenate([s for s, _ in rows])
            item = np.concatenate([np.full(len(s), i) for s, i in rows])
            at = np.concatenate([np.arange(len(s)) for s, _ in rows])
            order = np.argsort(value, kind="stable")
            bits = np.zeros(1 << BITS, bool)
            bits[(value >> U(64 - BITS)).astype(np.int64)] = True
            self.masks[mask] = value[order], item[order], at[order], bits

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows of (document, item, equal tokens, first token of the diagonal in the document), the best of each pair."""
        h, first = tokens(data, offsets)
        found = [np.zeros((0, 3), np.int64)]
        for mask, (value, item, at, bits) in self.masks.items():
            s = seeds(h, mask)
            pos = np.flatnonzero(bits[(s >> U(64 - BITS)).astype(np.int64)])
            lo, hi = np.searchsorted(value, s[pos], "left"), np.searchsorted(value, s[pos], "right")
            pos, lo, n = pos[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            for part in slices(n):
                k = ragged(lo[part], n[part])
                own = np.repeat(pos[part], n[part])
                doc = np.searchsorted(first, own, "right") - 1
                found.append(np.unique(np.stack([doc, item[k], own - at[k]], 1), axis=0))
        rows = np.unique(np.concatenate(found), axis=0)
        d, i, diagonal = rows.T
        size = self.size[i]
        a, b = np.maximum(diagonal, first[d]), np.minimum(diagonal + size, first[d + 1])
        w = np.minimum(WINDOW, size)
        ok = (b - a >= w) & ((size >= LEAST) | (first[d + 1] - first[d] == size))
        d, i, diagonal, a, n, w = d[ok], i[ok], diagonal[ok], a[ok], (b - a)[ok], w[ok]
        out = [np.zeros((0, 4), np.int64)]
        for part in slices(n):
            same = h[ragged(a[part], n[part])] == self.tokens[ragged((self.begin[i] + a - diagonal)[part], n[part])]
            sums = np.concatenate([[0], np.cumsum(same)])
            end = np.cumsum(n[part])
            m = n[part] - w[part] + 1
            at = ragged(end - n[part], m)
            most = np.maximum.reduceat(sums[at + np.repeat(w[part], m)] - sums[at], np.cumsum(m) - m) if len(m) else m
            hit = 100 * most >= PERCENT * w[part]
            out.append(np.stack([d[part], i[part], sums[end] - sums[end - n[part]], a[part] - first[d[part]]], 1)[hit])
        got = np.concatenate(out)
        got = got[np.lexsort((got[:, 3], got[:, 2], got[:, 1], got[:, 0]))]
        last = np.append(np.any(got[1:, :2] != got[:-1, :2], axis=1), True)[: len(got)]
        return got[last]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for sizes[0] numbers, then the same for the next."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def slices(sizes: np.ndarray) -> Iterator[slice]:
    """Consecutive slices whose sizes add up to about ``SLICE`` (or one entry)."""
    total = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SLICE, "right")))
        yield slice(at, to)
        at = to


def blocks(items: DataFrame) -> list[DataFrame]:
    """The items in blocks of about ``BLOCK`` characters."""
    n = -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK)
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).select("item_id", "text") for k in range(n)]


def found(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), item_id, matched, item_tokens, first_token of each item that a row holds."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, h long, item_id {items.schema['item_id'].dataType.simpleString()}, matched long, item_tokens long, first_token long"
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))

    def search(block: DataFrame):
        got = block.collect()
        held = spark.sparkContext.broadcast((pa.array([r[0] for r in got]), Index([r[1] for r in got])))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, index = held.value
            for b in batches:
                for first, _, data, offsets in chunks(b.column("text")):
                    d, i, n, at = index.hits(data, offsets).T
                    own = b.select(["doc_id", "h"]).take(pa.array(d + first))
                    cols = [*own.columns, ids.take(pa.array(i)), pa.array(n), pa.array(index.size[i]), pa.array(at)]
                    yield pa.RecordBatch.from_arrays(cols, ["doc_id", "h", "item_id", "matched", "item_tokens", "first_token"])

        return rows.mapInArrow(run, schema), held

    parts = blocks(items)
    if len(parts) == 1:
        return search(parts[0])[0]
    written = []
    for block in parts:
        hits, held = search(block)
        written.append(materialize(hits, "hits"))
        held.destroy()
    return reduce(DataFrame.unionByName, written) if written else spark.createDataFrame([], schema)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, matched (equal tokens), item_tokens, first_token: each item that a document holds."""
    return found(docs, items).drop("h")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item. A row is known by its doc_id (null is a value of its own) and its text's hash."""
    gone = found(docs, items).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct()
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_h")), "left_anti")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
