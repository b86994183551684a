"""Best-fit packing of documents into sequences of a fixed number of tokens, improved by swap-based local search.

Documents become token ids plus an end id; those longer than a sequence are cut into whole sequences behind a
first piece that takes the remainder. Pieces of full length fill a sequence each. The others are dealt out evenly
over groups of about ``GROUP`` pieces; each group is packed by best fit in decreasing order, then improved: moves,
one-for-one, two-for-one and one-for-two exchanges between underfull bins, each of which increases the sum of squared
fills, so that the search ends: when the bins are as few as the sizes allow, or no exchange is left. Items of one size
in a bin are the same to an exchange, so all exchanges of a bin are tried by its distinct sizes (at most
sqrt(2 * length)) and pairs of them. A group's bins lie within one task; groups do not depend on each other.

Defined results: null text is empty and has its end id alone; every row is packed, repeated ones too; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import materialize, table
from .textkit import chunks

LENGTH = 1024
END_ID = 2
GROUP = 16384
PIECES = "piece int, start long, length long, ids_crc32 long"

_encoders: dict = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str):
    """One encoder a worker process."""
    if path not in _encoders:
        from .tokens import Encoder

        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(ids: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """(start, ids) of the pieces of one document; only the first may be shorter."""
    first = len(ids) % length or min(len(ids), length)
    bounds = [0, *range(first, len(ids) + 1, length)]
    return [(a, ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; with_ids adds the ids as little-endian binary."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            for first, last, data, offsets in chunks(b.column("text")):
                raw = data.tobytes()
                texts = [raw[x:y].decode("utf-8", "replace") for x, y in zip(offsets[:-1], offsets[1:])]
                rows, out = [], ([], [], [], [], [])
                for i, ids in enumerate(enc.encode(texts)):
                    for k, (start, part) in enumerate(cut(np.append(ids, np.uint32(END_ID)).astype("<u4"), length)):
                        body = part.tobytes()
                        rows.append(first + i)
                        for put, x in zip(out, (k, start, len(part), zlib.crc32(body), body)):
                            put.append(x)
                cols = [b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(out[0], pa.int32())]
                cols += [pa.array(x, pa.int64()) for x in out[1:4]]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.array(out[4], pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {PIECES}" + ", ids binary" * with_ids)


class Bins:
    """Bins of a group during the search: sizes of the items in each, and which bins have which room."""

    def __init__(self, sizes: list[int], length: int):
        self.length, self.sizes = length, sizes
        self.items: list[list[int]] = []
        self.fill: list[int] = []
        self.by_room: list[list[int]] = [[] for _ in range(length + 1)]
        self.rooms = 0  # bit r is set if some bin has room r

    def open(self) -> int:
        self.items.append([])
        self.fill.append(0)
        self.note(len(self.fill) - 1)
        return len(self.fill) - 1

    def note(self, k: int) -> None:
        room = self.length - self.fill[k]
        insort(self.by_room[room], k)
        self.rooms |= 1 << room

    def forget(self, k: int) -> None:
        room = self.length - self.fill[k]
        own = self.by_room[room]
        own.pop(bisect_left(own, k))
        if not own:
            self.rooms &= ~(1 << room)

    def change(self, k: int, take: list[int], give: list[int]) -> None:
        """Take items out of bin k and give it others."""
        self.forget(k)
        for i in take:
            self.items[k].remove(i)
            self.fill[k] -= self.sizes[i]
        for i in give:
            self.items[k].append(i)
            self.fill[k] += self.sizes[i]
        self.note(k)

    def best_fit(self, size: int, skip: int = -1) -> int | None:
        """The used bin with least room that holds ``size`` more, other than ``skip``."""
        left = self.rooms >> size
        base = size
        while left:
            base += (left & -left).bit_length() - 1
            for k in self.by_room[base]:
                if k != skip and self.fill[k]:
                    return k
            left = self.rooms >> (base + 1)
            base += 1
        return None


def singles(bins: Bins, k: int) -> dict[int, list[int]]:
    """One item of each size in bin k, by size."""
    return {bins.sizes[i]: [i] for i in reversed(bins.items[k])}


def doubles(bins: Bins, k: int) -> dict[int, list[int]]:
    """Two items of bin k for each sum of sizes that two of them make."""
    by_size: dict[int, list[int]] = {}
    for i in bins.items[k]:
        by_size.setdefault(bins.sizes[i], []).append(i)
    sizes = sorted(by_size)
    out: dict[int, list[int]] = {}
    for a, x in enumerate(sizes):
        if len(by_size[x]) > 1:
            out.setdefault(2 * x, by_size[x][:2])
        for y in sizes[a + 1 :]:
            out.setdefault(x + y, [by_size[x][0], by_size[y][0]])
    return out


class Stock:
    """Which underfull bins can give away which total, as one item or as two."""

    def __init__(self, bins: Bins, used: list[int]):
        self.bins, self.used = bins, set(used)
        self.one: dict[int, set[int]] = {}
        self.two: dict[int, set[int]] = {}
        self.totals: dict[int, tuple[dict, dict]] = {}
        for k in used:
            self.enter(k)

    def enter(self, k: int) -> None:
        own = self.totals[k] = singles(self.bins, k), doubles(self.bins, k)
        for totals, stock in zip(own, (self.one, self.two)):
            for t in totals:
                stock.setdefault(t, set()).add(k)

    def leave(self, k: int) -> None:
        for totals, stock in zip(self.totals.pop(k), (self.one, self.two)):
            for t in totals:
                stock[t].discard(k)

    def swap(self, k: int, give: list[int], frm: int, take: list[int]) -> None:
        for x in (k, frm):
            if x in self.totals:
                self.leave(x)
        self.bins.change(k, give, take)
        self.bins.change(frm, take, give)
        for x in (k, frm):
            if x in self.used:
                self.enter(x)

    def find(self, stock: dict[int, set[int]], total: int, k: int) -> int | None:
        """A bin that is not fuller than bin k and can give ``total``."""
        most = self.bins.fill[k]
        return min((x for x in stock.get(total, ()) if x != k and self.bins.fill[x] <= most), default=None)

    def best(self, k: int) -> tuple[list[int], int, list[int]] | None:
        """The exchange that fills bin k most: items it gives, the other bin, items it takes."""
        room = self.bins.length - self.bins.fill[k]
        one, two = self.totals[k]
        for gain in range(room, 0, -1):
            for gives, stocks in ((one, (self.one, self.two)), (two, (self.one,))):
                for weight, give in gives.items():
                    for stock in stocks:
                        frm = self.find(stock, weight + gain, k)
                        if frm is not None:
                            return give, frm, self.totals[frm][stock is self.two][weight + gain]
        return None


def improve(bins: Bins, passes: int | None = None) -> None:
    """Local search: moves and exchanges that raise the sum of squared fills, until none is left (or for ``passes`` rounds)."""
    sizes, length = bins.sizes, bins.length
    least = -(-sum(sizes) // length)
    while passes is None or passes > 0:
        passes = None if passes is None else passes - 1
        used = sorted((k for k in range(len(bins.fill)) if 0 < bins.fill[k] < length), key=lambda k: (bins.fill[k], k))
        if sum(f > 0 for f in bins.fill) <= least or len(used) < 2:
            return
        changed = False
        for k in used:  # moves empty the emptiest bins first
            for i in sorted(bins.items[k], key=lambda i: -sizes[i]):
                to = bins.best_fit(sizes[i], k)
                if to is not None and bins.fill[to] + sizes[i] > bins.fill[k]:
                    bins.change(k, [i], [])
                    bins.change(to, [], [i])
                    changed = True
        stock = Stock(bins, [k for k in used if bins.fill[k]])
        for k in reversed(used):  # fullest first: fill its room by exchanges with emptier bins
            while 0 < bins.fill[k] < length and (found := stock.best(k)):
                give, frm, take = found
                stock.swap(k, list(give), frm, list(take))
                changed = True
        if not changed:
            return


def pack(sizes: list[int], length: int = LENGTH, passes: int | None = None) -> list[int]:
    """The bin of each item: best fit in decreasing order, then local search."""
    bins = Bins(sizes, length)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        k = bins.best_fit(sizes[i])
        if k is None:
            k = bins.open()
        bins.change(k, [], [i])
    improve(bins, passes)
    out = [0] * len(sizes)
    for k, items in enumerate(bins.items):
        for i in items:
            out[i] = k
    return out


def place(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if len(b)]
        if not got:
            return
        order = ["length", "doc_id", "piece", "start", "ids_crc32"]
        rows = pa.Table.from_batches(got).sort_by([(c, "ascending") for c in order])
        sizes = rows["length"].to_numpy()
        bins = np.array(pack(sizes.tolist(), length), np.int64)
        by_bin = np.argsort(bins, kind="stable")
        rows, bins, sizes = rows.take(pa.array(by_bin)), bins[by_bin], sizes[by_bin]
        before = np.cumsum(sizes) - sizes
        begins = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
        offset = before - np.repeat(before[begins], np.diff(np.append(begins, len(bins))))
        ids = bins + ((TaskContext.get().partitionId() + 1) << 40)
        yield from rows.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset)).to_batches()

    return run


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    cuts = materialize(pieces(docs, tokenizer, length), "pieces")
    part = cuts.where(F.col("length") < length)
    groups = max(1, -(-part.count() // group))
    kind = docs.schema["doc_id"].dataType.simpleString()
    placed = part.repartition(groups).mapInArrow(place(length), f"doc_id {kind}, {PIECES}, sequence_id long, offset long")
    full = cuts.where(F.col("length") == length).select("*", F.monotonically_increasing_id().alias("k"))
    full = full.select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(full)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())
