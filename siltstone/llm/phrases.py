"""Phrase collocations: candidates from upper bounds of a sketch, counted exactly by Aho-Corasick automata.

Texts are cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words ``[^\\x20\\x09]+`` (A-Z lower-cased); everything is per language.

1. Every task counts its phrases of 1 to ``most`` words into the cells of a sketch, one hash for language and phrase. Of the 2 ** 36 cells only those
   met are held, sorted and sent on as compressed gaps and counts, by parts that are summed over the tasks. A cell is never below the count of any of its
   phrases, so a phrase is a candidate only if its own cell and those of all shorter phrases in it reach ``least``. What tasks get back is one bit for
   neighbouring cells, ``ROOM`` bits for each cell that reaches it, so the share of false candidates does not grow with the documents.
2. A second pass reads the documents in groups of about ``GROUP`` bytes. Words that are candidates are counted and become three symbols each, one of each of three
   alphabets; the longer candidates of a group are compiled into automata of at most ``SHARD`` terms and ``BYTES`` symbols, which count all matches in the group, overlapping ones
   too. What is a candidate is the same in all groups, so sums over the groups are exact, and nothing that a task holds grows with the table.
3. Candidates are sent with their counts, in compressed blocks by buckets of hashes, which are summed bucket by bucket; those below ``least`` go.
4. Thresholds are applied to phrases and their parts, which are at least as frequent; products are decimals, so they are exact beyond 64 bits.

The width of the sketch decides how many false candidates are counted, never the result. Within a group words and candidates are told apart by 64-bit hashes.

Defined results: a null text is empty, a null language is ``und``; rows count as often as they are repeated, whatever their ids; texts are
never cut; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import discard, materialize, table
from .textkit import LOWER, SPACE, U, chunks, give_back, hash_runs, mix, owners, runs, salts

MOST, LEAST, TOP = 3, 10, 2000
CELLS, PARTS, BUCKETS = 1 << 36, 1 << 10, 1 << 10
#: Cells that a task holds; bits of the broadcast for each cell that reaches the threshold, and at most.
HELD, ROOM, WIDEST = 1 << 23, 64, 1 << 31
GROUP, SHARD, BYTES = 8 << 20, 600_000, 24_000_000
PIECES = ["part", "size", "held"]
BLOCKS = ["bucket", "lang", "held", "size", "f", "n"]

DELIMITER = np.zeros(256, bool)
DELIMITER[[ord(c) for c in ".,;:!?"]] = True
DELIMITER[10:14] = True
APART = DELIMITER | SPACE


def rows_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))


def laid(data: np.ndarray, starts: np.ndarray, size: np.ndarray, before: int, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``data`` one after the other, with so many spaces before and after each; and where each ends. Places are worked out for about a million at once."""
    end = np.cumsum(before + size + after)
    out = np.full(int(end[-1]) if len(end) else 0, 0x20, np.uint8)
    to, until, first = end - after - size, np.cumsum(size), 0
    while first < len(size):
        done = until[first] - size[first]
        some = slice(first, max(first + 1, int(np.searchsorted(until, done + (1 << 20), "right"))))
        n = size[some]
        ahead, step = until[some] - n - done, np.arange(n.sum())
        out[np.repeat(to[some] - ahead, n) + step] = data[np.repeat(starts[some] - ahead, n) + step]
        first = some.stop
    return out, end


class Words:
    """The words of a chunk of documents."""

    def __init__(self, langs: pa.Array, data: np.ndarray, offsets: np.ndarray):
        self.data = LOWER[data]
        self.starts, self.ends, first = runs(~APART[data], offsets)
        names = langs.dictionary_encode()
        self.langs = names.dictionary.to_pylist()
        doc = owners(first)
        self.lang = np.asarray(names.indices)[doc]
        marks = np.concatenate([[0], np.cumsum(DELIMITER[data])])
        #: Whether the word after it is of another piece.
        self.last = np.ones(len(doc), bool)
        if len(doc) > 1:
            self.last[:-1] = (doc[1:] != doc[:-1]) | (marks[self.starts[1:]] != marks[self.ends[:-1]])

    def hashes(self, most: int) -> list[np.ndarray]:
        """For 1 to ``most`` words: the hash of the phrase that begins at each word, with its language; 0 where the piece ends before."""
        n, k = len(self.starts), salts(2 * most)
        own = np.array([int.from_bytes(blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for x in self.langs] + [0], U)[self.lang]
        word = hash_runs(self.data, self.starts, self.ends)
        acc, ok = own + word * k[0], np.ones(n, bool)
        out = [mix(acc + k[most]) | U(1)]
        for j in range(1, most):
            ok[n - j :] = False
            ok[: n - j] &= ~self.last[j - 1 : n - 1]
            acc[: n - j] += word[j:] * k[j]
            out.append(np.where(ok, mix(acc + k[most + j]) | U(1), U(0)))
        return out


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for b in batches:
        for first, last, data, offsets in chunks(b.column("text")):
            yield Words(b.column("lang").slice(first, last - first), data, offsets)


def cell(h: np.ndarray, cells: int) -> np.ndarray:
    return (h >> U(64 - (cells.bit_length() - 1))).astype(np.int64)


def folded(parts: list[np.ndarray]) -> np.ndarray:
    """Sorted cells with their counts, each as cell << 8 | count; those of equal cells are summed, up to 255. Empties the list."""
    held = np.concatenate(parts)
    parts.clear()
    if not len(held):
        return held
    held.sort()
    first = np.flatnonzero(np.append(True, (held[1:] ^ held[:-1]) > 255))
    n = np.add.reduceat(held.view("<u8").view(np.uint8)[::8], first, dtype=np.int64)
    held = held[first]
    held &= ~255
    held |= np.minimum(n, 255, out=n)
    return held


def coded(at: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending numbers below 2 ** 32 as the bytes of their gaps, low ones first, and their counts."""
    gaps = np.diff(at, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4)
    return pa.compress(gaps.T.tobytes() + n.astype(np.uint8).tobytes(), "zstd", asbytes=True)


def decoded(block, size: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.decompress(block, 5 * size, "zstd"), np.uint8)
    gaps = np.ascontiguousarray(raw[: 4 * size].reshape(4, size).T).view("<u4")[:, 0]
    return np.cumsum(gaps, dtype=np.int64), raw[4 * size :].astype(np.int64)


def parts_of(cells: int) -> int:
    return min(PARTS, cells // 8)


def sketched(most: int, cells: int):
    parts = parts_of(cells)
    span = cells // parts

    def out(held: np.ndarray) -> pa.RecordBatch:
        at = held >> 8
        edge = np.searchsorted(at, np.arange(parts + 1) * span)
        own = np.flatnonzero(np.diff(edge))
        blocks = [coded(at[i:j] - p * span, held[i:j] & 255) for p, i, j in zip(own.tolist(), edge[own], edge[own + 1])]
        return pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.diff(edge)[own]), pa.array(blocks, pa.binary())], PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [np.zeros(0, np.int64)], 0
        for w in each(batches):
            h = np.concatenate(w.hashes(most))
            held.append(cell(h[h > 0], cells) << 8 | 1)
            n += len(held[-1])
            if n > HELD // 4:
                held, n = [folded(held)], 0
                if len(held[0]) > HELD:
                    yield out(held.pop())
        yield out(folded([np.zeros(0, np.int64), *held]))
        give_back()

    return run


def summed(least: int):
    """The cells that reach ``least``, of sorted parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, n = None, [], 0

        def out() -> pa.RecordBatch:
            all_ = folded(held)
            at = all_[(all_ & 255) >= least] >> 8
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([len(at)]), pa.array([coded(at, np.zeros(len(at)))], pa.binary())], PIECES)

        for b in batches:
            for p, size, x in zip(b.column("part").to_pylist(), b.column("size").to_pylist(), b.column("held")):
                if p != now:
                    if now is not None:
                        yield out()
                    now, held, n = p, [], 0
                at, count = decoded(x.as_buffer(), size)
                held.append(at << 8 | count)
                n += size
                if n > HELD // 4:
                    held, n = [folded(held)], 0
        if now is not None:
            yield out()

    return run


def sketch(rows: DataFrame, most: int, least: int, cells: int) -> np.ndarray:
    """Packed bits, a power of two of them: whether any of the cells with the same first bits counts at least ``least`` over all rows."""
    assert least <= 255
    schema = "part long, size long, held binary"
    full = rows.mapInArrow(sketched(most, cells), schema).repartition("part").sortWithinPartitions("part").mapInArrow(summed(least), schema)
    full = materialize(full, "cells")
    n = full.agg(F.sum("size")).first()[0] or 0
    bits = min(cells, WIDEST, max(PARTS * 8, 1 << (ROOM * n).bit_length()))
    parts = parts_of(cells)
    out = np.zeros((parts, bits // parts // 8), np.uint8)
    for r in full.toLocalIterator():
        mine = np.zeros(bits // parts, bool)
        mine[decoded(r["held"], r["size"])[0] // (cells // bits)] = True
        out[r["part"]] = np.packbits(mine)
    discard(full)
    return out.ravel()


class Group:
    """The words of some documents with the hashes of the candidates that begin at them, 0 where none does, by widths."""

    def __init__(self, held: list[tuple[Words, np.ndarray, list[np.ndarray]]]):
        before = np.cumsum([0, *(len(w.data) for w, _, _ in held)])
        self.data = np.concatenate([w.data for w, _, _ in held])
        self.starts, self.ends = (np.concatenate([getattr(w, k) + n for (w, _, _), n in zip(held, before)]) for k in ("starts", "ends"))
        self.last = np.concatenate([w.last for w, _, _ in held])
        self.lang = np.concatenate([lang for _, lang, _ in held])
        self.hashes = [np.concatenate(h) for h in zip(*(h for _, _, h in held))]

    def lines(self, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The phrases of ``width`` words that begin at the words ``first``, with single spaces and a line end each; and their sizes."""
        at = (first[:, None] + np.arange(width)).ravel()
        out, end = laid(self.data, self.starts[at], self.ends[at] - self.starts[at], 0, np.ones(len(at), np.int64))
        end = end[width - 1 :: width]
        out[end - 1] = 0x0A
        return out, np.diff(end, prepend=0)

    def coded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each word that is a candidate is first met, how often it occurs, and three symbols for each word of the group (0 for others), each of an alphabet of its own."""
        at = np.flatnonzero(self.hashes[0])
        _, one, own, n = np.unique(self.hashes[0][at], return_index=True, return_inverse=True, return_counts=True)
        place = np.empty(len(n), np.int64)
        place[np.argsort(-n, kind="stable")] = np.arange(len(n))  # frequent words first: an automaton looks through the edges of a node in turn
        base = max(1, round(len(n) ** (1 / 3)) + 1)
        symbols = np.zeros((len(self.starts), 3), "<u4")
        code = place[own]
        for i, digit in enumerate((code // base // base, code // base % base, code % base)):
            symbols[at, i] = digit + i * base + 1
        return at[one], n, symbols


def string(symbols: np.ndarray) -> str:
    return symbols.tobytes().decode("utf-32-le")


def matches(symbols: np.ndarray, last: np.ndarray, first: np.ndarray, width: np.ndarray, most: int, size: int) -> np.ndarray:
    """How often terms (first word, width) occur in a text of words in symbols that no term crosses the ends of, by automata of at most ``most`` terms and ``size`` symbols.

    The symbols of the places in a word differ, so terms match whole words only.
    """
    import ahocorasick

    known = symbols[:, 0] > 0
    count = np.where(known, 3, 0) + (last | ~known)  # a 0 after each piece, and in place of a word that no term holds
    text = np.zeros(int(count.sum()), "<u4")
    at = np.cumsum(count) - count
    for i in range(3):
        text[at[known] + i] = symbols[known, i]
    del known, count, at
    text = string(text)
    key = symbols[first].astype(np.int64) @ np.array([1 << 42, 1 << 21, 1])
    order = np.argsort(key, kind="stable")  # terms of an automaton begin alike, so it leaves most of the text soon
    first, width = first[order], width[order]
    out, until, i = np.zeros(len(first), np.int64), np.cumsum(3 * width), 0
    while i < len(first):
        before = until[i] - 3 * width[i]
        j = max(i + 1, min(i + most, int(np.searchsorted(until, before + size, "right"))))
        n = width[i:j]
        ahead = np.cumsum(n) - n
        some = string(symbols[np.repeat(first[i:j] - ahead, n) + np.arange(n.sum())])
        ends = (until[i:j] - before).tolist()
        made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, (x, y) in enumerate(zip([0, *ends], ends)):
            made.add_word(some[x:y], k)
        made.make_automaton()
        out[order[i:j]] = np.bincount(np.fromiter(map(itemgetter(1), made.iter(text)), np.int64), minlength=j - i)
        i = j
    return out


class Found:
    """The documents of a group and the candidates in them, each of which is sent on once, in one compressed block for each language and bucket of hashes."""

    def __init__(self, shard: int, size: int):
        self.shard, self.limit = shard, size
        self.total: dict[str, int] = {}
        self.held: list[tuple[Words, np.ndarray, list[np.ndarray]]] = []
        self.bytes = 0

    def add(self, w: Words, hashes: list[np.ndarray]) -> None:
        for lang, n in zip(w.langs, np.bincount(w.lang, minlength=len(w.langs)).tolist()):
            self.total[lang] = self.total.get(lang, 0) + n
        place = {lang: i for i, lang in enumerate(self.total)}
        self.held.append((w, np.array([place[lang] for lang in w.langs] + [0], np.int32)[w.lang], hashes))
        self.bytes += len(w.data)

    def blocks(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        g = Group(self.held)
        self.held, self.bytes = [], 0
        one, n, symbols = g.coded()
        terms = [(one, 1)]
        for width, h in enumerate(g.hashes[1:], 2):
            where = np.flatnonzero(h)
            terms.append((where[np.unique(h[where], return_index=True)[1]], width))
        held = g.hashes[1] > 0
        held[1:] |= held[:-1].copy()
        symbols[~held] = 0  # words in no candidate of two words, and so in no longer one
        first, width = np.concatenate([x for x, _ in terms[1:]]), np.concatenate([np.full(len(x), k) for x, k in terms[1:]])
        f = np.concatenate([n, matches(symbols, g.last, first, width, self.shard, self.limit)])
        del symbols, first, width
        data, size = zip(*(g.lines(*x) for x in terms))
        data, size = np.concatenate(data), np.concatenate(size)
        lang = np.concatenate([g.lang[first] for first, _ in terms])
        bucket = np.concatenate([cell(g.hashes[width - 1][first], BUCKETS) for first, width in terms])
        del g, terms
        order = np.lexsort((bucket, lang))
        lang, bucket, f = lang[order], bucket[order], f[order].astype("<i8")
        data, end = laid(data, (np.cumsum(size) - size)[order], size[order], 0, np.zeros(len(order), np.int64))
        edge = np.append(np.flatnonzero(np.append(True, (lang[1:] != lang[:-1]) | (bucket[1:] != bucket[:-1])) if len(lang) else lang), len(lang))
        names, first, end = [*self.total], edge[:-1], np.append(0, end)
        held, counts = ([pa.compress(x[a:b].tobytes(), "zstd", asbytes=True) for a, b in zip(at[:-1], at[1:])] for x, at in ((data, end[edge]), (f, edge)))
        cols = [pa.array(bucket[first]), pa.array([names[i] for i in lang[first]], pa.string()), pa.array(held, pa.binary()), pa.array(np.diff(end[edge])), pa.array(counts, pa.binary()), pa.array(np.diff(edge))]
        yield pa.RecordBatch.from_arrays(cols, BLOCKS)
        give_back()

    def words(self) -> pa.RecordBatch:
        n = len(self.total)
        empty = pa.nulls(n, pa.binary())
        cols = [pa.array([i % BUCKETS for i in range(n)], pa.int64()), pa.array([*self.total], pa.string()), empty, pa.nulls(n, pa.int64()), empty, pa.array([*self.total.values()], pa.int64())]
        return pa.RecordBatch.from_arrays(cols, BLOCKS)


def candidates(bits, most: int, shard: int, size: int):
    """Blocks of the phrases whose bits and those of their parts are all set, with their counts (n: how many phrases); and the words of each language (n), without phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found = bits.value, Found(shard, size)
        for w in each(batches):
            hashes, below, n = w.hashes(most), None, len(w.starts)
            for h in hashes:
                at = cell(h, 8 * len(held))
                ok = (h > 0) & ((held[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)
                if below is not None and n:
                    ok[: n - 1] &= below[:-1] & below[1:]
                    ok[n - 1] = False
                below = ok
                h[~ok] = 0
            found.add(w, hashes)
            if found.bytes > GROUP:
                yield from found.blocks()
        yield from found.blocks()
        yield found.words()

    return run


def merged(least: int):
    """The phrases of blocks sorted by bucket and language that occur ``least`` times, with their sums; and the sums of the words, with a null phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, n = None, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            if now is not None:
                found = sums(held) if held else None
                found = found.filter(pc.greater_equal(found["f"], least)) if held else pa.table({"phrase": pa.array([], pa.binary()), "f": pa.array([], pa.int64())})
                phrase = pa.array([x[:-1] for x in found["phrase"].to_pylist()], pa.binary()).cast(pa.string())
                size = len(phrase) + 1
                f = found["f"].combine_chunks()
                cols = [pa.array([now[1]] * size, pa.string()), pa.concat_arrays([phrase, pa.nulls(1, pa.string())]), pa.concat_arrays([f, pa.nulls(1, pa.int64())]), pa.concat_arrays([pa.nulls(size - 1, pa.int64()), pa.array([n], pa.int64())])]
                yield pa.RecordBatch.from_arrays(cols, ["lang", "phrase", "f", "n"])

        for b in batches:
            for bucket, lang, block, size, f, number in zip(*(b.column(c).to_pylist() for c in BLOCKS)):
                if (bucket, lang) != now:
                    yield from out()
                    now, held, n = (bucket, lang), [], 0
                if block is None:
                    n += number
                    continue
                data = pa.decompress(block, size, "zstd")
                ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x0A).astype(np.int64) + 1
                phrases = pa.LargeBinaryArray.from_buffers(pa.large_binary(), number, [None, pa.py_buffer(np.append(0, ends)), data])
                held.append(pa.table({"phrase": phrases, "f": np.frombuffer(pa.decompress(f, 8 * number, "zstd"), "<i8")}))
                if len(held) == 64:
                    held = [sums(held)]
        yield from out()

    return run


def sums(held: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(held).group_by("phrase").aggregate([("f", "sum")]).rename_columns({"f_sum": "f"}).select(["phrase", "f"])


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) of whole numbers, exactly; at most 1000000, as neither part is rarer than the whole."""
    a, left, right = (x.cast("decimal(19,0)") for x in (a, left, right))
    return F.call_function("div", a * a * F.lit(1000000).cast("decimal(7,0)"), left * right)


def collocations(docs: DataFrame, most: int = MOST, least: int = LEAST, inside: int = 50, top: int = TOP, cells: int = CELLS, shard: int = SHARD, size: int = BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language, of 2 to ``most`` words and at least ``least`` occurrences.

    A phrase inside a longer one with at least ``inside`` percent of its occurrences is left out.
    """
    rows = rows_of(docs)
    sc = rows.sparkSession.sparkContext
    bits = sc.broadcast(sketch(rows, most, least, cells))
    blocks = rows.mapInArrow(candidates(bits, most, shard, size), "bucket long, lang string, held binary, size long, f binary, n long")
    found = blocks.repartition("bucket").sortWithinPartitions("bucket", "lang").mapInArrow(merged(least), "lang string, phrase string, f long, n long")
    found = materialize(found, "counts")
    bits.destroy()
    counts = found.where("phrase IS NOT NULL").select("lang", "phrase", "f", F.split("phrase", " ").alias("_w"))
    one = counts.where(F.size("_w") > 1).withColumnRenamed("f", "a")

    def part(start, length) -> Column:
        return F.array_join(F.slice("_w", start, length), " ")

    n = F.size("_w")
    cuts = one.select("lang", "phrase", "a", F.explode(F.transform(F.sequence(F.lit(1), n - 1), lambda k: F.struct(k.alias("k"), part(1, k).alias("x"), part(k + 1, n - k).alias("y")))).alias("_c"))
    known = counts.select("lang", F.col("phrase").alias("_part"), "f")
    cuts = cuts.select("lang", "phrase", "a", "_c.*")
    for side, name in (("x", "l"), ("y", "r")):
        cuts = cuts.join(known.select("lang", F.col("_part").alias(side), F.col("f").alias(name)), ["lang", side])
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("_c"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda m: F.transform(F.sequence(F.lit(1), n - m + 1), lambda i: part(i, m))))
    longer = one.where(n > 2).select("lang", F.explode(spans).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    left = lowest.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("_longer") < inside * F.col("a"), F.lit(True)))
    best = Window.partitionBy("lang").orderBy(F.desc("_c.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    totals = found.where("phrase IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "_c.l", "_c.r", "n", "_c.score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT d, lang, generate_subscripts(x, 1) AS p, unnest(x) AS piece FROM (SELECT d, lang, regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]') AS x FROM d)),
w AS (SELECT d, lang, p, generate_subscripts(x, 1) AS i, unnest(x) AS w FROM (SELECT d, lang, p, regexp_extract_all(piece, '[^\x20\x09]+') AS x FROM p)),
n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
g AS (SELECT lang, w AS a1, lead(w) OVER s AS a2, lead(w, 2) OVER s AS a3 FROM w WINDOW s AS (PARTITION BY d, p ORDER BY i)),
f AS (
  SELECT lang, a1 AS phrase, 1 AS size, count(*) AS f FROM g GROUP BY ALL
  UNION ALL SELECT lang, a1 || ' ' || a2, 2, count(*) FROM g WHERE a2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, a1 || ' ' || a2 || ' ' || a3, 3, count(*) FROM g WHERE a3 IS NOT NULL GROUP BY ALL),
c AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
k AS (
  SELECT c.*, k, l.f AS l, r.f AS r, ((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM c, (VALUES (1), (2)) t(k)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:c.size], ' ')
  WHERE k < c.size),
s AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
b AS (
  SELECT lang, part AS phrase, max(a) AS longer
  FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM c WHERE size = 3) GROUP BY ALL),
o AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM s LEFT JOIN b ON b.lang = s.lang AND b.phrase = s.phrase WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000
"""
