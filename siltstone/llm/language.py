"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of up to ``ORDER`` bytes with escape probabilities (method C, with exclusion). Its
statistics are frozen after training, so every (context, byte) of a tree has one code length, and every
context one escape cost. A byte is coded at the longest context in which it was seen, after the escapes of the longer
ones; the exact code length of a text in a language is the sum. The shortest code wins; the score is the winner's
share when code lengths are read as probabilities.

Trees hold every context and byte of their sample: languages, bytes and contexts have no cap. Languages are kept in
blocks of ``TOGETHER``, whose trees share one sorted table of (context, byte) with a column for each language.
Before coding, A-Z and the upper-case letters of Latin-1 are lower-cased, and every other ASCII character
counts as a space; only the first of several spaces is coded. Learnt from at most ``PER_LANG`` documents of each language outside the
held-out fold, of texts over ``LONGEST`` bytes from as much out of their middle (a bound on fitting alone); all texts are scored whole.

Defined results: null texts and texts without a letter give ``und`` with score 0; ties go to the language that sorts
first; without training rows all texts give ``und``; a doc_id that occurs with several languages counts for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .labelled import fold
from .store import materialize, table
from .textkit import LOWER, chunks, segment_sum

ORDER = 5
PER_LANG = 200
LONGEST = 1 << 15
TOGETHER = 8
BROADCAST = 500_000
#: Bytes that can be coded: space, a-z and the bytes beyond ASCII.
ALPHABET = 1 + 26 + 128
UND = "und"

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


def plain(data: np.ndarray) -> np.ndarray:
    """Lower-cased bytes, all other ASCII as spaces."""
    out = LOWER[data]
    out = np.where(LETTER[out] | (out >= 128), out, np.uint8(32))
    if len(out) > 1:
        wide = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][wide] += 32
    return out


def keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each byte under the ``ORDER`` bytes before it, as one number, and which are coded; a document begins after spaces."""
    own = plain(data)
    n = len(own)
    begin = np.zeros(n + 1, bool)
    begin[offsets] = True
    out, fresh, before = own.astype(np.int64), np.zeros(n, bool), None
    for k in range(1, ORDER + 1):
        prev = np.full(n, 32, np.int64)
        prev[k:] = own[: max(n - k, 0)]
        fresh[k - 1 :] |= begin[: max(n - k + 1, 0)]  # a document begins within the last k bytes
        prev[fresh] = 32
        before = prev if before is None else before
        out |= prev << (8 * k)
    return out, (own != 32) | (before != 32)


def suffix(key: np.ndarray, order: int) -> np.ndarray:
    """The (context, byte) of a shorter context; order -1 leaves nothing."""
    return key & ((1 << 8 * (order + 1)) - 1)


def spots(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where values stand in a sorted table, and whether they are in it."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


class Tree:
    """The frozen tree of one language: for each order its (context, byte) with code lengths, and its contexts with escape costs."""

    def __init__(self, coded: np.ndarray):
        self.pairs, self.bits, self.contexts, self.escapes = [], [], [], []
        p = None
        for order in range(ORDER + 1):
            pair, count = np.unique(suffix(coded, order), return_counts=True)
            context, who = np.unique(pair >> 8, return_inverse=True)
            below = p[spots(self.pairs[-1], suffix(pair, order - 1))[0]] if order else np.full(len(pair), 1 / ALPHABET)
            n, d = np.bincount(who, count), np.bincount(who).astype(float)
            left = 1 - np.bincount(who, below)
            escape = np.where(left > 1e-9, d / (n + d), 0.0)
            p = count / n[who] * (1 - escape[who])
            self.pairs.append(pair)
            self.bits.append(-np.log2(p))
            self.contexts.append(context)
            self.escapes.append(-np.log2(np.maximum(escape, 1e-12) / np.maximum(left, 1e-9)))


class Block:
    """The trees of some languages side by side, tabulated for every (context, byte) that one of them has."""

    def __init__(self, trees: list[Tree]):
        self.pairs, self.bits, self.contexts, self.escapes = [], [], [], []
        for order in range(ORDER + 1):
            context = np.unique(np.concatenate([t.contexts[order] for t in trees]))
            escape = np.zeros((len(context), len(trees)))
            for j, t in enumerate(trees):
                escape[spots(context, t.contexts[order])[0], j] = t.escapes[order]
            pair = np.unique(np.concatenate([t.pairs[order] for t in trees]))
            below = self.bits[-1][spots(self.pairs[-1], suffix(pair, order - 1))[0]] if order else np.log2(ALPHABET)
            bits = below + escape[spots(context, pair >> 8)[0]]
            for j, t in enumerate(trees):
                bits[spots(pair, t.pairs[order])[0], j] = t.bits[order]
            self.pairs.append(pair)
            self.bits.append(bits.astype(np.float32))
            self.contexts.append(context)
            self.escapes.append(escape.astype(np.float32))

    def cost(self, coded: np.ndarray) -> np.ndarray:
        """Bits of each (context, byte) in each language."""
        out = np.zeros((len(coded), self.bits[0].shape[1]), np.float32)
        todo = np.arange(len(coded))
        for order in range(ORDER, -1, -1):
            key = suffix(coded[todo], order)
            at, known = spots(self.pairs[order], key)
            out[todo[known]] += self.bits[order][at[known]]
            todo, key = todo[~known], key[~known]
            at, known = spots(self.contexts[order], key >> 8)
            out[todo[known]] += self.escapes[order][at[known]]
        out[todo] += np.float32(np.log2(ALPHABET))
        return out


@dataclass
class Model:
    langs: list[str]
    blocks: list[Block]

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of each document in each language."""
        key, coded = keys(data, offsets)
        where = np.flatnonzero(coded)
        uniq, back = np.unique(key[where], return_inverse=True)
        first = np.searchsorted(where, offsets)
        return np.concatenate([segment_sum(b.cost(uniq)[back], first) for b in self.blocks], 1)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(offsets) - 1
        ascii_letters = np.concatenate([[0], np.cumsum(LETTER[data])])
        lettered = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
        for i in np.flatnonzero(~lettered):
            lettered[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "ignore"))
        if not self.langs:
            return [UND] * n, np.zeros(n)
        bits = self.lengths(data, offsets)
        best = bits.argmin(1)
        gap = bits - bits[np.arange(n), best][:, None]
        score = 1 / np.exp2(-np.minimum(gap, 1000)).sum(1)
        return [self.langs[k] if ok else UND for k, ok in zip(best, lettered)], np.where(lettered, score, 0.0)


def fit(texts: dict[str, list[bytes]]) -> Model:
    """Context trees from the training texts of each language; a language without a coded byte is left out."""
    trees = {}
    for lang in sorted(texts):
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts[lang]])]).astype(np.int64)
        key, coded = keys(np.frombuffer(b"".join(texts[lang]), np.uint8), offsets)
        if coded.any():
            trees[lang] = Tree(key[coded])
    own = list(trees.values())
    return Model(list(trees), [Block(own[k : k + TOGETHER]) for k in range(0, len(own), TOGETHER)])


def bounded(text: Column) -> Column:
    """``text``, or a slice from its middle where it has more than ``LONGEST`` bytes; a character has four at most."""
    n = LONGEST // 4
    return F.when(F.octet_length(text) <= LONGEST, text).otherwise(F.substring(text, F.floor((F.length(text) - n) / 2).cast("int") + 1, F.lit(n)))


def train(docs: DataFrame, per_lang: int = PER_LANG) -> Model:
    """Fit on documents that are chosen by a hash of doc_id."""
    own = docs.select("doc_id", "lang").where((fold(4) != 2) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = materialize(own.withColumn("r", rank).where(F.col("r") <= per_lang).select("doc_id", "lang").distinct(), "sample")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST else ids
    rows = docs.select("doc_id", "lang", bounded(F.col("text")).alias("text")).where("text IS NOT NULL").join(ids, ["doc_id", "lang"]).distinct().collect()
    texts: dict[str, list[bytes]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["doc_id"], r["text"])):
        texts.setdefault(r["lang"], []).append(r["text"].encode("utf-8", "replace"))
    return fit(texts)


def identify(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, per_lang))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last, data, offsets in chunks(b.column("text")):
                part = b.slice(first, last - first)
                lang, score = model.value.predict(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(lang), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", (fold(4) == 2).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )


def op9_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
