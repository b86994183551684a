"""Phrase collocations against a plain version."""

import random
import re
from collections import Counter

import pytest

from siltstone.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, n long"


def plain(rows, most=3, least=10, inside=50, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, most + 1):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i : i + size])] += 1
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, w), a in found.items():
        if any(L == lang and len(x) > len(w) and 100 * b >= inside * a and any(x[i : i + len(w)] == w for i in range(len(x))) for (L, x), b in found.items()):
            continue
        score, k = min((1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, v in out.items() for i, (s, a, p, x, y) in enumerate(sorted(v)[:top]))


def run(spark, rows, **settings):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = phrases.collocations(df, **({"cells": 1 << 12} | settings))
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in got.collect())


def made(seed, n):
    r = random.Random(seed)
    words = ["a", "b", "c", "Ä", "ä", "Zz", "ß日", "it's", " ", "▁x", "<s>", "aa"]
    gaps = [" "] * 12 + ["  ", "\t", " \t ", ",", ". ", "\n", "\r\n", " ; ", "?", "\x0b"]
    text = lambda: "".join(r.choice(words[: r.choice([3, 12])]) + r.choice(gaps) for _ in range(r.randrange(0, 60)))
    return [(i % 40, text(), r.choice(["en", "en", "de", None, "und", ""]), "x", 1) for i in range(n)] + [(None, None, None, None, None), (1, "", "en", "", 0), (2, " ,.\t", "xx", "", 0)]


@pytest.mark.parametrize(("seed", "settings"), [(1, {}), (2, {"shard": 90, "cells": 1 << 6}), (3, {"size": 900, "least": 2, "top": 5}), (4, {"most": 4, "least": 3, "inside": 80})])
def test_phrases(spark, seed, settings):
    rows = made(seed, 120)
    keep = {k: v for k, v in settings.items() if k in ("most", "least", "inside", "top")}
    want = plain(rows, **keep)
    assert len(want) > 10
    assert run(spark, rows, **settings) == want


def test_long_and_repeated(spark):
    """Counts over the range of a sketch cell, overlapping matches, one very long text, one very long word."""
    rows = [(i, "x x x x x", "en", "", 0) for i in range(300)] + [(1, "y " * 50000 + "w" * 70000 + " v" * 12, "en", "", 0)] + [(2, "w" * 70000 + " v", "en", "", 0)] * 9
    assert run(spark, rows) == plain(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_exact_scores(spark):
    """Products beyond 64 bits."""
    from pyspark.sql import functions as F

    rows = [(10**12 + 7, 10**12 + 11, 10**12 + 13), (3 * 10**9, 4 * 10**12 + 1, 3 * 10**9 + 1), (10, 10, 10)]
    got = [r[0] for r in spark.createDataFrame(rows, "a long, l long, r long").select(phrases.score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [1000000 * a * a // (x * y) for a, x, y in rows]


def test_documents_are_read_twice(spark, monkeypatch):
    """Once for the sketch and once for the counts, however many terms there are."""
    rows, read, whole = made(2, 120), spark.sparkContext.accumulator(0), phrases.rows_of

    def watched(docs):
        def count(batches):
            for b in batches:
                read.add(b.num_rows)
                yield b

        return whole(docs).mapInArrow(count, "lang string, text string")

    monkeypatch.setattr(phrases, "rows_of", watched)
    assert run(spark, rows, shard=20) == plain(rows)
    assert read.value == 2 * len(rows)


def test_parts_of_the_sketch_sum_up(monkeypatch):
    """Tasks that send what they hold several times, and cells beyond the range of a count."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(phrases, "HELD", 40)
    rows = [("en", x[1]) for x in made(3, 80) if x[1]] + [("en", "x " * 900)]
    batches = [pa.record_batch({"lang": pa.array([x]), "text": pa.array([y])}) for x, y in rows]
    for cells in (1 << 7, 1 << 36):
        n = Counter(c for w in phrases.each(iter(batches)) for h in w.hashes(3) for c in phrases.cell(h[h > 0], cells).tolist())
        parts = pa.Table.from_batches(phrases.sketched(3, cells)(iter(batches))).sort_by("part")
        span, got = cells // phrases.parts_of(cells), set()
        for b in phrases.summed(10)(iter(parts.to_batches(max_chunksize=5))):
            for p, size, held in zip(*(b.column(c).to_pylist() for c in phrases.PIECES)):
                got |= set((phrases.decoded(held, size)[0] + p * span).tolist())
        assert got == {c for c, k in n.items() if k >= 10}
    at = np.array([0, 5, (1 << 26) - 1])
    assert all((x == y).all() for x, y in zip(phrases.decoded(phrases.coded(at, np.array([1, 255, 9])), 3), (at, [1, 255, 9])))
