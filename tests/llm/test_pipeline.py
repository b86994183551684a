"""The corpus pipeline against a brute-force version on small tables with nulls, repeated ids, ties and clashing columns."""

import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from siltstone.llm import packing, quality, tokens

from .test_brute import brute_leaks, check_bins, sets

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept string, h string, label int, sequence_id string"


def tables(spark, path, rows, labels, items):
    spark.createDataFrame([(d, t, "en", "s", len(t or ""), "k", "h", 1, "q") for d, t in rows], COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def made(seed):
    g = random.Random(seed)
    words = ["w%d" % i for i in range(300)]
    say = lambda n: " ".join(g.choice(words) for _ in range(n))
    items = [(i, say(g.choice([6, 14, 25]))) for i in range(5)] + [(9, None), (None, "")]
    rows = []
    for i in range(90):
        r = g.random()
        if r < 0.5 or not rows:
            t = say(g.randint(0, 60))
        elif r < 0.65:
            t = g.choice(rows)[1]
            t = t and t.replace(" ", "  ", 3)
        elif r < 0.85:
            x = (g.choice(rows)[1] or "").split()
            if x:
                x[g.randrange(len(x))] = g.choice(words)
            t = " ".join(x)
        else:
            t = say(10) + " " + (g.choice(items)[1] or "") + " " + say(10)
        if g.random() < 0.25:
            t = " ".join(x + "!!" for x in (t or "").split())  # what the labels call bad
        rows.append((i, t))
    rows += [(3, "another text under the same id " + say(12)), (3, rows[7][1]), (None, rows[5][1]), (None, None), (None, say(30)), (200, ""), (201, None), (202, say(3000))]
    rows += [rows[8], rows[8]]
    labels = [(i, int("!!" not in (t or "")), 0) for i, t in rows[:60]] + [(None, 1, 0), (4, None, None)]
    g.shuffle(rows)
    return rows, labels, items


def brute(rows, model, items, width=5, percent=80):
    def accepted(t):
        raw = np.frombuffer((t or "").encode(), np.uint8)
        _, f = quality.indicators(raw, np.array([0, len(raw)]))
        margin = sum(float(model.weights[k]) for k in f.tolist()) + model.bias
        return 1 / (1 + np.exp(-(model.slope * margin + model.shift))) >= quality.THRESHOLD

    rows = [r for r in rows if accepted(r[1])]
    least = {}
    form = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for d, t in rows:
        if d is not None:
            least[form(t)] = min(d, least.get(form(t), d))
    rows = [(d, t) for d, t in rows if least.get(form(t)) == d]
    s = [sets(t, width) for _, t in rows]
    keep, seen = [], set()
    for i in range(len(rows)):
        if rows[i][0] is None or not s[i]:
            keep.append(i)
        elif i not in seen:
            part, todo = {i}, [i]
            while todo:
                x = todo.pop()
                for y in range(len(rows)):
                    if y not in part and rows[y][0] is not None and s[y] and 100 * len(s[x] & s[y]) >= percent * len(s[x] | s[y]):
                        part.add(y)
                        todo.append(y)
            seen |= part
            first = min(rows[k][0] for k in part)
            keep += [k for k in part if rows[k][0] == first]
    rows = [rows[k] for k in keep]
    held = brute_leaks(list(enumerate(t or "" for _, t in rows)), [(i, t or "") for i, t in items])
    return [r for k, r in enumerate(rows) if k not in {d for d, _ in held}]


@pytest.mark.parametrize("seed", [1, 2])
def test_pipeline_equals_brute_force(spark, tmp_path, seed):
    rows, labels, items = made(seed)
    path = tables(spark, str(tmp_path), rows, labels, items)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{path}/labels.parquet"))
    want = brute(rows, model, items)
    assert 10 < len(want) < len(rows) - 10
    got = corpus_pipeline.run(spark, path).collect()
    enc, pieces = tokens.Encoder(packing.default_tokenizer()), []
    for d, t in want:
        ids = np.append(enc.whole(t or ""), 2).astype("<u4")
        first = len(ids) % 1024 or min(1024, len(ids))
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        pieces += [repr((d, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(repr((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in got) == sorted(pieces)
    check_bins(got, 1024)


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    path = tables(spark, str(tmp_path), [], [], [])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.run(spark, path).count() == 0


def test_each_stage_on_whole_rows(spark, tmp_path):
    rows, labels, items = made(3)
    path = tables(spark, str(tmp_path), rows, labels, items)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    whole = {repr(tuple(r)) for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        got = out.collect()
        assert out.columns == docs.columns and {repr(tuple(r)) for r in got} <= whole and len(got) <= len(rows)
