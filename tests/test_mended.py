"""Splitting by a table function, JSON with many faults, and windows by the second chunk."""

import json
import random
import time

from pyspark.sql import functions as F

from siltstone.functions import text
from siltstone.operators import chunks


def test_table_function(spark):
    r = random.Random(8)
    rows = [(i, "".join(r.choice(["word ", "a.\n", "b\n", "c. ", "é", "😀"]) for _ in range(r.randrange(0, 200)))) for i in range(60)] + [(99, None), (98, "x" * 500), (97, "")]
    df = spark.createDataFrame(rows, "id long, text string")
    name = chunks.register_split(spark)
    got = spark.sql(f"SELECT id, part_no, start, part FROM {{df}}, LATERAL {name}(text, 40)", df=df).collect()
    want = set()
    for i, t in rows:
        at = 0
        for n, p in enumerate(chunks.split_text(t, 40) if t is not None else []):
            want.add((i, n, at, p))
            at += len(p)
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_repair_of_many_faults():
    body = '{"a": "' + "line\n\tof \\d+ text" * 20000 + '", "b": 1}'
    began = time.perf_counter()
    got = json.loads(text.repair(body))
    assert time.perf_counter() - began < 5
    assert got == {"a": "line\n\tof \\d+ text" * 20000, "b": 1}
    assert json.loads(text.repair('x {"q": "say "hi" now", "r": "\\u00e9 \\x \\" \\\\"} y')) == {"q": 'say "hi" now', "r": 'é \\x " \\'}
    assert text.repair('{"a": "never ends') is None and text.repair("[1]") is None and text.repair("") is None and text.repair(None) is None


def test_window_by_the_second_chunk(spark):
    doc = "a" * 50 + "SECOND" + "b" * 50
    rows = [(doc, "none", "gone", "xSECOND"), (doc, "none", "gone", None), (doc, "none", "gone", "nowhere"), (doc, "", "gone", "SECOND"), (doc, "a" * 6, "gone", "SECOND")]
    df = spark.createDataFrame(rows, "d string, f string, l string, s string")
    got = [r[0] for r in df.select(text.around_batch(F.col("d"), F.col("f"), F.col("l"), 6, 10, F.col("s"))).collect()]
    assert got == [doc[40:65], doc, doc, doc, doc[:15]]
