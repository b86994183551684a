"""Grouped ranks with ties against a plain version."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from siltstone.llm import ranking

SCHEMA = "g long, h string, a double, b double, x long, y long, place string, _a int, _range int"


def plain(rows, top):
    groups = defaultdict(list)
    for g, _, a, b, x, y, *_ in rows:
        a = None if a is None or a != a or abs(a) == float("inf") else a
        groups[g].append(((a is not None, a or 0), (b is None, b or 0), (x is None, x or 0), (y is None, y or 0), x, y))
    out = Counter()
    for g, lines in groups.items():
        lines.sort(key=lambda r: r[:4])
        pairs = [r[:2] for r in lines]
        for i, r in enumerate(lines):
            place = 1 + pairs.index(r[:2])
            if place <= top:
                out[g, i + 1, place, r[4], r[5], pairs.count(r[:2])] += 1
    return out


def run(spark, rows, top, ranges):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = ranking.ranked(df, {"g": F.col("g")}, (ranking.finite(F.col("a")), F.col("b")), {"x": F.col("x"), "y": F.col("y")}, top, ranges)
    return Counter((r["g"], r["pos"], r["place"], r["x"], r["y"], r["tied"]) for r in got.collect())


@pytest.mark.parametrize(("seed", "top", "ranges"), [(1, 3, 4), (2, 1, 7), (3, 5, 2)])
def test_ranks(spark, seed, top, ranges):
    r = random.Random(seed)
    pick = lambda *v: r.choice(v)
    rows = [(pick(None, -1, 1, 1, 1, 2, r.randrange(40)), "k", pick(None, 0.0, 1.0, 2.0, float("nan"), float("inf")), pick(None, 1.0, 2.0), pick(None, 1, 2, 3), pick(None, 1, 1, 2), "z", 1, 2) for _ in range(700)]
    assert run(spark, rows, top, ranges) == plain(rows, top)


def test_equal_lines_over_many_ranges(spark):
    """One group, one pair and one line hold most rows: they are dealt out over all ranges and numbered on."""
    rows = [(7, "k", 1.0, 1.0, 1, 1, "z", 1, 2)] * 400 + [(7, "k", 2.0, 1.0, None, 5, "z", 1, 2), (8, "k", None, None, None, None, "z", 1, 2)]
    assert run(spark, rows, 3, 9) == plain(rows, 3)


def test_empty(spark):
    assert run(spark, [], 3, 2) == Counter()


def test_query_on_odd_lines(spark, tmp_path):
    """Nulls in every column; the marked lines are one group."""
    rows = [(None,) * 9, (None,) * 9, (4, 1, 10, 3, None, None, None, "x", None), (4, 2, 11, 4, 35, 7.25, 0.05, None, None), (5, 1, -13, 3, 9, 1.0, 0.1, "x", None)]
    df = spark.createDataFrame(rows, "sale_id long, line_no int, item_id long, vendor_id long, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz")
    df.write.parquet(f"{tmp_path}/sale_lines.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW sale_lines AS SELECT * FROM read_parquet('{tmp_path}/sale_lines.parquet/*.parquet')")
    got = ranking.op11_grouped_ties(spark, str(tmp_path))
    rel = con.sql(ranking.SQL)
    assert sorted(map(repr, map(tuple, got.select(*rel.columns).collect()))) == sorted(map(repr, rel.fetchall()))
