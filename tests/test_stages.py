"""Stage graphs, batches of files, and neighbours by cells."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.operators import neighbours
from siltstone.sources import files, stages
from siltstone.sources.shared import written


def graph(spark, path, calls):
    def step(name, key, inputs, f):
        def compute(t):
            out = f(t)
            calls.setdefault(name, []).extend(sorted(r[key] for r in out.collect()))
            return out

        return stages.Step(name, key, inputs, compute)

    up = step("up", "id", {"src": "id"}, lambda t: t["src"].select("id", "grp", F.upper("x").alias("x")))
    left = step("left", "id", {"up": "id"}, lambda t: t["up"].select("id", "grp", F.length("x").alias("n")))
    right = step("right", "id", {"up": "id", "names": "id"}, lambda t: t["up"].join(t["names"], "id", "left").select("id", F.concat_ws("-", "x", "name").alias("y")))
    both = step("both", "id", {"left": "id", "right": "id"}, lambda t: t["left"].join(t["right"], "id").select("id", "n", "y"))
    total = step("total", "grp", {"left": "grp"}, lambda t: t["left"].groupBy("grp").agg(F.sum("n").alias("n")))
    return stages.Graph(spark, path, [both, total, right, left, up])


def test_diamond(spark, tmp_path):
    calls: dict = {}
    g = graph(spark, str(tmp_path), calls)
    assert g.order.index("up") < g.order.index("left") < g.order.index("both") and g.order.index("left") < g.order.index("total")
    src = lambda rows: spark.createDataFrame(rows, "id long, grp string, x string")
    names = lambda rows: spark.createDataFrame(rows, "id long, name string")
    first = [(1, "a", "p"), (2, "a", "q"), (3, "b", "r"), (None, "b", "s")]
    out = g.run({"src": src(first), "names": names([(1, "one")])})
    assert sorted(map(tuple, out["both"].collect())) == [(1, 1, "P-one"), (2, 1, "Q"), (3, 1, "R")]
    calls.clear()
    out = g.run({"src": src(first), "names": names([(1, "one")])})
    assert not any(calls.values())
    # 1: same length in another text; 2: gone; 3: the same in another case; 4: new; 3's name: new
    out = g.run({"src": src([(1, "a", "z"), (3, "b", "R"), (4, "b", "uu")]), "names": names([(1, "one"), (3, "three")])})
    assert {k: v for k, v in calls.items() if v} == {"up": [1, 3, 4], "left": [1, 4], "right": [1, 3, 4], "both": [1, 3, 4], "total": ["a", "b"]}
    assert sorted(map(tuple, out["both"].collect())) == [(1, 1, "Z-one"), (3, 1, "R-three"), (4, 2, "UU")]
    assert sorted(map(tuple, out["total"].collect())) == [("a", 1), ("b", 3)]
    # rows of a run that did not write its marks are not read
    spark.createDataFrame([(9, 9, "x", "9", "lost")], "id long, n int, y string, _key string, _run string").write.mode("append").parquet(f"{tmp_path}/both/rows")
    assert g.table("both").count() == 3


def test_circle():
    a, b = (stages.Step(n, "id", {m: "id"}, lambda t: t) for n, m in ("ab", "ba"))
    with pytest.raises(ValueError):
        stages.Graph(None, "x", [a, b])


def test_batches(spark, tmp_path):
    rows = lambda ids, tag: spark.createDataFrame([(i, i // 3 if i < 9 else None, tag, "é\n") for i in ids], "id long, b long, tag string, x string")
    files.write_batches(rows(range(11), "one"), str(tmp_path), "b", "id")
    files.write_batches(rows([3, 4, 5, 9, 10], "two"), str(tmp_path), "b", "id")
    got = files.gather_jsonl(spark, str(tmp_path), "id long, tag string, x string").collect()
    assert sorted((r["id"], r["tag"]) for r in got) == [(i, "two" if i in (3, 4, 5, 9, 10) else "one") for i in range(11)]
    assert {r["x"] for r in got} == {"é\n"}


@pytest.mark.parametrize(("pivots", "block"), [(None, 2048), (9, 7), (1, 3)])
def test_neighbours(spark, pivots, block):
    """Clusters, a third of all rows equal, a null vector; pruning leaves pairs of cells out where clusters are apart."""
    g = np.random.default_rng(3)
    centres = np.eye(12)[:9]
    x = np.concatenate([c + 0.05 * g.standard_normal((12, 12)) for c in centres] + [np.repeat(centres[:1], 54, 0)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(int(i), [float(v) for v in r]) for i, r in zip(g.permutation(len(x)), x)]
    df = spark.createDataFrame([*rows, (999, None), (None, rows[0][1])], "vec_id long, embedding array<double>").repartition(3)
    got = neighbours.knn_join(df, 4, lambda d: written(d, "cells"), pivots=pivots, block=block)
    ids, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    s = np.round(m @ m.T, 6)
    want = {(int(ids[q]), n + 1): (int(ids[j]), round(float(s[q, j]), 6)) for q in range(len(ids)) for n, j in enumerate(sorted(range(len(ids)), key=lambda j: (-s[q, j], ids[j]))[:4])}
    assert {(r["query"], r["rank"]): (r["item"], round(r["score"], 6)) for r in got.found.collect()} == want
    if pivots == 9:
        assert got.pairs < got.all_pairs
    assert neighbours.knn_join(df.limit(0), 4, lambda d: written(d, "cells")).found.count() == 0
