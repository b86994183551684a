"""What may not grow faster than the tables: shuffles of wide rows, blocks, batches for Python."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from siltstone.operators import details, generate, neighbours, retrieve
from siltstone.plans import catalog
from siltstone.sources import files, stages


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin")


def test_held_rows_are_read_without_a_shuffle(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        g = stages.Graph(spark, str(tmp_path), [stages.Step("up", "id", {"src": "id"}, lambda t: t["src"].select("id", F.upper("x").alias("x")))])
        g.run({"src": spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id long, x string")})
        assert shuffles(g.table("up").drop("_round")) == 0
        g.run({"src": spark.createDataFrame([(1, "a"), (2, "z")], "id long, x string")})
        assert sorted(map(tuple, g.table("up").select("id", "x", "_round").collect())) == [(1, "A", 1), (2, "Z", 2)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_small_cells_share_blocks():
    sizes = pd.DataFrame({"cell": range(300), "n": [3] * 299 + [1000], "radius": 0.1})
    first, parts = neighbours.packed(sizes, np.random.default_rng(1).standard_normal((300, 4)), 128)
    own = [range(f, f + m) for f, m in zip(first, parts)]
    rows = np.zeros(max(r.stop for r in own), int)
    for r, n in zip(own, sizes["n"]):
        rows[r.start : r.stop] += -(-n // len(r))
    assert rows.max() <= 128 and len(rows) <= 20 and rows.min() > 0 and parts[-1] == 8


def test_rows_of_one_small_file_are_spread(spark, tmp_path):
    rows = [(i, f"n{i}", 1, "b", "t") for i in range(10)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_size int, p_brand string, p_type string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert catalog.queries()["requirements"](spark, str(tmp_path)).rdd.getNumPartitions() > 4


def test_listing_pages_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    rows = [(i * 1000, f"n{i}", 1, "b", "t") for i in range(20)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_size int, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    seen, scraped = [], details.scraped
    monkeypatch.setattr(details, "scraped", lambda listings, *more: seen.append(listings.count()) or scraped(listings, *more))
    assert catalog.queries()["component_scrape"](spark, str(tmp_path)).count() == 20
    assert seen == [4]


def test_products_are_held_in_parts(spark, monkeypatch):
    monkeypatch.setattr(retrieve, "SCORES", 64)
    g = np.random.default_rng(5)
    x = np.round(g.standard_normal((300, 4)), 1)  # with ties
    df = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(g.permutation(300), x)], "vec_id long, embedding array<double>").coalesce(2)
    ids = np.array([r["vec_id"] for r in df.collect()])
    s = np.round(x @ x.T, 6)
    for found, sign in ((retrieve.top_k, -1), (retrieve.tail_k, 1)):
        got = {(r["query"], r["rank"]): r["item"] for r in found(df.where("vec_id < 30"), df, 7).collect()}
        assert got == {(int(q), n + 1): int(ids[j]) for i, q in enumerate(ids) if q < 30 for n, j in enumerate(sorted(range(300), key=lambda j: (sign * s[i, j], ids[j]))[:7])}


def test_prompts_come_in_small_batches(spark):
    name = generate.BATCH[0]
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, str(1 << 30))
        generate.call(spark.createDataFrame([(1, "x")], "k int, p string"), "k", "p")
        assert int(spark.conf.get(name)) <= 8 << 20
    finally:
        spark.conf.set(name, before)


def test_files_are_read_once(spark, tmp_path):
    for name, body in (("a.html", "<p>x</p>"), ("b.txt", "y"), ("c.pdf", "z"), ("d.csv", "")):
        (tmp_path / name).write_text(body)
    got = files.extract_text(files.tree(spark, files.Config(str(tmp_path))), pdf=bytes.decode, keep=("length",))
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan binaryFile") == 1
    assert sorted((r["text"], r["length"]) for r in got.collect()) == [("x", 8), ("y", 1), ("z", 1)]


def test_batches_are_put_in_place_by_their_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(i, i // 4, None if i % 3 else "é") for i in range(40)], "id long, b long, x string")
    files.write_batches(rows, str(tmp_path), "b", "id")
    first = sorted(tmp_path.iterdir())
    assert len(first) == 10 and not (tmp_path / "_SUCCESS").exists()
    (first[0] / "part-0000.json").write_text("{}\n")
    files.write_batches(rows, str(tmp_path), "b", "id")
    assert sorted(tmp_path.iterdir()) == first and [len(list(f.iterdir())) for f in first] == [1] * 10
    got = files.gather_jsonl(spark, str(tmp_path), "id long, b long, x string").collect()
    assert sorted(map(str, got)) == sorted(map(str, rows.collect()))


def test_files_are_listed_folder_by_folder(spark, tmp_path, monkeypatch):
    """No scan has the files of more than one folder, and the folders of the query's own tree hold a bounded number."""
    from siltstone.plans import sinks

    monkeypatch.setattr(sinks, "FOLDER", 8, raising=False)
    rows = [(i, f" t{i} ", "en", f"s{i % 3}", 4) for i in range(200)] + [(200, "", "en", "s", 0), (201, "x" * 2001, "en", "s", 0), (205, None, "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    scans, tree = [], files.tree
    monkeypatch.setattr(files, "tree", lambda *a: scans.append(tree(*a)) or scans[-1])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.openCostInBytes", "spark.sql.hive.filesourcePartitionFileCacheSize")}
    got = {r["name"]: (r["length"], r["text"]) for r in catalog.queries()["extracted_tree"](spark, str(tmp_path)).collect()}
    want = {f"{s}/{i}": (len(t), None if i % 4 == 0 else ("" if len(t) > 2000 else t.strip()) if i % 4 == 1 else t) for i, t, _, s, _ in rows if t and i % 4 < 3}
    assert got == want
    assert len(scans) > 10 and max(len(s.inputFiles()) for s in scans) < 30
    assert {k: spark.conf.get(k) for k in before} == before


def test_a_tree_without_files(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert catalog.queries()["extracted_tree"](spark, str(tmp_path)).collect() == []
