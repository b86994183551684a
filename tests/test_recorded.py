"""Files and their records as a data source."""

import os

import pytest

from siltstone.sources import recorded


def test_round_trip(spark, tmp_path):
    rows = [("a/x.HTML", b"<p>", "http://h/x", None, "up"), ("a/b/y.pdf", b"%" * 100, "http://h/y", "http://h/x", None), ("z", None, None, None, None)]
    df = spark.createDataFrame(rows, "path string, content binary, original_url string, source_page_url string, source_html_path string")
    recorded.record(df, f"file://{tmp_path}")
    recorded.record(df.where("path = 'a/x.HTML'"), f"file://{tmp_path}")
    (tmp_path / "a" / "bare.txt").write_text("no record")
    got = {r["path"]: r for r in recorded.recorded(spark, f"file://{tmp_path}").collect()}
    assert set(got) == {"a/x.HTML", "a/b/y.pdf", "z", "a/bare.txt"}
    x = got["a/x.HTML"]
    assert (x["dir"], x["ext"], x["length"], bytes(x["content"]), x["original_url"], x["source_page_url"], x["source_html_path"]) == ("a", ".html", 3, b"<p>", "http://h/x", None, "up")
    assert got["a/bare.txt"]["original_url"] is None and bytes(got["z"]["content"]) == b"" and got["z"]["dir"] == ""
    assert recorded.recorded(spark, f"{tmp_path}/none").count() == 0


def test_pushed_filters(spark, tmp_path):
    """Files that the filters leave out are not opened: one of them cannot be."""
    rows = [("a.txt", b"12345"), ("b.txt", b"1"), ("c.bin", b"123456")]
    recorded.record(spark.createDataFrame(rows, "path string, content binary"), str(tmp_path))
    name = recorded.PUSH
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        got = recorded.recorded(spark, str(tmp_path)).where("ext IN ('.txt', '.md') AND length >= 2 AND path <> 'q'")
        assert [r["path"] for r in got.select("path").collect()] == ["a.txt"]
    finally:
        spark.conf.set(name, before)
    schema = spark.createDataFrame([], recorded.SCHEMA).schema
    reader = recorded.Pushed(str(tmp_path), schema)
    left = list(reader.pushFilters([recorded.EqualTo(("ext",), ".txt"), recorded.GreaterThan(("length",), 1), recorded.LessThanOrEqual(("length",), 9), recorded.EqualTo(("path",), "a.txt")]))
    assert left == [recorded.EqualTo(("path",), "a.txt")] and (reader.suffixes, reader.least, reader.most) == ({".txt"}, 2, 9)
    os.chmod(tmp_path / "c.bin", 0)
    assert [b.column("path").to_pylist() for p in reader.partitions() for b in reader.read(p)] == [["a.txt"]]


def test_paths_outside(spark, tmp_path):
    with pytest.raises(Exception, match="not a path below"):
        recorded.record(spark.createDataFrame([("../x", b"1")], "path string, content binary"), str(tmp_path))
