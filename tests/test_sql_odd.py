"""Queries against their SQL on rows that the small tables lack: shared addresses and names, open references, quoted texts."""

import duckdb

from siltstone.plans import catalog

PAGES = "page_id long, url string, html string"


def same(spark, folder, query, **tables):
    """Whether a query gives the rows of its SQL on some tables (rows, schema); its rows."""
    con = duckdb.connect()
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    df = catalog.queries()[query](spark, str(folder))
    rel = con.sql(catalog.oracle_sql()[query])
    rows = [tuple(r) for r in df.select(*rel.columns).collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, rel.fetchall()))
    return rows


def page(h1, body="", title="t"):
    return f"<html><head><title>{title}</title></head><body><article><h1>{h1}</h1>{body}</article></body></html>"


def test_intent_words_end_as_in_sql(spark, tmp_path):
    said = ["Oié", "hi there", "hié", "olá", "olá x", "\xa0hi", "his", "oi", "INPUT:\nhi", "no INPUT:\nhi", "HELLO!"]
    rows = [(i, 0, "user", t) for i, t in enumerate(said)]
    got = dict(same(spark, tmp_path, "intent", conversations=(rows, "conv_id long, turn long, role string, text string")))
    assert got["0/0"] == got["2/0"] == "small_talk" and got["6/0"] == "domain_query"


OPEN = [(1, "http://a.org/x", page("A &amp", "<p>b &lt;c&gt; &amp; d</p>", "A &amp")), (2, "http://a.org/y", page("B &copy; &amp;lt;", "<p>one</p><p>two &lt</p>", "B &copy; &amp;lt;"))]


def test_open_references_as_in_sql(spark, tmp_path):
    got = same(spark, tmp_path / "a", "markdown_heading", pages=(OPEN, PAGES))
    assert dict(got)[1] == "# A &amp"
    assert len(same(spark, tmp_path / "b", "markdown_words", pages=(OPEN, PAGES))) == 2
    assert len(same(spark, tmp_path / "c", "page_signals", pages=(OPEN, PAGES))) == 2


def test_metadata_keeps_the_quotes_of_a_text(spark, tmp_path):
    texts = ['he said "no"', '"all of it"', '"', "", None, 'a <doc_metadata>\nFile: b\n</doc_metadata> c"', " x "]
    rows = [(i, t, None if i == 6 else f"s{i}") for i, t in enumerate(texts)]
    assert len(same(spark, tmp_path, "doc_metadata", documents=(rows, "doc_id long, text string, source string"))) == 7


def test_pages_of_one_address_are_fetched_once(spark, tmp_path):
    rows = [(1, "http://a.org/x", "one"), (2, "http://a.org/x", "two"), (3, "http://a.org/y.png", "three"), (4, "http://a.org/z", None)]
    assert len(same(spark, tmp_path, "fetched_pages", pages=(rows, PAGES))) == 3


def test_names_with_suffixes_as_in_sql(spark, tmp_path):
    rows = [(1, "http://a.org/x.html", ""), (2, "http://b.org/x.html", ""), (3, "http://b.org/d/x.html/", ""), (4, "http://b.org/y", "")]
    got = same(spark, tmp_path, "filename_collision_suffix", pages=(rows, PAGES))
    assert {r[2] for r in got} == {"x.html", "x.html_1", "x.html_2", "y"}


def test_numbers_of_any_length_are_ignored(spark, tmp_path):
    paths = ["/en/1", "/en/12", "/en/12345678901234567890", "/en/14121/", "/en/14408.html", "/1a/12", "/1/x", "/de/x", "/De/", "/de", "", "/", "/en/21"]
    rows = [(i, f"http://a.org{p}", "") for i, p in enumerate(paths)]
    got = same(spark, tmp_path, "glob_ignore", pages=(rows, PAGES))
    assert {r[1] for r in got} == {"/en/14121/", "/en/14408.html", "/1/x", "/de", "", "/", "/en/21"}


def test_links_of_pages_with_one_address(spark, tmp_path):
    link = lambda *to: page("h", "".join(f'<p><a href="{t}">x</a></p>' for t in to))
    hosts = [f"http://www.a{i}.example.com" for i in range(12)]
    rows = [(i, f"{h}/p{i}.html", link("/en/x", f"/w{i}")) for i, h in enumerate(hosts)] + [(12, f"{hosts[3]}/p3.html", link("/en/x", "/v")), (13, f"{hosts[3]}/p3.html", link("/u"))]
    got = same(spark, tmp_path / "a", "pages_relinked", pages=(rows, PAGES))
    n = {r[0]: r[2] for r in got}
    assert n[3] == n[12] == n[13] and n[3] % 3 == 0 and sum(n.values()) > 0
    same(spark, tmp_path / "b", "relink_observed", pages=(rows, PAGES))


def test_an_address_with_several_copies_is_relinked_to_each(spark, tmp_path):
    rows = [(1, "http://a.org/x", ""), (2, "http://a.org/x", ""), (4, "http://a.org/y", "")]
    assert len(same(spark, tmp_path, "relink", pages=(rows, PAGES))) == 11


def test_an_address_known_with_and_without_its_anchor(spark, tmp_path):
    urls = ["http://a.org/x"] * 3 + ["http://a.org/x#top"] * 2 + ["http://a.org/y#top"] * 2 + ["http://a.org/z#top#top", "http://a.org/z#top", None, None]
    got = same(spark, tmp_path, "relink", pages=([(i, u, "") for i, u in enumerate(urls)], PAGES))
    assert sum(r[:2] == ("http://a.org/x", "http://a.org/x#top") for r in got) == 18
