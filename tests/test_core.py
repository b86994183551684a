"""Operators, functions, sources and streams on small literals."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from siltstone.functions import keys, text, urls
from siltstone.operators import assemble, chunks, files, generate, graph, history, markdown, offerings, retrieve
from siltstone.sources import files as sources
from siltstone.sources import pages
from siltstone.streaming import state


def one(spark, schema, rows, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_keys(spark):
    from hashlib import sha256

    big = os.urandom(9000)
    got = one(spark, "s string, b binary", [(" a\n", big), ("x", b"ab"), (None, None)], keys.short_hash(F.col("s")), keys.text_hash(F.col("s")), keys.head_tail_hash(F.col("b")))
    h = lambda x: sha256(x).hexdigest()
    assert got[0] == (h(b" a\n")[:12], h(b"a"), h(big[:4096] + big[-4096:]))
    assert got[1] == (h(b"x")[:12], h(b"x"), h(b"ab"))
    assert got[2] == (None, None, None)
    assert one(spark, "k string", [("raft_chunk_ab_3_x_0",)], keys.origin_key(F.col("k"), 3)) == [("raft_chunk_ab",)]


def test_seeded_uniform(spark):
    u = [r[0] for r in spark.range(2000).toDF("id").select(keys.seeded_uniform("42", F.col("id"))).collect()]
    assert 0 <= min(u) and max(u) < 1 and abs(sum(u) / 2000 - 0.5) < 0.03
    assert spark.createDataFrame([("abc",)], "k string").select(keys.seeded_uniform("42", F.col("k"))).first()[0] == 2248124040 / 2**32


def test_urls(spark):
    rows = [("https://WWW.Ex.org/a%20b/c.PDF?x=1&y#f", "application/pdf"), ("http://ex.org", "text/html; charset=utf-8"), ("https://ex.org/d/", None)]
    u = F.col("u")
    got = one(spark, "u string, m string", rows, urls.host(u), urls.defrag(u), urls.ext_of(u, F.col("m")), urls.sanitize_filename(u), urls.local_path(u))
    assert got[0] == ("www.ex.org", "https://WWW.Ex.org/a%20b/c.PDF?x=1&y", ".pdf", "a_b_c.PDF", "www.ex.org/a%20b/c.PDF_x=1&y")
    assert got[1] == ("ex.org", "http://ex.org", ".html", "index", "ex.org/index.html")
    assert got[2][3:] == ("d", "ex.org/d.html")
    links = [("javascript:x",), ("#top",), ("mailto:a@b",), ("/p",), ("HTTP://x/",), ("ftp://x",), ("",)]
    assert [r[0] for r in one(spark, "h string", links, urls.follows(F.col("h")))] == [False, False, False, True, True, False, False]
    joined = one(spark, "b string, h string", [("http://a/b/c", "../d?q#f"), ("http://a/", None), ("http://[bad", "x")], urls.url_join(F.col("b"), F.col("h")))
    assert joined[0] == ("http://a/d?q#f",) and joined[1] == (None,)
    assert one(spark, "s string, t string, h string", [("a/b/c.html", "a/d.html", "x#k")], urls.relative_path(F.col("s"), F.col("t"), F.col("h"))) == [("../d.html#k",)]
    globs = urls.glob_regex(["*[Ff]oo*", "a?c.txt"])
    assert [r[0] for r in one(spark, "p string", [("x/y/Foo/z",), ("abc.txt",), ("abbc.txt",)], F.col("p").rlike(globs))] == [True, True, False]
    domains = one(spark, "p string, u string", [("/x/site.org/a/index.html", None), ("/x/y.html", ""), ("z", "http://q/p.htm")], urls.domain_path(F.col("p"), F.col("u"), ["site.org"]))
    assert domains == [("site.org/a",), ("x/y",), ("http://q/p",)]


def test_text(spark):
    c = F.col("s")
    f = lambda col, *rows: [r[0] for r in one(spark, "s string", [(x,) for x in rows], col)]
    assert f(text.clean_lines(c), " a \n\n\t b\n") == ["a\nb"]
    assert f(text.strip_links(c), "see [x](http://y) and http://z/q now") == ["see x and  now"]
    assert f(text.normalize_text(c), " é&nbsp;&lt;b&gt; ", None) == ["é <b>", None]
    assert f(text.slugify(c), "Olá, Mundo! 2", None) == ["ola-mundo-2", None]
    assert f(text.answer_of(c), "<REASON>r</REASON><ANSWER> a </ANSWER>", "<ANSWER>open", " bare ") == ["a", "open", "bare"]
    assert f(text.answer_valid(c), "<REASON><quote>q</quote></REASON><ANSWER>", "<REASON><ANSWER>") == [True, False]
    assert f(text.intent_label(c), "TIPO:  Small_Talk", "nothing") == ["small_talk", "domain_query"]
    assert f(text.json_object(c), 'x {"a": {"b": 1}} y', "[1]") == ['{"a": {"b": 1}}', None]
    assert f(text.model_turn(c), "<start_of_turn>user\nq<end_of_turn>\n<start_of_turn>model\nanswer<end_of_turn>") == ["answer"]
    assert f(text.first_line(c), "* - first\nsecond") == ["first"]
    assert f(text.citation_hosts(c), "a *[x](https://www.a.org/p)* b [y](http://z)") == [["a.org"]]
    assert f(text.doc_field(c, "File"), "<doc_metadata>\nFile: f.html\n</doc_metadata>") == ["f.html"]
    assert f(text.doc_body(c), '<doc_metadata>\nFile: f\n</doc_metadata>\n"body"') == ["body"]
    assert f(text.requirement_tokens(c), "(Calc MAT1010 E Alg MAT2020) OU FIS1001") == [["(", "MAT1010", "E", "MAT2020", ")", "OU", "FIS1001"]]
    assert f(text.strip_fences(c), "```md\n# a\n```") == ["# a"]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ('{"a": 1}', {"a": 1}),
        ('x {"a": "say "hi" now"} y', {"a": 'say "hi" now'}),
        ('{"a": "two\nlines"}', {"a": "two\nlines"}),
        (r'{"a": "bad \q"}', {"a": r"bad \q"}),
        (r'{"a": "bad \u12"}', {"a": r"bad \u12"}),
        ('{"a": "say "hi", then"}', {"a": 'say "hi", then'}),
        ('{"a": ["x "y", z", "w"]}', {"a": ['x "y", z', "w"]}),
        ('{"question": "a"b", "answer": "c "d" e"}', {"question": 'a"b', "answer": 'c "d" e'}),
        ("}{", None),
        ("[1, 2]", None),
        ("hopeless", None),
        (None, None),
    ],
)
def test_json_repair(given, want):
    got = text.repair(given)
    assert (got and json.loads(got)) == want


def test_cloaked_mail():
    page = '<p><span id="cloak1f">x</span><script>var addy1 = \'a&#46;b\' + \'&#64;\'; addy1 = addy1 + \'ex\' + \'&#46;org\';</script></p>'
    assert '<a href="mailto:a.b@ex.org">a.b@ex.org</a>' in text.reveal(page)
    assert text.reveal("<p>plain</p>") == "<p>plain</p>" and text.reveal(None) is None


def test_split_text():
    g = random.Random(1)
    for _ in range(300):
        t = "".join(g.choice(["ab", ".\n", "\n", ". ", "x"]) for _ in range(g.randint(0, 200)))
        parts = chunks.split_text(t, 37)
        assert "".join(parts) == t and all(len(p) <= 37 for p in parts)
    assert chunks.split_text("aaa.\nbbb\nccc", 8)[0] == "aaa.\n"


def test_chunk_rows(spark):
    items = "array<struct<chunk:string,topic:string>>"
    rows = [("f", 0, [("a", "t"), ("", "t")]), ("f", 1, [("b", "t")]), ("g", 0, [("", "")])]
    got = chunks.chunk_rows(spark.createDataFrame(rows, f"file string, part int, items {items}"), "file", "part", "items").collect()
    assert [(r["chunk_hash"], r["chunk"]) for r in sorted(got, key=lambda r: r["ordinal"])] == [("chunk_f_0", "a"), ("chunk_f_1", "b")]


def test_markdown():
    page = (
        '<body><nav>x</nav><main><h2>T</h2><p>a <b>bold</b><br>next<p>two <a href="/u/index.html">l</a> <a href="mailto:a@b.c?x=1">m</a>'
        '<table class="info"><tr><th>K:</th><td>v|1</td></tr></table><table><caption>C</caption><thead><tr><th scope=col>A<th scope=col>B<th>D</tr></thead><tr><td colspan=3>S</td></tr><tr><td>1<td>2<br>3</tr><tfoot><tr><td>end</tr></tfoot></table>'
        "<ul><li>one<li>two<ol><li>x</ol></ul><details><summary>Q?</summary>ans</details><pre>a  b</pre><select><option>o1<option>o2</select><h3>S</h3></main>"
    )
    md = markdown.convert(page, "http://h/x/")
    for part in ("# T", "two [l](http://h/u/) a@b.c", "**K:** v\\|1", "#### C\n\n| A | B | D |\n| --- | --- | --- |\n\n### S\n\n| A | B | D |\n| --- | --- | --- |\n| 1 | 2; 3 |  |\n\n**end**", "- one\n- two\n  1. x", "**Q?**", "```\na  b\n```", "- o1\n- o2", "### S"):
        assert part in md, part
    assert "x\n" not in md.split("# T")[0]
    assert markdown.convert(None) is None and markdown.convert("") == ""
    deep = "<b>" * 3000 + "inner" + "</b>" * 3000
    assert "inner" in markdown.convert(f"<main><p>{deep}</p><p>after</p></main>") and "after" in markdown.convert("<div>" * 3000 + "<script>x</script>after")
    assert "x" not in markdown.convert("<div>" * 3000 + "<script>x</script>after")
    wide = markdown.convert("<main><table><tr><th>a<th>b<th>c</tr><tr><td colspan=150>v<td>w</tr></table></main>")
    assert wide.count(" --- |") == 151


def test_tables():
    md = lambda t: markdown.convert(f"<main><table {t}</table></main>")
    assert md("><tr><td>a:<td>1</tr><tr><td>b<td></tr><tr><td><td>2</tr><tr><th>T</tr><tr><td>l</tr>") == "**a:** 1\n**b:**\n2\n\n### T\n\nl"
    assert md("class='x visualizacao'>" + "<tr><td>only</tr>" * 12 + "<tr><td>k<td>v</tr>").endswith("**k:** v")
    plain = "".join(f"<tr><td>{i}<td>x|{i}<td>z</tr>" for i in range(3))
    assert md(f">{plain}") == "\n".join(f"| {i} | x\\|{i} | z |" for i in range(3))
    assert md(f"><tr><td>a<td>b<td>c</tr><tr class=agrupador><td>G<td>H</tr>{plain}").startswith("| a | b | c |\n\n### GH\n\n| 0 |")
    assert md("><tr><td><td><td></tr>") == "" and md(">") == ""


def test_heading_levels():
    page = "<main><h2>A</h2><section><h2>B</h2><div><h3>C</h3><h3></h3></div><section><h4>D</h4></section></section><h2>E</h2></main>"
    md = markdown.convert(page)
    assert [x for x in md.split("\n") if x.startswith("#")][:3] == ["# A", "## B", "#### C"] and "##### D" in md and "## E" in md


def test_routes(spark):
    rows = [("a/components/ABC1234_x.html", None), ("a/offerings/2025-1/ABC_x.html", None), ("a/faq.html", None), ("a/faq.pdf", None), ("a/b.html", "ABC1234")]
    p = F.col("p")
    kind = files.file_type(p, files.is_faq(p, F.lit(None).cast("string"), F.lit(0), F.lit(0), F.array().cast("array<string>")), files.is_component(p, F.col("c")), files.is_offerings(p))
    assert [r[0] for r in one(spark, "p string, c string", rows, kind)] == ["component", "offerings", "faq", "regular", "component"]
    asks = files.is_faq(F.lit("x"), F.lit(None).cast("string"), F.lit(0), F.lit(0), F.col("b"))
    assert [r[0] for r in one(spark, "b array<string>", [(["a?", "Como b", "por que c", " d? "],), (["a?", "b?", "Onde", "How b"],)], asks)] == [True, False]


def test_dedup_and_cache(spark, tmp_path):
    df = spark.createDataFrame([("h", "b"), ("h", "a"), (None, "c"), (None, "d")], "h string, p string")
    assert sorted(r["p"] for r in files.first_of(df, "h", "p").collect()) == ["a", "c", "d"]
    names = files.collision_suffix(spark.createDataFrame([("x.html", 1), ("x.html", 2), ("y", 3), ("y", 4)], "n string, k int"), "n", "k")
    assert [r["unique_name"] for r in names.orderBy("k").collect()] == ["x.html", "x_1.html", "y", "y_1"]
    stage = sources.Stage(spark, str(tmp_path / "stage"), "k")
    asked = []

    def work(rows):
        asked.append(sorted(r["k"] for r in rows.collect()))
        return rows.withColumn("v", F.col("k") * 2)

    src = spark.range(5).toDF("k")
    stage.run(src.where("k < 3"), work)
    assert stage.run(src, work).count() == 5 and asked == [[0, 1, 2], [3, 4]]


def test_sources(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.html").write_bytes(b"ok \xff\xc3\xa9")
    (tmp_path / "a" / "empty.html").write_bytes(b"")
    (tmp_path / "a" / "skip_me.html").write_bytes(b"x")
    (tmp_path / "a" / "y.css").write_bytes(b"x")
    got = sources.tree(spark, sources.Config(str(tmp_path), ignore=("*skip_*",))).select("path", sources.decode_utf8(F.col("content")).alias("t")).collect()
    assert [(os.path.basename(r["path"]), r["t"]) for r in got] == [("x.html", "ok é")]
    (tmp_path / "extracted_faq").mkdir()
    (tmp_path / "extracted_faq" / "f.json").write_text('[{"question": "q", "answer": "é"}, 3]')
    assert [tuple(r) for r in sources.combine_json(spark, str(tmp_path), "question string, answer string", ("extracted_faq",)).collect()] == [("q", "é")]
    out = str(tmp_path / "out")
    sources.write_jsonl(spark.createDataFrame([("é", 1)], "a string, b int"), out)
    with open(os.path.join(out, "bad.json"), "w") as f:
        f.write("not json\n")
    assert [tuple(r) for r in sources.gather_jsonl(spark, out, "a string, b int").collect()] == [("é", 1)]


def test_seeded_split_order(spark, tmp_path):
    sources.publish(spark.range(50).selectExpr("id", "if(id < 40, 'train', 'val') AS split"), str(tmp_path / "s"))
    order = lambda seed: [r["id"] for r in sources.load_split(spark, str(tmp_path / "s"), "train", seed).collect()]
    assert order("a") == order("a") != order("b") and sorted(order("a")) == sorted(order(None)) == list(range(40))


def test_retrieval_in_blocks(spark, monkeypatch):
    g = random.Random(2)
    rows = [(i, [g.random() for _ in range(4)]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = sorted(map(tuple, retrieve.top_k(df, df, 3).collect()))
    monkeypatch.setattr(retrieve, "BROADCAST", 7)
    assert sorted(map(tuple, retrieve.top_k(df, df, 3).collect())) == whole
    assert len(whole) == 90
    few = retrieve.top_k(df.limit(1), df, 100).count()
    assert few == 30


def test_history(spark):
    rows = [(1, 0, "user", "out"), (1, 1, "assistant", "a0"), (1, 2, "user", "in"), (1, 3, "user", "  "), (1, 4, "assistant", "a1"), (1, 5, "user", "end")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    kept = history.domain_history(conv, F.col("text") == "out").orderBy("turn").collect()
    assert [r["text"] for r in kept] == ["in", "a1", "end"]
    before = {r["turn"]: (r["question"], r["answer"]) for r in history.previous_exchange(conv).collect()}
    assert before == {0: (None, None), 2: ("out", "a0"), 3: ("out", "a0"), 5: ("  ", "a1")}
    assert history.valid_requests(conv).collect()[0]["valid"]
    assert "<start_of_turn>model\na1<end_of_turn>" in history.chat_prompt(conv, F.lit("D"), "S").first()["prompt"]


@pytest.mark.parametrize("ratio", [0.0, 0.13, 0.5, 1.0])
def test_split(spark, ratio):
    sizes = {"a": 1, "b": 2, "c": 3, "d": 100}
    rows = [(f"{o}{i}", o) for o, n in sizes.items() for i in range(n)]
    got = assemble.stratified_split(spark.createDataFrame(rows, "k string, o string"), "o", "k", ratio, "s").collect()
    assert len({r["k"] for r in got}) == len(rows) == len(got)
    for o, n in sizes.items():
        val = sum(r["split"] == "val" for r in got if r["o"] == o)
        assert val <= n - 1 and (val in (int(n * ratio), int(n * ratio) + 1) or val == n - 1)


def test_assembly(spark):
    df = spark.createDataFrame([("g", ["a", "b"], 1), ("g", [], 2), ("g", ["a"], 3)], "g string, d array<string>, k int")
    for r in df.withColumns(assemble.assembled(F.col("g"), F.col("d"), F.col("k"), 0.5, "s")).collect():
        assert r["golden_index"] == (r["docs"].index("g") if "g" in r["docs"] else -1) and r["golden_present"] == ("g" in r["docs"])
        assert r["d"] or r["golden_present"]
    styles = assemble.style_schedule(spark.range(12).toDF("i"), "i")
    got = {i: sorted(r["style"] for r in styles.where(f"i = {i}").collect()) for i in (0, 1)}
    assert got[0] == ["casual", "formal", "multi-hop", "multi-hop-unanswerable"] and got[1] == ["casual", "formal", "multi-hop", "naturalistic"]
    m = assemble.to_messages(F.lit("q"), F.lit("a"))
    assert spark.range(1).select(assemble.train_text(m, "SYS")).first()[0] == "<start_of_turn>user\nSYS\n\nq<end_of_turn>\n<start_of_turn>model\na<end_of_turn>\n"


def test_offerings(spark):
    docs = spark.createDataFrame([("f1", {"ABC1": ("n", "2025.1", [([("T", "30"), ("U", "x")], 0, ("24M12", None), 40, 39, "room")])})], f"file string, offerings map<string,struct<name:string,year_period:string,offerings:array<{offerings.OFFERING}>>>")
    rows = offerings.exploded(docs).collect()
    assert [r["teacher"]["name"] for r in rows] == ["T", "U"]
    o = docs.select(F.explode("offerings").alias("code", "c")).select(offerings.to_markdown(F.col("c.year_period"), F.col("c.offerings"))).first()[0]
    assert "- Hours: 30" in o and "T (30h); U (xh)" in o and "39/40" in o
    comps = spark.createDataFrame([("ABC1", "x"), ("ABC2", "y"), ("ZZZ1", "z")], "code string, text string")
    blocks = spark.createDataFrame([("ABC1", "2025.1", "f2", "late"), ("ABC1", "2025.1", "f1", "first")], "code string, period string, file string, block string")
    got = dict(offerings.with_offerings(comps, blocks, "none").collect())
    assert got == {"ABC1": "x\n\nfirst", "ABC2": "y\n\n## Offerings 2025.1\nnone", "ZZZ1": "z"}


def test_crawl(spark):
    pages_df = spark.createDataFrame([("http://h/a", '<a href="http://h/b#x">'), ("http://h/b", '<a href="http://h/c"><a href="mailto:q">'), ("http://h/c", '<a href="http://h/a">')], "url string, body string")
    got = {r["url"]: r["depth"] for r in pages.crawl(spark.createDataFrame([("http://h/a",)], "url string"), pages_df, 1).collect()}
    assert got == {"http://h/a": 0, "http://h/b": 1}
    edges = spark.createDataFrame([("p", "b.html#k", "http://h/b#k"), ("p", "no", "http://h/no")], "src_url string, href string, dst_url string")
    seen = spark.createDataFrame([("http://h/b", "h/b.html")], "url string, local_path string")
    assert {(r["href"], r["local_path"]) for r in graph.relink(edges, seen).collect()} == {("b.html#k", "h/b.html"), ("no", None)}

    def fetch(u):
        if "bad" in u:
            raise OSError
        return 200, "text/html", "x"

    front = spark.createDataFrame([("http://h/ok",), ("http://h/bad",), ("http://h/x.css",)], "url string")
    assert {(r["url"], r["status"]) for r in pages.fetched(front, fetch).collect()} == {("http://h/ok", 200), ("http://h/bad", -1)}


def test_relative_links_and_quotes(spark):
    rows = [("http://h/d/a.html", "<a class='k' href='b.html'>x</a> <A HREF=/c?q=1>y</a><img src=\"../p.png\"><a title=\"x>y\" href = \"b.html#f\">"), ("http://h/d/b.html", "<a href=//o/z>")]
    df = spark.createDataFrame(rows, "url string, body string")
    got = {(r["href"], r["dst_url"]) for r in graph.resolved(graph.links(df, "body")).collect()}
    assert got == {("b.html", "http://h/d/b.html"), ("/c?q=1", "http://h/c?q=1"), ("../p.png", "http://h/p.png"), ("b.html#f", "http://h/d/b.html#f"), ("//o/z", "http://o/z")}
    crawl = pages.crawl(spark.createDataFrame([("http://h/d/a.html",)], "url string"), df, 2)
    assert {(r["url"], r["depth"], r["body"] is not None) for r in crawl.collect()} == {("http://h/d/a.html", 0, True), ("http://h/d/b.html", 1, True), ("http://h/c?q=1", 1, False), ("http://h/p.png", 1, False), ("http://o/z", 2, False)}
    names = [("attachment; filename=\"my file.pdf\"", "my_file.pdf"), ("x; filename*=UTF-8''a%20b.txt", "a_b.txt"), ("inline", None), (None, None)]
    assert [r[0] for r in one(spark, "h string", [(h,) for h, _ in names], urls.disposition_name(F.col("h")))] == [n for _, n in names]
    assert one(spark, "u string, h string", [("http://h/d/x?y=1", names[0][0]), ("http://h/d/x", None)], urls.local_path(F.col("u"), None, F.col("h"))) == [("h/d/my_file.pdf",), ("h/d/x.html",)]


def test_reach_without_depth(spark, tmp_path):
    edges = spark.createDataFrame([(i, i + 1) for i in range(12)] + [(12, 0)], "src long, dst long")
    n = iter(range(99))

    def write(df):
        path = str(tmp_path / str(next(n)))
        df.write.parquet(path)
        return spark.read.parquet(path)

    got = {r["node"]: r["depth"] for r in graph.reach(edges, spark.createDataFrame([(0,)], "node long"), truncate=write).collect()}
    assert got == {i: i for i in range(13)}
    with pytest.raises(ValueError):
        graph.reach(edges, spark.createDataFrame([(0,)], "node long"))


def test_first_of_ties(spark):
    rows = [("k", 1, "a"), ("k", 1, "b"), ("k", 1, "a"), ("l", None, "c"), ("l", 2, "d"), (None, 3, "e"), (None, 3, "e")]
    got = files.first_of(spark.createDataFrame(rows, "k string, o int, v string"), "k", "o").collect()
    assert sorted(str(r["k"]) for r in got) == ["None", "None", "k", "l"] and {r["v"] for r in got if r["k"] == "l"} == {"d"}


def test_trailing_window(spark):
    g = random.Random(5)
    rows = [(i, g.choice("ab"), g.randint(0, 400)) for i in range(300)]
    got = {r["i"]: (r["n"], r["first"]) for r in history.trailing(spark.createDataFrame(rows, "i long, k string, s long"), "k", "s", 60).collect()}
    for i, k, s in rows:
        near = [t for _, j, t in rows if j == k and s - 59 <= t <= s]
        assert got[i] == (len(near), min(near))


def test_extract_text(spark, tmp_path):
    for name, body in {"a.HTML": b"<main><p>hi</p></main>", "b.txt": b"plain \xff", "c.pdf": b"12345", "d.pdf": b"123456789", "e.css": b"no"}.items():
        (tmp_path / name).write_bytes(body)
    tree = sources.tree(spark, sources.Config(str(tmp_path)))
    got = {os.path.basename(r["path"]): r["text"] for r in sources.extract_text(tree, 6, lambda b: b.decode()).collect()}
    assert got == {"a.HTML": "hi", "b.txt": "plain ", "c.pdf": "12345", "d.pdf": ""}
    assert {r["text"] for r in sources.extract_text(tree).where("path LIKE '%.pdf'").collect()} == {None}


def test_skewed_join(spark):
    from siltstone.operators.skew import most_frequent, split_join

    g = random.Random(6)
    rows = [(g.choice(["hot"] * 6 + ["b", "c", "d", None]), i) for i in range(200)]
    left = spark.createDataFrame(rows, "k string, i long")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("b", 3), ("x", 4)], "k string, v int")
    sizes = left.groupBy("k").count()
    for how in ("inner", "left"):
        got = split_join(left, right, "k", most_frequent(sizes, "k", "count", 1), how)
        assert sorted(map(str, got.collect())) == sorted(map(str, left.join(right, "k", how).collect()))


def test_generation_of_the_rest(spark):
    df = spark.createDataFrame([(1, "About MAT1010 and FIS2020", ["one", "two"], True), (2, "none", ["x"], False)], "k long, t string, docs array<string>, un boolean")
    assert {r["k"]: sorted(r["offerings"]) for r in generate.extract_offerings(df, "k", "t").collect()} == {1: ["FIS2020", "MAT1010"], 2: []}
    assert {r["text"] for r in generate.revised_text(df, "k", "t").collect()} == {"About MAT1010 and FIS2020", "none"}
    assert generate.unanswerable_question(df, "k", F.lit("e"), "docs").count() == 2
    answers = generate.multihop_answer(df, "k", F.col("t"), "docs", F.col("un")).collect()
    assert all("<ANSWER>" in r["reply"] and r["error"] is None for r in answers)
    assert generate.multihop_answer(df, "k", F.col("t"), "docs", F.col("un"), lambda p, t: "no tags").first()["error"] == "invalid reply"
    assert {len(r["expansion"].split("\n")) for r in generate.expand_query(df, "k", F.col("t")).collect()} == {3}
    assert generate.expand_query(df, "k", F.col("t"), None).first()["expansion"] == ""
    alone = generate.contextualize(df, "k", F.col("t"), F.when(F.col("un"), "before").otherwise(""), lambda p, t: " whole question ")
    assert {r["k"]: r["query"] for r in alone.collect()} == {1: "whole question", 2: "none"}
    assert json.loads(generate.debug_rows(df, "k", "t", "docs").where("k = 1").first()["debug"]) == {"t": "About MAT1010 and FIS2020", "docs": ["one", "two"]}


def test_generation(spark):
    df = spark.createDataFrame([(1, ["doc a", "doc b"])], "k long, docs array<string>")
    pairs = generate.default_pairs(df, "k", "docs").orderBy("pos").collect()
    assert [(r["pos"], r["doc"]) for r in pairs] == [(0, "doc a"), (1, "doc b")] and all(r["question"] and r["answer"] for r in pairs)
    assert generate.multihop_question(df, "k", "docs").first()["chosen"] == ["doc a", "doc b"]
    texts = spark.createDataFrame([(1, "One. x\n\nTwo. y")], "k long, t string")
    assert [x["topic"] for x in generate.chunk_texts(texts, "k", "t").first()["items"]] == ["One", "Two"]
    assert generate.extract_faq(texts, "k", "t").count() == 1

    def broken(prompt, temperature):
        raise RuntimeError("down")

    dead = generate.call(texts.withColumn("p", F.col("t")), "k", "p", broken, attempts=2).first()
    assert dead["reply"] is None and dead["attempts"] == 2 and "down" in dead["error"]
    assert generate.intent(texts, "k", F.lit("hello")).first()["label"] == "small_talk"
    conv = spark.createDataFrame([(1, 0, "user", "about alpha")], "conv_id long, turn long, role string, text string")
    corpus = generate.embed(spark.createDataFrame([(7, "alpha text"), (8, "beta")], "item long, body string"), "item", "body").join(spark.createDataFrame([(7, "alpha text"), (8, "beta")], "item long, body string"), "item")
    got = generate.answer(conv, corpus, "S", k=1).first()
    assert "alpha text" in got["prompt"] and "beta" not in got["prompt"] and got["reply"]


def test_plain_questions(spark):
    def down(prompt, temperature):
        raise RuntimeError("down")

    turns = [(1, 0, "user", "about alpha"), (2, 0, "user", "x"), (2, 1, "assistant", "y"), (3, 0, "user", " ")]
    conv = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = generate.plain_chat(conv, "Be brief.", generate.with_fallback(down, lambda p, t: p.upper())).collect()
    assert [r["conv_id"] for r in got] == [1] and "ABOUT ALPHA" in got[0]["reply"] and "<DOCUMENT>" not in got[0]["prompt"]
    asked = generate.ask_each(conv.selectExpr("conv_id * 10 + turn AS k", "text"), "k", "text", lambda p, t: f"{p}\n2" if p != "y" else down(p, t)).collect()
    assert {r["k"]: r["reply"] for r in asked} == {10: "about alpha\n2", 20: "x\n2", 21: None, 30: " \n2"}
    assert all((r["seconds"] is None) == (r["reply"] is None) for r in asked)
    dead = generate.call(conv.withColumn("p", F.col("text")), "conv_id", "p", generate.with_fallback(down, down)).first()
    assert dead["reply"] is None and "down" in dead["error"]
    none = generate.component_pairs(conv, "conv_id", "text", lambda p, t: '{"qa_pairs": [{"question": "q", "answer": ""}]}')
    assert none.count() == 0


def test_probed(spark):
    from siltstone.sources import pages

    def head(url):
        if url.endswith("down"):
            raise OSError
        return "application/pdf" if url.endswith("f") else None

    urls_ = ["http://h.org/f", "http://x.org/f", "http://x.org/down", "http://x.org/a"]
    got = pages.probed(spark.createDataFrame([(u,) for u in urls_], "url string"), head, "h.org").collect()
    assert {r["url"]: r["content_type"] for r in got} == dict(zip(urls_, [None, "application/pdf", None, None]))


def test_streams(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.range(4).selectExpr("id AS k").write.parquet(src)
    stream = spark.readStream.schema("k long").parquet(src)
    state.ingest(stream, "k", out, lambda d: d.withColumn("v", F.col("k") + 1), str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(out).count() == 4
    events = spark.sql("SELECT id AS event_id, 'u' AS user, timestamp_seconds(id * 10) AS ts FROM range(12)")
    events.write.parquet(str(tmp_path / "ev"))
    live = spark.readStream.schema(events.schema).parquet(str(tmp_path / "ev"))
    q = state.limiter(live, "user", 3).writeStream.format("memory").queryName("limited").outputMode("append").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.table("limited").orderBy("event_id").collect()
    assert [r["admitted"] for r in got[:4]] == [True, True, True, False] and got[3]["wait_s"] == 30.0
    rate = state.request_rate(live, "user").writeStream.format("memory").queryName("rate").outputMode("append").option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start()
    rate.awaitTermination()
    flagged = state.flagged_questions(spark.createDataFrame([(1, "user", "x"), (1, "user", " x ")], "conv_id long, role string, text string"), F.lit(True))
    assert flagged.count() == 1


def hot_rows(n=400):
    g = random.Random(3)
    return [(g.choice(["hot"] * 5 + ["a", "b", None]), g.choice([i, i * 1000, 7]), i, g.choice([None, i])) for i in range(n)]


def test_row_numbers(spark):
    from pyspark.sql import Window

    from siltstone.operators.rank import bucketed, row_numbers

    rows = hot_rows()
    df = spark.createDataFrame(rows, "g string, k long, i long, v long").repartition(3)
    assert bucketed(df, "g", F.col("k"), size=60).where("g = 'hot'").select("_b").distinct().count() > 2
    unit = F.col("k") / F.lit(1e6)
    for by, spread in ((["k", "i"], None), ([unit, "i"], unit)):
        want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(*by)) - 1)
        for size in (20, 60, 1000):
            got = row_numbers(df, "g", "r", by, spread, size, total="n")
            pick = lambda d: {r["i"]: r["r"] for r in d.collect()}
            assert pick(got) == pick(want)
            assert {r["g"]: r["n"] for r in got.collect()} == {x[0]: sum(a[0] == x[0] for a in rows) for x in rows}
    assert row_numbers(df.limit(0), "g", "r", ["k"], size=2).count() == 0


def test_carried_over_buckets(spark):
    from siltstone.operators import rank

    rows = hot_rows()
    df = spark.createDataFrame(rows, "g string, k long, i long, v long").repartition(3)
    for size in (20, 60, 1000):
        last = {r["i"]: r["o"] for r in rank.last_before(df, "g", ["k", "i"], F.col("v"), "o", size).collect()}
        numbers = {r["i"]: r["s"] for r in rank.sessions(df, "g", ["k", "i"], F.lit(900), "s", size).collect()}
        for group in {r[0] for r in rows}:
            own = sorted((r[1], r[2], r[3]) for r in rows if r[0] == group)
            seen, number, before = None, 0, None
            for k, i, v in own:
                number += before is None or k - before > 900
                assert (last[i], numbers[i]) == (seen, number)
                seen, before = seen if v is None else v, k


def test_details(spark):
    from siltstone.operators import details

    page = '<table><tr><th>Code:</th><td>MAT1010</td></tr><tr><td>only</td></tr></table>'
    assert details.rows(page) == [("Code", "MAT1010")] and details.rows(None) == []
    cell = '( <a title="Calculus">MAT1010</a> E <a>ALG2020</a> ) OU FIS1001'
    assert details.expression(cell) == "( Calculus (MAT1010) E ALG2020 ) OU FIS1001"
    df = spark.createDataFrame([(page,), (None,)], "h string").select(details.syllabus_url(details.detail_pairs("h"), "Code").alias("v"))
    assert [r["v"] for r in df.collect()] == ["MAT1010", None]


def test_catalogue_pages(spark):
    from siltstone.operators import details

    row = lambda k, n: f"<tr><td>{k}</td><td> {n} </td><td><a title='Programa Atual do Componente' onclick=\"f({{'idComponente':'{k[-2:]}'}})\">p</a></td></tr>"
    listing = f"<form><table class=listagem><tbody>{row('MAT1010', 'Calculus')}{row('MAT1011', 'Algebra')}<tr><td>MAT1012<td>no link</tr></tbody></table></form>"
    page = (
        "<table class=visualizacao><caption>Dados Gerais do Componente Curricular</caption><tbody><tr><th>Código:</th><td>MAT1010</td></tr><tr><th>Pré-Requisitos:</th><td>( <acronym title='FIS1001 - Physics'>FIS1001</acronym> ou"
        " <acronym title='X'>ALG2020</acronym> )</td></tr><tr><th>Co-Requisitos:</th><td>-</td></tr></tbody></table><table><caption>Outros componentes que têm esse componente como pré-requisito</caption><tr><td>A</td></tr><tr><td>B</td></tr></table>"
    )
    got = details.scraped(
        spark.createDataFrame([("u", listing), ("v", None)], "unit string, html string"),
        spark.createDataFrame([("10", page)], "component_id string, html string"),
        spark.createDataFrame([("11", "<p>programme</p>")], "component_id string, html string"),
    )
    found = {r["code"]: r for r in got.collect()}
    assert set(found) == {"MAT1010", "MAT1011"} and found["MAT1010"]["name"] == "Calculus" and found["MAT1010"]["unit"] == "u"
    assert found["MAT1010"]["prerequisites"] == "( Physics (FIS1001) OU X (ALG2020) )" and found["MAT1010"]["corequisites"] == "-"
    assert found["MAT1010"]["equivalences"] == "-" and found["MAT1010"]["required_by"] == "A | B" and not found["MAT1010"]["has_programme"]
    assert found["MAT1011"]["body"] == "<p>programme</p>" and found["MAT1011"]["prerequisites"] is None
    assert details.expression("free text") == "free text" and details.expression("") == "-" and details.expression("<acronym title='MAT1010'>MAT1010</acronym>") == "MAT1010 (MAT1010)"
    part = '<div id="turmasAbertas"><table class="listagem"><caption>2 turmas encontrada(s)</caption><tr><td>a &lt; b<br></td></tr></table></div>'
    rows = [("u", "2025.1", f"<body><nav>x</nav>{part}</body>"), ("u", "2025.1", f"<body>{part}</body>"), ("v", "2025.1", "<div id=turmasAbertas>none</div>"), ("w", "2025.1", None)]
    got = details.offering_pages(spark.createDataFrame(rows, "unit string, period string, html string")).collect()
    assert [(r["unit"], r["body"]) for r in got] == [("u", f"<!DOCTYPE html><html><body>{part}</body></html>")]
