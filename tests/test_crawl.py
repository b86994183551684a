"""Crawls under rules and rewritten pages against plain versions."""

import random
import re
from collections import deque
from urllib.parse import urldefrag, urljoin, urlsplit

import pytest

from siltstone.operators import crawl, graph
from siltstone.sources.shared import written


def ends(url, hops):
    seen = set()
    while url in hops:
        if url in seen:
            return None
        seen.add(url)
        url = hops[url]
    return url


def plain(seeds, pages, hops, policy):
    """Level by level; pages are {url: (content type, body)}."""

    def limit(url):
        h = (urlsplit(url).hostname or "").lower()
        return policy.inside if h == policy.host else policy.outside if h == policy.root or h.endswith("." + policy.root) else 0

    def within(d, url):
        return limit(url) < 0 or d <= limit(url)

    out, kept, level, depth = {}, set(), sorted({urldefrag(s)[0] for s in seeds}), 0
    while level:
        follow = []
        for url in sorted(level):
            final = ends(url, hops)
            kind, body = pages.get(final, (None, None))
            at = final or url
            h, suffix = (urlsplit(at).hostname or "").lower(), (re.search(r"(\.[A-Za-z0-9]{1,5})$", urlsplit(at).path) or [""])[0].lower()
            typed = "text/html" in kind.lower() if kind is not None else suffix in ("", ".html", ".htm") or at.endswith("/")
            prefix = policy.prefix_only and not re.sub("[?#].*", "", url).startswith(re.sub("[?#].*", "", policy.start))
            if prefix or (policy.stay and typed and h != policy.host and not (h == policy.root or h.endswith("." + policy.root))):
                status = "refused"
            elif body is None:
                status = "failed"
            elif suffix[1:] in policy.reject:
                status = "rejected"
            elif final in kept:
                status = "alias"
            else:
                status = "saved"
                kept.add(final)
                if (kind is None or "text/html" in kind) and within(depth, final):
                    follow += [urldefrag(urljoin(final, x))[0] for x in re.findall(r'href="([^"]*)"', body)]
            out[url] = (final, depth, status)
        depth += 1
        level = {u for u in follow if u not in out and within(depth, u)}
    return out


@pytest.mark.parametrize(("seed", "policy"), [
    (1, crawl.Policy("http://a.site.org/p0", "site.org", 5, 3)),
    (2, crawl.Policy("http://a.site.org/p", "site.org", -1, -1, prefix_only=True)),
    (3, crawl.Policy("http://a.site.org/p0", "site.org", 2, 1, stay=False)),
])
def test_crawl_under_rules(spark, seed, policy):
    r = random.Random(seed)
    hosts = ["a.site.org", "a.site.org", "b.site.org", "site.org", "else.net"]
    names = [f"http://{r.choice(hosts)}/{r.choice('pq')}{i}{r.choice(['', '', '.html', '.png', '.pdf', '/'])}" for i in range(120)]
    gone = [f"http://a.site.org/gone{i}" for i in range(10)]
    pages = {u: (r.choice([None, "text/html; charset=utf-8", "application/pdf"]), "".join(f'<a href="{r.choice([v, v + "#k", urlsplit(v).path])}">x</a>' for v in r.choices(names + gone, k=3))) for u in names}
    hops = {u: r.choice(names + gone) for u in r.sample(gone + names[60:], 50)}
    hops = {u: v for u, v in hops.items() if u != v}
    seeds = names[:4] + [names[0] + "#top"]
    df = spark.createDataFrame([(u, b, k) for u, (k, b) in pages.items()], "url string, body string, content_type string")
    got = crawl.crawl(spark.createDataFrame([(s,) for s in [*seeds, None]], "url string"), df, policy, spark.createDataFrame([*hops.items()], "src string, dst string"), lambda x: written(x, "crawl"))
    want = plain(seeds, pages, hops, policy)
    assert {r["url"]: (r["final"], r["depth"], r["status"]) for r in got.visited.collect()} == want
    counts = {k: sum(s == k for *_, s in want.values()) for k in ("saved", "alias", "refused", "rejected", "failed")}
    assert got.counters == {"attempts": len(want), **counts}
    assert got.saved.count() == counts["saved"]


def test_finals(spark):
    """Chains of every length, a circle, an address that leads into it, two redirects of one address."""
    chain = [(f"u{i}", f"u{i + 1}") for i in range(37)]
    circle = [("a", "b"), ("b", "c"), ("c", "a"), ("in", "a"), ("x", "y"), ("x", "z"), ("self", "self")]
    got = {r["url"]: r["final"] for r in crawl.finals(spark.createDataFrame(chain + circle, "src string, dst string"), lambda x: written(x, "finals")).collect()}
    assert got == {**{f"u{i}": "u37" for i in range(37)}, "a": None, "b": None, "c": None, "in": None, "x": "y"}
    assert crawl.finals(spark.createDataFrame([], "src string, dst string"), lambda x: written(x, "finals")).collect() == []


def test_replaced_in_place():
    new = {"a": "1", "b?x&y": "2", "/s.js": "3", "i": "4"}
    html = "<a href='a'>a</a>\r\n<A title=\"href='a'\" HREF = a>é</A><!-- <a href=a> --><script src=\"/s.js\">'<a href=\"a\">'</script><img alt=\"a>b\" src=\" i \"><a href=\"\n b?x&y\t\">b</a><a data-href=a href=c><p href=a>"
    got, n = crawl.replaced(html, new)
    assert n == 5
    assert got == "<a href='1'>a</a>\r\n<A title=\"href='a'\" HREF = 1>é</A><!-- <a href=a> --><script src=\"3\">'<a href=\"a\">'</script><img alt=\"a>b\" src=\"4\"><a href=\"2\">b</a><a data-href=a href=c><p href=a>"


def test_relinked(spark):
    pages = [
        (1, "http://h/d/a.html", '<a href="b.html#k">b</a><a href="/no">n</a><img src=\'http://h/c.png\'>'),
        (2, "http://h/d/b.html#top", "<a href=a.html>a</a><a href=#here>x</a>"),
        (3, "http://h/unknown", '<a href="/d/a.html">a</a>'),
        (4, "http://h/null", None),
        (5, None, "<a href=x>"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    seen = spark.createDataFrame([("http://h/d/a.html", "h/d/a.html"), ("http://h/d/b.html", "h/e/b.html"), ("http://h/c.png", "h/c.png"), ("http://h/null", None), (None, "x")], "url string, local_path string")
    got = {r["page_id"]: (r["html"], r["n_links"]) for r in crawl.relinked(df, seen).collect()}
    assert got == {
        1: ('<a href="../e/b.html#k">b</a><a href="/no">n</a><img src=\'../c.png\'>', 2),
        2: ("<a href=../d/a.html>a</a><a href=#here>x</a>", 1),
        3: ('<a href="/d/a.html">a</a>', 0),
        4: (None, 0),
        5: ("<a href=x>", 0),
    }


def test_links_in_another_order_each_time(spark):
    """A shuffle gives its rows in the order in which they arrive; here they are dealt anew whenever they are read."""
    edges = spark.range(200, numPartitions=2).selectExpr("'p' AS src_url", "concat('/', id) AS href", "concat('http://h/', id) AS dst_url")
    dealt = edges.mapInPandas(lambda batches: (b.sample(frac=1) for b in batches), edges.schema)
    seen = spark.range(0, 200, 2).selectExpr("concat('http://h/', id) AS url", "concat('h/', id) AS local_path")
    got = {r["href"]: r["local_path"] for r in graph.relink(dealt, seen).collect()}
    assert got == {f"/{i}": f"h/{i}" if i % 2 == 0 else None for i in range(200)}
