"""A crawl under rules over a snapshot of pages, and its pages with local links.

A page is known by its final address: the end of the redirects of what was asked for. Levels are worked off one after the other; each cuts links out
of the pages that it has saved, and of no others. Decisions read the snapshot's narrow columns only; bodies are joined to the pages saved.
Levels and the table of what was seen are written, and the latter is compacted every ``COMPACT`` levels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import count

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions import urls
from ..functions.urls import REJECT_EXT, defrag
from .graph import links, relink, resolved, wanted

COMPACT = 8


@dataclass(frozen=True)
class Policy:
    """Rules of a crawl. A negative depth limit is none; hosts outside ``root`` have the limit 0."""

    start: str
    root: str
    inside: int = -1
    outside: int = 0
    prefix_only: bool = False
    stay: bool = True
    reject: tuple[str, ...] = REJECT_EXT

    @property
    def host(self) -> str:
        return regex.sub(r"^[^:]*://|[/?#:].*$", "", self.start).lower()

    def within(self, depth: Column, url: Column) -> Column:
        return urls.within_depth(depth, url, self.host, self.root, self.inside, self.outside)

    def refused(self, url: Column, final: Column, kind: Column) -> Column:
        """Not below the start, or HTML of a host outside the site."""
        out = ~urls.under_prefix(url, self.start) if self.prefix_only else F.lit(False)
        away = urls.offsite_html(final, kind, self.host) & ~urls.same_site(urls.host(final), self.root)
        return out | (away if self.stay else F.lit(False))


@dataclass
class Crawl:
    """visited: url, final, depth, status (saved, alias, refused, rejected, failed) of each address asked for; counters: their numbers."""

    visited: DataFrame
    counters: dict[str, int] = field(default_factory=dict)

    @property
    def saved(self) -> DataFrame:
        return self.visited.where("status = 'saved'").select(F.col("final").alias("url"), "depth")


def finals(redirects: DataFrame, truncate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """url, final: where the redirects (src, dst) of each address end; null where they go round.

    Each round doubles the hops that are known, so a chain of n hops takes about log2(n) rounds. The lengths of open chains have no gaps,
    so once a round ends none, those still open never end. Of several redirects of one address the smallest holds.
    """
    hops = redirects.select(defrag(F.col("src")).alias("url"), defrag(F.col("dst")).alias("final")).groupBy("url").agg(F.min("final").alias("final"))
    hops = truncate(hops.where("url <> final"))
    still = None
    while True:
        ahead = hops.select(F.col("url").alias("_at"), F.col("final").alias("_next"))
        step = hops.join(ahead, hops["final"] == ahead["_at"], "left")
        seen = Observation()
        step = step.observe(seen, F.count("_next").alias("n"))
        hops = truncate(step.select("url", F.coalesce("_next", "final").alias("final"), F.col("_next").isNotNull().alias("open")))
        n = seen.get["n"]
        if n in (0, still):
            return hops.select("url", F.when(~F.col("open"), F.col("final")).alias("final"))
        still, hops = n, hops.drop("open")


def crawl(seeds: DataFrame, snapshot: DataFrame, policy: Policy, redirects: DataFrame, truncate: Callable[[DataFrame], DataFrame]) -> Crawl:
    """Crawl a snapshot (url, body, content_type) from ``seeds`` (url) under ``policy``; ``redirects`` are (src, dst).

    Of the addresses of a level that end at one page the smallest saves it, the others, and all of later levels, are its aliases.
    ``truncate`` writes a table and reads it back. The counters are observed in the writes of the levels. Null addresses are left out.
    """
    ends = finals(redirects, truncate).withColumnRenamed("final", "_final")
    pages = snapshot.select(defrag(F.col("url")).alias("_page"), "content_type", "body")
    narrow = pages.groupBy("_page").agg(F.max(F.col("body").isNotNull()).alias("_there"), F.min("content_type").alias("_kind"))
    narrow = truncate(narrow)
    seen = kept = None
    parts: list[DataFrame] = []
    counters: dict[str, int] = {}
    level = truncate(seeds.select(defrag(F.col("url")).alias("url")).where("url IS NOT NULL").distinct())
    for depth in count():
        asked = _asked(level, ends)
        rows = asked.join(narrow, asked["final"] == narrow["_page"], "left")
        status = (
            F.when(policy.refused(F.col("url"), F.coalesce("final", "url"), F.col("_kind")), "refused")
            .when(~F.coalesce(F.col("_there"), F.lit(False)), "failed")
            .when(F.substring(urls.ext_of(F.col("final"), F.col("_kind")), 2, 9).isin(*policy.reject), "rejected")
        )
        rows = rows.select("url", "final", F.lit(depth).alias("depth"), status.alias("status"))
        if kept is not None:
            known = kept.select(F.col("final").alias("_known"))
            rows = rows.join(known, rows["final"] == known["_known"], "left").withColumn("status", F.when(F.col("status").isNull() & F.col("_known").isNotNull(), "alias").otherwise(F.col("status"))).drop("_known")
        first = rows.where("status IS NULL").groupBy("final").agg(F.min("url").alias("_first")).withColumnRenamed("final", "_end")
        rows = rows.join(first, rows["final"] == first["_end"], "left")
        named = F.when(F.col("status").isNotNull(), F.col("status")).when(F.col("url") == F.col("_first"), "saved").otherwise("alias")
        watch = Observation()
        kinds = ("saved", "alias", "refused", "rejected", "failed")
        rows = rows.select("url", "final", "depth", named.alias("status")).observe(watch, F.count(F.lit(1)).alias("attempts"), *(F.count_if(F.col("status") == k).alias(k) for k in kinds))
        done = truncate(rows)
        for k, n in watch.get.items():
            counters[k] = counters.get(k, 0) + n
        parts.append(done)
        fresh = done.where("status = 'saved'").select("final")
        seen = done.select("url") if seen is None else seen.unionByName(done.select("url"))
        kept = fresh if kept is None else kept.unionByName(fresh)
        if depth % COMPACT == COMPACT - 1:
            seen, kept = truncate(seen), truncate(kept)
        html = F.coalesce(F.lower("content_type").contains("text/html"), F.lit(True))
        own = pages.join(fresh, pages["_page"] == fresh["final"], "left_semi").where(html & policy.within(F.lit(depth), F.col("_page")))
        edges = resolved(wanted(links(own, "body", "_page"))).select(defrag(F.col("dst_url")).alias("url")).distinct()
        level = truncate(edges.where(policy.within(F.lit(depth + 1), F.col("url"))).join(seen, "url", "left_anti"))
        if level.isEmpty():
            break
    visited = parts[0]
    for p in parts[1:]:
        visited = visited.unionByName(p)
    return Crawl(visited, counters)


def _asked(level: DataFrame, ends: DataFrame) -> DataFrame:
    """url, final: where each address ends: itself without a redirect, null in a circle."""
    known = ends.select(F.col("url").alias("_from"), "_final")
    rows = level.join(known, level["url"] == known["_from"], "left")
    return rows.select("url", F.when(F.col("_from").isNull(), F.col("url")).otherwise(F.col("_final")).alias("final"))


#: A start tag of an element that may link, or what hides tags; the values of its attributes are told by ATTRIBUTE.
ELEMENT = regex.compile(r"""<!--.*?(?:-->|\Z)|<(?P<raw>script|style)\b(?P<own>(?:[^>"']|"[^"]*"|'[^']*')*+)>.*?(?:</(?P=raw)\s*>|\Z)|<(?:a|link|img|iframe)\b(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>""", regex.I | regex.S)
ATTRIBUTE = regex.compile(r"""(?P<name>[^\s"'>/=]+)(?:\s*=\s*(?:"(?P<v>[^"]*)"|'(?P<v>[^']*)'|(?P<v>[^\s"'>]+)))?|"[^"]*"|'[^']*'""")


def replaced(html: str, new: dict[str, str]) -> tuple[str, int]:
    """``html`` with the link values that ``new`` knows exchanged in place, and their number; every other character stays as it is."""
    out: list[str] = []
    at = n = 0
    for m in ELEMENT.finditer(html):
        for name in ("own", "attrs"):
            if m[name]:
                for a in ATTRIBUTE.finditer(html, m.start(name), m.end(name)):
                    if a["v"] is None or a["name"].lower() not in ("href", "src"):
                        continue
                    to = new.get(a["v"].translate({10: None, 13: None, 9: None}).strip(" "))
                    if to is not None:
                        start, end = a.span("v")
                        out += html[at:start], to
                        at, n = end, n + 1
    return "".join([*out, html[at:]]), n


def relinked(pages: DataFrame, visited: DataFrame, watch: Observation | None = None) -> DataFrame:
    """page columns, html with the links to visited pages as relative paths, n_links: the links exchanged.

    ``pages`` are (url, html) and other columns; ``visited`` (url, local_path) are the addresses that have a local copy. A link is looked up as written,
    as resolved on its page, and without its fragment, which is put back. Pages without a copy of their own, and links without one, stay as they are.
    The new values of a page come to it as one array, from one shuffle by address. ``watch`` observes rewritten, the pages that changed, and exchanged, the links.
    """
    known = visited.where("url IS NOT NULL AND local_path IS NOT NULL").groupBy("url").agg(F.min("local_path").alias("local_path"))
    own = known.select(F.col("url").alias("_own"), F.col("local_path").alias("_path"))
    edges = resolved(wanted(links(pages.select("url", "html")))).distinct()
    found = relink(edges, known).where("local_path IS NOT NULL")
    found = found.join(own, defrag(found["src_url"]) == own["_own"])
    path = urls.relative_path(F.col("_path"), F.col("local_path"), F.col("href"))
    maps = found.groupBy(F.col("src_url").alias("_src")).agg(F.collect_set(F.struct(F.col("href"), path.alias("to"))).alias("_new"))
    rows = pages.join(maps, pages["url"] == maps["_src"], "left").drop("_src")
    names = pages.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [
                (h, 0) if h is None or not new else replaced(h, {x["href"]: x["to"] for x in new})
                for h, new in zip(b.column("html").to_pylist(), b.column("_new").to_pylist())
            ]
            cols = [pa.array([h for h, _ in got], pa.string()) if c == "html" else b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([n for _, n in got], pa.int64())], [*names, "n_links"])

    out = rows.mapInArrow(run, StructType([*pages.schema.fields, StructField("n_links", LongType())]))
    return out if watch is None else out.observe(watch, F.count_if(F.col("n_links") > 0).alias("rewritten"), F.coalesce(F.sum("n_links"), F.lit(0)).alias("exchanged"))
