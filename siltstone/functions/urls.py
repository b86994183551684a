"""URL parts, names made from URLs, and predicates of the crawl."""

from __future__ import annotations

import posixpath
import re
from urllib.parse import urldefrag, urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Link schemes that are never followed.
SKIP_SCHEMES = ("javascript:", "mailto:", "tel:", "#", "data:")
#: Suffixes by media type.
MIME_EXT = {"text/html": ".html", "application/pdf": ".pdf", "text/plain": ".txt", "application/json": ".json", "text/csv": ".csv"}
#: Suffixes that are rejected before a fetch.
REJECT_EXT = ("css", "js", "png", "jpg", "jpeg", "gif", "svg", "ico", "webp", "atom")


def scheme(u: Column) -> Column:
    return F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)


def host(u: Column) -> Column:
    return F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))


def path(u: Column) -> Column:
    return F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def query(u: Column) -> Column:
    return F.regexp_extract(u, r"\?([^#]*)", 1)


def defrag(u: Column) -> Column:
    """The URL without its fragment: the key of the crawl."""
    return F.regexp_replace(u, r"#.*$", "")


def ext_of(u: Column, mime: Column | None = None) -> Column:
    """The URL's suffix of 1 to 5 characters after the dot, else the media type's."""
    own = F.lower(F.regexp_extract(path(u), r"(\.[A-Za-z0-9]{1,5})$", 1))
    if mime is None:
        return own
    known = F.create_map(*[F.lit(x) for kv in MIME_EXT.items() for x in kv])
    return F.when(own != "", own).otherwise(F.coalesce(known[F.regexp_extract(F.lower(mime), r"^([^;\s]+)", 1)], F.lit("")))


def same_site(h: Column, root: str) -> Column:
    return (h == root) | h.endswith("." + root)


def follows(href: Column) -> Column:
    """Links worth following: not empty, not of a skipped scheme; http, https or relative."""
    skipped = F.lit(False)
    for s in SKIP_SCHEMES:
        skipped = skipped | F.lower(href).startswith(s)
    other = F.lower(href).rlike(r"^[a-z][a-z0-9+.-]*:") & ~F.lower(href).rlike(r"^https?:")
    return (F.length(href) > 0) & ~skipped & ~other


def within_depth(depth: Column, u: Column, start_host: str, root: str, inside: int, outside: int) -> Column:
    """Depth limits: exact host, sub-domains, others (0); a negative limit is none."""
    h = host(u)
    limit = F.when(h == start_host, inside).when(same_site(h, root), outside).otherwise(0)
    return (limit < 0) | (depth <= limit)


def offsite_html(u: Column, content_type: Column, start_host: str) -> Column:
    """HTML outside the start's host: by media type, or without one by a suffix that HTML has or by none."""
    suffix = ext_of(u)
    typed = F.lower(content_type).contains("text/html")
    untyped = (suffix == "") | suffix.isin(".html", ".htm") | path(u).endswith("/")
    return F.coalesce(typed, untyped) & (host(u) != start_host)


def disposition_name(header: Column) -> Column:
    """The file name of a Content-Disposition header, decoded and sanitised; null without one."""
    raw = F.regexp_extract(header, r"""(?i)filename\*?=(?:UTF-8'')?("[^"]+"|[^;\s]+)""", 1)
    plain = F.btrim(raw, F.lit('"'))
    name = F.coalesce(F.try_url_decode(plain), plain)
    return F.nullif(F.btrim(F.regexp_replace(F.regexp_replace(name, r"(?U)[^\w.\-?=&]", "_"), r"_+", "_"), F.lit("_.")), F.lit(""))


def under_prefix(u: Column, start: str) -> Column:
    bare = re.sub(r"[?#].*$", "", start)
    return F.regexp_replace(u, r"[?#].*$", "").startswith(bare)


def sanitize_filename(u: Column, default: str = "index") -> Column:
    """A file name from a URL's path: decoded, separators and odd characters as ``_``, collapsed, stripped."""
    s = F.try_url_decode(path(u))
    s = F.regexp_replace(F.coalesce(s, path(u)), r"[/\\]", "_")
    s = F.regexp_replace(F.regexp_replace(s, r"(?U)[^\w.\-?=&]", "_"), r"_+", "_")
    s = F.btrim(s, F.lit("_."))
    return F.when(s == "", default).otherwise(s)


def sanitize_title(s: Column) -> Column:
    """Characters that some file systems refuse become ``_``; runs collapse."""
    return F.regexp_replace(F.regexp_replace(s, r'[<>:"/\\|?*]', "_"), r"_+", "_")


def local_path(u: Column, mime: Column | None = None, disposition: Column | None = None) -> Column:
    """host/path with the query appended and a suffix: where a page is kept. A Content-Disposition header names the file."""
    p = F.btrim(path(u), F.lit("/"))
    p = F.when(p == "", "index").otherwise(p)
    q = F.when(query(u) == "", "").otherwise(F.concat(F.lit("_"), F.regexp_replace(query(u), r"[^A-Za-z0-9_.=&-]", "_")))
    ext = F.when(ext_of(u) == "", F.when(F.lit(mime is None), ".html").otherwise(ext_of(u, mime) if mime is not None else F.lit(""))).otherwise("")
    own = F.concat(host(u), F.lit("/"), p, q, ext)
    if disposition is None:
        return own
    return F.coalesce(F.concat(host(u), F.lit("/"), F.regexp_extract(p, r"^(.*/)[^/]*$", 1), disposition_name(disposition)), own)


def domain_path(path_col: Column, original_url: Column, domains: list[str]) -> Column:
    """Where a file comes from: its recorded URL, else a known or guessed domain in its path; index and suffix dropped."""
    known = "|".join(re.escape(d) for d in domains) or r"$^"
    guess = F.regexp_extract(path_col, rf"((?:{known})(?:/.*)?)$", 1)
    dotted = F.regexp_extract(path_col, r"(?:^|/)([a-z0-9-]+(?:\.[a-z0-9-]+)+/.*)$", 1)
    tail = F.regexp_extract(path_col, r"([^/]*/[^/]*)$", 1)
    s = F.coalesce(F.nullif(original_url, F.lit("")), F.nullif(guess, F.lit("")), F.nullif(dotted, F.lit("")), tail)
    return F.regexp_replace(F.regexp_replace(s, r"/index\.html?$", ""), r"\.html?$", "")


def glob_regex(globs: list[str]) -> str:
    """One anchored regex for shell globs; ``*`` crosses separators and ``[Ff]`` classes are kept."""
    out = []
    for g in globs:
        s, i = "", 0
        while i < len(g):
            c = g[i]
            end = g.find("]", i + 1) if c == "[" else -1
            if c == "*":
                s += ".*"
            elif c == "?":
                s += "."
            elif end > 0:
                body = g[i + 1 : end]
                s += "[" + ("^" + body[1:] if body[0] == "!" else body) + "]"
                i = end
            else:
                s += re.escape(c)
            i += 1
        out.append(s)
    return "(?s)^(?:" + "|".join(out) + r")\z"


@F.pandas_udf(StringType())
def url_join(base: pd.Series, href: pd.Series) -> pd.Series:
    """RFC 3986 resolution; null if either is null or cannot be resolved."""

    def one(b, h):
        try:
            return urljoin(b, h) if b is not None and h is not None else None
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(base, href)], dtype=object)


@F.pandas_udf(StringType())
def relative_path(source: pd.Series, target: pd.Series, href: pd.Series) -> pd.Series:
    """The path from one local page to another, keeping the link's fragment."""

    def one(s, t, h):
        if s is None or t is None:
            return h
        frag = urldefrag(h or "")[1]
        return posixpath.relpath(t, posixpath.dirname(s) or ".") + (f"#{frag}" if frag else "")

    return pd.Series([one(*x) for x in zip(source, target, href)], dtype=object)
