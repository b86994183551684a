"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks: text between block-level tags, with the path of open tags. A numpy
bidirectional LSTM reads, for each block, hashed vectors of its tag path (tags, classes, ids) and of its words with
a few measures (length, share of link text, punctuation), and labels all blocks with the whole page as context.

It is trained on at most ``PAGES`` pages of the table with at most ``LONGEST`` characters, chosen by a hash of page_id, and on
``MADE`` pages. In the table's pages the author's own elements tell the article: article and main, without the nav, header,
footer, aside, form and similar elements inside. Each such page is learnt from three times, once as it is and twice with the article's own element
hidden, as unnamed divs, table cells or nothing, so that pages without such marks are read by what they hold. Pages that mark no article are not learnt from. (That a block repeats over
pages tells nothing here: articles have copies, and licence lines within them repeat.) Made pages are composed
of the blocks so found in other layouts (menus, sidebars, notices, adverts, forms and reader comments), labelled by what
was composed; a part of them carries names that are usual for such parts, another random names or none. Scripts,
styles, templates, titles and form fields are never text. Whole pages are read.

Defined results: null or empty html, and pages without article blocks, give an empty text; each row is read on its own;
other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import nn
from .store import table
from .textkit import LOWER, SPACE, U, hash_runs, owners, runs

PAGES, MADE = 300, 700
LONGEST = 1 << 18
SLICE = 1 << 14
PATH, WORDS, EXTRA = 256, 64, 6
DIM, HIDDEN = 24, 16
STEPS, BATCH, RATE = 700, 32, 0.01
CELLS = 60_000

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S,
)
#: The same up to a tag's name, for pages on which the quotes of a tag do not close.
HEAD = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)|<[!?][^>]*(?:>|\Z)", re.S)
EDGES = re.compile(r"[>\"']")
NAME = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
PART = re.compile(r"[a-z]+")
#: Fixed sets of HTML element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea title svg iframe select".split())
CLOSED = re.compile(r"(?:^|[\s\"'])/$")
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An opening tag ends an open one of these, unless a tag of the second set lies between.
ENDS = {"p": ("p",), "li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "body": ("head",)}
SCOPE = frozenset("article aside blockquote body div dl figure footer form header li main nav ol section table td ul".split())


@lru_cache(100_000)
def bin_of(name: str) -> int:
    return crc32(name.encode()) % PATH


class Path:
    """The names of the open tags, outermost first. It holds its last tag's names and the path around it, so that depth costs nothing."""

    __slots__ = ("apart", "article", "bits", "last", "names", "outer")

    def __init__(self, outer: Path | None = None, names: tuple[str, ...] = ()):
        self.outer, self.names = outer, names
        self.bits, self.last, self.article, self.apart = (outer.bits, outer.last, outer.article, outer.apart) if outer else (0, (), False, False)
        for x in names:
            self.bits |= 1 << bin_of(x)
        self.last = (*self.last, *names)[-2:]
        self.article = self.article or "<article" in names or "<main" in names
        self.apart = self.apart or not APART.isdisjoint(names)

    def __iter__(self) -> Iterator[str]:
        steps, at = [], self
        while at is not None:
            steps.append(at.names)
            at = at.outer
        return (x for names in reversed(steps) for x in names)

    def row(self) -> bytes:
        """The buckets of a path as bits: every name, and the last two once more by place."""
        bits = self.bits
        for k, x in enumerate(reversed(self.last)):
            bits |= 1 << bin_of(f"-{k}{x}")
        return bits.to_bytes(PATH // 8, "little")


Block = tuple[str, Path, int]


def closings(page: str) -> tuple[list[int], list[int]]:
    """The places of angles and quotes, and for each where a tag closes that meets it outside of quotes (-1: nowhere), in one pass from the end."""
    found = [(m.start(), m[0]) for m in EDGES.finditer(page)]
    ends = [-1] * (len(found) + 1)
    same: dict[str, int] = {}
    for k in range(len(found) - 1, -1, -1):
        at, sign = found[k]
        if sign == ">":
            ends[k] = at
        else:
            ends[k] = ends[same[sign] + 1] if sign in same else -1
            same[sign] = k
    return [at for at, _ in found], ends


def blocks(page: str) -> list[Block]:
    """(text, path, characters inside links) of each leaf block, in page order; in time linear in the page."""
    out: list[Block] = []
    stack: list[str] = []
    paths = [Path()]  # that of the root, then of each open tag
    where: dict[str, list[int]] = {}  # the places of open tags in the stack
    scopes: list[int] = []
    parts: list[tuple[str, bool]] = []
    edges: tuple[list[int], list[int]] | None = None

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(s for s, _ in parts)).split())
            if text:
                inside = sum(len(s) for s, a in parts if a)
                out.append((text, paths[-1], min(inside, len(text))))
            parts.clear()

    def pop(k: int) -> None:
        for t in stack[k:]:
            where[t].pop()
        del stack[k:], paths[k + 1 :]
        while scopes and scopes[-1] >= k:
            scopes.pop()

    pos, size = 0, len(page)
    while pos < size:
        m = (TAG if edges is None else HEAD).search(page, pos)
        if m is None:
            parts.append((page[pos:], bool(where.get("a"))))
            break
        if m.start() > pos:
            parts.append((page[pos : m.start()], bool(where.get("a"))))
        pos = m.end()
        if edges is None:
            tag, closing, attrs = m[2] or m[5], m[1] or m[4], m[3] or m[6] or ""
            if m[5]:
                edges = closings(page)
        else:
            tag, closing, attrs = m[2], m[1], ""
            if tag:
                end = edges[1][bisect_left(edges[0], pos)]
                end = page.find(">", pos) if end < 0 else end
                attrs, pos = (page[pos:], size) if end < 0 else (page[pos:end], end + 1)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag in BLOCK:
                flush()
            if where.get(tag):
                pop(where[tag][-1])
            continue
        if tag in RAW:
            if not (tag == "svg" and CLOSED.search(attrs)):  # only there a slash closes an element
                end_tag = re.compile(rf"</{tag}\s*>", re.I).search(page, pos)
                pos = end_tag.end() if end_tag else size
            continue
        if tag == "br":
            parts.append((" ", False))
        if tag in BLOCK:
            flush()
            ends = ENDS.get(tag, ("p",) if tag in SCOPE or tag[0] == "h" else ())
            nearest = max((where[t][-1] for t in ends if where.get(t)), default=-1)
            if nearest >= (scopes[-1] if scopes and tag != "body" else 0):
                pop(nearest)
        if tag in VOID:
            continue
        if tag in BLOCK:
            names = [f"<{tag}"]
            if attrs:
                for key, *values in NAME.findall(attrs):
                    names += PART.findall(next(filter(None, values), "").lower())
            paths.append(Path(paths[-1], tuple(names)))
        else:
            paths.append(paths[-1])
        where.setdefault(tag, []).append(len(stack))
        if tag in SCOPE:
            scopes.append(len(stack))
        stack.append(tag)
    flush()
    return out


def features(page_blocks: list[Block], at: int = 0, total: int | None = None) -> np.ndarray:
    """One row for each block: tag-path vector, hashed-word vector, measures. The blocks begin at ``at`` of ``total`` in their page."""
    n = len(page_blocks)
    total = n if total is None else total
    out = np.zeros((n, PATH + WORDS + EXTRA), np.float32)
    if not n:
        return out
    raw = [t.encode("utf-8", "surrogatepass") for t, _, _ in page_blocks]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    starts, ends, first = runs(~SPACE[data], offsets)
    h = hash_runs(LOWER[data], starts, ends)
    who = owners(first)
    count = np.maximum(np.diff(first), 1)
    bag = np.bincount(who * WORDS + (h >> U(58)).astype(np.int64), minlength=n * WORDS).reshape(n, WORDS)
    out[:, PATH : PATH + WORDS] = np.minimum(bag / np.sqrt(count)[:, None], 2)
    rows = np.frombuffer(b"".join(path.row() for _, path, _ in page_blocks), np.uint8).reshape(n, -1)
    out[:, :PATH] = np.unpackbits(rows, axis=1, bitorder="little")
    for i, (text, _, inside) in enumerate(page_blocks):
        k = PATH + WORDS
        out[i, k : k + EXTRA] = (
            np.log1p(len(text)) / 8,
            inside / len(text),
            text[-1] in ".!?:;\"'",
            min(text.count(",") + text.count("."), 20) / 20,
            (at + i) / max(total - 1, 1),
            min(total, 200) / 200,
        )
    return out


@dataclass
class Model:
    p: nn.Params

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        z = x @ self.p["w"] + self.p["d"]
        return z, *self.read(np.tanh(z), mask, keep)

    def read(self, z: np.ndarray, mask: np.ndarray, keep: bool = False):
        h, kept = nn.bilstm(z, mask, {k: v for k, v in self.p.items() if k[0] in "fr"}, keep)
        return h, kept, h @ self.p["o"] + self.p["c"]

    def inputs(self, page_blocks: list[Block]) -> np.ndarray:
        """What the network reads of each block, made ``SLICE`` blocks at a time."""
        n = len(page_blocks)
        parts = [features(page_blocks[a : a + SLICE], a, n) @ self.p["w"] + self.p["d"] for a in range(0, n, SLICE)]
        return np.tanh(np.concatenate([np.zeros((0, DIM), np.float32), *parts]))

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Whether each block of each page belongs to the article; pages of like length share a batch."""
        out = [np.zeros(len(r), bool) for r in pages]
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        while order:
            size = len(pages[order[-1]])
            n = max(1, min(len(order), CELLS // size))
            own, order = order[-n:], order[:-n]
            x, mask = stacked([self.inputs(pages[i]) for i in own], size)
            score = self.read(x, mask)[2]
            for j, i in enumerate(own):
                out[i] = score[: len(pages[i]), j] > 0
        return out


def stacked(rows: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((size, len(rows), rows[0].shape[1]), np.float32)
    mask = np.zeros((size, len(rows)), np.float32)
    for j, r in enumerate(rows):
        x[: len(r), j], mask[: len(r), j] = r, 1
    return x, mask


#: HTML elements for what stands apart from an article, and names that made pages give to such parts and to articles.
APART = frozenset("<nav <header <footer <aside <form <menu <button <dialog <head <fieldset <label".split())
ASIDE = "nav menu navbar sidebar header masthead footer ad ads advert advertisement banner cookie notice consent promo sponsored related share social breadcrumb newsletter subscribe login search form comment comments reply widget popup pagination toolbar copyright legal".split()
ARTICLE = "article main content post entry story body text".split()


def placed(path: Path) -> bool:
    """Whether a path stands inside an article element and in no element that is set apart from it."""
    return path.article and not path.apart


def labelled(pages: list[str]) -> list[tuple[list[Block], np.ndarray]]:
    """The blocks of pages that mark their article, and which of them are article."""
    out = []
    for page in map(blocks, pages):
        y = np.array([placed(path) for _, path, _ in page], bool)
        if y.any():
            out.append((page, y))
    return out


def hidden(page: list[Block], g: np.random.Generator) -> list[Block]:
    """A page's blocks as if its article stood in unnamed or oddly named divs, or in nothing of its own."""
    odd = lambda: "".join("abcdefghijklmnopqrstuvwxyz"[i] for i in g.integers(0, 26, g.integers(1, 7)))
    forms = [(), ("<div",), ("<div", odd()), ("<div", odd(), "<div", odd()), ("<main", "<div", odd(), "<div", odd()), ("<table", "<tbody", "<tr", "<td"), ("<table", "<tr", "<td"), ("<section", odd())]
    new = forms[int(g.integers(len(forms)))]
    moved: dict[Path, Path] = {}

    def move(path: Path) -> Path:
        steps, at = [], path
        while at is not None and at not in moved:
            steps.append(at)
            at = at.outer
        out = moved.get(at)
        for step in reversed(steps):
            names = tuple(y for x in step.names for y in (new if x in ("<article", "<main") else (x,)))
            out = moved[step] = Path(out, names)
        return out

    return [(t, move(path), n) for t, path, n in page]


def made_page(g: np.random.Generator, inside: list[str], outside: list[str]) -> tuple[str, list[bool]]:
    """A page composed of article texts and of others in a random layout, and whether each of its blocks is article."""
    pick = lambda xs: xs[int(g.integers(len(xs)))]
    plain = g.random() < 0.25  # parts of this page have random names or none
    html: list[str] = []
    labels: list[bool] = []

    def words(lo: int, hi: int, apart: bool = False) -> str:
        w = pick(outside if apart and g.random() < 0.5 else inside).split()
        n = int(g.integers(lo, hi))
        a = int(g.integers(0, max(1, len(w) - n)))
        return entities.escape(" ".join(w[a : a + n]) or "text")

    def put(s: str, keep: bool) -> str:
        labels.append(keep)
        return s

    def attrs(names: list[str]) -> str:
        if plain:
            return "" if g.random() < 0.5 else f' class="{"".join(pick("abcdefghijklmnopqrstuvwxyz") for _ in range(6))}"'
        key = pick(["class", "id"])
        return f' {key}="{pick(names)}{pick(["", "-box", "-1", " wide", "_area", "-wrapper", ""])}"'

    def extra(kind: str) -> None:
        tags = {"nav": ["nav", "div", "ul", "header"], "footer": ["footer", "div"], "header": ["header", "div"], "form": ["form"], "aside": ["aside", "div", "section"]}
        names = {"nav": ["nav", "menu", "navbar", "breadcrumb", "topnav menu"], "footer": ["footer", "copyright", "legal", "site footer"], "header": ["header", "masthead", "banner", "site header"]}
        options = tags.get(kind, ["div", "section", "aside"])
        tag = pick([t for t in options if f"<{t}" in APART] or ["aside"]) if plain else pick(options)
        own = names.get(kind, [kind] if kind != "aside" else ["sidebar", "widget", "related", "share social"])
        html.append(f"<{tag}{attrs(own) if tag in ('div', 'ul', 'section') or g.random() < 0.5 else ''}>")
        if kind == "nav" or (kind == "aside" and g.random() < 0.5):
            inner = [f'<li><a href="/x">{put(words(1, 4, True), False)}</a></li>' for _ in range(int(g.integers(2, 8)))]
            html.append("".join(inner) if tag == "ul" else f"<ul>{''.join(inner)}</ul>")
        elif kind in ("comment", "comments"):
            inner_tag = pick(["li", "div", "p"])
            for _ in range(int(g.integers(1, 5))):
                inner = "" if inner_tag == "p" else f"<p>{put(words(5, 40, True), False)}</p>"
                html.append(f"<{inner_tag}>{inner or put(words(5, 40, True), False)}</{inner_tag}>")
        elif kind == "form":
            html.append(f"<label>{put(words(1, 5, True), False)} <input name=q></label><button>{put(words(1, 3, True), False)}</button>")
        else:
            for _ in range(int(g.integers(1, 4))):
                t = pick(["p", "div", "span", ""])
                s = words(1, 25, True)
                if t in ("p", "div"):
                    html.append(f"<{t}>{put(s, False)}</{t}>")
                else:
                    html.append(f"<div>{put(s, False)}</div>")
        html.append(f"</{tag}>")

    for kind in g.permutation(["header", "nav", pick(ASIDE), "aside"])[: int(g.integers(1, 5))]:
        extra(str(kind))
    tags = [pick(["article", "main", "div", "section", ""] if plain else ["article", "main", "div", "section", "article", "div"])]
    tags = [t for t in tags if t] + ["div"] * int(pick([0, 0, 0, 1, 2]))
    cells = g.random() < 0.08  # the article is a cell of a table
    html.append("<table><tr><td>" * cells)
    html.append("".join(f"<{t}{attrs(ARTICLE) if t in ('div', 'section') else ''}>" for t in tags))
    if g.random() < 0.6:
        html.append(f"<h1>{put(words(2, 12), True)}</h1>")
    for _ in range(int(g.integers(1, 14))):
        r = g.random()
        if r < 0.07:
            html.append(f"<h2>{put(words(1, 8), True)}</h2>")
        elif r < 0.14:
            html.append("<ul>" + "".join(f"<li>{put(words(2, 20), True)}</li>" for _ in range(int(g.integers(2, 5)))) + "</ul>")
        elif r < 0.19:
            html.append(f"<blockquote>{put(words(5, 40), True)}</blockquote>")
        elif r < 0.30:
            extra(pick(["ad", "aside", "comment", "share", "related", "newsletter", "form", "notice"]))
        else:
            s = words(1, 120)
            link = f' <a href="/y">{words(1, 4)}</a>' if g.random() < 0.2 else ""
            html.append(pick([f"<p>{s}{link}</p>", f"<p><b>{s}{link}<br>", f"<p>{s}{link}"]))
            put("", True)
    html.append("".join(f"</{t}>" for t in reversed(tags)) + "</td></tr></table>" * cells)
    for kind in g.permutation(["comments", "footer", pick(ASIDE), "form", "aside"])[: int(g.integers(1, 5))]:
        extra(str(kind))
    return f"<html><body>{''.join(html)}</body></html>", labels


def examples(pages: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    g = np.random.default_rng(17)
    known = labelled(pages)
    rows = [(features(p), y) for page, y in known for p in (page, hidden(page, g), hidden(page, g))]
    inside = [t for page, y in known for (t, _, _), ok in zip(page, y) if ok and len(t) > 40]
    inside = inside or ["some words of a page that has more of them, and then some others"]
    outside = [t for page, y in known for (t, _, _), ok in zip(page, y) if not ok] or inside
    for _ in range(MADE):
        page, labels = made_page(g, inside, outside)
        own = blocks(page)
        if len(own) == len(labels):
            rows.append((features(own), np.array(labels)))
    return rows


def fit(pages: list[str], steps: int | None = None) -> Model:
    g = np.random.default_rng(23)
    size = PATH + WORDS + EXTRA
    p = nn.lstm_params(g, DIM, HIDDEN, "f") | nn.lstm_params(g, DIM, HIDDEN, "r")
    p |= {
        "w": (g.standard_normal((size, DIM)) * 0.2).astype(np.float32),
        "d": np.zeros(DIM, np.float32),
        "o": (g.standard_normal(2 * HIDDEN) * 0.3).astype(np.float32),
        "c": np.zeros(1, np.float32),
    }
    model, rows = Model(p), examples(pages)
    adam = nn.Adam(p, RATE)
    for _ in range(steps or STEPS):
        own = [rows[i] for i in g.integers(0, len(rows), BATCH)]
        longest = max(len(y) for _, y in own)
        x, mask = stacked([r for r, _ in own], longest)
        y = np.zeros(mask.shape, np.float32)
        for j, (_, labels) in enumerate(own):
            y[: len(labels), j] = labels
        z, h, kept, score = model.logits(x, mask, True)
        d = ((nn.sigmoid(score) - y) * mask / mask.sum()).astype(np.float32)
        dx, grads = nn.bilstm_back(d[:, :, None] * p["o"], kept, p)
        dz = (dx * (1 - np.tanh(z) ** 2)).reshape(-1, DIM)
        grads |= {"o": (h * d[:, :, None]).sum((0, 1)), "c": d.sum(keepdims=True).reshape(1), "w": x.reshape(-1, size).T @ dz, "d": dz.sum(0)}
        adam.step(grads)
    return model


def train(pages: DataFrame, sample: int = PAGES) -> Model:
    pages = pages.select("page_id", "html").where(F.length("html") <= LONGEST)
    picked = pages.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    got = pages.join(F.broadcast(picked), "page_id").groupBy("page_id").agg(F.min("html").alias("html")).orderBy("page_id").select("html").toArrow()
    return fit([h for h in got["html"].to_pylist() if h])


def extract(pages: DataFrame, sample: int = PAGES) -> DataFrame:
    """page_id, url, text, n_chars, n_blocks (article blocks), n_dropped of every row of ``pages``."""
    model = pages.sparkSession.sparkContext.broadcast(train(pages, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, len(b), 256):
                part = b.slice(k, 256)
                own = [blocks(h or "") for h in part.column("html").to_pylist()]
                keep = model.value.label(own)
                texts = ["\n".join(t for (t, _, _), ok in zip(x, y) if ok) for x, y in zip(own, keep)]
                kept = np.array([int(y.sum()) for y in keep], np.int64)
                size = np.array([len(x) for x in own], np.int64)
                cols = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(kept), pa.array(size - kept)]
                yield pa.RecordBatch.from_arrays(cols, ["page_id", "url", "text", "n_chars", "n_blocks", "n_dropped"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, n_blocks long, n_dropped long")


def op6_html_bilstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
