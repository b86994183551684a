"""HTML to Markdown: a tolerant event parser builds a small tree, which rules turn into text.

Errors are mended as browsers do: ends implied for p, li, rows, cells and dt/dd; rows implied around cells; what stands in a table
but in no cell goes before it (foster parenting); end tags reach out of no cell and inline ones out of no block; and links, bold
and slanted text that is closed out of order or left open at a block's end goes on in the next (a list of active formats, with
elements split where they overlap). The parser and the rules run in a pandas UDF; documents stay whole.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

#: What is stripped as boilerplate, and where the main content is looked for.
DROP_TAGS = frozenset("script style nav footer header aside meta iframe link noscript".split())
DROP_NAMES = re.compile(r"\b(menu|navbar|sidebar|breadcrumb|footer|cookie|banner|share|ad|ads)\b", re.I)
MAIN = (("main", ""), ("article", ""), ("div", "content"), ("div", "main"))
VOID = frozenset("area base br col embed hr img input link meta source wbr".split())
IMPLIED = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
FENCE = {"p": {"div", "section", "article", "li", "td", "th", "blockquote", "body", "details"}, "li": {"ul", "ol"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tr": {"table"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
BLOCKS = frozenset("p div section article main ul ol table blockquote pre h1 h2 h3 h4 h5 h6 hr details dl figure body".split())
#: HTML's elements of tables, those that hold only rows and cells, what may stand in them, formats that shape Markdown, and elements that inline end tags do not leave.
CELLS = frozenset("td th caption".split())
ROWS = frozenset("table thead tbody tfoot tr".split())
PARTS = {"tr": ROWS - {"tr"}, "td": frozenset({"tr"}), "th": frozenset({"tr"}), **dict.fromkeys("thead tbody tfoot caption colgroup col".split(), frozenset({"table"}))}
IN_TABLE = frozenset([*PARTS, *"script style template form input".split()])
FORMATS = frozenset("a b em i strong".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SPECIAL = BLOCKS | CELLS | ROWS | frozenset("root html head li dt dd header footer nav aside form button address center figcaption summary select".split())
#: At most so many equal formats stay active, and an end tag splits at most so many blocks.
ALIKE, SPLITS = 3, 8


#: Fixed value: HTML reads a larger colspan as this one.
COLSPAN = 1000
NESTING, LEVELS = 3, 6
#: Classes of tables of labels and values.
PAIR_TABLES = frozenset(("visualizacao", "programaRelatorio"))


class Node:
    __slots__ = ("attrs", "blocky", "kids", "tag", "up")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.kids, self.blocky, self.up = tag, {} if attrs is None else attrs, [], False, None

    def walk(self):
        todo = [self]
        while todo:
            n = todo.pop()
            yield n
            todo += [k for k in reversed(n.kids) if isinstance(k, Node)]

    def text(self) -> str:
        out, todo = [], [self]
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                out.append(n)
            else:
                todo += reversed(n.kids)
        return "".join(out)


class Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("root")
        self.open = [self.root]
        self.count = Counter({"root": 1})
        self.active: list[Node | None] = []  # open or interrupted formats; None where a cell begins
        self.deepest = 1

    def cut(self, k: int) -> None:
        """Close the open elements from the k-th on."""
        for n in reversed(self.open[k:]):
            self.count[n.tag] -= 1
            if n.tag in CELLS:
                while self.active and self.active.pop() is not None:
                    pass
        del self.open[k:]

    def innermost(self, tags: frozenset[str] | set[str], stop: frozenset[str] | set[str]) -> int:
        """The place of the innermost open element of ``tags``, 0 if there is none or one of ``stop`` lies inside it."""
        if not any(self.count[t] for t in tags):
            return 0
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                return k
            if self.open[k].tag in stop:
                return 0
        return 0

    def place(self, new: Node | str, into: Node) -> None:
        """Put content into an element; before its table, if only rows and cells may stand there."""
        stays = not new.strip() if isinstance(new, str) else new.tag in IN_TABLE
        if into.tag in ROWS and not stays:
            table = next(n for n in reversed(self.open) if n.tag == "table") if self.count["table"] else None
            if table is not None and table.up is not None:
                kids = table.up.kids
                k = next(k for k in range(len(kids) - 1, -1, -1) if kids[k] is table)
                kids.insert(k, new)
                into = table.up
            else:
                into.kids.append(new)
        else:
            into.kids.append(new)
        if isinstance(new, Node):
            new.up = into

    def push(self, node: Node) -> Node:
        self.place(node, self.open[-1])
        self.open.append(node)
        self.count[node.tag] += 1
        self.deepest = max(self.deepest, len(self.open))
        return node

    def resume(self) -> None:
        """Open the active formats again that a closed block has interrupted."""
        k = len(self.active)
        while k and self.active[k - 1] is not None and not self.is_open(self.active[k - 1]):
            k -= 1
        for k in range(k, len(self.active)):
            self.active[k] = self.push(Node(self.active[k].tag, self.active[k].attrs))

    def is_open(self, n: Node) -> bool:
        return self.count[n.tag] > 0 and any(o is n for o in reversed(self.open))

    def last_format(self, tag: str) -> Node | None:
        for n in reversed(self.active):
            if n is None or n.tag == tag:
                return n
        return None

    def close_format(self, tag: str) -> None:
        """Close a format; blocks that began inside it are split from it, so that each keeps what it had."""
        for _ in range(SPLITS):
            fmt = self.last_format(tag)
            if fmt is None:
                self.close_inline(tag)
                return
            if not self.is_open(fmt):
                self.active.remove(fmt)
                return
            k = next(k for k in range(len(self.open) - 1, 0, -1) if self.open[k] is fmt)
            if any(n.tag in CELLS or n.tag == "table" for n in self.open[k:]):
                return
            far = next((j for j in range(k + 1, len(self.open)) if self.open[j].tag in SPECIAL), 0)
            if not far:
                self.cut(k)
                self.active.remove(fmt)
                return
            self.split(fmt, k, far)

    def split(self, fmt: Node, k: int, far: int) -> None:
        """Take the block at ``far`` out of the format at ``k``: formats between are copied, other elements between are closed."""
        block = last = self.open[far]
        mark = self.active.index(fmt)
        for j in range(far - 1, k, -1):
            between = self.open[j]
            if between not in self.active:
                self.count[between.tag] -= 1
                del self.open[j]
                continue
            copy = Node(between.tag, between.attrs)
            at = self.active.index(between)
            self.active[at] = self.open[j] = copy
            if last is block:
                mark = at + 1
            self.detach(last)
            copy.kids.append(last)
            last.up, last = copy, copy
        self.detach(last)
        self.place(last, self.open[k - 1])
        inner = Node(fmt.tag, fmt.attrs)
        inner.kids, block.kids, inner.up = block.kids, [inner], block
        for n in inner.kids:
            if isinstance(n, Node):
                n.up = inner
        self.active.insert(mark, inner)
        self.active.remove(fmt)
        del self.open[k]
        self.open.insert(next(j for j in range(len(self.open) - 1, 0, -1) if self.open[j] is block) + 1, inner)

    def detach(self, n: Node) -> None:
        if n.up is not None:
            kids = n.up.kids
            del kids[next(k for k in range(len(kids) - 1, -1, -1) if kids[k] is n)]

    def close_inline(self, tag: str) -> None:
        if k := self.innermost({tag}, SPECIAL):
            self.cut(k)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        if tag in PARTS and (table := self.innermost({"table"}, frozenset())):
            held = self.innermost(PARTS[tag], {"table"} - PARTS[tag])
            self.cut((held or self.innermost(PARTS["tr"], frozenset()) or table) + 1)
            if tag in ("td", "th") and not held:
                self.push(Node("tr"))
        else:
            ends = IMPLIED.get(tag, {"p"} if tag in BLOCKS else set())
            if ends and (k := self.innermost(ends, FENCE.get(tag, FENCE["p"]) | {"table"})):
                self.cut(k)
            if tag in HEADINGS and self.open[-1].tag in HEADINGS:
                self.cut(len(self.open) - 1)
            if tag == "a" and (old := self.last_format("a")) is not None:
                self.close_format("a")
                if old in self.active:
                    self.active.remove(old)
            if tag not in SPECIAL:
                self.resume()
        if tag in VOID:
            self.place(node, self.open[-1])
            return
        self.push(node)
        if tag in CELLS:
            self.active.append(None)
        if tag in FORMATS:
            own = self.active[len(self.active) - next((k for k, n in enumerate(reversed(self.active)) if n is None), len(self.active)) :]
            alike = [n for n in own if n.tag == tag]
            if len(alike) >= ALIKE:
                self.active.remove(alike[0])
            self.active.append(node)

    def handle_startendtag(self, tag, attrs):
        self.place(Node(tag, {k: v or "" for k, v in attrs}), self.open[-1])

    def handle_endtag(self, tag):
        if tag in FORMATS:
            self.close_format(tag)
        elif tag in PARTS or tag == "table":
            if k := self.innermost({tag}, set() if tag == "table" else {"table"}):
                self.cut(k)
        elif tag in HEADINGS:
            if k := self.innermost(HEADINGS, CELLS | {"table"}):
                self.cut(k)
        elif tag in SPECIAL:
            if k := self.innermost({tag}, CELLS | {"table"}):
                self.cut(k)
        else:
            self.close_inline(tag)

    def handle_data(self, data):
        if self.active and not data.isspace():
            self.resume()
        self.place(data, self.open[-1])


def parse(html: str) -> Node:
    b = Builder()
    b.feed(html)
    b.close()
    # The rules call each other once for each level of the tree; such calls use no C stack.
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 8 * b.deepest + 1000))
    return b.root


def stripped(node: Node) -> None:
    """Take boilerplate out of the tree."""
    for n in node.walk():
        n.kids = [k for k in n.kids if isinstance(k, str) or not (k.tag in DROP_TAGS or DROP_NAMES.search(f"{k.attrs.get('class', '')} {k.attrs.get('id', '')}"))]


def main_content(root: Node) -> Node:
    for tag, name in MAIN:
        for n in root.walk():
            if n.tag == tag and (not name or name in (n.attrs.get("id", ""), *n.attrs.get("class", "").split())):
                return n
    return root


def link(n: Node, base: str, inner: str) -> str:
    href = n.attrs.get("href", "").strip()
    if href.lower().startswith("mailto:"):
        return href[7:].split("?")[0]
    if not href or href.lower().startswith(("javascript:", "tel:", "data:")):
        return inner
    try:
        url = urljoin(base, href)
    except ValueError:
        return inner
    url = re.sub(r"/index\.html?(?=$|#)", "/", url)
    url = re.sub(r"\.html?#", "#", url)
    return f"[{inner}]({url})" if inner else ""


def grid(table: Node) -> list[Node]:
    """Rows with cells, without those of nested tables."""
    rows = []
    for k in table.kids:
        if isinstance(k, Node) and k.tag == "tr":
            rows += [k] if cells_of(k) else []
        elif isinstance(k, Node) and k.tag in ("thead", "tbody", "tfoot"):
            rows += grid(k)
    return rows


def cell_text(c: Node, base: str) -> str:
    s = inline(c, base, "; ")
    return re.sub(r"\s+", " ", s).strip().strip(";").strip().replace("|", "\\|")


def table_md(t: Node, base: str) -> str:
    """Rows of a label and a value as bold pairs; else a grid: caption, column names, rows padded to the widest, section rows as headings."""
    rows = [cells_of(r) for r in grid(t)]
    caption = next((inline(n, base).strip() for n in t.walk() if n.tag == "caption"), "")
    out = [f"#### {caption}", ""] if caption else []
    widths = [len(r) for r in rows]
    hint = PAIR_TABLES & set(t.attrs.get("class", "").split())
    named = sum(n.tag == "th" and n.attrs.get("scope") == "col" for n in t.walk())
    if rows and max(widths) <= 2 and (hint or set(widths[:5]) == {2} or (sum(widths) < 10 and len(rows) > named)):
        return "\n".join(out + [pair(r, base) for r in rows]).strip("\n")
    head = header(t)
    foot = [id(r) for part in t.kids if isinstance(part, Node) and part.tag == "tfoot" for r in part.kids]
    over = [id(r) for r in head]
    width = max((sum(span(c) for c in cells_of(r)) for r in grid(t) if id(r) not in foot), default=0)
    titles = padded(head[-1], width, base) if head else []
    names = [line(titles), "|" + " --- |" * width] if head else []
    out += names
    for r in grid(t):
        if id(r) in over or id(r) in foot:
            continue
        own = cells_of(r)
        if "agrupador" in r.attrs.get("class", "").split() or (len(own) == 1 and width > 1 and span(own[0]) >= width - 1 and "colspan" in own[0].attrs):
            title = re.sub(r"\s+", " ", r.text()).strip()
            out += ["", f"### {title}", "", *names] if title else []
            continue
        cells = padded(r, width, base)
        if any(cells):
            out.append(line(cells))
    closing = re.sub(r"\s+", " ", " ".join(cell_text(c, base) for r in grid(t) if id(r) in foot for c in cells_of(r))).strip()
    return "\n".join(out + (["", f"**{closing}**"] if closing else []))


def pair(cells: list[Node], base: str) -> str:
    """A label and its value; a cell alone is a heading if it is a th, else a line."""
    shown = [cell_text(c, base) for c in cells]
    if len(shown) == 1:
        return f"\n### {shown[0]}\n" if cells[0].tag == "th" and shown[0] else shown[0]
    label = f"**{shown[0].rstrip(':').strip()}:**" if shown[0] else ""
    return f"{label} {shown[1]}".strip()


def cells_of(row: Node) -> list[Node]:
    return [c for c in row.kids if isinstance(c, Node) and c.tag in ("td", "th")]


def header(table: Node) -> list[Node]:
    """The rows that name the columns: those of thead, else a first row of th cells only."""
    named = [r for part in table.kids if isinstance(part, Node) and part.tag == "thead" for r in grid(part)]
    first = grid(table)[:1]
    return named or [r for r in first if all(c.tag == "th" for c in cells_of(r))]


def padded(row: Node, width: int, base: str) -> list[str]:
    """The row's cells, each followed by empty ones for its span, up to ``width``."""
    cells: list[str] = []
    for c in cells_of(row):
        cells += [cell_text(c, base)] + [""] * (span(c) - 1)
    return cells + [""] * (width - len(cells))


def line(cells: list[str]) -> str:
    return "| " + " | ".join(cells) + " |"


def span(c: Node) -> int:
    s = c.attrs.get("colspan", "1")
    return max(1, min(int(s), COLSPAN)) if s.isdigit() else 1


def inline(n: Node, base: str, line_break: str = "\n") -> str:
    out = []
    for k in n.kids:
        if isinstance(k, str):
            out.append(re.sub(r"\s+", " ", k))
            continue
        inner = inline(k, base, line_break)
        bare = inner.strip()
        if k.tag == "br":
            out.append(line_break)
        elif k.tag in ("strong", "b"):
            out.append(f"**{bare}**" if bare and "\n" not in bare else inner)
        elif k.tag in ("em", "i"):
            out.append(f"*{bare}*" if bare and "\n" not in bare else inner)
        elif k.tag == "a":
            out.append(link(k, base, bare))
        elif k.tag == "select":
            out.append("\n" + "\n".join(f"- {o.text().strip()}" for o in k.walk() if o.tag == "option") + "\n")
        else:
            out.append(inner)
    return "".join(out)


def is_heading(n: Node) -> bool:
    return len(n.tag) == 2 and n.tag[0] == "h" and n.tag[1] in "123456"


def levels(root: Node) -> dict[int, int]:
    """The level of each heading (by id of its node), at most ``LEVELS``.

    It counts from the page's highest; each enclosing element that holds an earlier heading with text adds one, at most ``NESTING``.
    """
    low = min((int(n.tag[1]) for n in root.walk() if is_heading(n)), default=1)
    out: dict[int, int] = {}
    path: list[list] = [[root, 0, False]]  # element, its next kid, whether it held a heading so far
    while path:
        top = path[-1]
        if top[1] == len(top[0].kids):
            path.pop()
            continue
        k = top[0].kids[top[1]]
        top[1] += 1
        if isinstance(k, str):
            continue
        if is_heading(k):
            out[id(k)] = min(LEVELS, int(k.tag[1]) - low + 1 + min(NESTING, sum(held for _, _, held in path)))
            top[2] = top[2] or bool(k.text().strip())
        path.append([k, 0, False])
    return out


def mark_blocks(root: Node) -> None:
    """Note for every node whether a block stands somewhere inside it."""
    for n in reversed(list(root.walk())):
        n.blocky = any(isinstance(k, Node) and (k.blocky or k.tag in BLOCKS) for k in n.kids)


def block(n: Node, base: str, depth: dict[int, int], indent: int = 0) -> str:
    """The node's content as blocks divided by blank lines."""
    out: list[str] = []
    loose: list[str | Node] = []

    def settle() -> None:
        if loose:
            hold = Node("span")
            hold.kids = list(loose)
            s = inline(hold, base)
            if s.strip():
                out.append(s.strip())
            loose.clear()

    for k in n.kids:
        if isinstance(k, str) or not (k.tag in BLOCKS or k.blocky):
            loose.append(k)
            continue
        settle()
        if k.tag in ("ul", "ol"):
            items = [c for c in k.kids if isinstance(c, Node) and c.tag == "li"]
            pad = " " * indent
            lines = []
            for i, c in enumerate(items):
                mark = f"{i + 1}. " if k.tag == "ol" else "- "
                body = block(c, base, depth, indent + 2).strip()
                lines.append(pad + mark + body.replace("\n\n", "\n"))
            out.append("\n".join(lines))
        elif k.tag == "table":
            out.append(table_md(k, base))
        elif k.tag == "pre":
            out.append("```\n" + k.text().strip("\n") + "\n```")
        elif k.tag == "hr":
            out.append("---")
        elif is_heading(k):
            out.append("#" * depth[id(k)] + " " + re.sub(r"\s+", " ", inline(k, base)).strip())
        elif k.tag == "blockquote":
            out.append("\n".join("> " + x for x in block(k, base, depth).split("\n") if x.strip()))
        elif k.tag == "details":
            head = next((c for c in k.kids if isinstance(c, Node) and c.tag == "summary"), None)
            if head is not None:
                out.append(f"**{inline(head, base).strip()}**")
                k.kids = [c for c in k.kids if c is not head]
            out.append(block(k, base, depth))
        else:
            out.append(block(k, base, depth, indent))
    settle()
    return "\n\n".join(x for x in out if x.strip())


def convert(html: str | None, base: str | None = "") -> str | None:
    """Markdown of a page's main content; null stays null."""
    if html is None:
        return None
    root = parse(html)
    stripped(root)
    main = main_content(root)
    mark_blocks(main)
    md = block(main, base or "", levels(main))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(x.rstrip() for x in md.split("\n"))).strip()


@F.pandas_udf(StringType())
def to_markdown(html: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([convert(h, b) for h, b in zip(html, base)], dtype=object)


SIGNALS = StructType(
    [StructField("title", StringType()), StructField("details", IntegerType()), StructField("summaries", IntegerType()), StructField("bold", ArrayType(StringType()))]
)


@F.pandas_udf(SIGNALS)
def signals(html: pd.Series) -> pd.DataFrame:
    """What tells a page of questions: title, foldable parts, bold texts (one a tag as written: its text up to the end of its first block)."""

    def one(h):
        nodes = list(parse(h or "").walk())
        title = next((n.text().strip() for n in nodes if n.tag == "title"), None)
        written = {id(n.attrs): n for n in reversed(nodes) if n.tag in ("b", "strong")}  # parts of a tag share its attributes
        bold = [n.text().strip() for n in reversed(written.values())]
        return title, sum(n.tag == "details" for n in nodes), sum(n.tag == "summary" for n in nodes), bold

    return pd.DataFrame([one(h) for h in html], columns=["title", "details", "summaries", "bold"])
