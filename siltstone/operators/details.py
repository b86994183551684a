"""Course catalogues: listings, detail pages, prerequisite expressions, and result pages of offerings, from a snapshot of pages."""

from __future__ import annotations

import html as codec
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .markdown import VOID, Node, parse
from .skew import spread

#: Fixed values of the catalogue's pages: titles, names and captions that tell what a part is.
PROGRAMME_LINK = "Programa Atual do Componente"
COMPONENT_ID = re.compile(r"'idComponente'\s*:\s*'(\d+)'")
GENERAL = "Dados Gerais do Componente Curricular"
REQUIRED_BY = "outros componentes que têm esse componente como pré-requisito"
LABELS = {"code": "Código", "name": "Nome", "prerequisites": "Pré-Requisitos", "corequisites": "Co-Requisitos", "equivalences": "Equivalências"}
OFFERINGS_ID, OFFERINGS_CAPTION = "turmasAbertas", "turmas encontrada(s)"
NOTHING = "-"

text_fields = lambda names: [StructField(n, StringType()) for n in names]
PAIRS = ArrayType(StructType(text_fields(["key", "value"])))
LISTED = ArrayType(StructType(text_fields(["component_id", "code", "name"])))
DETAILS = StructType(text_fields([*LABELS, "required_by"]))


def plain(n: Node) -> str:
    return re.sub(r"\s+", " ", n.text()).strip()


def cells(row: Node) -> list[Node]:
    return [c for c in row.kids if isinstance(c, Node) and c.tag in ("td", "th")]


def captioned(root: Node, caption: str) -> Node | None:
    """The first table whose caption holds some words."""
    tables = (n for n in root.walk() if n.tag == "table")
    return next((t for t in tables if any(n.tag == "caption" and caption.lower() in plain(n).lower() for n in t.walk())), None)


def rows(html: str | None) -> list[tuple[str, str]]:
    """(key, value) of the table rows that have exactly a label and a value."""
    out = []
    for n in parse(html or "").walk():
        if n.tag == "tr":
            own = [plain(c) for c in cells(n)]
            if len(own) == 2 and own[0]:
                out.append((own[0].rstrip(":").strip(), own[1]))
    return out


@F.pandas_udf(PAIRS)
def detail_pairs(html: pd.Series) -> pd.Series:
    return pd.Series([[{"key": k, "value": v} for k, v in rows(h)] for h in html], dtype=object)


def expressed(cell: Node) -> str:
    """A prerequisite cell as ``name (code)`` tokens joined by E, OU and brackets; its plain text where it holds none of these.

    Names come from the titles of marked codes, less the code itself; a code without one stands alone.
    """
    out = []
    todo = list(reversed(cell.kids))
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            out += [t.upper() for t in re.findall(r"[A-Z]{3,4}\d{4}|\b(?:OU|E|ou|e)\b|[()]", n)]
            continue
        code, title = plain(n), n.attrs.get("title", "").strip()
        if title and re.fullmatch(r"[A-Z]{3,4}\d{4}", code):
            out.append(f"{title.replace(code, '').strip(' -') or code} ({code})")
        else:
            todo += reversed(n.kids)
    return " ".join(out) or plain(cell) or NOTHING


def expression(html: str | None) -> str | None:
    return None if html is None else expressed(parse(html))


@F.pandas_udf(StringType())
def requirement_expr(html: pd.Series) -> pd.Series:
    return html.map(expression)


def syllabus_url(pairs: Column, key: str) -> Column:
    """The value of one detail; null without it."""
    return F.get(F.filter(pairs, lambda x: x["key"] == key), F.lit(0))["value"]


@F.pandas_udf(LISTED)
def listed(html: pd.Series) -> pd.Series:
    """The components of a listing that have a link to a programme."""

    def one(h: str | None) -> list[dict]:
        out = []
        for row in (n for n in parse(h or "").walk() if n.tag == "tr"):
            link = next((n for n in row.walk() if n.tag == "a" and n.attrs.get("title") == PROGRAMME_LINK), None)
            own = [plain(c) for c in cells(row)]
            if link is not None and len(own) >= 2 and own[0] and own[1]:
                found = COMPONENT_ID.search(link.attrs.get("onclick", ""))
                out.append({"component_id": found and found[1], "code": own[0], "name": own[1]})
        return out

    return pd.Series([one(h) for h in html], dtype=object)


@F.pandas_udf(DETAILS)
def component_details(html: pd.Series) -> pd.DataFrame:
    """The general fields of a detail page, and the components that require it; ``NOTHING`` where a field is absent."""

    def one(h: str | None) -> list[str]:
        root = parse(h or "")
        general, others = captioned(root, GENERAL), captioned(root, REQUIRED_BY)
        fields = {}
        for row in general.walk() if general else ():
            if row.tag == "tr" and [c.tag for c in cells(row)] == ["th", "td"]:
                label, value = cells(row)
                fields.setdefault(plain(label).replace(":", ""), value)
        out = [plain(fields[v]) or NOTHING if v in fields else NOTHING for v in list(LABELS.values())[:2]]
        out += [expressed(fields[v]) if v in fields else NOTHING for v in list(LABELS.values())[2:]]
        first = [next((plain(c) for c in cells(r) if c.tag == "td"), "") for r in (others.walk() if others else ()) if r.tag == "tr"]
        return [*out, " | ".join(x for x in first if x) or NOTHING]

    return pd.DataFrame([one(h) for h in html], columns=[*LABELS, "required_by"])


def scraped(listings: DataFrame, details: DataFrame, programmes: DataFrame) -> DataFrame:
    """unit, component_id, code, name, the fields of the detail page, has_programme, body (null without a programme).

    ``listings`` has unit and html, the other two component_id and html. A component without a detail page has null fields.
    """
    own = spread(listings.select("unit", "html"), "html").select("unit", F.inline(listed("html")))
    fields = spread(details.select("component_id", "html"), "component_id").select("component_id", component_details("html").alias("d")).select("component_id", *[F.col(f"d.{n}").alias(n) for n in DETAILS.names if n not in ("code", "name")])
    bodies = programmes.select("component_id", F.col("html").alias("body"))
    return own.join(fields, "component_id", "left").join(bodies, "component_id", "left").withColumn("has_programme", F.col("body").isNotNull())


def outer(node: Node) -> str:
    """A node as HTML."""
    out, todo = [], [node]
    while todo:
        n = todo.pop()
        if isinstance(n, tuple):
            out.append(n[0])
        elif isinstance(n, str):
            out.append(codec.escape(n, quote=False))
        else:
            out.append("<" + "".join([n.tag, *(f' {k}="{codec.escape(v)}"' for k, v in n.attrs.items())]) + ">")
            if n.tag not in VOID:
                todo += [(f"</{n.tag}>",), *reversed(n.kids)]
    return "".join(out)


@F.pandas_udf(StringType())
def offerings_part(html: pd.Series) -> pd.Series:
    """The results of a search for offerings as a page of their own; null where the page has none."""

    def one(h: str | None) -> str | None:
        part = next((n for n in parse(h or "").walk() if n.attrs.get("id") == OFFERINGS_ID), None)
        return f"<!DOCTYPE html><html><body>{outer(part)}</body></html>" if part is not None and captioned(part, OFFERINGS_CAPTION) else None

    return pd.Series([one(h) for h in html], dtype=object)


def offering_pages(results: DataFrame) -> DataFrame:
    """unit, period, body of the result pages (unit, period, html) that hold offerings; a unit and period is kept once."""
    found = results.select("unit", "period", offerings_part("html").alias("body")).where("body IS NOT NULL")
    return found.groupBy("unit", "period").agg(F.min("body").alias("body"))
