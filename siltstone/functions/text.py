"""Text columns: cleaning, fields of tagged answers, formats of documents and prompts."""

from __future__ import annotations

import html
import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .keys import strip

#: Entities and what they stand for.
ENTITIES = (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))


def collapse(c: Column) -> Column:
    """Runs of white space as one space."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


def clean_lines(c: Column) -> Column:
    """Lines stripped, empty ones dropped."""
    return F.array_join(F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != ""), "\n")


def strip_fences(c: Column) -> Column:
    """The inside of a fenced block, if the text is one."""
    return F.regexp_replace(F.regexp_replace(c, r"^\s*```[A-Za-z]*\n", ""), r"\n?```\s*$", "")


def strip_links(c: Column) -> Column:
    """Markdown links as their text, bare URLs removed."""
    return F.regexp_replace(F.regexp_replace(c, r"\[([^\]]*)\]\([^)]*\)", "$1"), r"https?://[^\s)]+", "")


def decode_entities(c: Column) -> Column:
    for name, value in ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(value))
    return c


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def normalize_text(c: Column) -> Column:
    return strip(nfc(decode_entities(c)))


@F.pandas_udf(StringType())
def slugify(s: pd.Series) -> pd.Series:
    """Lower-case ASCII words joined by hyphens."""

    def one(x):
        if x is None:
            return None
        plain = unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode().lower()
        return re.sub(r"[^a-z0-9]+", "-", plain).strip("-")

    return s.map(one)


def tagged(c: Column, tag: str) -> Column:
    """What stands between <TAG> and </TAG>, stripped; null if it is not there."""
    return F.nullif(strip(F.regexp_extract(c, rf"(?s)<{tag}>(.*?)</{tag}>", 1)), F.lit(""))


def answer_of(c: Column) -> Column:
    """The answer of a tagged response: closed, else open to the end, else the whole text."""
    open_end = F.nullif(strip(F.regexp_extract(c, r"(?s)<ANSWER>(.*)$", 1)), F.lit(""))
    return F.coalesce(tagged(c, "ANSWER"), open_end, strip(c))


def reason_of(c: Column) -> Column:
    return tagged(c, "REASON")


def answer_valid(c: Column, unanswerable: bool = False) -> Column:
    ok = c.contains("<ANSWER>") & c.contains("<REASON>")
    return ok if unanswerable else ok & c.contains("</quote>")


def model_turn(c: Column) -> Column:
    """What the model said between turn marks."""
    return strip(F.regexp_extract(c, r"(?s)<start_of_turn>model\n(.*?)(?:<end_of_turn>|$)", 1))


def intent_label(c: Column, default: str = "domain_query") -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(F.lower(c), r"tipo:\s*([a-z_0-9]+)", 1), F.lit("")), F.lit(default))


def json_object(c: Column) -> Column:
    """The first to the last brace of a text; null without one."""
    return F.nullif(F.regexp_extract(c, r"(?s)(\{.*\})", 1), F.lit(""))


def first_line(c: Column) -> Column:
    """The first line without leading bullets."""
    return F.split(F.regexp_replace(c, r"^[*\- ]+", ""), "\n")[0]


def citation_hosts(c: Column) -> Column:
    """Hosts, without www., of links that stand alone in italics."""
    found = F.regexp_extract_all(c, F.lit(r"\*\[[^\]]*\]\((https?://[^)\s]+)\)\*"), F.lit(1))
    return F.transform(found, lambda u: F.regexp_replace(F.regexp_extract(u, r"^https?://([^/?#]+)", 1), r"^www\.", ""))


def doc_field(c: Column, name: str) -> Column:
    """A field of a document's metadata block."""
    block = F.regexp_extract(c, r"(?s)^\s*(<doc_metadata>.*?</doc_metadata>)", 1)
    return F.nullif(strip(F.regexp_extract(block, rf"(?m)^{name}:[ \t]*(.*)$", 1)), F.lit(""))


def doc_body(c: Column) -> Column:
    """A document without the metadata block before it and the pair of quotes around it; other blocks and quotes are its own."""
    body = strip(F.regexp_replace(c, r"(?s)^\s*<doc_metadata>.*?</doc_metadata>", ""))
    quoted = (F.length(body) > 1) & body.startswith('"') & body.endswith('"')
    return F.when(quoted, strip(F.substring(body, F.lit(2), F.length(body) - 2))).otherwise(body)


def escape_html(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def details_html(pairs: Column) -> Column:
    """An array of (key, value) as an escaped definition list."""
    item = lambda x: F.concat(F.lit("<dt>"), escape_html(x["key"]), F.lit("</dt><dd>"), escape_html(x["value"]), F.lit("</dd>"))
    return F.concat(F.lit("<dl>"), F.array_join(F.transform(pairs, item), ""), F.lit("</dl>"))


def around(document: Column, first: Column, last: Column, tail: int = 200, reach: int = 4000) -> Column:
    """The part of a document around a batch: from before the first chunk's end to after the last chunk's end."""
    a = F.position(F.right(first, F.lit(tail)), document)
    b = F.position(F.right(last, F.lit(tail)), document)
    start = F.greatest(F.lit(1), F.when(a > 0, a - reach).otherwise(F.lit(1)))
    stop = F.least(F.length(document), F.when(b > 0, b + tail + reach).otherwise(F.length(document)))
    return F.substring(document, start, F.greatest(stop - start + 1, F.lit(0)))


def around_batch(document: Column, first: Column, last: Column, tail: int = 200, reach: int = 4000, second: Column | None = None) -> Column:
    """``around`` with the last chunk searched behind the first; where neither is found, from the second chunk, if there is one.

    The whole document if the first or last chunk is empty or none is found.
    """
    f, l = F.right(first, F.lit(tail)), F.right(last, F.lit(tail))  # noqa: E741
    a = F.position(f, document)
    behind = F.when(a > 0, a + F.length(f)).otherwise(F.lit(1))
    b = F.position(l, F.substring(document, behind, F.length(document)))
    b = F.when(b > 0, b + behind - 1).otherwise(F.lit(0))
    start = F.when(a > 0, a).otherwise(b)
    if second is not None:
        again = F.position(F.right(second, F.lit(tail)), document)
        start = F.when((start == 0) & (F.coalesce(F.length(second), F.lit(0)) > 0), again).otherwise(start)
    stop = F.when(b > 0, b).otherwise(start + 1) + F.length(l) - 1 + reach
    low = F.greatest(F.lit(1), start - reach)
    known = (F.length(first) > 0) & (F.length(last) > 0) & (start > 0)
    return F.when(known, F.substring(document, low, stop - low + 1)).otherwise(document)


ESCAPE = re.compile(r'\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})|\\')


def repair(s: str | None) -> str | None:
    """A JSON object from text that is nearly one; null if it cannot be read.

    The text from the first to the last brace is read. Raw control characters in strings are read as they are. If the decoder stops at a backslash that
    escapes nothing, all of these are doubled in one pass; wherever else it stops, the last quote before was part of a string and is escaped.
    """
    if s is None:
        return None
    body = s[s.find("{") : s.rfind("}") + 1] or s
    shown: str | None = body
    doubled = False
    for _ in range(len(body) + 1):
        try:
            got = json.loads(shown, strict=False)
            return json.dumps(got, ensure_ascii=False) if isinstance(got, dict) else None
        except json.JSONDecodeError as e:
            if e.msg.startswith("Invalid \\") and not doubled:
                doubled = True
                shown = ESCAPE.sub(lambda m: m[0] if len(m[0]) > 1 else "\\\\", shown)
            else:
                shown = _quoted(shown, e)
        if shown is None:
            break
    pair = re.search(r'"question"\s*:\s*"(.*?)"\s*,\s*"answer"\s*:\s*"(.*)"', body, re.S)
    return json.dumps({"question": pair[1], "answer": pair[2]}, ensure_ascii=False) if pair else None


def _quoted(s: str, e: json.JSONDecodeError) -> str | None:
    """``s`` with the last open quote before the decoder's error escaped; null where none can be."""
    if e.msg.startswith(("Unterminated", "Invalid \\")):
        return None
    at = s.rfind('"', 0, e.pos)
    while at > 0 and (at - len(s[:at].rstrip("\\"))) % 2:
        at = s.rfind('"', 0, at)
    return s[:at] + "\\" + s[at:] if at >= 0 else None


@F.pandas_udf(StringType())
def json_repair(s: pd.Series) -> pd.Series:
    return s.map(repair)


CLOAK = re.compile(r'<span id="(cloak[0-9a-f]+)">.*?</span>\s*<script[^>]*>(.*?)</script>', re.S | re.I)
PIECE = re.compile(r"""(?:var\s+)?(addy\w*)\s*=\s*((?:\s*\+?\s*(?:'[^']*'|"[^"]*"|addy\w*))+)""")


def reveal(page: str | None) -> str | None:
    """Addresses that a script assembles beside a cloaked span, as mail links."""

    def one(m: re.Match) -> str:
        value: dict[str, str] = {}
        for name, expr in PIECE.findall(m[2]):
            bits = re.findall(r"""'([^']*)'|"([^"]*)"|(addy\w*)""", expr)
            value[name] = "".join(html.unescape(a or b) if not c else value.get(c, "") for a, b, c in bits)
        mails = [v for v in value.values() if re.fullmatch(r"[^@\s]+@[^@\s]+\.[^@\s]+", v)]
        return f'<a href="mailto:{mails[-1]}">{mails[-1]}</a>' if mails else m[0]

    return None if page is None else CLOAK.sub(one, page)


@F.pandas_udf(StringType())
def email_deobfuscate(s: pd.Series) -> pd.Series:
    return s.map(reveal)


def requirement_tokens(c: Column) -> Column:
    """Course codes, connectives and brackets of a prerequisite cell, in order."""
    return F.regexp_extract_all(c, F.lit(r"([A-Z]{3,4}[0-9]{4}|\bOU\b|\bE\b|[()])"), F.lit(1))
