"""Assembly of training examples: schedules, contexts, formats, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import origin_key, seeded_uniform, short_hash
from ..functions.text import strip_links
from .rank import row_numbers

#: Names of the writing styles, and the schedule of row index i by them.
STYLES = ("naturalistic", "casual", "formal")


def style_schedule(rows: DataFrame, i: str, component: Column | None = None, styles: tuple[str, ...] = STYLES, iterations: int = 1, seed: str = "style") -> DataFrame:
    """Rows of (input columns, style, iteration) under the modulo schedule of the row index ``i``.

    Plain rows: multi-hop always, unanswerable if i is even, and each style unless its turn is left out. Component rows:
    multi-hop if i divides by 3, unanswerable if i + 1 divides by 6, and one seeded style where no multi-hop is due.
    """
    n = F.col(i)
    comp = F.lit(False) if component is None else component
    due = lambda c, m: F.pmod(c, F.lit(m)) == 0
    skip = {"naturalistic": due(n, 4), "casual": due(n + 1, 5), "formal": due(n + 2, 4)}
    own = F.element_at(F.array(*map(F.lit, styles)), (F.floor(seeded_uniform(seed, n) * len(styles)) + 1).cast("int"))
    plain = [F.when(~skip.get(s, F.lit(False)), F.lit(s)) for s in styles]
    plain += [F.lit("multi-hop"), F.when(due(n, 2), F.lit("multi-hop-unanswerable"))]
    parts = [F.when(due(n, 3), F.lit("multi-hop")).otherwise(own), F.when(due(n + 1, 6), F.lit("multi-hop-unanswerable"))]
    chosen = F.array_compact(F.when(comp, F.array(*parts)).otherwise(F.array(*plain)))
    out = rows.withColumn("style", F.explode(chosen))
    return out.withColumn("iteration", F.explode(F.sequence(F.lit(0), F.lit(iterations - 1))))


def styled_key(key: Column, style: Column, iteration: Column) -> Column:
    return F.concat(key, F.lit("_"), F.regexp_replace(F.lower(style), r"[^a-z0-9]+", "-"), F.lit("_"), iteration)


def reuse_style(rows: DataFrame, cached: DataFrame, key: str, styles: tuple[str, ...] = STYLES) -> DataFrame:
    """``rows`` with ``style``: the first style, in their order, whose question a run has already stored (key, style); null without one."""
    order = F.array_position(F.array(*map(F.lit, styles)), F.col("style"))
    first = cached.where(F.col("style").isin(*styles)).groupBy(key).agg(F.min_by("style", order).alias("style"))
    return rows.join(first, key, "left")


def assembled(golden: Column, distractors: Column, key: Column, probability: float, seed: str) -> dict[str, Column]:
    """docs, golden_present, golden_index: golden shuffled among distractors, included with a probability.

    Golden is forced where there is no distractor; the index is -1 where golden is left out.
    """
    present = (seeded_uniform(seed + "-golden", key) < probability) | (F.size(distractors) == 0)
    pool = F.when(present, F.concat(F.array(golden), distractors)).otherwise(distractors)
    order = F.transform(pool, lambda d: F.struct(F.sha2(F.concat_ws("|", F.lit(seed), key.cast("string"), d.cast("string")), 256).alias("h"), d.alias("d")))
    docs = F.transform(F.array_sort(order), lambda x: x["d"])
    return {"docs": docs, "golden_present": present, "golden_index": F.when(present, F.array_position(docs, golden) - 1).otherwise(F.lit(-1)).cast("int")}


def context(docs: Column) -> Column:
    """Documents, each in its own element, as one string."""
    return F.array_join(F.transform(docs, lambda d: F.concat(F.lit("<DOCUMENT>"), d, F.lit("</DOCUMENT>\n"))), "")


def _meta(fields: list[tuple[str, Column]]) -> Column:
    lines = [F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{k}: "), c)) for k, c in fields]
    return F.concat(F.lit("<doc_metadata>\n"), F.concat_ws("\n", *lines), F.lit("\n</doc_metadata>"))


def format_doc_train(kind: Column, body: Column, question: Column, answer: Column, topic: Column, professor: Column, course: Column, file: Column, url: Column, html: Column) -> Column:
    """A training document: body, then its metadata. Components omit the file; other than HTML lists URLs."""
    text = F.when(kind == "faq", F.concat(F.lit("Q: "), question, F.lit("\nA: "), answer)).otherwise(body)
    shown = F.when(kind == "component", F.lit(None)).otherwise(file)
    own = F.when(html, url)
    many = F.when(~html, url)
    return F.concat(text, F.lit("\n"), _meta([("Topic", topic), ("Professor", professor), ("Course", course), ("File", shown), ("URL", own), ("URLs", many)]))


def format_doc_serve(kind: Column, body: Column, question: Column, answer: Column, topic: Column, course: Column, file: Column, url: Column) -> Column:
    """A document for serving: metadata first, then the body without links, quoted."""
    text = F.when(kind == "faq", F.concat(question, F.lit(" "), answer)).otherwise(strip_links(body))
    meta = _meta([("File", file), ("Topic", topic), ("Course", F.when(kind == "faq", course)), ("URL", url)])
    return F.concat(meta, F.lit('\n"'), text, F.lit('"'))


def embed_text(body: Column, *fields: Column) -> Column:
    """What is embedded: the quoted clean text and its fields, nulls skipped."""
    return F.concat_ws(" ", F.concat(F.lit('"'), strip_links(body), F.lit('"')), *fields)


def to_messages(question: Column, answer: Column) -> Column:
    say = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(say("user", question), say("assistant", answer))


def chat_records(rows: DataFrame) -> DataFrame:
    """messages, url, golden_index, qa_pair_hash of rows with a question and an answer."""
    good = rows.where((F.coalesce("question", F.lit("")) != "") & (F.coalesce("answer", F.lit("")) != ""))
    return good.select(
        to_messages(F.col("question"), F.col("answer")).alias("messages"),
        F.coalesce("file_url", "url").alias("url"),
        F.coalesce("golden_index", F.lit(-1)).alias("golden_index"),
        "qa_pair_hash",
    )


def train_text(messages: Column, system: str) -> Column:
    """Turn-marked text for training; the system text goes before the first user turn."""
    def turn(m: Column, i: Column) -> Column:
        who = F.when(m["role"] == "assistant", "model").otherwise(m["role"])
        lead = F.when(i == 0, F.lit(system + "\n\n")).otherwise("")
        return F.concat(F.lit("<start_of_turn>"), who, F.lit("\n"), lead, m["content"], F.lit("<end_of_turn>\n"))

    return F.array_join(F.transform(messages, turn), "")


def stratified_split(rows: DataFrame, origin: str, key: str, ratio: float, seed: str) -> DataFrame:
    """``rows`` with split: of each origin's n rows, int(n * ratio) and, with the fraction's chance, one more are val.

    At most n - 1 go to val, so an origin of one row is all train. Rows are ranked by a seeded hash.
    """
    u = seeded_uniform(seed, F.col(key))
    out = row_numbers(rows, origin, "_r", [u, key], spread=u, total="_n")
    exact = F.col("_n") * F.lit(float(ratio))
    base = F.floor(exact)
    more = F.when(seeded_uniform(seed + "-frac", F.col(origin)) < exact - base, 1).otherwise(0)
    val = F.greatest(F.lit(0), F.least(base + more, F.col("_n") - 1))
    return out.withColumn("split", F.when(F.col("_r") < F.col("_n") - val, "train").otherwise("val")).drop("_n", "_r")


def pair_key(path: Column, question: Column, prefix: str = "default_") -> Column:
    return F.concat(F.lit(prefix), short_hash(F.concat(path, question)))


def origins(keys: Column, derived: bool = False) -> Column:
    return origin_key(keys, 3 if derived else 2)
