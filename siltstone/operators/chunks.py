"""Splitting texts and numbering their parts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .rank import row_numbers

MAX_CHARS = 40000
MARKS = (".\n", "\n", ". ")


def split_text(text: str, limit: int = MAX_CHARS) -> list[str]:
    """Parts of at most ``limit`` characters that concatenate to the text.

    A part that is too long is divided after the last full stop with line end, else line end, else full stop, before
    its middle, else in the middle. Works through an explicit list, so texts of any length are safe.
    """
    out, todo = [], [text]
    while todo:
        t = todo.pop()
        if len(t) <= limit:
            out.append(t)
            continue
        half = max(1, len(t) // 2)
        cut = next((k + len(m) for m in MARKS if (k := t.rfind(m, 0, half)) >= 0 and k + len(m) < len(t)), half)
        todo += [t[cut:], t[:cut]]
    return out


def split_long(df: DataFrame, key: str, text: str, limit: int = MAX_CHARS) -> DataFrame:
    """key, part_no, part of every row."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, i, p) for k, t in zip(b[key], b[text]) if t is not None for i, p in enumerate(split_text(t, limit))]
            yield pd.DataFrame(rows, columns=[key, "part_no", "part"])

    return df.select(key, text).where(F.col(text).isNotNull()).mapInPandas(run, f"{key} {kind}, part_no int, part string")


def ordinals(df: DataFrame, group: str, *order: str) -> Column:
    """Dense numbers from 0 within a group."""
    return F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1


def batches(df: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """group, batch, keys (in order): consecutive batches of ``size`` rows; ``order`` is numeric."""
    rows = row_numbers(df.select(group, order), group, "batch", [order]).withColumn("batch", F.floor(F.col("batch") / size))
    return rows.groupBy(group, "batch").agg(F.sort_array(F.collect_list(order)).alias("keys"))


def valid_chunks(items: Column) -> Column:
    """Items that have a chunk and a topic."""
    return F.filter(items, lambda x: (F.coalesce(x["chunk"], F.lit("")) != "") & (F.coalesce(x["topic"], F.lit("")) != ""))


def chunk_rows(parts: DataFrame, file: str, part_no: str, items: str) -> DataFrame:
    """file, ordinal, chunk_hash, chunk, topic; a file with a part that has no valid item yields nothing.

    One shuffle by file, of parts: each is numbered on from the valid items of the parts before, and then unfolded.
    """
    here = Window.partitionBy(file)
    n = F.size("_valid")
    rows = parts.withColumn("_valid", valid_chunks(F.col(items)))
    rows = rows.withColumns({"_least": F.min(n).over(here), "_ahead": F.coalesce(F.sum(n).over(here.orderBy(part_no).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))}).where("_least > 0")
    rows = rows.select(file, "_ahead", F.posexplode("_valid").alias("pos", "item")).withColumn("ordinal", (F.col("_ahead") + F.col("pos")).cast("int"))
    return rows.select(file, "ordinal", F.concat(F.lit("chunk_"), file, F.lit("_"), "ordinal").alias("chunk_hash"), "item.chunk", "item.topic")


class SplitText:
    """A table function: the parts of ``split_text`` with their numbers and places, told while it walks the text's offsets."""

    def eval(self, text: str, limit: int):
        todo, no = [(0, len(text))] if text is not None else [], 0
        while todo:
            a, b = todo.pop()
            if b - a <= limit:
                yield no, a, text[a:b]
                no += 1
                continue
            half = a + max(1, (b - a) // 2)
            cut = next((k + len(m) for m in MARKS if (k := text.rfind(m, a, half)) >= 0 and k + len(m) < b), half)
            todo += [(cut, b), (a, cut)]


def register_split(spark: SparkSession, name: str = "split_text") -> str:
    """Make the table function known to SQL: ``FROM documents, LATERAL split_text(text, 40000)`` gives part_no, start, part; Arrow carries its rows."""
    spark.udtf.register(name, F.udtf(SplitText, returnType="part_no int, start int, part string", useArrow=True))
    return name
