"""Bounded training samples of labelled documents, and scoring of whole tables batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import chunks

LONGEST = 1 << 17


def fold(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``; -1 for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus, F.lit(-1)).cast("int")


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, per_class: int) -> DataFrame:
    """doc_id, label, text, lang of at most ``per_class`` labelled documents for either class, outside the held-out fold.

    Which ones is decided by a hash of doc_id, so the sample does not depend on the order of rows. Rows with a
    null or other label are left out; a document labelled twice counts once, and of rows that share a doc_id the one
    with the least text. Texts of more than ``LONGEST`` bytes are not learnt from. lang (null without such a column) is
    for fits that are made by language; it is no input of a score.
    """
    own = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("label IN (0, 1) AND doc_id IS NOT NULL")
    own = own.where(fold(modulus) != held).groupBy("doc_id").agg(F.max("label").alias("label"))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [own.where(F.col("label") == k).orderBy(*by_hash).limit(per_class) for k in (0, 1)]
    ids = picked[0].unionByName(picked[1])
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select("doc_id", F.struct(F.coalesce("text", F.lit("")).alias("text"), lang.alias("lang")).alias("row")).where(F.octet_length("row.text") <= LONGEST)
    return rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("row").alias("row")).select("doc_id", "label", "row.text", "row.lang")


class Example(NamedTuple):
    doc_id: object
    label: int
    lang: str | None
    feature: bytes


def featurise(picked: DataFrame, features: Callable[[np.ndarray, np.ndarray], list[np.ndarray]]) -> list[Example]:
    """The sampled documents by doc_id, each with its feature array as bytes; only features come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last, data, offsets in chunks(b.column("text")):
                rows = [np.ascontiguousarray(x).tobytes() for x in features(data, offsets)]
                part = b.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "label", "lang")), pa.array(rows, pa.binary())], ["doc_id", "label", "lang", "f"])

    kind = picked.schema["doc_id"].dataType.simpleString()
    got = picked.select("doc_id", "text", "label", "lang").mapInArrow(run, f"doc_id {kind}, label int, lang string, f binary").toArrow()
    return sorted((Example(*x) for x in zip(*(got[c].to_pylist() for c in ("doc_id", "label", "lang", "f")))), key=lambda x: x.doc_id)


def score_table(docs: DataFrame, held: Column, predict: Callable[[np.ndarray, np.ndarray], np.ndarray], threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted of every document. ``predict`` maps a batch to scores in 0 to 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last, data, offsets in chunks(b.column("text")):
                s = np.asarray(predict(data, offsets), np.float64)
                part = b.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(s), pa.array((s >= threshold).astype("int32"))],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )
