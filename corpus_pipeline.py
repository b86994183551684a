"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return
the columns of ``documents``. ``run`` writes each stage's result in the shared folder and reads it again.

Defined results: the unit is the row, known by its doc_id and its text, so rows that share a doc_id are judged each by
its own text. Null and empty texts are scored by the classifier like others, are equal to each other as exact copies, link
with nothing, hold no passage, and pack to their end id. A null doc_id goes where an equal text has a doc_id, is no near copy
of anything, and goes where it holds a passage. Rows that repeat the doc_id and text that stays all stay. Empty tables give
no rows. Further columns are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import decontaminate, exact_dedup, near_dedup, packing, quality
from siltstone.llm.store import discard, materialize, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_rejected(docs, table(spark, sf_dir, "labels"))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs).select(*docs.columns)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs, width=5, percent=80).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_exact),
    ("MinHash near-dedup", drop_near),
    ("benchmark decontamination", drop_leaks),
    ("best-fit packing", pack),
]

#: Neither a trained classifier nor packing can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
