"""Held-out accuracy of the trained operators on the driver's tables, and the pipeline against its stages."""

import os

import pytest
from pyspark.sql import functions as F

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def scored(spark, df, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return [(r["score"], r["predicted"], r[label]) for r in df.join(labels, "doc_id").where("held_out").collect()]


def test_quality(spark):
    from siltstone.llm.quality import op1_quality_nbsvm

    rows = scored(spark, op1_quality_nbsvm(spark, SF), "quality")
    assert sum(p == y for _, p, y in rows) / len(rows) >= 0.95


@pytest.mark.parametrize(("folder", "auc", "recall"), [(SF, 0.9, 0.5), ("/root/testdata/sf0.1", 0.95, 0.85)])
def test_toxicity(spark, folder, auc, recall):
    from siltstone.llm.toxicity import op7_toxicity_cnn

    if not os.path.isdir(folder):
        pytest.skip("test tables are not here")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic IS NOT NULL")
    rows = op7_toxicity_cnn(spark, folder).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = ([r for r in rows if r["toxic"] == k] for k in (1, 0))
    above = sum((a["score"] > b["score"]) + (a["score"] == b["score"]) / 2 for a in toxic for b in clean)
    caught, wrong = sum(r["predicted"] for r in toxic), sum(r["predicted"] for r in clean)
    print("held out: auc", above / len(toxic) / len(clean), "recall", caught, len(toxic), "wrong", wrong, len(clean))
    assert above >= auc * len(toxic) * len(clean) and caught >= recall * len(toxic) and wrong <= 0.03 * len(clean)


def test_language(spark):
    from siltstone.llm.language import op9_language_ppm

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = op9_language_ppm(spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) >= 0.95


def test_pipeline_is_its_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    ids = {r["doc_id"] for r in docs.collect()}
    got = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in got.select("doc_id").distinct().collect()} == ids
    norm = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)
    assert docs.select(norm).distinct().count() == docs.count()
