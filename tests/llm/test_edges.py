"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import zlib
from hashlib import sha256

import pytest

from siltstone.llm import decontaminate, exact_dedup, html_text, language, near_dedup, packing, pii, quality, secrets, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, value string, kept string, score string, doc string, row string"
LONG = "word and another word in a long text " * 6000
ROWS = [
    (1, "a plain text with some words in it for the test", "en", "s1"),
    (2, "a plain text with some words in it for the test", None, None),
    (3, None, "en", "s1"),
    (4, "", "de", "s2"),
    (5, " \n\t ", None, "s2"),
    (6, LONG, "en", "s3"),
    (None, "a plain text with some words in it for the test", "en", "s1"),
    (None, None, None, None),
    (7, "12345 !!", "fr", "s4"),
    (7, "12345 !!", "fr", "s4"),
    (8, "Ünïcode 日本語 \U0001f600 text", "de", "s5"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 0, "x", "x", "x", "x", "x") for r in ROWS], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (4, None, None), (4, 1, 1), (4, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(autouse=True)
def few_steps(monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 20)
    monkeypatch.setattr(pii, "STEPS", 10)
    monkeypatch.setattr(html_text, "STEPS", 10)
    monkeypatch.setattr(html_text, "MADE", 20)
    monkeypatch.setattr(pii, "WINDOWS", 50)


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_classifiers(docs, none, labels, score):
    got = score(docs, labels).collect()
    assert len(got) == len(ROWS)
    mod, rem, cut = (4, 2, 0.7) if score is quality.score_quality else (5, 0, 0.5)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % mod == rem)
    assert score(none, labels).count() == 0
    alone = score(docs, labels.limit(0)).collect()
    assert len({r["score"] for r in alone}) == 1


def test_stage_of_quality_keeps_columns(docs, labels):
    got = quality.drop_rejected(docs, labels)
    assert got.columns == docs.columns
    got.count()


def test_exact_dedup(docs, none):
    got = exact_dedup.exact_dedup(docs).collect()
    by_text = {}
    import re

    for d, t, *_ in ROWS:
        by_text.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(d)
    want = []
    for t, ids in by_text.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(d, keep, len(ids), d == keep, sha256(t.encode()).hexdigest()) for d in ids]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert exact_dedup.exact_dedup(none).count() == 0


def test_exact_dedup_split_does_not_matter(docs):
    few, many = (sorted(map(repr, exact_dedup.exact_dedup(docs, n).collect())) for n in (1, 1000))
    assert few == many


def test_near_dedup(docs, none):
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in near_dedup.near_components(docs, 4).collect()}
    assert got[1, 8] == (1, True) and got[2, 8] == (1, False)
    assert got[3, 0] == (3, True) and got[4, 0] == (4, True) and got[5, 0] == (5, True)
    assert got[None, 8] == (None, True) and got[None, 0] == (None, True)
    assert got[7, 1] == (7, True)
    assert near_dedup.near_components(none, 4).count() == 0


def test_packing(docs, none):
    got = packing.pack_documents(docs, packing.default_tokenizer(), 64).collect()
    check_packing(got, {}, 64)
    assert {r["doc_id"] for r in got} == {1, 2, 3, 4, 5, 6, 7, 8, None}
    assert sum(r["length"] for r in got if r["doc_id"] == 4) == 1
    assert packing.pack_documents(none, packing.default_tokenizer()).count() == 0


def check_packing(rows, sizes, length):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length


def test_secrets(docs, none):
    got = secrets.find_secrets(docs).collect()
    assert len(got) == len(ROWS)
    assert all(r["base_sha256"] == sha256(b"").hexdigest() and r["spans"] == "" for r in got)
    assert secrets.find_secrets(none).count() == 0


def test_decontaminate(spark, docs, none):
    items = spark.createDataFrame([(1, "a plain text with some words in it for the test"), (2, None), (3, ""), (4, "a plain"), (None, "12345")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(1, 1), (2, 1), (None, 1), (7, None)}
    assert decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns[0] == "doc_id" and set(left.columns) == set(docs.columns)


def test_html(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (3, "u", "<article><p>hello &amp; you</p></article>"), (3, "u", "<" * 500), (4, "u", '<a href="' * 300)]
    pages = spark.createDataFrame([(*r, "x", "x") for r in rows], schema)
    got = html_text.extract(pages).collect()
    assert len(got) == len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] in (1, 2)] == ["", ""]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_pii(docs, none):
    got = pii.find_personal_data(docs).collect()
    assert len(got) == len(ROWS)
    assert all(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] == 0 for r in got)
    assert pii.find_personal_data(none).count() == 0


def test_language(docs, none):
    got = {(r["doc_id"], r["lang_pred"]) for r in language.identify(docs).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (7, "und"), (None, "und")} <= got
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in language.identify(docs.withColumn("lang", docs.lang.substr(9, 1)).na.replace("", None, ["lang"])).collect())
    assert language.identify(none).count() == 0
