"""Token counts of the compiled transducer against the library, and its state maps in blocks of every size."""

import os
import random

import pyarrow as pa
import pytest

from siltstone.llm import counting

tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATH = tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def known():
    return counting.Tally(PATH)


def texts(lib, seed, n):
    r = random.Random(seed)
    voc = [lib.id_to_piece(i).replace("▁", " ") for i in range(259, lib.get_piece_size())]
    parts = ["the", "re", " ", "in", "g", "a", "  ", "aa", "tion", "s", "er", "日", "😀", "\n"]
    for _ in range(n):
        yield "".join(r.choice(voc) for _ in range(r.randrange(1, 12)))
        yield "".join(r.choice("abcdeinrst  \n.,19éß") for _ in range(r.randrange(1, 60)))
        yield "".join(r.choice(parts) for _ in range(r.randrange(1, 30)))
        yield "".join(chr(r.choice([r.randrange(32, 127), r.randrange(160, 900), r.randrange(0x3000, 0x9FFF)])) for _ in range(r.randrange(1, 40)))


def test_random_texts(lib, known):
    rows = list(texts(lib, 5, 1500))
    assert known.of(pa.array(rows)).tolist() == [len(x) for x in lib.encode(rows)]


def test_odd_texts(lib, known):
    rows = ["", " ", "  ", "▁", "▁▁x", "\n", "a\x00b", "<s></s><0x41>", " " * 7000, "a" * 20000, "ab" * 9000, "日本語" * 4000, "é́" * 50, "x" * 4096 + " y", "long words " * 30000]
    assert known.of(pa.array([*rows, None])).tolist() == [*(len(x) for x in lib.encode(rows)), 0]


@pytest.mark.parametrize(("block", "warm"), [(1, 0), (3, 1), (7, 2), (64, 32)])
def test_blocks(lib, known, block, warm):
    for t in ["thequickbrownfox" * 40, "a" * 301, " " * 77, "日本語" * 30 + "theinging" * 30]:
        assert known.machine.scan(" " + t, block, warm) == len(lib.encode(t))


def test_forgotten(lib, monkeypatch):
    """Small memories give the same counts."""
    monkeypatch.setattr(counting, "TRANSITIONS", 50)
    monkeypatch.setattr(counting, "KEEP", 20)
    rows = list(texts(lib, 6, 60))
    fresh = counting.Tally(PATH)
    got = [int(n) for i in range(0, len(rows), 16) for n in fresh.of(pa.array(rows[i : i + 16]))]
    assert got == [len(x) for x in lib.encode(rows)]


def test_equal_hashes(lib, monkeypatch):
    """Chunks whose hashes clash are told apart by their bytes."""
    real = counting.hash_runs
    monkeypatch.setattr(counting, "hash_runs", lambda *a: real(*a) % counting.U(5))
    rows = list(texts(lib, 7, 40))
    assert counting.Tally(PATH).of(pa.array(rows)).tolist() == [len(x) for x in lib.encode(rows)]


def test_uncuttable_vocabulary(spark):
    """A vocabulary with pieces across spaces has no cuts; its texts run in blocks."""
    scores = {p: -float(i) for i, p in enumerate(["ab", "b a", " a", "b ", "ab ", "a", "b", " "])}
    machine = counting.Transducer(scores)
    assert not machine.resets
    r = random.Random(3)
    for _ in range(300):
        t = "".join(r.choice("ab ") for _ in range(r.randrange(1, 40)))
        assert machine.run(t)[1] == machine.scan(t, 5, 2) == len(machine.pieces.merged(t))


def test_rows(spark, lib):
    rows = [(1, "one", "x", 1), (1, "one", "y", 2), (None, None, None, None), (3, "", "n", 3), (4, "word " * 5000, "n", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, limit int")
    got = counting.token_counts(df, PATH).collect()
    want = [(d, len((t or "").encode()), n := len(lib.encode(t or "")), n > 4096) for d, t, *_ in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert counting.token_counts(df.limit(0), PATH).collect() == []


def test_query(spark, lib):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables are not here")
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in counting.op12_token_counts(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert got == {r["doc_id"]: (len(r["text"].encode()), len(lib.encode(r["text"]))) for r in docs}
