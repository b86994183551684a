"""Queries over whole tables, against brute force."""

from hashlib import sha256

from siltstone.plans import catalog


def test_content_hash_of_all_documents(spark, tmp_path):
    texts = [None, "", "a", "é" * 2048, "é" * 2048 + "b", "ab" * 3000, "x" * 8192, "y" * 4096 + "ü" * 2500, "head" + "z" * 20000 + "tail"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["content_hash"] for r in catalog.queries()["content_hash"](spark, str(tmp_path)).collect()}
    want = {}
    for k, t in enumerate(texts):
        b = t.encode() if t is not None else None
        want[k] = None if b is None else sha256(b[:4096] + (b[-4096:] if len(b) > 4096 else b"")).hexdigest()
    assert got == want


def window(t):
    if not t:
        return t
    first, last = t.split("\n")[0][-200:], t.split("\n")[-1][-200:]
    if not first or not last:
        return t
    a = t.find(first)
    b = t.find(last, a + len(first))
    return t[max(0, a - 4000) : (a + 1 if b < 0 else b) + len(last) + 4000]


def test_context_window_of_all_documents(spark, tmp_path):
    middle = "word " * 3000
    texts = [None, "", "one line", f"a\n{middle}\n", f"\n{middle}\nend", f"begin end\n{middle}\nend", "x" * 9000 + "first\n" + middle + "\nlast", "é" * 20000, f"same\n{middle}\nsame", f"ab\n{middle}\nz\n{middle}\nz"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["around"] for r in catalog.queries()["context_window"](spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(map(window, texts)))
