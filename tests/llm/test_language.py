"""Code lengths against a plain PPM over dictionaries, many languages, all bytes, ties."""

import random
from collections import defaultdict
from math import log2

import numpy as np

from siltstone.llm import language


class Plain:
    """Prediction by partial matching, method C with exclusion, one symbol at a time."""

    def __init__(self, texts):
        self.counts = defaultdict(lambda: defaultdict(int))
        for t in texts:
            for before, c in self.coded(t):
                for k in range(language.ORDER + 1):
                    self.counts[before[len(before) - k :]][c] += 1

    @staticmethod
    def coded(t):
        s = b" " * language.ORDER + language.plain(np.frombuffer(t, np.uint8)).tobytes()
        for i in range(language.ORDER, len(s)):
            if s[i] != 32 or s[i - 1] != 32:
                yield s[i - language.ORDER : i], s[i]

    def p(self, context, c):
        if context is None:
            return 1 / language.ALPHABET
        shorter = context[1:] if context else None
        seen = self.counts.get(context)
        if not seen:
            return self.p(shorter, c)
        n, d = sum(seen.values()), len(seen)
        left = 1 - sum(self.p(shorter, x) for x in seen)
        escape = d / (n + d) if left > 1e-9 else 0
        return seen[c] / n * (1 - escape) if c in seen else max(escape, 1e-12) / max(left, 1e-9) * self.p(shorter, c)

    def bits(self, t):
        return -sum(log2(self.p(b, c)) for b, c in self.coded(t))


def some_text(g, letters, n):
    return "".join(g.choice(letters) for _ in range(n)).encode()


def test_code_lengths_equal_a_plain_ppm(monkeypatch):
    monkeypatch.setattr(language, "TOGETHER", 2)
    g = random.Random(1)
    kinds = {"a": "abc de", "b": "aXé. è", "c": "日本 語ab"}
    texts = {k: [some_text(g, v, g.randint(0, 60)) for _ in range(6)] for k, v in kinds.items()}
    model = language.fit(texts)
    asked = [some_text(g, "abcdéè日z ,", g.randint(0, 40)) for _ in range(30)] + [b"", b"  ", texts["a"][0]]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in asked])])
    got = model.lengths(np.frombuffer(b"".join(asked), np.uint8), offsets)
    assert model.langs == ["a", "b", "c"] and len(model.blocks) == 2
    for j, lang in enumerate(model.langs):
        slow = Plain(texts[lang])
        assert np.allclose(got[:, j], [slow.bits(x) for x in asked], rtol=1e-4, atol=1e-3)


def test_seventy_languages_and_all_bytes():
    g = random.Random(2)
    alphabets = {f"l{k:02d}": "".join(chr(0x4E00 + 23 * k + i) for i in range(20)) + " " for k in range(70)}
    texts = {k: [some_text(g, v, 300)] for k, v in alphabets.items()}
    texts["raw"] = [bytes(range(256)) * 4]
    model = language.fit(texts)
    asked = [some_text(g, v, 60) for v in alphabets.values()] + [bytes(range(128, 256)) * 3]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in asked])])
    lang, score = model.predict(np.frombuffer(b"".join(asked), np.uint8), offsets)
    assert lang[:70] == list(alphabets) and (score[:70] > 0.99).all()


def test_ties_go_to_the_first():
    model = language.fit({"b": [b"some text"], "a": [b"some text"], "none": [b" 12 "]})
    raw = np.frombuffer(b"text", np.uint8)
    assert model.predict(raw, np.array([0, 4]))[0] == ["a"] and model.langs[:2] == ["a", "b"]


def test_a_doc_id_with_two_languages(spark):
    rows = [(1, "alpha beta gamma " * 5, "x"), (1, "delta epsilon " * 5, "y"), (5, None, "x"), (5, "alpha beta", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["lang_pred"] for r in language.identify(docs).collect()}
    assert got == {"x", "y", "und"}


def test_language_of_long_documents_only(spark):
    """Texts over the bound are learnt from in part, so their language can be predicted."""
    words = {"aa": "alpha beta gamma delta epsilon zeta", "bb": "raz dwa trzy cztery piec szesc"}
    rows = [(i, f"{words['aa']} " * (3 if i < 20 else 1), "aa") for i in range(40)] + [(100 + i, f"{words['bb']} " * 1500, "bb") for i in range(12)] + [(999, "trzy cztery dwa raz", None)]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[999] == "bb" and all(got[100 + i] == "bb" for i in range(12)) and all(got[i] == "aa" for i in range(40))
