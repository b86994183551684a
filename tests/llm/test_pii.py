"""Personal data: patterns against plain regular expressions, the network on held-out variants, windows against a naive decoding."""

import os
import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from siltstone.llm import nn, pii

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
PLAIN = "The long road along the river was quiet and the people of the house went home late in the evening. "
SPELLED = ["jane at example dot com", "mary [at] harbor [dot] org", "john(at)garden(dot)net"]


#: Prose that holds no personal data, and spellings that no template of the training writes.
PROSE = [
    "We should meet at noon dot the end of it.", "Take a look at dot com bubble stories.", "We met at the dot of noon.", "He was at 5 dot 3 points.", "LOOK AT THE DOT COM BOOM", "Polka dot at home, dot by dot.",
    "They arrived at dawn. Come in.", "She laughed at him. De facto it was over.", "Version 10.4.2 came at 12.30 on 2024-03-01.", "See pp. 120-135 and ISBN 978-0-306-40615-7.", "A dot at the end is a full stop.",
]
OTHER = [
    ("jane.doe AT example DOT com", "email"), ("mark.lee at harbour-town dot co dot uk", "email"), ("PETER AT GARDEN DOT ORG", "email"), ("anna_b [ at ] river [ dot ] net", "email"), ("info{at}museum{dot}de", "email"), ("sam (AT) school (DOT) edu", "email"),
    ("192 dot 168 dot 0 dot 1", "ip"), ("10 DOT 20 DOT 30 DOT 40", "ip"), ("172[.]16[.]254[.]3", "ip"), ("0176/1234567", "phone"), ("0171 2345678", "phone"), ("(415) 555-0132", "phone"), ("0049 171 234 5678", "phone"), ("4111.1111.1111.1111", "card"), ("4111  1111  1111  1111", "card"),
]


def by_regex(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    tests = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and sum(map(int, "".join(str(int(c) * (1 + k % 2)) for k, c in enumerate(digits(s)[::-1])))) % 10 == 0),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    return {kind: [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(p, t) if ok(m[0])] for kind, (p, ok) in tests.items()}


@pytest.fixture
def few_steps(monkeypatch):
    monkeypatch.setattr(pii, "STEPS", 5)
    monkeypatch.setattr(pii, "WINDOWS", 40)


def test_base_of_every_kind(spark, few_steps):
    g = random.Random(14)
    bits = ["4111 1111 1111 1111", "4111111111111111", "49927398716", "+1 415 555 0100", "+44(20)7946-0958", "1", "7", " ", "-", ".", "(", ")", "+", "a@b.co", "x", "é😀", "10.0.0.255", "256.1.1.1", "0378282246310005", "\n"]
    rows = [(i, "".join(g.choice(bits) for _ in range(g.randint(0, 25)))) for i in range(400)]
    rows += [rows[3], rows[3], (900, "".join(g.choice(bits) for _ in range(6000))), (None, "4111 1111 1111 1111 a@b.co"), (901, None)]
    got = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    texts, seen = dict(rows), Counter()
    for r in got:
        want = by_regex(texts[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in pii.KINDS] == [len(want[k]) for k in pii.KINDS]
        base = [x for k in pii.KINDS for x in want[k]]
        assert r["base_sha256"] == sha256(",".join(base).encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(base) <= set(spans) and len(spans) == len(base) + r["n_added"]
        seen.update(k for k in pii.KINDS for _ in want[k])
    assert min(seen[k] for k in pii.KINDS) > 20


def test_windows_agree_with_a_naive_decoding():
    g = np.random.default_rng(4)
    words = [*"at dot cat data . @ [at] (dot) 7 12.5.5.5 a".split(), "4111 1111 1111 1111", "house", "along", "x" * 70]
    texts = ["", *(" ".join(g.choice(words, g.integers(1, 900))) for _ in range(40))]
    k = len(pii.KINDS) + 1
    p = nn.lstm_params(g, pii.DIM, pii.HIDDEN, "f") | nn.lstm_params(g, pii.DIM, pii.HIDDEN, "r")
    p |= {"e": g.standard_normal((pii.N_SYMBOLS, pii.DIM)).astype(np.float32), "o": g.standard_normal((2 * pii.HIDDEN, k)).astype(np.float32)}
    model = pii.Model(p | {"c": np.zeros(k, np.float32), "t": (2 * np.eye(k)).astype(np.float32)})
    for t, got in zip(texts, model.tags(texts)):
        starts = pii.windows(len(t)) if t else []
        paths = {}
        for s in starts:
            ids = pii.symbols(t[s : s + pii.SIZE]).astype(np.int64)[:, None]
            mask = np.ones((len(ids), 1), np.float32)
            paths[s] = nn.viterbi(model.emissions(ids, mask)[3], mask, model.p["t"])[:, 0]
        want = []
        for c in range(len(t)):
            s = starts[min(max(0, (c - pii.EDGE) // pii.STRIDE), len(starts) - 1)]
            want.append(paths[s][c - s])
        assert got.tolist() == want


def test_inference_equals_training_forms():
    g = np.random.default_rng(3)
    p = nn.lstm_params(g, 5, 4, "f") | nn.lstm_params(g, 5, 4, "r")
    e = g.standard_normal((7, 5)).astype(np.float32)
    ids, mask = g.integers(0, 7, (12, 9)), np.ones((12, 9), np.float32)
    for j in range(9):
        mask[12 - j :, j] = 0
    h, _ = nn.bilstm(e[ids], mask, p, False)
    live = mask[:, :, None]
    assert np.allclose(h[:, :, :4] * live, nn.states(ids, mask, e @ p["fx"] + p["fb"], p["fh"]) * live, atol=1e-5)
    assert np.allclose(h[:, :, 4:] * live, nn.states(ids[::-1], mask[::-1], e @ p["rx"] + p["rb"], p["rh"])[::-1] * live, atol=1e-5)
    x, trans = g.standard_normal((12, 9, 5)).astype(np.float32), g.standard_normal((5, 5)).astype(np.float32)
    assert (nn.viterbi(x, mask, trans) == nn.best_paths(x, mask, trans)).all()


def test_scores_equal_training_forms():
    """Rows of any length, of which only those that are not over are worked on; rows without a possible tag are told exactly."""
    g = np.random.default_rng(8)
    k = len(pii.KINDS) + 1
    p = nn.lstm_params(g, pii.DIM, pii.HIDDEN, "f") | nn.lstm_params(g, pii.DIM, pii.HIDDEN, "r")
    p |= {"e": g.standard_normal((9, pii.DIM)).astype(np.float32), "o": g.standard_normal((2 * pii.HIDDEN, k)).astype(np.float32)}
    p |= {"c": (2 * (np.arange(k) == 0)).astype(np.float32), "t": (g.standard_normal((k, k)) + 2 * np.eye(k)).astype(np.float32)}
    lengths = np.sort(g.integers(1, 40, 150))
    mask = (np.arange(40)[:, None] < lengths).astype(np.float32)
    ids = g.integers(0, 9, (40, 150))
    want = pii.Model(p).emissions(ids, mask)[3]
    got = nn.emissions(ids, lengths, p)
    assert np.allclose(want * mask[..., None], got.transpose(0, 2, 1) * mask[..., None], atol=1e-4)
    for shift in (0, 2, 4, 6):
        e = want + shift * (np.arange(k) == 0).astype(np.float32)
        has = nn.viterbi(e, mask, p["t"]).any(0)
        may = nn.tagged(np.ascontiguousarray(e.transpose(0, 2, 1)), lengths, p["t"])
        assert not (has & ~may).any()
    assert not may.all()


def test_padding_is_not_worked_on(monkeypatch):
    """Steps of short rows beside long ones cost no products."""
    done, product = [], np.matmul
    monkeypatch.setattr(nn.np, "matmul", lambda a, b, **more: done.append(b.shape[1]) or product(a, b, **more))
    model = pii.Model(pii.fit(["a 1 b"], steps=1).p)
    done.clear()
    model.tags(["x" * 40] * 300 + ["y" * 900])
    assert sum(done) < 2 * (300 * 40 + 900 + 1000 * nn.AT_ONCE)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_held_out_variants(spark):
    """Variants of another seed in documents that training never saw; exact spans count."""
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("text IS NOT NULL").orderBy("doc_id").collect()]
    seen, apart = texts[::2], [t for t in texts[1::2] if len(t) > 300 and not pii.base_spans(t)]
    model = pii.fit([t for t in seen if pii.TRIGGER.search(t)] + [t for t in seen if not pii.TRIGGER.search(t)][:50])
    g = np.random.default_rng(99)
    rows = []
    for k in range(400):
        t = apart[k % len(apart)]
        s, kind = pii.variants(g)
        gaps = [m.end() for m in re.finditer(" ", t)]
        a = gaps[int(g.integers(len(gaps)))]
        rows.append((t[:a] + s + " " + t[a:], kind, a, a + len(s)))
    rows += [(PLAIN * 3 + f"Please write to {s} when you can. " + PLAIN * 3, 1, len(PLAIN) * 3 + 16, len(PLAIN) * 3 + 16 + len(s)) for s in SPELLED]
    hit = added = found = wanted = 0
    for (t, kind, a, b), tags in zip(rows, model.tags([r[0] for r in rows])):
        base = pii.base_spans(t)
        more = pii.added_spans(t, tags, base)
        touched = any(x < b and a < y for _, x, y in base)
        want = {(pii.KINDS[kind - 1], a, b)} if kind else set()
        found += len(more)
        added += len(want & set(more))
        if kind and not touched:
            wanted += 1
            hit += bool(want & set(more))
    print("recall", hit, wanted, "precision", added, found)
    assert wanted > 150 and hit >= 0.9 * wanted
    assert added >= 0.9 * found
    assert not pii.added_spans(PLAIN * 5, model.tags([PLAIN * 5])[0], [])
    prose = [PLAIN + x + " " + PLAIN for x in PROSE]
    assert [pii.added_spans(t, tags, pii.base_spans(t)) for t, tags in zip(prose, model.tags(prose))] == [[]] * len(PROSE)
    apart = [PLAIN * 2 + f"You can reach us under {x} at any time. " + PLAIN for x, _ in OTHER]
    got = [{(k, t[a:b]) for k, a, b in pii.added_spans(t, tags, pii.base_spans(t))} for t, tags in zip(apart, model.tags(apart))]
    print([x for x, g in zip(OTHER, got) if g != {x[::-1]}])
    assert sum(g == {x[::-1]} for x, g in zip(OTHER, got)) >= 0.8 * len(OTHER)
    assert sum(len(g - {x[::-1]}) for x, g in zip(OTHER, got)) <= 1


def test_long_text_full_of_spans():
    """Spans are compared with what they touch only."""
    t = "0176/1234567 " * 20000
    tags = np.tile(np.array([4] * 12 + [0], np.int8), 20000)
    assert len(pii.added_spans(t, tags, pii.base_spans(t))) == 20000
    for t in ("a.b." * 5000, "a dot " * 5000, "at a dot b " * 3000, "x" * 20000, "- . " * 5000):
        pii.added_spans(t, np.ones(len(t), np.int8), [])
