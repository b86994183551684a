"""Operators against brute-force versions and round trips."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from siltstone.llm import components, decontaminate, near_dedup, nn, packing, pii, quality, secrets, textkit, tokens
from siltstone.llm.components import components as parts_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets(t, w):
    x = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(x[i : i + w]) for i in range(len(x) - w + 1)} if len(x) >= w else ({tuple(x)} if x else set())


def linked(rows, w, percent):
    s = {d: sets(t, w) for d, t in rows}
    root = {d: d for d in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(s), 2):
        n = len(s[a] & s[b])
        if n and 100 * n >= percent * len(s[a] | s[b]):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {d: (len(s[d]), find(d)) for d in s}


def near_copies(seed, families, members, edits):
    """Families of near copies, some dominated by a passage that all share."""
    g = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)]
    passage = [g.choice(vocab) for _ in range(30)]
    rows = []
    for f in range(families):
        base = [g.choice(vocab) for _ in range(g.randint(5, 120))]
        for _ in range(members):
            t = list(base)
            for _ in range(g.randint(0, edits)):
                t[g.randrange(len(t))] = g.choice(vocab)
            rows.append((len(rows), " ".join(t + passage * (f % 2))))
    g.shuffle(rows)
    return rows


@pytest.mark.parametrize("shape", [(25, 6, 6), (2, 90, 9)])
def test_near_components(spark, shape, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 2000)
    rows = near_copies(1, *shape)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r[0]: (r[1], r[2]) for r in near_dedup.near_components(docs, 4).collect()}
    assert got == linked(rows, 4, 80)


def test_near_components_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BROADCAST", 0)
    rows = near_copies(2, 10, 5, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in near_dedup.near_components(docs, 5).collect()}
    assert got == linked(rows, 5, 80)


def test_components(spark):
    g = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(g.randrange(200, 260), g.randrange(200, 260)) for _ in range(40)]
    got = dict(parts_of(spark.createDataFrame(edges, "u long, v long")).collect())
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    want = {}
    for n in sorted(near):
        if n not in want:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = n
                    todo += near[x]
    assert got == want
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_shingles_match_python():
    g = random.Random(5)
    texts = ["".join(g.choice(["a", "B", "é", " ", "\n", "x" * 300, "."]) for _ in range(g.randint(0, 60))) for _ in range(200)]
    for _, _, data, offsets in textkit.chunks(pa.array(texts), 700):
        assert len(offsets) > 1
    for w in (1, 4, 5):
        total = []
        for _, _, data, offsets in textkit.chunks(pa.array(texts), 700):
            d, h = textkit.shingles(*textkit.words(data, offsets), w)
            total += np.bincount(d, minlength=len(offsets) - 1).tolist()
        assert total == [len(sets(t, w)) for t in texts]


def test_encoder_equals_library():
    enc = tokens.Encoder(packing.default_tokenizer())
    g = random.Random(6)
    bits = [" ", "  ", "\n", "\t", "'s", "'ll", "'", "a", "Zé", "9", "!", "'re", "x'dy", " ", "日本", "\r\n", "😀", "''s", "<|endoftext|>"]
    texts = ["".join(g.choice(bits) for _ in range(g.randint(0, 12))) for _ in range(3000)]
    assert [x.tolist() for x in enc.encode(texts)] == [enc.whole(t).tolist() for t in texts]


def test_packing_round_trip(spark):
    g = random.Random(7)
    rows = [(i, " ".join(g.choice(["alpha", "béta", "gamma's", "42", "..."]) for _ in range(g.choice([0, 3, 50, 700, 3000])))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = packing.default_tokenizer()
    got = packing.pack_documents(docs, path, 256, group=40).collect()
    enc = tokens.Encoder(path)
    want = {}
    for d, t in rows:
        ids = np.append(enc.whole(t), 2).astype("<u4")
        first = len(ids) % 256 or min(256, len(ids))
        cuts = [0, *range(first, len(ids) + 1, 256)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[d, k] = (a, b - a, zlib.crc32(ids[a:b].tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    check_bins(got, 256)


def check_bins(rows, length):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0] + [n for _, n in sorted(parts)])[:-1].tolist()
        assert sum(n for _, n in parts) <= length


def test_local_search_only_improves():
    g = random.Random(8)
    for _ in range(20):
        sizes = [g.randint(1, 100) for _ in range(g.randint(1, 80))]
        a, b = packing.pack(sizes, 100, 0), packing.pack(sizes, 100)
        fa, fb = np.bincount(a, weights=sizes), np.bincount(b, weights=sizes)
        assert fb.max() <= 100 and (fb > 0).sum() <= (fa > 0).sum() and (fb**2).sum() >= (fa**2).sum()


def test_local_search_empties_a_bin():
    bins = packing.Bins([6, 5, 5, 4, 4, 6], 10)
    for items in ([0], [1, 3], [2, 4], [5]):
        k = bins.open()
        bins.change(k, [], items)
    packing.improve(bins, 20)
    assert sum(f > 0 for f in bins.fill) == 3


def brute_leaks(docs, items):
    word = re.compile(r"[A-Za-z0-9\u0080-\U0010ffff]+")
    low = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in word.findall(t)]
    out = set()
    for d, t in docs:
        a = low(t)
        for i, s in items:
            b = low(s)
            w = min(13, len(b))
            if len(b) < 5:
                if b and a == b:
                    out.add((d, i))
                continue
            for x in range(len(a) - w + 1):
                if any(100 * sum(p == q for p, q in zip(a[x : x + w], b[y : y + w])) >= 80 * w for y in range(len(b) - w + 1)):
                    out.add((d, i))
                    break
    return out


def test_decontamination(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 300)
    g = random.Random(9)
    vocab = ["v%d" % i for i in range(60)]
    items = [(i, " ".join(g.choice(vocab) for _ in range(g.choice([1, 3, 6, 12, 13, 30])))) for i in range(12)]
    docs = []
    for d in range(150):
        t = [g.choice(vocab) for _ in range(g.randint(0, 60))]
        if d % 2:
            s = g.choice(items)[1].split()
            for _ in range(g.randint(0, 4)):
                s[g.randrange(len(s))] = g.choice(vocab)
            at = g.randint(0, len(t))
            t[at:at] = s[g.randint(0, 3) :] or s
        docs.append((d, g.choice([" ", ", ", "\n"]).join(t).title()))
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r[0], r[1]) for r in got.collect()} == brute_leaks(docs, items)


def test_every_spoilt_window_has_a_seed():
    for spoilt in combinations(range(13), 2):
        assert any(
            all(x + j not in spoilt for j, c in enumerate(m) if c == "1") for m in decontaminate.MASKS for x in range(13 - len(m) + 1)
        )


def spans_by_python(t):
    found = []
    rules = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), ("access", "AKIA[A-Z0-9]+", 0), ("hex", "[0-9a-f]+", 0)]
    for k, (kind, p, f) in enumerate(rules):
        for m in re.finditer(p, t, f):
            if {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}[kind](m):
                found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(found))


def test_secret_spans(spark):
    g = random.Random(10)
    bits = ["password", "Token", "api_key", "APIKEY", " = ", ":", "'", '"', "=", "abcdef12", "é日", "AKIA" + "Z9" * 8, "AKIA12", "0f" * 12, "deadbeef", " ", "\n", "secret:", "x", "ghp_" + "aB3" * 9]
    rows = [(i, "s%d" % (i % 3), "".join(g.choice(bits) for _ in range(g.randint(0, 25)))) for i in range(300)]
    from hashlib import sha256

    got = {r["doc_id"]: r for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    for d, _, t in rows:
        assert got[d]["base_sha256"] == sha256(spans_by_python(t).encode()).hexdigest(), t


def test_ownership_separates_copied_from_live(spark):
    own, copied, spread = "a17f3c9e5b2d8064" * 2, "b2c4d6e8f0a19375" * 2, "c93b5d7f1e80a264" * 2
    rows = [(0, "s0", f"password = {own}"), (1, "s0", f"token: {own}")] + [(i, f"s{i}", f"secret={copied}") for i in range(2, 8)]
    rows.append((9, "s9", "key " + "Zz9qR4tY7" * 4))
    rows += [(20 + i, "s0", f"hash {spread}") for i in range(7)]  # one owner, many repositories
    rows += [(30, None, f"hash {'d' + own[1:]}"), (31, None, f"hash {'d' + own[1:]}")]  # unknown owners are not one owner
    rows += [(40, "s1", "password = changeme99"), (41, "s1", "api_key = aaaabbbbaaaabbbb"), (42, None, "token = hT5vQ9xK2m")]
    rows += [(50, "s5", f"password = {'e' + own[1:]}")] * 9  # repeated rows are one repository
    got = {r["doc_id"]: r for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    counts = {d: (r["n_live"], r["n_copied"]) for d, r in got.items()}
    assert counts[0] == (2, 0) and counts[2] == (0, 2) and counts[20] == (0, 1) and counts[30] == (0, 1)
    assert counts[40] == (0, 1) and counts[41] == (0, 1) and counts[42] == (1, 0) and counts[50] == (2, 0)
    assert got[9]["spans"] == "token:4:40"


def test_secrets_of_a_text_with_many_spans(spark):
    text = "x\x01password=a1b2c3 " * 1500
    rows = [(1, "s", text), (1, "s", text), (2, "s", "\x01\x01 token=\x01 AKIA" + "7" * 16)]
    got = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, source string, text string")).orderBy("doc_id").collect()
    assert got[0]["base_sha256"] == got[1]["base_sha256"] == hash_of(spans_by_python(text)) and got[0]["n_assign"] == 1500
    assert got[2]["spans"] == spans_by_python(rows[2][2])


def hash_of(s):
    from hashlib import sha256

    return sha256(s.encode()).hexdigest()


def test_email_spans_equal_the_pattern():
    g = random.Random(11)
    bits = ["a", "b.c", "@", ".", "-", "_", " ", "d9", "x@y.z", "+"]
    p = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for _ in range(5000):
        t = "".join(g.choice(bits) for _ in range(g.randint(0, 20)))
        assert list(pii.emails(t)) == [m.span() for m in p.finditer(t)], t


def test_ip_spans_equal_the_pattern():
    g = random.Random(12)
    p = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        t = "".join(g.choice(["1", "25", "255", "256", ".", ".", " ", "0010"]) for _ in range(g.randint(0, 20)))
        want = [m.span() for m in p.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
        assert [(a, b) for k, a, b in pii.base_spans(t) if k == "ip"] == want, t


def test_windows_agree_over_the_whole_text():
    assert all(set(range(n)) <= {c for s in pii.windows(n) for c in range(s, s + pii.SIZE)} for n in range(1, 400))


def test_gradients():
    g = np.random.default_rng(0)
    p = {k: v.astype(float) for k, v in (nn.lstm_params(g, 3, 4, "f") | nn.lstm_params(g, 3, 4, "r")).items()}
    x, mask = g.standard_normal((5, 2, 3)), np.ones((5, 2))
    mask[3:, 1] = 0
    out, tags, trans = g.standard_normal((8, 3)), g.integers(0, 3, (5, 2)), g.standard_normal((3, 3))
    loss = lambda: nn.crf(nn.bilstm(x, mask, p)[0] @ out, tags, mask, trans)[0]
    h, kept = nn.bilstm(x, mask, p)
    _, de, dt = nn.crf(h @ out, tags, mask, trans)
    dx, grads = nn.bilstm_back(de @ out.T, kept, p)
    for array, grad in ((trans, dt), (x, dx), *((p[k], grads[k]) for k in p)):
        i = tuple(s // 2 for s in array.shape)
        old = array[i]
        array[i] = old + 1e-3
        up = loss()
        array[i] = old - 1e-3
        down = loss()
        array[i] = old
        assert abs((up - down) / 2e-3 - grad[i]) < 1e-3


def test_viterbi_is_the_best_path():
    g = np.random.default_rng(1)
    e, trans, mask = g.standard_normal((4, 3, 3)), g.standard_normal((3, 3)), np.ones((4, 3))
    got = nn.viterbi(e, mask, trans)
    from itertools import product

    for j in range(3):
        best = max(product(range(3), repeat=4), key=lambda y: sum(e[t, j, y[t]] for t in range(4)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
        assert tuple(got[:, j]) == best


def test_indicators_are_distinct_and_whole():
    t = "One two TWO two. two two two!!"
    raw = np.frombuffer(t.encode(), np.uint8)
    d, f = quality.indicators(raw, np.array([0, len(raw)]))
    assert len(set(f.tolist())) == len(f)
    twice = np.frombuffer((t * 2).encode(), np.uint8)
    d2, f2 = quality.indicators(twice, np.array([0, len(raw), 2 * len(raw)]))
    assert Counter(d2.tolist()) == {0: len(f), 1: len(f)} and f2[: len(f)].tolist() == f.tolist()


def test_encoder_survives_equal_hashes(monkeypatch):
    monkeypatch.setattr(tokens, "mix", lambda h: h % np.uint64(5))
    enc = tokens.Encoder(packing.default_tokenizer())
    texts = ["one two three", "", "a bb ccc dddd", "one one two", "x" * 400, "the end, of it"]
    assert [x.tolist() for x in enc.encode(texts)] == [enc.whole(t).tolist() for t in texts]


def gain_left(sizes, out, length):
    """Whether a move or an exchange of one for one, two for one or one for two would raise the squared fill."""
    items = defaultdict(list)
    for i, k in enumerate(out):
        items[k].append(sizes[i])
    bins = [v for v in items.values() if sum(v) < length]
    groups = lambda v: [(), *combinations(v, 1), *combinations(v, 2)]
    for a in bins:
        for b in bins:
            if a is not b and sum(a) >= sum(b):
                for give in groups(a):
                    for take in groups(b):
                        d = sum(take) - sum(give)
                        if (len(give), len(take)) in {(0, 1), (1, 1), (2, 1), (1, 2)} and 0 < d <= length - sum(a):
                            return True
    return False


def test_local_search_ends_without_a_gain():
    g = random.Random(13)
    for _ in range(60):
        sizes = [g.choice([g.randint(1, 40), g.randint(30, 70), 35]) for _ in range(g.randint(2, 60))]
        out = packing.pack(sizes, 100)
        assert len(set(out)) == -(-sum(sizes) // 100) or not gain_left(sizes, out, 100)
