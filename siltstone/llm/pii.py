"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions that adds spans.

Kinds are email, ip, card and phone. Base spans are the patterns' leftmost non-overlapping matches in the whole
text; they always stay. The network is trained in numpy from labelled spans: windows around base spans and other
digits of a bounded sample of documents, and variants of the four kinds (spelled-out signs, other groupings, no
country code) written into plain windows, beside dates, versions, prices and hashes that are none, and plain windows
as they are. Every text is cut into overlapping windows, all of which are decoded by the Viterbi path; each character
takes its tag from the window in which it lies most central, so that windows agree over the whole text. Runs of a tag
are widened to whole words; those that pass their kind's plain test and touch no base span are added.

Positions count code points, the end is exclusive. Defined results: null text is empty; without spans the digest
is that of the empty string; each row is scanned on its own, repeated ones too; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import nn
from .store import table
from .textkit import chunks

KINDS = ("email", "ip", "card", "phone")
SIZE, STRIDE = 960, 912
EDGE = (SIZE - STRIDE) // 2
EXAMPLE = 96
DIM, HIDDEN = 10, 12
TOGETHER = 768
SAMPLE_DOCS = 600
LONGEST = 1 << 16
WINDOWS = 1500
STEPS, BATCH, RATE = 800, 64, 0.01

LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9][0-9.]*")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
ENDING = re.compile(r"\s*[A-Za-z]{2,}")
#: Frequent top-level domains, one of which ends an added address, and words that are no domain before a spelled-out dot.
TOP_LEVEL = "ai app at be biz br ca ch cn co com cz de dev dk edu es eu fi fr gov gr hu ie in info io it jp kr me mil mx net nl no nz org pl pt ro ru se tv uk us".split()
NO_DOMAIN = "a an any each her his its my no of our that the their this your".split()
#: What stands for the signs; spelled-out ones need white space or brackets around them, so each text is read in one way only.
AT, SPELLED_DOT = r"(?:\s*(?:@|[\[({]\s*at\s*[\])}])\s*|\s+at\s+)", r"(?:\s*[\[({]\s*(?:dot|\.)\s*[\])}]\s*|\s+dot\s+)"
DOT = rf"(?:\s*\.\s*|{SPELLED_DOT})"
ADDRESS = re.compile(rf"(?<![a-z0-9._%+-])[a-z0-9._%+-]+(?:{SPELLED_DOT}[a-z0-9._%+-]+)*{AT}(?!(?:dot|{'|'.join(NO_DOMAIN)})\b)[a-z0-9-]+(?:{DOT}[a-z0-9-]+)*{DOT}(?:{'|'.join(TOP_LEVEL)})(?![a-z0-9-])", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def emails(t: str) -> Iterator[tuple[int, int]]:
    pos, at = 0, t.find("@")
    while at >= 0:
        start = at
        while start > pos and t[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(t, at + 1) if start < at else None
        if m:
            yield start, m.end()
            pos = m.end()
        at = t.find("@", max(at + 1, pos))


def byte_part(s: str) -> bool:
    s = s.lstrip("0")
    return len(s) <= 3 and int(s or "0") <= 255


def base_spans(t: str) -> list[tuple[str, int, int]]:
    """Spans by kind as listed, then start."""
    out = [("email", a, b) for a, b in emails(t)]
    for run in DOTTED.finditer(t):
        if run[0].count(".") >= 3:
            out += [("ip", m.start(), m.end()) for m in IP.finditer(t, run.start(), run.end()) if all(map(byte_part, m[0].split(".")))]
    for m in CARD.finditer(t):
        if m.end() - m.start() >= 13 and 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(t) if 9 <= len(digits_of(m[0])) <= 15]
    return out


#: Symbols of the network: letters by case, digits, some signs and the letters of spelled-out ones each; the last stands for the rest.
SIGNS = " \n@.-_+()[]{}<>/:;,=\"'#%*|&$!?"
SPELLED = "adot"
N_SYMBOLS = 4 + len(SIGNS) + len(SPELLED)


def symbols(t: str) -> np.ndarray:
    points = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    return SYMBOL[np.minimum(points, 256)]


def _symbol_table() -> np.ndarray:
    out = np.full(257, N_SYMBOLS - 1, np.uint8)
    out[97:123], out[65:91], out[48:58] = 0, 1, 2
    out[192:] = 0  # letters beyond ASCII, roughly
    for k, c in enumerate(SIGNS):
        out[ord(c)] = 3 + k
    for k, c in enumerate(SPELLED):
        out[ord(c)] = out[ord(c.upper())] = 3 + len(SIGNS) + k
    return out


SYMBOL = _symbol_table()


def windows(n: int, size: int = SIZE, stride: int = STRIDE) -> list[int]:
    """Starts of the overlapping windows of a text of n characters."""
    return list(range(0, max(1, n - size + stride), stride))


@dataclass
class Model:
    p: nn.Params

    def emissions(self, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        x = self.p["e"][ids]
        h, kept = nn.bilstm(x, mask, {k: v for k, v in self.p.items() if k[0] in "fr"}, keep)
        return x, h, kept, h @ self.p["o"] + self.p["c"]

    def tags(self, texts: list[str]) -> list[np.ndarray]:
        """The reconciled tag of every character: 0 for none, else the kind's number."""
        out = [np.zeros(len(t), np.int8) for t in texts]
        coded = [symbols(t) if t else np.zeros(0, np.uint8) for t in texts]
        todo = [(i, k) for i, t in enumerate(texts) if t for k in windows(len(t))]
        todo.sort(key=lambda x: min(len(texts[x[0]]) - x[1], SIZE))
        held, n_held = [], 0  # scores of windows that may hold tags, until there are enough for one decoding
        for at in range(0, len(todo), TOGETHER):
            part = todo[at : at + TOGETHER]
            lengths = np.array([min(len(texts[i]) - k, SIZE) for i, k in part])
            rows = np.zeros((len(part), lengths[-1]), np.uint8)
            for j, (i, k) in enumerate(part):
                rows[j, : lengths[j]] = coded[i][k : k + SIZE]
            e = nn.emissions(rows.T.astype(np.int64, "C"), lengths, self.p)
            open_ = np.flatnonzero(nn.tagged(e, lengths, self.p["t"]))
            held.append((np.take(e, open_, axis=2), lengths[open_], [part[j] for j in open_]))
            n_held += len(open_)
            if n_held and (n_held >= TOGETHER or at + TOGETHER >= len(todo)):
                for (i, k), path in zip((w for h in held for w in h[2]), self.paths(held)):
                    a, b = EDGE if k else 0, len(path) if k + SIZE >= len(texts[i]) else SIZE - EDGE
                    out[i][k + a : k + b] = path[a:b]
                held, n_held = [], 0
        return out

    def paths(self, held: list[tuple]) -> Iterator[np.ndarray]:
        """The best path of each window, from scores (steps, tags, windows) and lengths in several parts."""
        lengths = np.concatenate([h[1] for h in held])
        e = np.zeros((lengths.max(), len(KINDS) + 1, len(lengths)), np.float32)
        at = 0
        for scores, own, _ in held:
            e[: len(scores), :, at : at + len(own)] = scores[: len(e)]
            at += len(own)
        mask = (np.arange(len(e))[:, None] < lengths).astype(np.float32)
        best = nn.best_paths(e.transpose(0, 2, 1), mask, self.p["t"])
        return (best[:n, j] for j, n in enumerate(lengths.tolist()))


def plausible(kind: str, s: str) -> bool:
    """The plain test of an added span."""
    n = len(digits_of(s))
    if kind == "email":
        return len(s) <= 254 and ADDRESS.fullmatch(s) is not None
    if kind == "ip":
        parts = re.findall(r"[0-9]+", s)
        return len(parts) == 4 and all(map(byte_part, parts))
    if kind == "card":
        return 13 <= n <= 19 and luhn(digits_of(s))
    return 9 <= n <= 15 and not re.search(r"[A-Za-z]", s)


def added_spans(t: str, tags: np.ndarray, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    out: list[tuple[str, int, int]] = []
    if not tags.any():
        return out
    taken = np.zeros(len(t), bool)
    for _, a, b in base:
        taken[a:b] = True
    cut = np.flatnonzero(np.diff(tags, prepend=0, append=0))
    for a, b in zip(cut[:-1], cut[1:]):
        if not tags[a]:
            continue
        kind = KINDS[tags[a] - 1]
        while a < b and t[a] in " \n.,;:":
            a += 1
        while b > a and t[b - 1] in " \n.,;:":
            b -= 1
        while 0 < a < b and t[a].isalnum() and t[a - 1].isalnum():
            a -= 1
        while a < b < len(t) and t[b - 1].isalnum() and t[b].isalnum():
            b += 1
        if kind == "email" and re.search(r"(?i:\bdot[\])]?|\.)$", t[a:b]) and (m := ENDING.match(t, b)):
            b = m.end()
        if kind == "email" and (m := ADDRESS.search(t[a:b])):
            a, b = a + m.start(), a + m.end()
        if plausible(kind, t[a:b]) and not taken[a:b].any():
            taken[a:b] = True
            out.append((kind, int(a), int(b)))
    return out


def variants(g: np.random.Generator) -> tuple[str, int]:
    """One written example and its kind's number (0: none)."""
    word = lambda lo, hi: "".join(g.choice(list("abcdefghijklmnopqrstuvwxyz"), g.integers(lo, hi)))
    num = lambda n: "".join(map(str, g.integers(0, 10, n)))
    pick = lambda *a: a[g.integers(len(a))]
    kind = pick(0, 0, 1, 1, 1, 2, 2, 3, 4, 4)
    if kind == 1:
        at, dot = pick((" at ", " dot "), (" at ", " dot "), (" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", " dot "), ("[at]", "."), ("@", "."), (" @ ", "."))
        s = word(3, 9) + pick("", "", f".{word(2, 8)}", f"_{word(2, 8)}") + pick("", num(2)) + at + word(3, 9) + dot + pick("com", "org", "net", "example.com", "de", "fr", "co" + dot + "uk")
        return pick(s, s, s.upper(), s.replace(" at ", " AT ").replace(" dot ", " DOT ")), 1
    if kind == 2:
        dot = pick(".", "[.]", "(.)", " . ", ".", " dot ", " DOT ", "[dot]")
        return dot.join(str(x) for x in g.integers(0, 256, 4)), 2
    if kind == 3:
        d = pick("4", "5", "37", "6011") + num(20)
        d = d[: pick(13, 15, 16, 16, 16, 19) - 1]
        d += next(c for c in "0123456789" if luhn(d + c))
        sep = pick("", " ", "-", ".", "  ")
        return sep.join(d[i : i + 4] for i in range(0, len(d), 4)), 3
    if kind == 4:
        a, b, c = num(3), num(3), num(4)
        cc = pick("+1 ", "+44 ", "+49", "0049 ", "001-", "1-", "")
        body = pick(f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"{a}/{b}{c}", f"0{a}/{b}{c}", f"0{a} {b}{c}")
        return cc + body, 4
    w = lambda: word(2, 9)
    spoken = pick(f"{w()} at {w()} dot {w()}", f"{w()} at dot {w()}", f"{w()} at {w()}", f"{w()} dot {w()}", f"at {num(1)} dot", f"{w()} at {num(2)}", f"the dot com {w()}", f"{w()} at the dot com {w()}", f"{w()}. {w()} at {w()}. {w()}")
    if g.random() < 0.5:
        return pick(spoken, spoken, spoken.upper(), spoken.capitalize()), 0
    return pick(
        f"{g.integers(1990, 2031)}-{g.integers(1, 13):02d}-{g.integers(1, 29):02d}",
        f"{g.integers(1, 13)}/{g.integers(1, 29)}/{g.integers(1990, 2031)}",
        f"version {g.integers(0, 20)}.{g.integers(0, 20)}.{g.integers(0, 20)}",
        f"{g.integers(0, 20)}.{g.integers(0, 9)}",
        f"${g.integers(1, 999)},{num(3)}.{num(2)}",
        f"{g.integers(0, 24):02d}:{g.integers(0, 60):02d}:{g.integers(0, 60):02d}",
        sha256(num(8).encode()).hexdigest()[: pick(18, 32, 40, 64)],
        "AKIA" + num(16),
        f"No. {num(6)}",
        f"pp. {num(3)}-{num(3)}",
        f"@{word(4, 9)}",
        f"ISBN {num(3)}-{num(1)}-{num(4)}-{num(4)}-{num(1)}",
        num(pick(1, 2, 4, 6, 8)),
    ), 0


def examples(texts: list[str]) -> list[tuple[str, np.ndarray]]:
    """Labelled windows: around digits and base spans of texts, plain ones, and plain ones with variants written in."""
    g = np.random.default_rng(11)
    found, quiet = [], []
    for t in texts:
        tags = np.zeros(len(t), np.int64)
        for kind, a, b in base_spans(t):
            tags[a:b] = KINDS.index(kind) + 1
        for s in windows(len(t), EXAMPLE, EXAMPLE // 2):
            (found if TRIGGER.search(t, s, s + EXAMPLE) else quiet).append((t[s : s + EXAMPLE], tags[s : s + EXAMPLE]))
    g.shuffle(found)
    g.shuffle(quiet)
    out = found[:WINDOWS] + quiet[: WINDOWS // 4]
    plain = [w for w, _ in quiet[:WINDOWS]] or ["the text of a page without any number stands here and goes on for a while until it ends"]
    for k in range(WINDOWS):
        w = plain[k % len(plain)]
        s, kind = variants(g)
        spaces = [m.start() for m in re.finditer(r"\s", w)] or [len(w)]
        a = spaces[int(g.integers(len(spaces)))] + 1
        new = w[:a] + s + " " + w[a:]
        tags = np.zeros(len(new), np.int64)
        tags[a : a + len(s)] = kind
        cut = int(min(max(0, a - g.integers(0, EXAMPLE // 2)), max(0, len(new) - EXAMPLE)))
        out.append((new[cut : cut + EXAMPLE], tags[cut : cut + EXAMPLE]))
    return out


def fit(texts: list[str], steps: int | None = None) -> Model:
    g = np.random.default_rng(5)
    k = len(KINDS) + 1
    p = nn.lstm_params(g, DIM, HIDDEN, "f") | nn.lstm_params(g, DIM, HIDDEN, "r")
    p |= {
        "e": (g.standard_normal((N_SYMBOLS, DIM)) * 0.5).astype(np.float32),
        "o": (g.standard_normal((2 * HIDDEN, k)) * 0.2).astype(np.float32),
        "c": np.zeros(k, np.float32),
        "t": np.zeros((k, k), np.float32),
    }
    model, rows = Model(p), examples(texts)
    adam = nn.Adam(p, RATE)
    steps = steps or STEPS
    for step in range(steps):
        adam.rate = RATE * (1 - 0.9 * step / steps)  # small at the end, so that rounding does not decide what is learnt
        own = [rows[i] for i in g.integers(0, len(rows), BATCH)]
        ids, tags, mask = np.zeros((EXAMPLE, BATCH), np.int64), np.zeros((EXAMPLE, BATCH), np.int64), np.zeros((EXAMPLE, BATCH), np.float32)
        for j, (w, y) in enumerate(own):
            n = len(w)
            if n:
                ids[:n, j], tags[:n, j], mask[:n, j] = symbols(w), y, 1
        x, h, kept, e = model.emissions(ids, mask, True)
        _, de, dt = nn.crf(e.astype(np.float64), tags, mask, p["t"])
        flat = de.reshape(-1, k)
        dx, grads = nn.bilstm_back(de @ p["o"].T, kept, p)
        grads |= {"o": h.reshape(-1, 2 * HIDDEN).T @ flat, "c": flat.sum(0), "t": dt, "e": np.zeros_like(p["e"])}
        np.add.at(grads["e"], ids.ravel(), dx.reshape(-1, DIM))
        adam.step(grads)
    return model


def train(docs: DataFrame, sample: int = SAMPLE_DOCS) -> Model:
    """Fit on windows of at most ``sample`` documents of at most ``LONGEST`` bytes with a digit or an at sign, chosen by a hash of doc_id."""
    docs = docs.select("doc_id", "text").where(F.octet_length("text") <= LONGEST)
    rows = docs.where("text RLIKE '[0-9@]'").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    got = docs.join(F.broadcast(rows), "doc_id").distinct().orderBy("doc_id", "text").select("text").toArrow()
    return fit([t for t in got["text"].to_pylist() if t])


def digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_personal_data(docs: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, sample))
    order = {k: i for i, k in enumerate(KINDS)}
    none = sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last, data, offsets in chunks(b.column("text")):
                hot = np.flatnonzero(offsets[1:] > offsets[:-1])
                texts = [data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace") for i in hot]
                n = last - first
                counts, sums, shown, added = np.zeros((n, 4), np.int64), [none] * n, [""] * n, np.zeros(n, np.int64)
                for i, t, tags in zip(hot.tolist(), texts, model.value.tags(texts)):
                    base = base_spans(t)
                    more = added_spans(t, tags, base)
                    for k, _, _ in base:
                        counts[i, order[k]] += 1
                    added[i] = len(more)
                    sums[i] = sha256(digest(base).encode()).hexdigest()
                    shown[i] = digest(sorted(base + more, key=lambda s: (order[s[0]], s[1])))
                cols = [b.slice(first, n).column("doc_id"), *map(pa.array, counts.T), pa.array(sums), pa.array(shown), pa.array(added)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {longs}, base_sha256 string, spans string, n_added long")


def op8_pii_bilstm_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))
