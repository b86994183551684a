"""Token ids of whole batches by a byte-level BPE file of the ``tokenizers`` library.

The pre-tokenizer's pattern is applied to code points with numpy; every distinct piece is encoded once by the
library, and documents are put together from the pieces. Pieces are looked up by hash and then compared with the
remembered piece character by character; a document with a piece of equal hash and other characters goes through the library whole. Texts with a character whose class could depend on the
Unicode version go through the library whole. Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import os
import unicodedata
from itertools import chain

import numpy as np

from .textkit import U, mix, powers

CHARS = 1 << 19
KEEP = 1 << 19
#: White space of the pattern's \s (Unicode White_Space).
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
OTHER, LETTER, NUMBER, BLANK, UNSURE = range(5)


def classes() -> np.ndarray:
    old = unicodedata.ucd_3_2_0.category
    kind = {"L": LETTER, "N": NUMBER}
    out = np.full(0x110000, UNSURE, np.uint8)
    for c in range(0x110000):
        a = unicodedata.category(ch := chr(c))
        if a == old(ch) and a != "Cn":
            out[c] = kind.get(a[0], OTHER)
    out[WHITE] = BLANK
    return out


class Encoder:
    """Ids of texts; remembers the pieces it has met, up to ``KEEP``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True
        self.kind = classes()
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, U)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)  # of each key: where its ids are, and how many
        self.char_at, self.chars = np.zeros(0, np.int64), np.zeros(0, np.int64)  # the same for its characters
        self.ids, self.points = np.zeros(0, np.uint32), np.zeros(0, np.uint32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Arrays of ids, one for each text."""
        out: list[np.ndarray] = []
        start = total = 0
        for i, t in enumerate(texts):
            total += len(t)
            if total >= CHARS:
                out += self.some(texts[start : i + 1])
                start, total = i + 1, 0
        return out + (self.some(texts[start:]) if start < len(texts) else [])

    def some(self, texts: list[str]) -> list[np.ndarray]:
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        if len(points) == 0:
            return [np.zeros(0, np.uint32) for _ in texts]
        kind = self.kind[points]
        unsure = np.flatnonzero(np.add.reduceat(np.append(kind == UNSURE, False), offsets[:-1]) * (np.diff(offsets) > 0)) if (kind == UNSURE).any() else ()
        starts = self.cuts(points, kind, offsets)
        ends = np.append(starts[1:], len(points))
        up, down = powers(len(points) + 1)
        sums = np.zeros(len(points) + 1, U)
        np.cumsum((points.astype(U) + U(1)) * up[: len(points)], out=sums[1:])
        keys = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))
        uniq, where, back = np.unique(keys, return_index=True, return_inverse=True)
        self.learn(uniq, joined, points, starts[where], ends[where])
        slot = np.searchsorted(self.keys, uniq)[back]
        length = ends - starts
        known = np.repeat(self.char_at[slot] - starts, length) + np.arange(len(points))  # the same place in the remembered piece
        unlike = (length != self.chars[slot]) | np.logical_or.reduceat(points != self.points[np.minimum(known, len(self.points) - 1)], starts)
        size = self.size[slot]
        first = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(self.at[slot] - first[:-1], size) + np.arange(first[-1])]
        edge = first[np.searchsorted(starts, offsets)]
        out = [ids[a:b] for a, b in zip(edge[:-1], edge[1:])]
        apart = np.searchsorted(offsets, starts[unlike], "right") - 1
        for i in {*unsure, *apart.tolist()}:
            out[i] = self.whole(texts[i])
        return out

    def learn(self, uniq: np.ndarray, joined: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Remember the pieces of the keys that are new."""
        if len(self.keys) > KEEP:
            self.forget()
        put = np.searchsorted(self.keys, uniq)
        new = np.append(self.keys, U(0))[put] != uniq
        new |= put == len(self.keys)
        if not new.any():
            return
        put, starts, chars = put[new], starts[new], (ends - starts)[new]
        got = [x.ids for x in self.lib.encode_batch_fast([joined[a : a + n] for a, n in zip(starts.tolist(), chars.tolist())], add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        at, char_at = len(self.ids) + np.cumsum(size) - size, len(self.points) + np.cumsum(chars) - chars
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(got), np.uint32, int(size.sum()))])
        self.points = np.concatenate([self.points, points[np.repeat(starts - (np.cumsum(chars) - chars), chars) + np.arange(chars.sum())]])
        self.keys = np.insert(self.keys, put, uniq[new])
        self.at, self.size, self.char_at, self.chars = (np.insert(x, put, y) for x, y in ((self.at, at), (self.size, size), (self.char_at, char_at), (self.chars, chars)))

    @staticmethod
    def cuts(points: np.ndarray, kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pieces of the pattern begin."""
        n = len(points)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        edge[n] = True
        run = edge.copy()
        run[1:n] |= kind[1:] != kind[:-1]
        cut = run.copy()
        after = np.zeros(n, bool)  # the next character is of another run of the same document
        after[:-1] = run[1:n] & ~edge[1:n]
        tail = np.flatnonzero((kind == BLANK) & after)  # last white space before other text
        cut[tail] = True
        space = tail[points[tail] == 32]
        cut[space + 1] = False  # a plain space joins what follows
        quote = np.flatnonzero((points == 39) & cut[:n] & run[1:])
        quote = quote[(quote + 1 < n)]
        quote = quote[(kind[quote + 1] == LETTER) & ~edge[quote + 1]]
        if len(quote):
            a = points[quote + 1]
            b = np.where((quote + 2 < n) & ~edge[np.minimum(quote + 2, n)], points[np.minimum(quote + 2, n - 1)], 0)
            two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
            one = np.isin(a, [ord(c) for c in "stmd"])
            for hit, length in ((quote[one], 2), (quote[two & ~one], 3)):
                cut[hit + 1] = False
                # what follows begins anew; a space there was cut or joined already
                nxt = hit + length
                nxt = nxt[nxt < n]
                cut[nxt] = True
        return np.flatnonzero(cut[:n])
