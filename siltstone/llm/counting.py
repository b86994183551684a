"""Token counts by a finite-state compilation of a byte-pair vocabulary with byte fallback.

The tokens of a text are the one way to cut it into vocabulary pieces of which every two neighbours are what merging gives for
the two alone. So the tokens of a growing prefix follow from a finite memory: for every place from which a piece
could still reach beyond the prefix, how far that piece has come (a trie node), the token that ends at the place, and how many tokens fewer the
prefix up to there has. These memories are the states of a deterministic transducer; each transition is annotated with the number of tokens that
its character adds (it may be negative: a merge takes tokens back). Characters outside the vocabulary emit
one token for each of their UTF-8 bytes. Transitions are compiled when a text first needs them, and kept.

A character pair that occurs in no piece resets the state. Texts are cut at such pairs (before the space that opens a word), so the state
map of a chunk between two cuts is constant: the chunks run once for each distinct one, and a prefix sum over their counts composes the
maps. A chunk of more than ``BLOCK`` characters without a cut is run in blocks, each from the states that can enter it
(first the one guessed from the characters ahead); the blocks' state maps compose by pointer doubling, a parallel prefix scan.

Defined results: null counts as empty, which has no token; rows are independent, so repeated ids and texts each get their row; other columns
are ignored; an empty table gives no rows. Strings of special tokens inside texts are ordinary text. No text is cut short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .store import table
from .textkit import U, chunks, hash_runs

BLOCK, WARM = 4096, 32
#: What a worker remembers at most: transitions, and chunks with their counts.
TRANSITIONS, KEEP = 1 << 19, 1 << 19
LIMIT = 4096
#: The vocabulary's mark for a space.
MARK = "▁"


class Pieces:
    """The merging rules of a vocabulary: best score first, then leftmost; a space stands for the mark."""

    def __init__(self, scores: dict[str, float]):
        self.score = scores
        self.parts: dict[str, tuple[str, str]] = {}
        self.valid = {p for p in scores if self.merged(p) == [p]}
        seen: dict[float, int] = {}
        for p in self.valid:
            seen[scores[p]] = seen.get(scores[p], 0) + 1
        #: Pieces whose history the spines do not tell: equal scores, or parts that are merged later than the whole.
        self.odd: set[str] = set()
        for p in sorted(self.valid, key=len):
            if len(p) > 1:
                parts = [x for x in self.parts[p] if len(x) > 1]
                if seen[scores[p]] > 1 or any(x in self.odd or scores[x] <= scores[p] for x in parts):
                    self.odd.add(p)
        self.crossing = {p[i : i + 2] for p in scores for i in range(len(p) - 1)}
        self.known: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """``text`` merged to the end; remembers how a piece that comes out whole was last put together."""
        out = list(text)
        while len(out) > 1:
            best, at = None, -1
            for i in range(len(out) - 1):
                s = self.score.get(out[i] + out[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            if len(out) == 2:
                self.parts[text] = (out[0], out[1])
            out[at : at + 2] = [out[at] + out[at + 1]]
        return out

    def spine(self, piece: str, side: int) -> list[tuple[str, float]]:
        """The pieces at one edge (0: left, 1: right) in the order in which they come about, each with the score of the merge that ends it."""
        out = [(piece, -np.inf)]
        while len(piece) > 1:
            end, piece = self.score[piece], self.parts[piece][side]
            out.append((piece, end))
        return out[::-1]

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging gives just ``a`` and ``b`` for the two together."""
        if not a or a[-1] + b[0] not in self.crossing:
            return True
        if (a, b) not in self.known:
            if len(self.known) > TRANSITIONS:
                self.known.clear()
            self.known[a, b] = self.merged(a + b) == [a, b] if a in self.odd or b in self.odd else self.apart(a, b)
        return self.known[a, b]

    def apart(self, a: str, b: str) -> bool:
        """No merge across the edge comes before the merges that end its two parts; of equal ones, the left one is first."""
        left, right, i, j = self.spine(a, 1), self.spine(b, 0), 0, 0
        while True:
            (x, x_end), (y, y_end) = left[i], right[j]
            s = self.score.get(x + y)
            if s is not None and s > x_end and s >= y_end:
                return False
            if x_end == y_end == -np.inf:
                return True
            if x_end >= y_end:
                i += 1
            else:
                j += 1


class Transducer:
    """States are numbers; 0 is the beginning of a text, and where a pair outside all pieces resets."""

    def __init__(self, scores: dict[str, float]):
        self.pieces = Pieces(scores)
        self.children: list[dict[str, int]] = [{}]
        self.token: list[str | None] = [None]
        letters = {c for p in scores for c in p}
        for p in self.pieces.valid | letters:
            node = 0
            for c in p:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.token.append(None)
                node = self.children[node][c]
            self.token[node] = p
        #: Whether texts may be cut before a space that follows another character.
        self.resets = not any(p[1] == " " != p[0] for p in self.pieces.crossing)
        self.forget()

    def forget(self) -> None:
        self.states: list[tuple] = [((0, "", 0),)]
        self.number = {self.states[0]: 0}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.size = 0

    def emitted(self, token: str) -> int:
        return 1 if token in self.pieces.score else len(token.encode("utf-8", "surrogatepass"))

    def compile(self, state: int, char: str) -> tuple[int, int]:
        """The transition of ``state`` on ``char``: the next state, and the tokens added."""
        memory = self.states[state]
        last = memory[-1][1]
        if last and last[-1] + char not in self.pieces.crossing:
            memory = self.states[0]
        reach, found = [], None
        for node, before, fewer in memory:
            node = self.children[node].get(char)
            if node is None:
                continue
            token = self.token[node]
            if token is not None and found is None and self.pieces.compatible(before, token):
                found = token, fewer + self.emitted(token)
            if self.children[node]:
                reach.append((node, before, fewer))
        token, added = found or (char, self.emitted(char))
        after = (*((node, before, fewer - added) for node, before, fewer in reach), (0, token, 0))
        number = self.number.setdefault(after, len(self.states))
        if number == len(self.states):
            self.states.append(after)
            self.moves.append({})
        self.moves[state][char] = number, added
        self.size += 1
        return number, added

    def run(self, text: str, state: int = 0) -> tuple[int, int]:
        """The state after ``text``, and the tokens that it adds."""
        total, moves = 0, self.moves
        for c in text:
            move = moves[state].get(c) or self.compile(state, c)
            state = move[0]
            total += move[1]
        return state, total

    def scan(self, text: str, block: int = BLOCK, warm: int = WARM) -> int:
        """The tokens of ``text`` by blocks: their state maps, on the states that can enter them, composed by pointer doubling."""
        blocks = [text[i : i + block] for i in range(0, len(text), block)]
        slot: dict[tuple[int, int], int] = {}
        out: list[tuple[int, int]] = []
        memo: dict[tuple[str, int], tuple[int, int]] = {}
        todo = [(0, 0), *((k, self.run(blocks[k - 1][-warm:])[0]) for k in range(1, len(blocks)))]
        while todo:
            k, state = todo.pop()
            if (k, state) in slot:
                continue
            slot[k, state] = len(out)
            key = blocks[k], state
            if key not in memo:
                memo[key] = self.run(blocks[k], state)
            out.append(memo[key])
            if k + 1 < len(blocks):
                todo.append((k + 1, out[-1][0]))
        end = len(out)
        after = np.full(end + 1, end)
        for (k, _), i in slot.items():
            after[i] = slot.get((k + 1, out[i][0]), end)
        total = np.array([n for _, n in out] + [0], np.int64)
        while (after != end).any():
            total += total[after]
            after = after[after]
        return int(total[slot[0, 0]])


class Tally:
    """Token counts of whole batches; each distinct chunk between two cuts runs once while it is remembered."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        lib = SentencePieceProcessor(model_file=path)
        plain = [i for i in range(lib.get_piece_size()) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.machine = Transducer({lib.id_to_piece(i).replace(MARK, " "): lib.get_score(i) for i in plain})
        self.forget()

    def forget(self) -> None:
        self.keys, self.count = np.zeros(0, U), np.zeros(0, np.int64)
        self.at, self.size, self.bytes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def of(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), MARK, " ")
        texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, pa.scalar("", texts.type)))
        return np.concatenate([np.zeros(0, np.int64), *(self.some(data, offsets) for _, _, data, offsets in chunks(texts))])

    def some(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not len(data):
            return np.zeros(len(offsets) - 1, np.int64)
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        if self.machine.resets:
            space = data == 0x20
            cut[1:-1] |= space[1:] & ~space[:-1]
        starts = np.flatnonzero(cut[:-1])
        ends = np.append(starts[1:], len(data))
        size = ends - starts
        count = np.zeros(len(starts), np.int64)
        for i in np.flatnonzero(size > BLOCK):
            count[i] = self.machine.scan(data[starts[i] : ends[i]].tobytes().decode("utf-8", "surrogatepass"))
            self.bound()
        short = np.flatnonzero(size <= BLOCK)
        if len(short):
            count[short] = self.looked_up(data, starts[short], ends[short])
        total = np.concatenate([[0], np.cumsum(count)])  # the composition of constant maps
        edge = total[np.searchsorted(starts, offsets)]
        return edge[1:] - edge[:-1]

    def bound(self) -> None:
        if self.machine.size > TRANSITIONS:
            self.machine.forget()

    def looked_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Counts of chunks, found by hash and compared byte by byte; one that differs runs by itself."""
        uniq, where, back = np.unique(hash_runs(data, starts, ends), return_index=True, return_inverse=True)
        self.learn(uniq, data, starts[where], ends[where])
        slot = np.searchsorted(self.keys, uniq)[back]
        size = ends - starts
        first = np.cumsum(size) - size
        step = np.arange(size.sum())
        here = np.repeat(starts - first, size) + step
        there = np.minimum(np.repeat(self.at[slot] - first, size) + step, len(self.bytes) - 1)
        other = (size != self.size[slot]) | np.logical_or.reduceat(data[here] != self.bytes[there], first)
        count = self.count[slot]
        for i in np.flatnonzero(other):
            count[i] = self.machine.run(data[starts[i] : ends[i]].tobytes().decode("utf-8", "surrogatepass"))[1]
        return count

    def learn(self, uniq: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        if len(self.keys) > KEEP or len(self.bytes) > 16 * KEEP:
            self.forget()
        put = np.searchsorted(self.keys, uniq)
        new = np.append(self.keys, U(0))[put] != uniq
        new |= put == len(self.keys)
        if not new.any():
            return
        put, starts, ends = put[new], starts[new], ends[new]
        count = np.empty(len(put), np.int64)
        for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
            count[i] = self.machine.run(data[a:b].tobytes().decode("utf-8", "surrogatepass"))[1]
            self.bound()
        size = ends - starts
        at = len(self.bytes) + np.cumsum(size) - size
        self.bytes = np.concatenate([self.bytes, data[np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(size.sum())]])
        self.keys = np.insert(self.keys, put, uniq[new])
        self.count, self.at, self.size = np.insert(self.count, put, count), np.insert(self.at, put, at), np.insert(self.size, put, size)


_tallies: dict[str, Tally] = {}


def tally(path: str) -> Tally:
    if path not in _tallies:
        _tallies[path] = Tally(path)
    return _tallies[path]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of each row of ``docs``, for the sentencepiece model at ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tally(path)
        for b in batches:
            text = pc.fill_null(b.column("text"), "")
            n = known.of(text)
            size = pc.cast(pc.binary_length(text), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), size, pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    out = [rows.schema["doc_id"], StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())]
    return rows.mapInArrow(run, StructType(out))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
