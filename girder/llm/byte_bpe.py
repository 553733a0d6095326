"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding by offsets.

Texts are joined, turned into code points and mapped to classes by one table. A small automaton with
nine states tells where pieces begin; each class is a transition function on the states, functions
compose associatively, so blocks of text are reduced at once, combined by a scan, and replayed from
their true first states. What a state can't know is put into the classes beforehand: whether
white space is the last before other text, and whether a letter can end a contraction. The byte slices
between the boundaries are looked up in a cache; a missing one is merged pair by pair, lowest rank
and then leftmost first.

The boundaries are those of the pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.

Defined results. Null and empty text: no ids. Special tokens are ordinary text. Bytes that aren't
UTF-8 count as U+FFFD. Repeated rows and ties: each row by itself. Extra columns are ignored. The cache
of merges is bounded, results don't depend on it. Very long pieces merge in n log n.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from girder.llm.common import lean, rounds, utf8

#: Pieces that a worker's cache holds before its older half goes.
CACHE_PIECES = 200_000
ROUND = 1 << 18
BLOCK = 64

SEP, LETTER, SHORT, LONG, NUMBER, SPACE_LAST, SPACE, WHITE_LAST, WHITE, QUOTE, OTHER = range(11)
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_WHITE, AT_QUOTE, IN_CONTRACTION, DONE = range(9)
# The white space of Unicode.
WHITE_SPACE = (9, 10, 11, 12, 13, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@cache
def class_table() -> np.ndarray:
    """The class of each code point, before looking at its neighbours."""
    kinds = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    major = {"L": LETTER, "N": NUMBER}
    for c in range(sys.maxunicode + 1):
        kind = major.get(unicodedata.category(chr(c))[0])
        if kind is not None:
            kinds[c] = kind
    kinds[list(WHITE_SPACE)] = WHITE
    kinds[ord(" ")] = SPACE
    kinds[ord("'")] = QUOTE
    return kinds


@cache
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """next[state, class], and whether a piece begins at that character."""
    to = np.zeros((9, 11), np.uint8)
    begins = np.zeros((9, 11), bool)
    runs = {IN_LETTERS: (LETTER, SHORT, LONG), IN_NUMBERS: (NUMBER,), IN_OTHERS: (OTHER,)}
    for state in range(9):
        for run, kinds in runs.items():
            for k in kinds:
                to[state, k] = run
                begins[state, k] = state not in (run, AFTER_SPACE)
        joins = state in (IN_OTHERS, AFTER_SPACE, AT_QUOTE)
        to[state, QUOTE] = IN_OTHERS if joins else AT_QUOTE
        begins[state, QUOTE] = not joins
        for k in (SPACE, WHITE):
            to[state, k] = IN_WHITE
            begins[state, k] = state != IN_WHITE
        to[state, SPACE_LAST], to[state, WHITE_LAST] = AFTER_SPACE, DONE
        begins[state, [SPACE_LAST, WHITE_LAST]] = True
        to[state, SEP], begins[state, SEP] = START, True
    begins[AT_QUOTE, OTHER] = False
    for k, state in ((SHORT, DONE), (LONG, IN_CONTRACTION)):
        to[AT_QUOTE, k] = state
        begins[AT_QUOTE, k] = False
    for k in (LETTER, SHORT, LONG):
        to[IN_CONTRACTION, k] = DONE
        begins[IN_CONTRACTION, k] = False
    return to, begins


def classes(points: np.ndarray, separators: np.ndarray) -> np.ndarray:
    """Classes with what the automaton must know of the next character."""
    kinds = class_table()[points]
    kinds[separators] = SEP
    after = np.append(points[1:], 0)
    last = np.append(kinds[1:], SEP)
    white = (kinds == SPACE) | (kinds == WHITE)
    ends = white & (last != SPACE) & (last != WHITE) & (last != SEP)
    letters = kinds == LETTER
    short = np.isin(points, [ord(c) for c in "stmd"]) & letters
    e, ell = after == ord("e"), after == ord("l")
    long = ((points == ord("r")) | (points == ord("v"))) & e | (points == ord("l")) & ell
    kinds[ends] -= 1  # SPACE to SPACE_LAST, WHITE to WHITE_LAST
    kinds[short] = SHORT
    kinds[long & letters & (last != SEP)] = LONG
    return kinds


def beginnings(kinds: np.ndarray) -> np.ndarray:
    """True where a piece (or a separator) begins, by an associative scan over blocks."""
    to, begins = automaton()
    states, width = to.shape
    flat, out = to.ravel(), begins.ravel()
    n = len(kinds)
    blocks = -(-n // BLOCK)
    grid = np.zeros(blocks * BLOCK, np.uint8)
    grid[:n] = kinds
    columns = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T)
    # every block as a function of its first state
    whole = np.tile(np.arange(states, dtype=np.uint8), (blocks, 1))
    for kind in columns:
        whole = flat.take(whole.astype(np.uint16) * width + kind[:, None])
    # inclusive scan of the functions: after step k each holds the last 2**k blocks
    step = 1
    while step < blocks:
        later = np.take_along_axis(whole[step:], whole[:-step], axis=1)
        whole = np.concatenate((whole[:step], later))
        step *= 2
    state = np.empty(blocks, np.uint8)
    state[0] = START
    state[1:] = whole[:-1, START]
    marks = np.empty((BLOCK, blocks), bool)
    for j, kind in enumerate(columns):
        at = state.astype(np.uint16) * width + kind
        marks[j] = out.take(at)
        state = flat.take(at)
    return marks.T.ravel()[:n]


def pieces(texts: list[bytes]) -> list[list[bytes]]:
    """The slices of each text between the boundaries."""
    data = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    first = np.flatnonzero((raw & 0xC0) != 0x80)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    separators = np.searchsorted(first, ends)
    marks = np.flatnonzero(beginnings(classes(points, separators)))
    cuts = first[marks].tolist()
    found = [data[a:b] for a, b in zip(cuts, cuts[1:])]
    found.append(b"\n")
    at = np.searchsorted(marks, separators).tolist()
    return [found[a:b] for a, b in zip([0, *(x + 1 for x in at)], at)]


def parse_ranks(file: bytes) -> dict[bytes, int]:
    """Token bytes to rank of a rank file: a base64 token and its rank in each line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines()) if a}


class Merger(dict):
    """piece -> its ids as little-endian unsigned 32-bit integers; fills itself."""

    def __init__(self, ranks: dict[bytes, int], limit: int = CACHE_PIECES) -> None:
        super().__init__()
        self.ranks, self.limit, self.older = ranks, limit, {}

    def __missing__(self, piece: bytes) -> bytes:
        found = self.older.get(piece)
        if found is None:
            rank = self.ranks.get(piece)
            ids = [rank] if rank is not None else self.merge(piece)
            found = np.array(ids, "<u4").tobytes()
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[piece] = found
        return found

    def merge(self, piece: bytes) -> list[int]:
        if len(piece) > 48:
            return self.merge_long(piece)
        rank = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [rank(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = min(pairs)
            if best == _NEVER:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], _NEVER)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], _NEVER)
        return [self.ranks[p] for p in parts]

    def merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap over linked parts."""
        n = len(piece)
        end = list(range(1, n + 1))  # of the part that begins here
        before = list(range(-1, n - 1))
        alive = [True] * n
        rank = self.ranks.get
        heap = []

        def push(i: int) -> None:
            j = end[i]
            if j < n:
                r = rank(piece[i : end[j]])
                if r is not None:
                    heapq.heappush(heap, (r, i, j, end[j]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if not alive[i] or end[i] != j or not alive[j] or end[j] != k:
                continue  # one of the two has changed since
            alive[j] = False
            end[i] = k
            if k < n:
                before[k] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return out


_NEVER = 1 << 40
_LOADED: dict[int, Merger] = {}


class Vocabulary:
    """Token bytes in one array with offsets, by which ids decode at once."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        size = max(ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, i in ranks.items():
            tokens[i] = token
        self.length = np.fromiter(map(len, tokens), np.int64, size)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(tokens) or b"\0", np.uint8)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """The byte offset at which each token ends in its text."""
        return np.cumsum(self.length[ids])

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        size = self.length[ids]
        at = np.repeat(self.start[ids] - (ends - size), size)
        return self.data[at + np.arange(ends[-1])].tobytes()


def _valid(text: bytes) -> bytes:
    return text.decode("utf-8", "replace").encode()


def encode_texts(texts: list[bytes], merger: Merger) -> list[bytes]:
    """The ids of each text, as little-endian unsigned 32-bit integers."""
    try:
        cut = pieces(texts)
    except UnicodeDecodeError:
        cut = pieces([_valid(t) for t in texts])
    get = merger.__getitem__
    return [b"".join(map(get, p)) for p in cut]


def encode(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    offsets: bool = False,
) -> DataFrame:
    """id, n_tokens and ids (binary, four bytes each) of every row; with ``offsets`` also ``ends``,
    the byte offset at which each token ends in the text.

    path: a rank file on the driver; it has a bounded number of tokens and goes out with the task.
    """
    with open(path, "rb") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        ranks = parse_ranks(file.value)
        merger, vocabulary = Merger(ranks), Vocabulary(ranks) if offsets else None
        for b in batches:
            chars, at = utf8(b.column("text"))
            data = chars.tobytes()
            for i, j in rounds(at, ROUND):
                part = at[i : j + 1].tolist()
                ids = encode_texts([data[x:y] for x, y in zip(part, part[1:])], merger)
                columns = [
                    b.column("id").slice(i, j - i),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ]
                if vocabulary is not None:
                    ends = [vocabulary.ends(np.frombuffer(x, "<u4")) for x in ids]
                    columns.append(pa.array(ends, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    schema = kept.select("id").schema.add("n_tokens", "long").add("ids", "binary")
    if offsets:
        schema = schema.add("ends", T.ArrayType(T.LongType()))
    return kept.mapInArrow(lean(run), schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns of ``encode``'s result and ``decoded``, the bytes of the text."""
    with open(path, "rb") as f:
        file = encoded.sparkSession.sparkContext.broadcast(f.read())
    place = encoded.columns.index("ids")

    def run(batches):
        vocabulary = Vocabulary(parse_ranks(file.value))
        for b in batches:
            out = []
            for x in b.column(place):
                ids = np.frombuffer(x.as_py(), "<u4")
                out.append(vocabulary.decode(ids, vocabulary.ends(ids)))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(out, pa.binary())], schema.names
            )

    schema = encoded.select("*").schema.add("decoded", "binary")
    return encoded.mapInArrow(lean(run), schema)
