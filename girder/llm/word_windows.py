"""Passages of ``words`` words that also stand elsewhere, whatever their length in bytes.

Windows of words are met as ``repeats`` meets windows of bytes: the run of ``gram`` words with the smallest
hash in a window (leftmost on ties) is its anchor, and equal windows have equal anchors at equal
offsets. Anchors are counted first, some tenth of all words; only windows whose anchor is not alone are
then hashed and counted themselves, so every window is decided exactly (128-bit keys).

Words are what ASCII white space separates; passages that differ in white space only are equal. A span is the
bytes from a window's first word to its last. Null text, repeated rows, matches in one text, ties, an empty
table and extra columns: as in ``repeats``. A long text is hashed in overlapping pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from girder.llm.common import deleted, hashed, lean, renamed, split_join, utf8, written
from girder.llm.repeats import _BASES, _Hashes, _keyed, _sliding_argmin, merged

#: Words of a text that are hashed at once.
PIECE = 1 << 16


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word, and the byte after it."""
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = (data == 32) | ((data >= 9) & (data <= 13))
    turn = np.flatnonzero(blank[1:] != blank[:-1])
    return turn[::2], turn[1::2]


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    for i in range(0, len(starts), 4096):
        a, b = starts[i : i + 4096], ends[i : i + 4096]
        out[i : i + 4096] = _Hashes(data[a[0] : b[-1]], base).of(a - a[0], b - a[0])
    return out


def _anchored(hashes: np.ndarray, words: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of words: where its anchor is, and the anchor's hash."""
    n = len(hashes)
    at = np.arange(n - gram + 1)
    keys = _Hashes(hashes, _BASES[0]).of(at, at + gram)
    low = np.uint64(PIECE * 2 - 1)
    best = _sliding_argmin((keys & ~low) | at.astype(np.uint64), words - gram + 1)
    best = (best & low).astype(np.int64)
    return best, keys[best].view(np.int64)


def _pieces(hashes: np.ndarray, words: int):
    """(first word, hashes) of pieces whose windows are all windows, each once."""
    for i in range(0, len(hashes) - words + 1, PIECE):
        yield i, hashes[i : i + PIECE + words - 1]


def _texts(batch: pa.RecordBatch):
    chars, at = utf8(batch.column("text"))
    for r, (i, j) in enumerate(zip(at.tolist(), at[1:].tolist())):
        data = chars[i:j]
        yield (r, data, *word_bounds(data))


def _tables(names: list[str], kinds: list[pa.DataType], rows):
    """Record batches of the tuples of equally long arrays that rows yields."""
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += len(row[-1])
        if n > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), t) for x, t in zip(zip(*held), kinds)], names)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), t) for x, t in zip(zip(*held), kinds)], names)


def repeated_spans(
    docs: DataFrame, words: int, gram: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """_k1, _k2 and spans (start, end) in bytes, merged within a stretch of the text: what repeated
    windows of ``words`` words cover. Texts without one have no row."""
    if not 0 < gram < words < PIECE:
        raise ValueError("the gram must be shorter than the window")
    rows, (doc, text) = renamed(docs, id_col, text_col)
    texts = _keyed(rows, doc, text).select("_k1", "_k2", F.coalesce(text, F.lit("")).alias("text"))
    int64, int32 = pa.int64(), pa.int32()

    def scan(batches):
        def rows(b):
            k1, k2 = (b.column(c).to_numpy() for c in ("_k1", "_k2"))
            for r, data, starts, ends in _texts(b):
                if len(starts) < words:
                    continue
                last = -1
                for i, part in _pieces(_word_hashes(data, starts, ends, _BASES[0]), words):
                    best, keys = _anchored(part, words, gram)
                    new = np.flatnonzero(np.diff(best, prepend=-1) > 0)
                    new = new[best[new] + i > last]
                    if len(new):
                        pos = best[new] + i
                        last = int(pos[-1])
                        yield np.full(len(new), k1[r]), np.full(len(new), k2[r]), pos, keys[new]

        for b in batches:
            yield from _tables(["_k1", "_k2", "pos", "key"], [int64, int64, int32, int64], rows(b))

    def windows(batches):
        def rows(b):
            k1, k2 = (b.column(c).to_numpy() for c in ("_k1", "_k2"))
            wanted = b.column("at")
            for r, data, starts, ends in _texts(b):
                alive = np.zeros(len(starts), bool)
                alive[np.array(wanted[r].as_py())] = True
                first = _word_hashes(data, starts, ends, _BASES[0])
                second = _word_hashes(data, starts, ends, _BASES[1])
                for i, part in _pieces(first, words):
                    at = np.flatnonzero(alive[_anchored(part, words, gram)[0] + i])
                    if len(at):
                        h1 = _Hashes(part, _BASES[0]).of(at, at + words).view(np.int64)
                        other = second[i : i + len(part)]
                        h2 = _Hashes(other, _BASES[1]).of(at, at + words).view(np.int64)
                        a, b_ = starts[at + i], ends[at + i + words - 1]
                        yield np.full(len(at), k1[r]), np.full(len(at), k2[r]), a, b_, h1, h2

        for b in batches:
            kinds = [int64] * 6
            yield from _tables(["_k1", "_k2", "start", "end", "h1", "h2"], kinds, rows(b))

    anchors = written(
        texts.mapInArrow(lean(scan), "_k1 long, _k2 long, pos int, key long"), "word-anchors"
    )
    again = written(anchors.groupBy("key").count().filter("count > 1"), "word-digits")
    alive = split_join(anchors, again, ["key"], "inner", anchors.count())
    by_text = alive.groupBy("_k1", "_k2").agg(F.collect_set("pos").alias("at"))
    left = written(by_text, "word-anchors-left")
    found = texts.join(hashed(left), ["_k1", "_k2"]).select("_k1", "_k2", "text", "at")
    made = written(
        found.mapInArrow(
            lean(windows), "_k1 long, _k2 long, start long, end long, h1 long, h2 long"
        ),
        "word-windows",
    )
    twice = written(made.groupBy("h1", "h2").count().filter("count > 1"), "word-windows-again")
    part = F.floor(F.col("start") / F.lit(PIECE)).alias("part")
    spans = (
        split_join(made, twice, ["h1", "h2"], "inner", made.count())
        .groupBy("_k1", "_k2", part)
        .agg(F.collect_set(F.struct("start", "end")).alias("_spans"))
        .select("_k1", "_k2", "_spans")
    )

    def joined(batches):
        for b in batches:
            cut = [merged([(s["start"], s["end"]) for s in x]) for x in b.column("_spans").to_pylist()]
            cut = [[{"start": x, "end": y} for x, y in c] for c in cut]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:2], pa.array(cut, b.schema.field("_spans").type)], b.schema.names
            )

    result = written(spans.mapInArrow(lean(joined), spans.schema), "word-spans")
    deleted(anchors, again, left, made, twice)
    return result
