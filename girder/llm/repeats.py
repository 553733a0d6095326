"""Suffix-array dedup: bytes covered by a string of ``window`` bytes that also starts elsewhere.

The suffixes are ordered only through ``window`` bytes, by most-significant-digit passes; a suffix
that is alone in its group after a pass is dropped, so what is left in equal groups after the last
pass are exactly the repeated windows. Two things keep the passes small:

* Suffixes are sorted in bunches. The ``gram`` bytes with the smallest hash in a window (leftmost on
  ties) are its anchor; equal windows have equal anchors at equal offsets. An anchor stands for all
  windows that hold it at offsets 0 to ``window - gram``, some hundred suffixes in one row.
* A pass refines ranges of offsets. For a range, the bytes that all its windows share are the digit:
  if no other anchor has them, the whole range is dropped. The bytes that its windows cover together
  are compared as well: if another anchor has those, every window of the range is repeated and the
  range is settled. Ranges that are neither are cut in seven and go to the next pass; ranges of one
  offset are windows, and are settled always. The widths are powers of seven, so a pass's ranges are
  whole parts of the last one's and no window is in two of them. The first pass reads the texts, the others the bytes
  around the anchors that are left (one for each distinct surrounding that is settled, so that copies
  don't repeat).

Groups are formed by grouped counts and joins, never gathered: a passage that a third of all
documents share costs its anchors once a pass. Keys are 128-bit polynomial hashes.

Defined results. Null text: empty, zero bytes. Texts shorter than the window: nothing is removed.
Repeated rows are documents of their own, so each is a repeat of the other. Matches overlap freely
and may lie in one text; ties are none, as every holder of a repeated window loses it. An empty table gives an
empty result. Extra columns pass through under any names. Texts are read whole; one that is longer than
a segment is read in overlapping segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from girder.llm.common import deleted, hashed, lean, renamed, rounds, split_join, utf8, written

WINDOW = 400
GRAM = 128
SEGMENT = 1 << 17
BRANCH = 7

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse, mod 2**64, for i < n at least."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(1 << max(12, (n - 1).bit_length()), b, np.uint64)
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        _POWERS[base] = (out[0], out[1])
    return _POWERS[base]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class _Hashes:
    """Hashes of any ranges of a byte array (or of the rows of a matrix), by prefix sums."""

    def __init__(self, data: np.ndarray, base: int) -> None:
        n = data.shape[-1] + 1
        self.up, self.down = _powers(base, n)
        self.sums = np.zeros((*data.shape[:-1], n), np.uint64)
        terms = (data.astype(np.uint64) + np.uint64(1)) * self.up[: n - 1]
        np.cumsum(terms, axis=-1, out=self.sums[..., 1:])

    def of(self, a: np.ndarray, b: np.ndarray, row: np.ndarray | None = None) -> np.ndarray:
        s = self.sums if row is None else None
        low = s[a] if row is None else self.sums[row, a]
        high = s[b] if row is None else self.sums[row, b]
        return _mix((high - low) * self.down[a])


def _sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of keys[i:i + width] for every i, in three passes."""
    n = len(keys)
    rows = -(-n // width)
    grid = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    grid[:n] = keys
    grid = grid.reshape(rows, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def _anchors(
    data: np.ndarray, windows: list[tuple[int, int]], window: int, gram: int
) -> np.ndarray:
    """Positions of the anchors of the windows that start in the given ranges, ascending."""
    n = len(data)
    if n < window:
        return np.zeros(0, np.int64)
    hashes = _Hashes(data, _BASES[0])
    at = np.arange(n - gram + 1)
    bits = np.uint64(max(1, (n - 1).bit_length()))
    keys = (hashes.of(at, at + gram) >> bits << bits) | at.astype(np.uint64)
    best = _sliding_argmin(keys, window - gram + 1)
    inside = np.zeros(len(best) + 1, np.int8)
    for a, b in windows:
        if a < b:
            inside[a] += 1
            inside[b] -= 1
    best = best[np.cumsum(inside[:-1]) > 0] & ((np.uint64(1) << bits) - np.uint64(1))
    best = best.astype(np.int64)
    return best[np.concatenate(([True], best[1:] != best[:-1]))] if len(best) else best


def _fold(h: np.ndarray, extra: np.ndarray) -> np.ndarray:
    return _mix(h + extra.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)).view(np.int64)


def _scan(data: np.ndarray, at: np.ndarray, window: int, gram: int) -> Iterator[tuple]:
    """(row, position, gram key, key 1, key 2) arrays of the anchors of the texts in ``data``."""
    reach = window - gram
    for i, j in rounds(at, SEGMENT):
        lo, hi = int(at[i]), int(at[j])
        if hi - lo <= SEGMENT or j - i > 1:
            pieces = [(lo, hi, [(int(a) - lo, int(b) - window + 1 - lo) for a, b in zip(at[i:j], at[i + 1 : j + 1])])]
        else:
            pieces = []
            for s in range(lo, hi - window + 1, SEGMENT):
                a = max(lo, s - reach)
                b = min(hi, s + SEGMENT + reach + window)
                pieces.append((a, b, [(s - a, min(s + SEGMENT, hi - window + 1) - a)]))
        last = -1
        for a, b, windows in pieces:
            part = data[a:b]
            pos = _anchors(part, windows, window, gram) + a
            pos = pos[pos > last]
            if not len(pos):
                continue
            last = int(pos[-1])
            row = np.searchsorted(at, pos, "right") - 1
            left = np.minimum(reach, pos - at[row])
            right = np.minimum(window, at[row + 1] - pos)
            first, second = _Hashes(part, _BASES[0]), _Hashes(part, _BASES[1])
            p = pos - a
            span = left * (window + 1) + right
            yield (
                row,
                pos - at[row],
                first.of(p, p + gram).view(np.int64),
                _fold(first.of(p - left, p + right), span),
                _fold(second.of(p - left, p + right), span),
                left,
                right,
            )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A key of 128 bits for each distinct (id, text)."""
    doc = F.col(id_col).cast("string")
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn("_k1", F.xxhash64(text, doc)).withColumn(
        "_k2", F.xxhash64(F.lit(7), doc, text)
    )


def _decide(rows: DataFrame) -> DataFrame:
    """The rows that are not alone with their digit, with ``settled`` (every window is repeated)
    and ``first`` (it stands for all that have the same bytes). Deletes rows.

    rows: _k1, _k2, pos, lo, a, b, i (digit), u1, u2 (all bytes of the range). The counts are written
    before they are joined, and a digit or class that very many share is dealt among tasks.
    """
    total = rows.count()
    again = written(rows.groupBy("i", "lo").count().filter("count > 1"), "digits")
    alive = written(split_join(rows, again, ["i", "lo"], "inner", total), "alive")
    deleted(rows, again)
    classes = written(
        alive.groupBy("u1", "u2", "lo")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_k1", "_k2", "pos")).alias("least"))
        .filter("n > 1"),
        "classes",
    )
    both = split_join(alive, classes, ["u1", "u2", "lo"], "left", alive.count(), "n")
    decided = both.select(
        "_k1", "_k2", "pos", "lo", "a", "b", "i", "count",
        F.col("n").isNotNull().alias("settled"),
        F.coalesce(F.col("least") == F.struct("_k1", "_k2", "pos"), F.lit(False)).alias("first"),
    )
    decided = written(decided, "decided")
    deleted(alive, classes)
    return decided


def _left(decided: DataFrame) -> DataFrame:
    """What the next pass has to compare: unsettled ranges, and one of each settled class that they
    share a digit with."""
    loose = decided.filter("NOT settled").select("_k1", "_k2", "pos", "lo", "i", "count")
    firsts = decided.filter("settled AND first").select("_k1", "_k2", "pos", "lo", "i")
    digits = loose.groupBy("i", "lo").agg(F.max("count").alias("count"))
    near = split_join(firsts, digits, ["i", "lo"], "left_semi", decided.count())
    return loose.select("_k1", "_k2", "pos", "lo").unionByName(near.select("_k1", "_k2", "pos", "lo"))


def _surroundings(docs: DataFrame, left: DataFrame, window: int, gram: int) -> DataFrame:
    """The bytes around each anchor that is left, cut at the ends of its text."""
    reach = window - gram
    by_doc = left.groupBy("_k1", "_k2").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    wanted = written(by_doc, "anchors-left")
    # an equal row repeats all surroundings of its twin; one of them is enough
    texts = docs.join(hashed(wanted), ["_k1", "_k2"])

    def run(batches):
        for b in batches:
            chars, at = utf8(b.column("text"))
            out: list[list] = [[], [], [], [], [], []]
            k1, k2 = b.column("_k1").to_pylist(), b.column("_k2").to_pylist()
            for r, places in enumerate(b.column("at").to_pylist()):
                text = chars[at[r] : at[r + 1]].tobytes()
                for p in places:
                    around = text[max(0, p - reach) : p + window]
                    before = min(p, reach)
                    row = (k1[r], k2[r], p, around, before, len(around) - before)
                    for x, y in zip(out, row):
                        x.append(y)
                if len(out[0]) > 5_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names)
                    out = [[], [], [], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names)

    names = ["_k1", "_k2", "pos", "around", "before", "after"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32()]
    return texts.select("_k1", "_k2", "text", "at").mapInArrow(
        lean(run), "_k1 long, _k2 long, pos int, around binary, before int, after int"
    )


def _cut(left: DataFrame, around: DataFrame, wide: int, width: int, window: int, gram: int):
    """Rows of the next pass: every range of ``wide`` offsets that is left, in parts of ``width``."""
    reach = window - gram
    nodes = left.groupBy("_k1", "_k2", "pos").agg(F.collect_set("lo").alias("nodes"))
    rows = around.join(nodes, ["_k1", "_k2", "pos"])

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                m = b.num_rows
                before = b.column("before").to_numpy(zero_copy_only=False)
                after = b.column("after").to_numpy(zero_copy_only=False)
                data = np.zeros((m, reach + window), np.uint8)
                for r, x in enumerate(b.column("around").to_pylist()):
                    data[r, reach - before[r] : reach + after[r]] = np.frombuffer(x, np.uint8)
                first, second = _Hashes(data, _BASES[0]), _Hashes(data, _BASES[1])
                lists = b.column("nodes")
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = np.diff(lists.offsets.to_numpy())
                row = np.repeat(np.arange(m), sizes)
                lo = (flat[:, None] + np.arange(0, wide, width)).ravel()
                row = np.repeat(row, wide // width)
                hi = np.minimum(lo + width - 1, reach)
                a = np.maximum(lo, window - after[row])
                c = np.minimum(hi, before[row])
                ok = (lo <= reach) & (a <= c)
                row, lo, hi, a, c = row[ok], lo[ok], hi[ok], a[ok], c[ok]
                digit = first.of(reach - lo, reach - hi + window, row).view(np.int64)
                span = a * (reach + 1) + c
                u1 = _fold(first.of(reach - c, reach - a + window, row), span)
                u2 = _fold(second.of(reach - c, reach - a + window, row), span)
                picked = b.select(["_k1", "_k2", "pos"]).take(pa.array(row))
                ints = [pa.array(x.astype(np.int32)) for x in (lo, a, c)]
                longs = [pa.array(x) for x in (digit, u1, u2)]
                yield pa.RecordBatch.from_arrays(
                    [*picked.columns, *ints, *longs],
                    ["_k1", "_k2", "pos", "lo", "a", "b", "i", "u1", "u2"],
                )

    return rows.mapInArrow(lean(run), ROWS)


ROWS = "_k1 long, _k2 long, pos int, lo int, a int, b int, i long, u1 long, u2 long"


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """_k1, _k2 (the key of a row's id and text) and its spans: array of (start, end) in bytes, the
    maximal runs in order. Texts without a repeated window have no row.
    """
    if not 0 < gram < window:
        raise ValueError("the gram must be shorter than the window")
    plain, (doc, body) = renamed(docs, id_col, text_col)
    texts = _keyed(plain, doc, body).select("_k1", "_k2", F.coalesce(body, F.lit("")).alias("text"))

    def scan(batches):
        for b in batches:
            chars, at = utf8(b.column("text"))
            for row, pos, digit, u1, u2, left, right in _scan(chars, at, window, gram):
                keys = b.select(["_k1", "_k2"]).take(pa.array(row))
                zero = np.zeros(len(row), np.int32)
                ints = [pa.array(x.astype(np.int32)) for x in (pos, zero, window - right, left)]
                longs = [pa.array(x) for x in (digit, u1, u2)]
                yield pa.RecordBatch.from_arrays(
                    [*keys.columns, *ints, *longs],
                    ["_k1", "_k2", "pos", "lo", "a", "b", "i", "u1", "u2"],
                )

    rows = written(texts.mapInArrow(lean(scan), ROWS), "anchors")
    around, found, wide, tables = None, None, BRANCH, []
    while wide < window - gram + 1:
        wide *= BRANCH
    while True:
        decided = _decide(rows)
        tables.append(decided)
        spans = decided.filter("settled").select(
            "_k1", "_k2", (F.col("pos") - F.col("b")).alias("start"),
            (F.col("pos") - F.col("a") + window).alias("end"),
        )
        found = spans if found is None else found.unionByName(spans)
        if wide == 1:
            break
        left = written(_left(decided), "left")
        if around is None:
            around = written(_surroundings(texts, left, window, gram), "around")
        width = wide // BRANCH
        rows = written(_cut(left, around, wide, width, window, gram), "ranges")
        deleted(left)
        wide = width
    span = F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    by_text = found.groupBy("_k1", "_k2").agg(F.collect_set(span).alias("_spans"))

    def run(batches):
        for b in batches:
            cut = [merged([(s["start"], s["end"]) for s in x]) for x in b.column("_spans").to_pylist()]
            cut = [[{"start": x, "end": y} for x, y in c] for c in cut]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:2], pa.array(cut, b.schema.field("_spans").type)], b.schema.names
            )

    spans = written(by_text.mapInArrow(lean(run), by_text.schema), "spans")
    deleted(around, *tables)
    return spans


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps; touching spans become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """text without the given merged spans."""
    cuts = [0, *(x for s in spans for x in s), len(text)]
    return b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2]))


def whole_chars(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without the parts of code points at their ends: what is left stays UTF-8."""
    out = []
    for a, b in spans:
        while a < len(text) and text[a] & 0xC0 == 0x80:
            a += 1
        while b < len(text) and b > a and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def with_spans(
    docs: DataFrame, more: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", **how
) -> DataFrame:
    """All rows and columns of docs, and last the spans (null: nothing is repeated). The columns are named
    by place: c0, c1, ... ``more``: other spans of the same texts, which are added as they are."""
    rows, (doc, text) = renamed(docs, id_col, text_col)
    spans = repeated_spans(rows, doc, text, **how)
    if more is not None:
        both = spans.unionByName(more).groupBy("_k1", "_k2")
        spans = written(both.agg(F.flatten(F.collect_list("_spans")).alias("_spans")), "all-spans")
    keyed = _keyed(rows, doc, text)
    return keyed.join(hashed(spans), ["_k1", "_k2"], "left").select(
        *rows.columns, "_spans"
    )


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """id, n_bytes, n_removed, n_spans (maximal runs) and kept (bytes) of every row."""
    rows = with_spans(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), id_col="id", **how)
    rows = rows.toDF("id", "text", "_spans")

    def run(batches):
        for b in batches:
            chars, at = utf8(b.column("text"))
            n_removed, n_spans, kept = [], [], []
            for r, spans in enumerate(b.column("_spans").to_pylist()):
                text = chars[at[r] : at[r + 1]].tobytes()
                cut = [(s["start"], s["end"]) for s in spans or ()]
                n_removed.append(sum(y - x for x, y in cut))
                n_spans.append(len(cut))
                kept.append(kept_bytes(text, cut))
            cols = [pa.array(np.diff(at)), *(pa.array(x, pa.int64()) for x in (n_removed, n_spans))]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *cols, pa.array(kept, pa.binary())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    schema = rows.select("id").schema
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, "long")
    return rows.mapInArrow(lean(run), schema.add("kept", "binary"))


def without_repeats(
    docs: DataFrame,
    text_col: str = "text",
    more: DataFrame | None = None,
    id_col: str = "doc_id",
    **how,
) -> DataFrame:
    """docs with its texts cut; partly covered code points stay, so the texts stay UTF-8."""
    rows = with_spans(docs, more, id_col, text_col, **how)
    place, names = docs.columns.index(text_col), docs.columns

    def run(batches):
        for b in batches:
            chars, at = utf8(b.column(place))
            null = b.column(place).is_null().to_pylist()
            out = []
            for r, spans in enumerate(b.column(b.num_columns - 1).to_pylist()):
                text = chars[at[r] : at[r + 1]].tobytes()
                cut = whole_chars(text, merged([(s["start"], s["end"]) for s in spans or ()]))
                out.append(None if null[r] else kept_bytes(text, cut).decode())
            columns = list(b.columns[:-1])
            columns[place] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(lean(run), T.StructType(docs.schema.fields))
