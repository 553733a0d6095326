"""Benchmark decontamination by spaced-seed hashing.

Texts become word hashes. A mask picks some of the words of a window and ignores the others; the words
that it picks are hashed together. The masks are chosen so that however the allowed share of a window
is substituted, some mask at some shift picks none of the substituted words: a window that is similar enough is
always hit. Hashes of the benchmark and of the training texts are joined; around each hit the two texts
are laid side by side and the overlap is verified, tolerant of substitutions.

A training text is contaminated by an item if ``WINDOW`` words in a row (all words of a shorter item)
agree with it in a share of ``SIMILARITY`` at least; items of fewer than five words must so be met word for
word. Items are searched from ``MIN_WORDS`` words on, so all that have a word; who deems short ones to
be chance leaves them out of the benchmark.

The training side is filtered by a bitmap of the benchmark's hashes before the join. The bitmap goes
out only if the benchmark has at most ``BITMAP_HASHES`` hashes, a counted bound; beyond, all hashes
meet in the join. Only the words around hits leave the scan. The benchmark's seeds and words are broadcast
if their bytes, counted, are few; beyond, hits meet them in a shuffled join in which seeds and items that very
many documents hit are dealt among tasks.

Defined results. Null or empty text on either side: no overlap. Words are runs of ASCII letters and
digits and of any other characters beyond ASCII; A to Z count as lower case. Repeated items each
give a row; repeated documents share one. Of several overlaps with an item the widest is told, of equally
wide ones that with the most matches, then the first. Null ids are kept. Texts are read whole, a very long
one in a round of its own, and only what is around its hits is kept. Extra columns pass through ``clean``
under any names; an empty benchmark or table gives an empty result.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from girder.llm.common import anti, fits, lean, renamed, rounds, split_join, utf8, written
from girder.llm.repeats import _BASES, _Hashes, _keyed

WINDOW = 12
SIMILARITY = 0.8
MIN_WORDS = 1
BITMAP_HASHES = 4_000_000
ROUND = 1 << 18

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def needed(length: int, similarity: float = SIMILARITY) -> int:
    """Words that must agree in a window."""
    return int(np.ceil(similarity * length - 1e-9))


@cache
def masks(length: int, similarity: float = SIMILARITY) -> tuple[tuple[int, ...], ...]:
    """Word offsets of masks of which one, somewhere in the window, always avoids the substitutions."""
    errors = length - needed(length, similarity)
    bad = set(combinations(range(length), errors))
    weight = min(6, max(2, length // (errors + 1) + 1)) if errors else min(6, length)
    chosen: list[tuple[int, ...]] = []
    while bad:
        best, hit = None, set()
        for rest in combinations(range(1, length), weight - 1):
            mask = (0, *rest)
            found = set()
            for shift in range(length - mask[-1]):
                at = {shift + o for o in mask}
                found |= {b for b in bad if at.isdisjoint(b)}
            if len(found) > len(hit):
                best, hit = mask, found
        if best is None:
            weight -= 1
            continue
        chosen.append(best)
        bad -= hit
    return tuple(chosen)


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts data[at[i]:at[i + 1]], and the text it is in."""
    word = np.append(_WORD[data], False)
    breaks = np.zeros(len(data) + 1, bool)
    breaks[at] = True
    before = np.concatenate(([False], word[:-1])) & ~breaks
    starts = np.flatnonzero(word & ~before)
    after = np.append(word[1:], False)
    after[:-1] &= ~breaks[1:]
    ends = np.flatnonzero(word & ~after) + 1
    hashes = _Hashes(_LOWER[data], _BASES[0])
    owner = np.searchsorted(at, starts, "right") - 1
    return hashes.of(starts, ends), owner


def seeds(hashes: np.ndarray, owner: np.ndarray, mask: tuple[int, ...], which: int):
    """(position, hash) of a mask at every place where all its span is in one text."""
    n = len(hashes) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n, 0x9E37 * (which + 1), np.uint64)
    for o in mask:
        total = (total ^ hashes[o : o + n]) * np.uint64(0xD6E8FEB86659FD93)
        total ^= total >> np.uint64(32)
    at = np.flatnonzero(owner[:n] == owner[mask[-1] : mask[-1] + n])
    return at, total[at]


def _bitmap(hashes: np.ndarray) -> tuple[np.ndarray, int]:
    bits = max(22, min(28, int(64 * max(1, len(hashes))).bit_length()))
    table = np.zeros(1 << (bits - 3), np.uint8)
    for h in _probes(hashes, bits):
        np.bitwise_or.at(table, (h >> 3).astype(np.int64), (1 << (h & np.uint64(7))).astype(np.uint8))
    return table, bits


def _probes(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [hashes >> np.uint64(64 - bits), hashes & np.uint64((1 << bits) - 1)]


def _kept(hashes: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    at = np.arange(len(hashes))
    for k in range(2):
        h = _probes(hashes[at], bits)[k]
        on = table[(h >> np.uint64(3)).astype(np.int64)] >> (h & np.uint64(7)).astype(np.uint8) & 1
        at = at[on.astype(bool)]
    return at


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item, row, tokens of each item with enough words."""
    kept = benchmark.select(F.col(id_col).alias("item"), F.col(text_col).alias("text"))
    schema = kept.select("item").schema.add("tokens", "binary").add("n", "integer")

    def run(batches):
        for b in batches:
            chars, at = utf8(b.column("text"))
            hashes, owner = words(chars, at)
            cuts = np.searchsorted(owner, np.arange(b.num_rows + 1))
            tokens = [hashes[x:y].tobytes() for x, y in zip(cuts, cuts[1:])]
            sizes = pa.array(np.diff(cuts).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("item"), pa.array(tokens, pa.binary()), sizes], schema.names
            )

    rows = kept.mapInArrow(lean(run), schema).filter(F.col("n") >= MIN_WORDS)
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "items")


def _seed_rows(items: DataFrame, used: dict[int, list[int]], all_masks: list) -> DataFrame:
    """row, place, seed: the hashes of each item under the masks for its length."""

    def run(batches):
        for b in batches:
            rows, places, out = [], [], []
            for row, t in zip(b.column("row").to_pylist(), b.column("tokens").to_pylist()):
                tokens = np.frombuffer(t, np.uint64)
                owner = np.zeros(len(tokens), np.int32)
                for k in used[min(WINDOW, len(tokens))]:
                    at, h = seeds(tokens, owner, all_masks[k], k)
                    rows.append(np.full(len(at), row))
                    places.append(at)
                    out.append(h)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(rows).astype(np.int64)),
                        pa.array(np.concatenate(places).astype(np.int32)),
                        pa.array(np.concatenate(out).view(np.int64)),
                    ],
                    ["row", "place", "seed"],
                )

    return items.select("row", "tokens").mapInArrow(lean(run), "row long, place int, seed long")


def _regions(docs: DataFrame, all_masks: list, longest: int, bitmap) -> DataFrame:
    """_k1, _k2, id, first, tokens, hits: the words around the hits of a text, and the hits in them."""
    schema = docs.select("_k1", "_k2", "id").schema
    schema = schema.add("first", "integer").add("tokens", "binary")
    schema = schema.add("places", "binary").add("seeds", "binary")

    def run(batches):
        for b in batches:
            chars, at = utf8(b.column("text"))
            rows, columns = [], [[], [], [], []]
            for i, j in rounds(at, ROUND):
                part = at[i : j + 1] - at[i]
                hashes, owner = words(chars[at[i] : at[j]], part)
                found = []
                for k, mask in enumerate(all_masks):
                    where, h = seeds(hashes, owner, mask, k)
                    if bitmap is not None:
                        some = _kept(h, *bitmap.value)
                        where, h = where[some], h[some]
                    found.append((where, h))
                where = np.concatenate([w for w, _ in found])
                if not len(where):
                    continue
                order = np.argsort(where, kind="stable")
                where, h = where[order], np.concatenate([x for _, x in found])[order]
                starts = np.searchsorted(owner, np.arange(j - i + 1))
                mine = owner[where]
                low = np.maximum(where - longest, starts[mine])
                high = np.minimum(where + longest + WINDOW, starts[mine + 1])
                new = np.concatenate(([True], (low[1:] > high[:-1]) | (mine[1:] != mine[:-1])))
                cuts = np.append(np.flatnonzero(new), len(where))
                for x, y in zip(cuts, cuts[1:]):
                    a, z = int(low[x]), int(high[x:y].max())
                    rows.append(i + int(mine[x]))
                    columns[0].append(a - int(starts[mine[x]]))
                    columns[1].append(hashes[a:z].tobytes())
                    columns[2].append((where[x:y] - a).astype(np.int32).tobytes())
                    columns[3].append(h[x:y].tobytes())
            if rows:
                kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                picked = b.select(["_k1", "_k2", "id"]).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*picked.columns, *(pa.array(c, t) for c, t in zip(columns, kinds))],
                    schema.names,
                )

    return docs.mapInArrow(lean(run), schema)


def _hit_rows(regions: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            places = [np.frombuffer(x, np.int32) for x in b.column("places").to_pylist()]
            found = [np.frombuffer(x, np.int64) for x in b.column("seeds").to_pylist()]
            if not places:
                continue
            row = np.repeat(np.arange(len(places)), [len(p) for p in places])
            picked = b.select(["_k1", "_k2", "first"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array(np.concatenate(places)), pa.array(np.concatenate(found))],
                ["_k1", "_k2", "first", "at", "seed"],
            )

    return regions.select("_k1", "_k2", "first", "places", "seeds").mapInArrow(
        lean(run), "_k1 long, _k2 long, first int, at int, seed long"
    )


def overlap(
    text: np.ndarray, item: np.ndarray, shift: int, similarity: float = SIMILARITY
) -> tuple[int, int, int] | None:
    """(start, end, matches) in the text of the widest run of similar windows; None if there is none.

    item[k] lies beside text[shift + k]. The window is WINDOW words, or the whole of a shorter item.
    """
    window = min(WINDOW, len(item))
    a, b = max(0, -shift), min(len(item), len(text) - shift)
    if b - a < window:
        return None
    same = np.concatenate(([0], np.cumsum(text[shift + a : shift + b] == item[a:b])))
    good = np.flatnonzero(same[window:] - same[:-window] >= needed(window, similarity))
    if not len(good):
        return None
    groups = np.split(good, np.flatnonzero(np.diff(good) > window) + 1)
    first, last = max(((g[0], g[-1] + window) for g in groups), key=lambda s: s[1] - s[0])
    return shift + a + int(first), shift + a + int(last), int(same[last] - same[first])


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """_k1, _k2 (the document's key), id, item, start, end (words of the document), matches, similarity.

    One row for each document text and item that overlap, the widest overlap.
    """
    items = _items(benchmark, item_col, item_text_col)
    lengths = sorted({min(WINDOW, r["n"]) for r in items.select(F.least("n", F.lit(WINDOW)).alias("n")).distinct().collect()})
    all_masks = sorted({m for n in lengths for m in masks(n)})
    used = {n: [all_masks.index(m) for m in masks(n)] for n in lengths}
    longest = items.agg(F.max("n")).collect()[0][0] or 0
    planted = written(_seed_rows(items, used, all_masks), "seeds")
    spark = docs.sparkSession
    bitmap = None
    if planted.count() <= BITMAP_HASHES:
        seen = planted.select("seed").distinct().toArrow().column(0).to_numpy().view(np.uint64)
        bitmap = spark.sparkContext.broadcast(_bitmap(seen))
    keyed = _keyed(docs, id_col, text_col).select(
        "_k1", "_k2", F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    if not all_masks:
        keyed = keyed.limit(0)
    regions = written(_regions(keyed, all_masks or [(0,)], longest, bitmap), "regions")
    hits = _hit_rows(regions)
    if fits(planted):
        seeded = hits.join(F.broadcast(planted), "seed")
    else:
        sizes = hits.groupBy("seed").count()
        lists = planted.groupBy("seed").agg(F.collect_list(F.struct("row", "place")).alias("in"))
        side = written(lists.join(sizes, "seed"), "seed-lists")
        seeded = split_join(hits, side, ["seed"], "inner", hits.count()).select("*", F.inline("in"))
    pairs = seeded.select("_k1", "_k2", "first", "row", (F.col("at") - F.col("place")).alias("shift")).distinct()
    texts = regions.select("_k1", "_k2", "id", "first", "tokens").dropDuplicates(["_k1", "_k2", "first"])
    tokens = items.select("row", "item", F.col("tokens").alias("item_tokens"))
    laid = pairs.join(texts, ["_k1", "_k2", "first"])
    if fits(tokens, F.octet_length("item_tokens")):
        beside = laid.join(F.broadcast(tokens), "row")
    else:
        pairs = written(pairs, "pairs")
        side = written(tokens.join(pairs.groupBy("row").count(), "row"), "items-hit")
        laid = pairs.join(texts, ["_k1", "_k2", "first"])
        beside = split_join(laid, side, ["row"], "inner", pairs.count())
    schema = beside.select("_k1", "_k2", "id", "item").schema
    for name in ("start", "end", "matches"):
        schema = schema.add(name, "integer")

    def verify(batches):
        for b in batches:
            rows, out = [], [[], [], []]
            names = ("first", "shift", "tokens", "item_tokens")
            for r, (first, shift, t, item) in enumerate(zip(*(b.column(c).to_pylist() for c in names))):
                found = overlap(np.frombuffer(t, np.uint64), np.frombuffer(item, np.uint64), shift)
                if found is not None:
                    rows.append(r)
                    for c, x in zip(out, (first + found[0], first + found[1], found[2])):
                        c.append(x)
            picked = b.select(["_k1", "_k2", "id", "item"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, *(pa.array(c, pa.int32()) for c in out)], schema.names
            )

    best = F.max_by(
        F.struct("start", "end", "matches"),
        F.struct(F.col("end") - F.col("start"), "matches", -F.col("start")),
    )
    found = beside.mapInArrow(lean(verify), schema).groupBy("_k1", "_k2", "id", "item").agg(best.alias("o"))
    share = F.col("o.matches") / (F.col("o.end") - F.col("o.start"))
    return found.select("_k1", "_k2", "id", "item", "o.*", share.alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The rows of docs that no item contaminates, with their columns."""
    found = written(overlaps(docs, benchmark, id_col, **how).select("_k1", "_k2").distinct(), "leaks")
    plain, (doc, body) = renamed(docs, id_col, how.get("text_col", "text"))
    return anti(_keyed(plain, doc, body), found).select(*plain.columns).toDF(*docs.columns)
