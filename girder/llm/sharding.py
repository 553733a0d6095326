"""Shards along a Hilbert curve over metadata, cut to near equal bytes.

Language, source and size are quantised by bytes: the values of a dimension are put in order, and a value's
cell is where the middle of its bytes lies among all bytes. So a dimension takes the whole width of the
curve whether it has four values or millions, and each half of a dimension holds near half of the bytes.
Sources are ordered by name, so those of one site lie together, and sizes by number; languages, few and uneven,
by their bytes, so that the heaviest doesn't share its half of the curve with small ones if it fills it.
The cells are put on a Hilbert curve, documents are sorted by their place on it, and the order is cut into
runs: neighbours on the curve are near in every dimension, so a filter on any of them can skip shards by
what ``manifest`` tells: languages by their names, sources and sizes by ranges. Values are compared whole.

Law ``bytes``: a document counts its UTF-8 bytes plus 1, and a run ends where its share of all bytes is
reached. Equal texts form a group: they take the metadata of the group's first document, so they lie
together on the curve, and a cut that would split a group moves to its nearer end, if that costs at most
``SLACK`` of a shard. A larger group is split, since the law comes first.

The order is one range partitioning on (curve, text, id, row), which splits any group of copies;
positions are running sums of each partition plus the sums of those before it.

Defined results. Null text: size 1. Null language or source: a value before all others. Ties on the curve are
ordered by a hash of the text, then the id (null first), then the place in the table. Repeated rows: each
has its own slot. A text longer than a shard: it is dealt whole, by its middle. An empty table gives an empty
result. Fewer documents than shards: some shards are empty. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from girder.llm.common import fits, lean, split_join, written

SHARDS = 8
CELL_BITS = 5
SLACK = 0.04


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of cells (n x dimensions, each below 2**bits)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the excess work of the curve's turns
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where((x[dims - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            place = place << 1 | (x[i] >> b & 1)
    return place


DIMENSIONS = ("d_lang", "d_source", "d_size")


def _value(name: str) -> Column:
    """A value that isn't null and sorts as the column does, null first."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def _running(rows: DataFrame, order: list[str], weight: str) -> DataFrame:
    """rows with ``index`` and ``at``: how many rows, and what weight, come before each in the order.

    One range partitioning; each partition counts by itself, then adds what the ones before it have.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ranged.select("*").schema.add("part", "integer").add("index", "long").add("at", "long")
    names = schema.names

    def number(batches):
        part, index, at = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            sizes = b.column(weight).to_numpy(zero_copy_only=False)
            ends = at + np.cumsum(sizes)
            more = [
                pa.array(np.full(b.num_rows, part, np.int32)),
                pa.array(index + np.arange(b.num_rows)),
                pa.array(ends - sizes),
            ]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names)
            index += b.num_rows
            at = int(ends[-1]) if b.num_rows else at

    numbered = written(ranged.mapInArrow(lean(number), schema), "ordered")
    # one row for each partition
    sums = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w"))
    offsets, count, size = [], 0, 0
    for r in sorted(sums.collect()):
        offsets.append((r["part"], count, size))
        count, size = count + r["n"], size + r["w"]
    before = rows.sparkSession.createDataFrame(
        offsets, "part int, index_before long, at_before long"
    )
    return numbered.join(F.broadcast(before), "part").select(
        *rows.columns,
        (F.col("index") + F.col("index_before")).alias("index"),
        (F.col("at") + F.col("at_before")).alias("at"),
    )


def _with_cell(rows: DataFrame, base: DataFrame, name: str, total: int, count: int) -> DataFrame:
    """rows, the dimension's value replaced by its cell among those of base."""
    values = base.groupBy(name).agg(F.sum("size").alias("weight"), F.count(F.lit(1)).alias("count"))
    middle = (F.col("at") + F.col("weight") / 2) * (1 << CELL_BITS) / F.lit(max(total, 1))
    cell = F.least(F.floor(middle), F.lit((1 << CELL_BITS) - 1)).cast("int").alias("_cell")
    rank = -F.col("weight") if name == "d_lang" else F.lit(0).cast("long")
    cells = _running(values.withColumn("rank", rank), ["rank", name], "weight")
    cells = written(cells.select(name, cell, "count"), "cells")
    if fits(cells, F.octet_length(F.col(name).cast("string"))):
        met = rows.join(F.broadcast(cells), name)
    else:
        met = split_join(rows, cells, [name], "inner", count)
    return met.drop("count", name).withColumnRenamed("_cell", name)


def shards(
    docs: DataFrame,
    n_shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    slack: float = SLACK,
) -> DataFrame:
    """id, size, crc, lang, source, curve, shard, slot of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    rows = docs.select(
        F.col(id_col).alias("id"),
        size.alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text).alias("hash"),
        F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"),
        _value(lang_col).alias("d_lang"),
        _value(source_col).alias("d_source"),
        size.alias("d_size"),
    )
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "sizes")
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).collect()[0]
    total = total or 0

    # copies take the metadata of their group's first document
    groups = rows.groupBy("hash", "crc", "size").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "row", *DIMENSIONS)).alias("first")
    )
    copied = written(groups.filter("n > 1").select("hash", "crc", "size", "first", "n"), "groups")
    joined = split_join(rows, copied, ["hash", "crc", "size"], "left", count, "n")
    joined = joined.withColumns({d: F.coalesce(f"first.{d}", d) for d in DIMENSIONS}).drop("first", "n")
    base = written(joined, "grouped")
    joined = base
    for d in DIMENSIONS:
        joined = _with_cell(joined, base, d, total, count)
    kept = ["id", "size", "crc", "hash", "lang", "source", "row"]

    def place(batches):
        for b in batches:
            cells = np.stack([b.column(d).to_numpy(zero_copy_only=False) for d in DIMENSIONS], 1)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in kept), pa.array(hilbert(cells, CELL_BITS))], [*kept, "curve"]
            )

    placed = joined.select(*kept, *DIMENSIONS).mapInArrow(
        lean(place), joined.select(*kept).schema.add("curve", "long")
    )
    order = ["curve", "hash", "id", "row"]
    global_rows = _running(placed, order, "size")
    cuts = _cuts(global_rows, total, n_shards, slack)
    middle = F.col("at") + F.col("size") / 2
    shard = sum((F.when(middle > c, 1).otherwise(0) for c in cuts), F.lit(0))
    dealt = global_rows.withColumn("shard", shard.cast("int"))
    firsts = dealt.groupBy("shard").agg(F.min("index").alias("first"))  # n_shards rows at most
    return dealt.join(F.broadcast(firsts), "shard").select(
        "id", "size", "crc", "lang", "source", "curve", "shard",
        (F.col("index") - F.col("first")).alias("slot"),
    )


def _cuts(rows: DataFrame, total: int, n_shards: int, slack: float) -> list[float]:
    """Where the runs end, moved to the end of a group of copies if that is near enough."""
    ideal = [total * k / n_shards for k in range(1, n_shards)]
    if not total:
        return ideal
    inside = [(F.col("at") <= c) & (F.col("at") + F.col("size") > c) for c in ideal]
    on_cut = inside[0] if inside else F.lit(False)
    for x in inside[1:]:
        on_cut = on_cut | x
    hit = rows.filter(on_cut).select("curve", "hash", "crc").distinct()  # a row for each cut at most
    spans = (
        rows.join(F.broadcast(hit), ["curve", "hash", "crc"])
        .groupBy("curve", "hash", "crc")
        .agg(F.min("at").alias("a"), F.max(F.col("at") + F.col("size")).alias("b"))
        .collect()
    )
    out = []
    for c in ideal:
        for r in spans:
            if r["a"] < c < r["b"]:
                near = r["a"] if c - r["a"] <= r["b"] - c else r["b"]
                if abs(near - c) <= slack * total / n_shards:
                    c = near
                break
        out.append(float(c))
    return out


def manifest(dealt: DataFrame) -> DataFrame:
    """Each shard's documents, bytes, languages (few, as a list) and the ranges by which a filter can skip it."""
    return dealt.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("size").alias("n_bytes"),
        F.sort_array(F.collect_set("lang")).alias("langs"),
        *[
            f(c).alias(f"{name}_{c}")
            for c in ("lang", "source", "size", "curve")
            for f, name in ((F.min, "min"), (F.max, "max"))
        ],
    )
