"""Hilbert sharding: the curve, the law, groups and odd rows."""

import random
import zlib
from collections import defaultdict

import xxhash

import numpy as np
import pytest
from pyspark.sql import functions as F

from girder.llm import common
from girder.llm import sharding as op
from girder.llm.common import table


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (3, 3)])
def test_curve_is_one_path(dims, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
    place = op.hilbert(cells, bits)
    assert sorted(place.tolist()) == list(range(side**dims))
    path = cells[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check(rows, texts, n):
    assert sorted((r.id, r.size, r.crc) for r in rows) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts
    )
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
        assert [r.curve for r in sorted(rs, key=lambda r: r.slot)] == sorted(r.curve for r in rs)
    total = sum(r.size for r in rows)
    largest = max(r.size for r in rows)
    for s in range(n):
        got = sum(r.size for r in by[s])
        assert abs(got - total / n) <= 2 * max(op.SLACK * total / n, largest)
    for a in range(n - 1):  # runs of the curve
        if by[a] and by[a + 1]:
            assert max(r.curve for r in by[a]) <= min(r.curve for r in by[a + 1])


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = op.shards(docs).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], 8)
    shards = {}
    for r in rows:
        shards.setdefault((r.crc, r.size), set()).add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) <= 7
    assert op.manifest(op.shards(docs)).agg(F.sum("n_docs")).collect()[0][0] == len(rows)


def test_hot_group_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, "copy " * 20, "en", f"s{i % 5}", None) for i in range(150)]
    rows += [(i, "".join(rng.choices("abc ", k=rng.randint(0, 200))), rng.choice(["de", None, "fr"]), None, 1) for i in range(150, 400)]
    rows += [(400, None, None, None, 1), (400, None, None, None, 1), (400, "x", "en", "s", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size int")
    got = op.shards(df).collect()
    check(got, [(r[0], r[1]) for r in rows], 8)
    assert op.shards(df.limit(0)).collect() == []
    one = op.shards(df.limit(1)).collect()
    assert [(r.id, r.slot) for r in one] == [(0, 0)]


def brute(rows, n=8):
    """The shard and slot of each row (id, text, lang, source), dealt by plain loops."""
    data = [((t or "").encode(), k, i, lang, source) for k, (i, t, lang, source) in enumerate(rows)]
    none_first = lambda x: (x is not None, x if x is not None else 0)
    first = {}
    for text, k, i, lang, source in sorted(data, key=lambda d: (none_first(d[2]), d[1])):
        first.setdefault(text, (lang, source))
    total = sum(len(d[0]) + 1 for d in data)
    dims = []
    for text, *_ in data:
        lang, source = ("" if x is None else "=" + x for x in first[text])
        dims.append((lang.encode(), source.encode(), len(text) + 1))
    cells = np.zeros((len(data), 3), np.int64)
    for k in range(3):
        before, at = {}, 0
        weights = defaultdict(int)
        for d in dims:
            weights[d[k]] += d[2]
        for v, weight in sorted(weights.items(), key=lambda x: (-x[1] if k == 0 else 0, x[0])):
            before[v] = min(int((at + weight / 2) * 32 / total), 31)
            at += weight
        cells[:, k] = [before[d[k]] for d in dims]
    curve = op.hilbert(cells, op.CELL_BITS).tolist()
    signed = lambda t: int(np.uint64(xxhash.xxh64_intdigest(t, 42)).astype(np.int64))
    order = sorted(data, key=lambda d: (curve[d[1]], signed(d[0]), none_first(d[2]), d[1]))
    at, spans, place = 0, {}, {}
    for text, k, *_ in order:
        place[k] = at
        a = spans.get(text, (at, 0))[0]
        at += len(text) + 1
        spans[text] = (a, at)
    cuts = []
    for c in (total * k / n for k in range(1, n)):
        for a, b in spans.values():
            if a < c < b:
                near = a if c - a <= b - c else b
                c = near if abs(near - c) <= op.SLACK * total / n else c
                break
        cuts.append(c)
    out, slots = {}, defaultdict(int)
    for text, k, *_ in order:
        shard = sum(place[k] + (len(text) + 1) / 2 > c for c in cuts)
        out[k] = (shard, slots[shard])
        slots[shard] += 1
    return [out[k] for k in range(len(data))]


def test_against_plain_dealing(spark):
    rng = random.Random(7)
    rows = []
    for i in range(700):
        text = rng.choice([None, "", "copy " * 9, "x" * 5000, *["".join(rng.choices("abcé ", k=rng.randint(0, 300))) for _ in range(12)]])
        rows.append((rng.choice([i, i, i, None]), text, rng.choice(["de", "en", None]), rng.choice(["https://a", "https://b", "https://b/c", "é"])))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)
    got = op.shards(df).collect()
    want = brute(rows)
    key = lambda i, t, lang, source: (i, zlib.crc32((t or "").encode()), lang, source)
    assert sorted(((r.id, r.crc, r.lang, r.source, r.shard, r.slot) for r in got), key=str) == sorted(
        ((*key(*r), *w) for r, w in zip(rows, want)), key=str
    )


@pytest.mark.parametrize("hot_keys", [1000, 10])
def test_filters_skip_shards(spark, monkeypatch, hot_keys):
    """A filter on a language, a source or a size leaves most shards out, by the ranges of the manifest."""
    monkeypatch.setattr(common, "HOT_KEYS", hot_keys)
    monkeypatch.setattr(common, "BROADCAST_BYTES", 8 << 20 if hot_keys == 1000 else 0)
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    dealt = op.shards(docs)
    ranges = op.manifest(dealt).collect()
    total = dealt.agg(F.sum("size")).first()[0]
    for r in dealt.groupBy("lang").agg(F.sum("size").alias("size")).collect():
        reads = sum(r.lang in m.langs for m in ranges)
        assert reads <= max(4, -(-8 * r.size // total) + 1), (r.lang, reads)
    sizes = [r["size"] for r in dealt.select("size").collect()]
    assert sum(sum(m.min_size <= v <= m.max_size for m in ranges) for v in sizes) <= 5 * len(sizes)
    held = dealt.groupBy("source").agg(F.countDistinct("shard").alias("n")).collect()
    assert sum(r.n for r in held) <= 6 * len(held)  # copies lie together, whatever their sources
