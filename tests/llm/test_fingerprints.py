"""Fingerprints, successors and the block tables against plain loops."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from girder.llm import fingerprints as op


def brute_tokens(text):
    tokens, run = [], ""
    for c in text + " ":
        if "!" <= c <= "\u2fff" and len(run) < op.LONGEST:
            run += c
            continue
        if run:
            tokens.append(run)
        run = c if "!" <= c <= "\u2fff" else ""
        if c > "\u2fff":
            tokens.append(c)
    return tokens or [""]


def brute_fp(text):
    tokens = brute_tokens(text)
    votes, total = [0] * 64, 0
    for a, b, c in zip(tokens, [*tokens[1:], None], [*tokens[2:], None, None]):
        if a == b == c:
            continue
        h = xxhash.xxh64_intdigest(a.encode(), 42)
        h = h if b is None else xxhash.xxh64_intdigest(b.encode(), h)
        total += 1
        for k in range(64):
            votes[k] += h >> k & 1
    fp = sum(1 << k for k in range(64) if 2 * votes[k] > total)
    return fp - (1 << 64) if fp >> 63 else fp


def make_texts(n):
    rng = random.Random(4)
    words = ["épée", "a", "a a a", "stone", "🙂x", "long-winded", "", "b\nc", "\x01\u3000\u00a0", "漢字かな", "x" * 40]
    return [" ".join(rng.choices(words, k=rng.choice([3, 30, 120]))) for _ in range(n)]


@pytest.mark.parametrize("bucket_rows", [1, 7, 1000])
def test_against_loops(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(op, "BUCKET_ROWS", bucket_rows)
    texts = [None, *make_texts(40), "same", "same", ""]
    ids = random.Random(9).sample(range(-500, 10**9), len(texts))
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").withColumn(
        "fp", F.lit("clash")
    )
    got = {r.id: r for r in op.edited_fingerprints(df).collect()}
    order = sorted(zip(ids, texts), reverse=True)
    assert len(got) == len(order)
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        cut = len(t) // 3
        edited = t[: len(t) - cut] + after[:cut]
        r = got[i]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.fp, r.edited_fp, r.next_fp) == (brute_fp(t), brute_fp(edited), brute_fp(after))


def test_many_parts_of_a_quantile(spark, monkeypatch):
    monkeypatch.setattr(op, "BUCKET_ROWS", 2)
    monkeypatch.setattr(op, "QUANTILES", 3)
    texts = make_texts(60)
    ids = [1, 2, 3, *range(1000, 1050), 10**12, 10**12 + 1, -5, -6, 7, 8, 9][: len(texts)]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = {r.id: r.next_fp for r in op.edited_fingerprints(df).collect()}
    order = sorted(zip(ids, texts), reverse=True)
    assert got == {i: brute_fp(b) for (i, _), (_, b) in zip(order, order[1:] + order[:1])}


def test_odd_tables(spark):
    df = spark.createDataFrame([(7, "only one")], "doc_id long, text string")
    (row,) = op.edited_fingerprints(df).collect()
    assert row.fp == row.next_fp
    assert op.edited_fingerprints(df.limit(0)).collect() == []
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, None), (2, "d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = op.edited_fingerprints(df).collect()
    assert sorted((r.id or 0, r.fp) for r in got) == sorted(
        (i or 0, brute_fp(t or "")) for i, t in rows
    )


@pytest.mark.parametrize("radius", [0, 1, 3, 6])
def test_block_tables_find_all(spark, radius):
    rng = random.Random(radius)
    fps = []
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(5):
            x = base
            for _ in range(rng.randint(0, 8)):
                x ^= 1 << rng.randrange(64)
            fps.append(x - (1 << 64) if x >> 63 else x)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    some = df.filter("fp % 3 = 0")
    got = {(r.fp, r.other, r.distance) for r in op.within(some, df, radius).collect()}
    mask = (1 << 64) - 1
    asked = [r.fp for r in some.collect()]
    want = {(a, b, ((a ^ b) & mask).bit_count()) for a in asked for b in fps}
    assert got == {x for x in want if x[2] <= radius}


def bits(a, b):
    return ((a ^ b) & ((1 << 64) - 1)).bit_count()


def test_one_kind_of_term_at_every_length(spark):
    """Lengths around 256 characters, one long text without spaces, and a very long one."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    base = " ".join(word() for _ in range(43))
    kana = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(600))
    solid = "".join(rng.choices("abcdefgh", k=800))
    texts = [base[:k] for k in (254, 255, 256, 257)]
    texts += [kana, kana[:300] + "新" + kana[300:], solid, solid[:400] + "!" + solid[401:]]
    texts += [" ".join(word() for _ in range(200_000)), "no " * 5000 + base, base]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.fp for r in op.edited_fingerprints(df).collect()}
    assert got == {i: brute_fp(t) for i, t in enumerate(texts)}
    assert all(bits(got[a], got[b]) <= 8 for a, b in [(0, 1), (1, 2), (2, 3), (4, 5), (6, 7), (9, 10)])
    assert bits(got[3], got[4]) > 15 and bits(got[6], got[8]) > 15


@pytest.mark.parametrize("equal", [False, True])
def test_an_id_that_a_third_of_all_rows_share(spark, monkeypatch, equal):
    monkeypatch.setattr(op, "BUCKET_ROWS", 5)
    text = lambda i: "same text" if equal else f"text {i} of many"
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, text(i)) for i in range(180)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    dealt = op._bucketed(df, "doc_id", "text").groupBy("bucket").count().collect()
    assert max(r["count"] for r in dealt) <= 20
    got = op.edited_fingerprints(df).collect()
    assert sorted((r.id or -1, r.fp) for r in got) == sorted((i or -1, brute_fp(t)) for i, t in rows)
    assert sorted(r.next_fp for r in got) == sorted(brute_fp(t) for _, t in rows)


@pytest.mark.parametrize("limit", [2, 512])
def test_counts_within(spark, monkeypatch, limit):
    monkeypatch.setattr(op, "LIST_LIMIT", limit)
    monkeypatch.setattr(op.within, "__defaults__", (op.RADIUS, limit))
    rng = random.Random(limit)
    fps = [0, 0, 0]
    for _ in range(60):
        x = 0
        for _ in range(rng.randint(0, 6)):
            x ^= 1 << rng.randrange(64)
        fps.append(x - (1 << 64) if x >> 63 else x)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {r.fp: r.n_within for r in op.counts_within(df, df.filter("fp % 2 = 0")).collect()}
    assert got == {a: sum(bits(a, b) <= 3 for b in fps) for a in set(fps) if a % 2 == 0}


def test_query_likeness(spark):
    import math

    from girder.llm import registry

    sf_dir = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    order = sorted(((r.doc_id, r.text or "") for r in rows), reverse=True)
    mask = (1 << 64) - 1
    fp = {i: brute_fp(t) & mask for i, t in order}
    got = {r.doc_id: r for r in registry.op10_document_fingerprints(spark, sf_dir).collect()}
    assert len(got) == len(order)
    like = lambda a, b: max(0.0, math.cos(math.pi / 64 * bits(a, b)))
    better = 0
    for (i, t), (j, after) in zip(order, order[1:] + order[:1]):
        cut = len(t) // 3
        edited = t[: len(t) - cut] + after[:cut]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == f"{fp[i]:016x}" and r.edited_fingerprint == f"{brute_fp(edited) & mask:016x}"
        assert abs(r.near_edited - like(fp[i], brute_fp(edited))) < 1e-9
        assert abs(r.near_next - like(fp[i], fp[j])) < 1e-9
        near = sum(bits(fp[i], x) <= 3 for x in fp.values()) if i % 20 == 0 else None
        assert r.n_within == near
        better += r.near_edited > r.near_next or t == after
    assert better >= 0.99 * len(order)
