"""SimHash links against brute force over all pairs."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from girder.llm import simhash_links as op


def brute_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("list_limit", [2, 32])
def test_links_close_like_all_pairs(spark, list_limit):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = set(base)
    for b in base[:4]:
        for _ in range(60):
            x = b
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = [signed(x) for x in fps]
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = [(r.a, r.b) for r in op.links(df, list_limit=list_limit).collect()]
    mask = (1 << 64) - 1
    want = [
        (a, b) for a in fps for b in fps if a < b and ((a ^ b) & mask).bit_count() <= op.RADIUS
    ]
    assert set(got) <= set(want)
    assert closure(got, fps) == closure(want, fps)


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "gamma", "épée", "DELTA", "x"]
    texts = [None, "", " \t\n", "One", "one", "a b", "a  b c", "é" * 3000 + " Z z"]
    for _ in range(40):
        t = " ".join(rng.choices(vocabulary, k=rng.randint(1, 60)))
        texts += [t, t.upper(), t + " x"] if rng.random() < 0.3 else [t]
    rows = [(i, t, "clash", 1, None) for i, t in enumerate(texts)] + [(3, "One", "r", 2, None)]
    df = spark.createDataFrame(
        rows, "doc_id long, text string, fp string, component_id int, id string"
    )
    got = {(r.doc_id, r.fp, r.component_id) for r in op.near_duplicates(df).collect()}
    fps = {i: brute_fp(t) for i, t in enumerate(texts)}
    pairs = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    roots = closure(pairs, list(fps))
    assert got == {(i, signed(fps[i]), roots[i]) for i in fps}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op.near_duplicates(df).collect() == []


def test_long_path_is_one_component(spark):
    from girder.llm.components import connected_components

    edges = spark.range(0, 700).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = connected_components(edges).collect()
    assert len(got) == 701 and {r.component for r in got} == {0}
