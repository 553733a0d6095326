"""Decontamination against brute force over every alignment."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from girder.llm import common
from girder.llm import decontaminate as op


def brute(doc, item):
    split = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())
    d, i = split(doc), split(item)
    if len(i) < op.MIN_WORDS:
        return False
    w = min(op.WINDOW, len(i))
    return any(
        sum(x == y for x, y in zip(d[a : a + w], i[b : b + w])) >= op.needed(w)
        for a in range(len(d) - w + 1)
        for b in range(len(i) - w + 1)
    )


@pytest.mark.parametrize("length", range(1, 13))
def test_masks_lose_nothing(length):
    for bad in combinations(range(length), length - op.needed(length)):
        assert any(
            not {s + o for o in m} & set(bad)
            for m in op.masks(length)
            for s in range(length - m[-1])
        )


@pytest.mark.parametrize("bound", [0, 4_000_000])
def test_against_brute_force(spark, monkeypatch, bound):
    """Bound 0: no bitmap, nothing of the benchmark is broadcast, and hot seeds are split."""
    monkeypatch.setattr(op, "BITMAP_HASHES", bound)
    if not bound:
        monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(common, "HOT_KEYS", 20)
    rng = random.Random(8)
    vocabulary = ["w%d" % k for k in range(30)] + ["Épée", "the", "of"]
    make = lambda n: rng.choices(vocabulary, k=n)
    items = [make(n) for n in (3, 5, 6, 8, 11, 12, 13, 20, 40, 20)] + [[]]
    items += [["rare", "pair"], ["lonely"], ["four", "w1", "w2", "rare"]]
    items.append(items[7])
    vocabulary.append("lonely")
    docs = [None, "", "one"]
    for _ in range(120):
        item = list(rng.choice(items[:-1]))
        for _ in range(rng.randint(0, 5)):
            if item:
                item[rng.randrange(len(item))] = "sub%d" % rng.randrange(5)
        cut = item[: rng.randint(0, len(item))] if rng.random() < 0.3 else item
        sep = rng.choice([" ", ", ", "\n"])
        text = sep.join(make(rng.randint(0, 30)) + cut + make(rng.randint(0, 30)))
        docs.append(text.upper() if rng.random() < 0.1 and text.isascii() else text)
    texts = [" ".join(i) for i in items] + [None]
    benchmark = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = [(i % 100, t, "clash", 0) for i, t in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, item string, first int")
    got = {(r.id, r.item) for r in op.overlaps(df, benchmark).collect()}
    want = {
        (i % 100, k) for i, d in enumerate(docs) for k, t in enumerate(texts) if brute(d, t)
    }
    assert got == want and len(want) > 50
    kept = op.clean(df, benchmark)
    assert kept.columns == df.columns
    clean = [(i % 100, d) for i, d in enumerate(docs) if not any(brute(d, t) for t in texts)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(clean, key=str)


def test_long_text_ties_and_clashing_columns(spark):
    rng = random.Random(2)
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu"
    noise = " ".join(f"n{rng.randrange(10**6)}" for _ in range(150_000))
    docs = [noise + " " + item + " " + noise, item + " x " + item, noise, None, item]
    rows = [(k, t, k * 10, f"s{k}") for k, t in enumerate(docs)] + [(4, item, 40, "s4")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _k1 long, _key string")
    benchmark = spark.createDataFrame([(1, item), (2, item.upper())], "item_id long, text string")
    got = sorted((r.id, r.item, r.start, r.end, r.matches) for r in op.overlaps(df, benchmark).collect())
    assert got == [(i, k, s, s + 12, 12) for i, s in [(0, 150_000), (1, 0), (4, 0)] for k in (1, 2)]
    kept = sorted(op.clean(df, benchmark).collect())
    assert [tuple(r) for r in kept] == [(2, noise, 20, "s2"), (3, None, 30, "s3")]


def test_query_against_brute_force(spark):
    from girder.llm import registry

    sf_dir = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r for r in registry.op1_decontamination(spark, sf_dir).collect()}
    split = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())
    texts, wanted = {i: split(t) for i, t in docs.items()}, {k: split(t) for k, t in items.items()}
    where = {}
    for i, words in texts.items():
        for at, word in enumerate(words):
            where.setdefault(word, {}).setdefault(i, []).append(at)
    want = {}
    for k, item in wanted.items():
        w = min(op.WINDOW, len(item))
        shifts = {(i, at - b) for b, word in enumerate(item) for i, ats in where.get(word, {}).items() for at in ats}
        for i, shift in shifts:  # every alignment that shares a word at all
            a, z = max(0, -shift), min(len(item), len(texts[i]) - shift)
            same = [texts[i][shift + j] == item[j] for j in range(a, z)]
            if any(sum(same[j : j + w]) >= op.needed(w) for j in range(len(same) - w + 1)):
                found = op.overlap(*(np.array([hash(x) for x in t]) for t in (texts[i], item)), shift)
                want.setdefault((i, k), []).append((found[1] - found[0], found[2]))
    assert got.keys() == want.keys() and len(want) >= 3
    for key, found in want.items():
        assert got[key].overlap_words == max(n for n, _ in found)
        assert got[key].matches == max(found)[1]


def test_empty_sides(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert op.overlaps(docs.limit(0), benchmark).collect() == []
    assert op.overlaps(docs, benchmark.limit(0)).collect() == []
    (row,) = op.overlaps(docs, benchmark).collect()
    assert (row.start, row.end, row.matches, row.similarity) == (0, 7, 7, 1.0)
