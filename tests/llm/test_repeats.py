"""Repeated windows against brute force over all windows."""

import random
from collections import Counter

import pytest

from girder.llm import common
from girder.llm import repeats as op


def brute_spans(texts, window):
    seen = Counter(hash(t[i : i + window]) for t in texts for i in range(len(t) - window + 1))
    return [
        op.merged([(i, i + window) for i in range(len(t) - window + 1) if seen[hash(t[i : i + window])] > 1])
        for t in texts
    ]


def brute(texts, window):
    return [
        (len(t), sum(b - a for a, b in cut), len(cut), op.kept_bytes(t, cut))
        for t, cut in zip(texts, brute_spans(texts, window))
    ]


def cases(rng, window):
    def words(n):
        return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(n))

    passage, edge = words(window // 2), words(window // 3)
    texts = [None, "", "short", words(window), words(window * 2)]
    for _ in range(12):
        texts.append(words(rng.randint(0, 60)) + passage + words(rng.randint(0, 60)))
    for _ in range(4):
        cut = rng.randint(1, len(passage) - 1)
        texts.append(words(20) + passage[:cut] + "#" + passage[cut:])
        texts.append(edge + words(10))
        texts.append(words(10) + edge)
    texts += [passage, passage, "x" * (3 * window), "ab" * window, passage[:window], passage[:window]]
    texts.append(words(30) + passage + words(5) + passage)
    return texts


@pytest.mark.parametrize(
    ("window", "gram", "segment"), [(40, 8, 1 << 20), (60, 16, 150), (400, 64, 1 << 20)]
)
def test_against_brute_force(spark, monkeypatch, window, gram, segment):
    monkeypatch.setattr(op, "SEGMENT", segment)
    texts = cases(random.Random(window), window)
    rows = [(i, t, None, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pos int, id string").coalesce(2)
    got = {
        r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
        for r in op.removed(df, window=window, gram=gram).collect()
    }
    want = brute([(t or "").encode() for t in texts], window)
    assert got == dict(enumerate(want))
    assert sum(w[1] for w in want) > 0


def test_segments_give_the_same_anchors():
    import numpy as np

    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    at = np.array([0, 5000])
    whole = np.concatenate([x[1] for x in op._scan(data, at, 60, 16)])
    op_segment, op.SEGMENT = op.SEGMENT, 150
    try:
        cut = np.concatenate([x[1] for x in op._scan(data, at, 60, 16)])
    finally:
        op.SEGMENT = op_segment
    assert whole.tolist() == cut.tolist()


def test_repeated_rows_null_ids_and_empty_table(spark):
    t = "".join(random.Random(2).choices("abc ", k=90))
    rows = [(1, t), (1, t), (None, t[:50]), (2, "z" + t[:30])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.id or 0, r.n_removed) for r in op.removed(df, window=40, gram=8).collect())
    assert got == [(0, 50), (1, 90), (1, 90), (2, 0)]
    assert op.removed(df.limit(0)).collect() == []


def test_texts_stay_valid(spark):
    a, b = "éa" * 30 + "ç", "ũa" + "éa" * 30 + "è"
    df = spark.createDataFrame([(1, a, 7), (2, b, 8), (3, None, 9)], "doc_id long, text string, k int")
    got = {r.doc_id: (r.text, r.k) for r in op.without_repeats(df, window=40, gram=8).collect()}
    assert got[3] == (None, 9) and set(got) == {1, 2, 3}
    assert "éaéa" not in got[1][0] and got[2][0].startswith("ũ")


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize(("window", "gram"), [(400, 128), (280, 96)])
def test_periodic_texts(spark, window, gram, seed):
    """Anchors stand close together in periodic texts; a window must not be counted twice for them."""
    rng = random.Random(seed)
    texts = []
    for _ in range(10):
        unit = "".join(rng.choices("ab \n", k=rng.choice([1, 2, 7, 39, 42, 60, 127, 150, 273])))
        noise = lambda: "".join(rng.choices("cdefgh ", k=rng.randint(0, 300)))
        body = (unit * (1200 // len(unit) + 2))[: rng.randint(window - 60, 1200)]
        texts.append(noise() + body + noise())
        if rng.random() < 0.5:
            texts.append(noise() + body[rng.randint(0, 50) :] + noise())
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    got = {
        r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
        for r in op.removed(df, window=window, gram=gram).collect()
    }
    assert got == dict(enumerate(brute([t.encode() for t in texts], window)))


def test_hot_keys_are_split(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_KEYS", 5)
    texts = cases(random.Random(1), 40) * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in op.removed(df, window=40, gram=8).collect()}
    assert got == dict(enumerate(brute([(t or "").encode() for t in texts], 40)))


def test_columns_with_our_names_come_through(spark):
    t = "".join(random.Random(3).choices("abc ", k=90))
    rows = [(1, 11, 12, "s", t + "x", 5), (2, 21, 22, "s", "y" + t, 6), (3, 31, 32, "s", None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, _k1 long, _k2 long, _spans string, text string, c1 int")
    got = sorted(op.without_repeats(df, window=40, gram=8).collect())
    assert [tuple(r) for r in got] == [(1, 11, 12, "s", "x", 5), (2, 21, 22, "s", "y", 6), (3, 31, 32, "s", None, 7)]
    assert op.without_repeats(df, window=40, gram=8).columns == df.columns
