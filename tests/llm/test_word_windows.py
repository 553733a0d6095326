"""Repeated windows of words against plain loops."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as pipeline
from girder.llm import word_windows as op
from girder.llm.repeats import merged

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(texts, words):
    """The bytes of each text that repeated windows cover, as merged spans."""
    places = []
    for text in texts:
        data = (text or "").encode()
        at, found = 0, []
        for w in data.split():
            at = data.index(w, at)
            found.append((w, at, at + len(w)))
            at += len(w)
        places.append(found)
    window = lambda p, i: tuple(w for w, _, _ in p[i : i + words])
    seen = Counter(window(p, i) for p in places for i in range(len(p) - words + 1))
    return [
        merged([(p[i][1], p[i + words - 1][2]) for i in range(len(p) - words + 1) if seen[window(p, i)] > 1])
        for p in places
    ]


def test_against_loops(spark):
    rng = random.Random(16)
    shared = [rng.choices(["a", "é", "stone", "🙂"], k=k) for k in (6, 7, 8, 30)]
    texts = ["", None, " \n ", "a " * 40, "b " * 7, "a  b\tc d e f g h", "x a b c d\ne f g h"]
    for _ in range(40):
        own = [rng.choices("abcdefghijklmnop", k=rng.randint(0, 60)) for _ in range(2)]
        texts.append(rng.choice(["", " "]) + rng.choice([" ", "  "]).join(own[0] + rng.choice(shared) + own[1]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    keyed = op._keyed(df, "doc_id", "text").select("doc_id", "_k1", "_k2")
    for r in op.repeated_spans(df, 7, 3).join(keyed, ["_k1", "_k2"]).collect():
        got.setdefault(r.doc_id, []).extend((s["start"], s["end"]) for s in r["_spans"])
    want = {i: cut for i, cut in enumerate(brute(texts, 7)) if cut}
    assert {i: merged(cut) for i, cut in got.items()} == want
    assert len(want) > 20


def test_passages_of_short_words(spark, sf_dir):
    rng = random.Random(8)
    some = lambda k, n: [("".join(rng.choices("bcdfghjk", k=n))) for _ in range(k)]
    over, under = " ".join(some(51, 4)), " ".join(some(50, 4))
    assert len(over) < pipeline.PASSAGE
    around = [" ".join(some(30, 9)) for _ in range(8)]
    texts = [f"{a} {p} {b}" for a, b, p in zip(around[::2], around[1::2], [over, over, under, under])]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    got = dict(pipeline.STAGES)["passages"](spark, spark.createDataFrame(rows, SCHEMA), sf_dir)
    got = {r.doc_id: r.text for r in got.collect()}
    cut = [f"{a}  {b}" for a, b in zip(around[:4:2], around[1:4:2])]
    assert [got[i] for i in range(4)] == [*cut, *texts[2:]]


def test_long_texts_in_pieces(monkeypatch):
    hashes = np.random.default_rng(2).integers(0, 1 << 63, 700, np.uint64)
    want = op._anchored(hashes, 7, 3)[0].tolist()
    monkeypatch.setattr(op, "PIECE", 64)
    got = [p + i for i, x in op._pieces(hashes, 7) for p in op._anchored(x, 7, 3)[0].tolist()]
    assert got == want
