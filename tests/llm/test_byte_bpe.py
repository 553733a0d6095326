"""Byte-level BPE against the tiktoken library."""

import base64
import random

import pytest

import public_tokenizers
import tiktoken
from girder.llm import byte_bpe as op

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def merger():
    with open(PATH, "rb") as f:
        return op.Merger(op.parse_ranks(f.read()), limit=500)


def ids(texts, merger):
    found = op.encode_texts([t.encode() for t in texts], merger)
    return [memoryview(x).cast("I").tolist() for x in found]


def random_texts(n):
    rng = random.Random(7)
    bits = ["'s", "'", "re", "'re", "ve", "ll", "'ll", "l", " ", "  ", "\n", "\t", " ", "a", "É", "12", "²", "!", "…", "漢字", "é", "\x1c", " ", "🙂", "d", "m", "'d", "S", "\r\n"]
    return ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(n)]


def test_equals_the_library(library, merger):
    texts = ["", " ", "\n", "don't  stop'sll ''s", *random_texts(3000)]
    assert ids(texts, merger) == [library.encode_ordinary(t) for t in texts]


def test_blocks_and_long_pieces(library, merger):
    texts = ["ab" * 3000, "é" * 500 + " " * 700 + "x", " " * 5000, "!" * 999, "word " * 4000]
    assert ids(texts, merger) == [library.encode_ordinary(t) for t in texts]


def test_rows_nulls_and_round_trip(spark):
    texts = [None, "", "same", "same", "Ünï'll go", "<|endoftext|>"] + random_texts(200)
    rows = [(i % 50, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = op.decode(op.encode(df, PATH, offsets=True), PATH).collect()
    assert sorted((r.id, bytes(r.decoded)) for r in got) == sorted(
        (i % 50, (t or "").encode()) for i, t in enumerate(texts)
    )
    assert all(len(r.ids) == 4 * r.n_tokens == 4 * len(r.ends) for r in got)
    assert op.encode(df.limit(0), PATH).collect() == []
