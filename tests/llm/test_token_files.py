"""Token files: the library's ids, the round trip, order and starts."""

import random
import zlib

import numpy as np
import pytest

import public_tokenizers
from girder.llm import token_files as op
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def definition():
    with open(PATH) as f:
        return f.read()


def random_texts(n):
    rng = random.Random(3)
    bits = ["Don't", " ", "\n", "word,", "word.", "!?", "…,", "É", "É", "H̱", "İ", "12.5", "<|endoftext|>", " ", "'s,", "漢字", "Straße;", "\x1c", "\x85", "a.b", "🙂!", "ΣΑΣ", "|", "a|b", " | "]
    return ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(n)]


def test_equals_the_library(definition, monkeypatch):
    monkeypatch.setattr(op, "CACHE_CHUNKS", 60)
    library, coder = Tokenizer.from_file(PATH), op.Coder(definition)
    texts = random_texts(2000)
    for i in range(0, len(texts), 100):
        part = texts[i : i + 100]
        got = [np.frombuffer(x, coder.kind).tolist() for x in coder.encode([t.encode() for t in part])]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in part]


@pytest.mark.parametrize("per_file", [7, 5000])
def test_files_round_trip(spark, definition, monkeypatch, per_file):
    monkeypatch.setattr(op, "FILE_DOCUMENTS", per_file)
    library = Tokenizer.from_file(PATH)
    texts = [None, "", "same", "same", *random_texts(60), "long word " * 20_000]
    ids = [5, 5, 9, 9, *random.Random(1).sample(range(-100, 10**6), 61)]
    df = spark.createDataFrame(
        [(i, t, "clash") for i, t in zip(ids, texts)] + [(None, "none", "x")],
        "doc_id long, text string, n string",
    )
    folder, files = op.write(df, definition, 2)
    got = op.read(folder, files, with_ids=True).collect()
    want = sorted(
        [(i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in zip(ids, texts)]
        + [(-(10**9), library.encode("none", add_special_tokens=False).ids + [2])],
        key=lambda x: x[0],
    )
    got = sorted(got, key=lambda r: r.start)
    named = [(r.id if r.id is not None else -(10**9), list(r.ids)) for r in got]
    assert [i for i, _ in named] == [i for i, _ in want]
    assert sorted(named) == sorted(want)
    assert files.count() >= (9 if per_file == 7 else 1)
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids)
        assert r.crc == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += len(r.ids)


@pytest.mark.parametrize("rows", [[(7, "same words")] * 90, [(None, f"text {i}") for i in range(90)]])
def test_rows_that_share_an_id_go_to_many_files(spark, definition, monkeypatch, rows):
    monkeypatch.setattr(op, "FILE_DOCUMENTS", 10)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    folder, files = op.write(df, definition, 2)
    assert files.count() >= 6 and max(r.n_docs for r in files.collect()) <= 30
    assert op.read(folder, files).count() == 90


def test_files_are_bounded_by_bytes(spark, definition, monkeypatch):
    monkeypatch.setattr(op, "FILE_BYTES", 2000)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=400))) for i in range(60)]
    folder, files = op.write(spark.createDataFrame(rows, "doc_id long, text string"), definition, 2)
    assert files.count() >= 3
    assert [r.id for r in sorted(op.read(folder, files).collect(), key=lambda r: r.start)] == list(range(60))


def test_query_ties_ids_to_documents(spark, sf_dir):
    from girder.llm import registry

    library = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r.doc_id: r for r in registry.op7_token_files(spark, sf_dir).collect()}
    start = 0
    for r in sorted(docs, key=lambda r: r.doc_id):
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens) == (start, len(ids))
        assert got[r.doc_id].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_empty_table(spark, definition):
    df = spark.createDataFrame([], "doc_id long, text string")
    folder, files = op.write(df, definition, 2)
    assert op.read(folder, files).collect() == []
