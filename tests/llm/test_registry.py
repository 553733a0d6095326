"""Queries against their SQL, and the contracts of the others on a small table."""

import hashlib

import duckdb
import pytest

from girder.llm import oracles, registry
from tests.compare import same_rows


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_its_oracle(spark, sf_dir, name):
    with duckdb.connect() as db:
        same_rows(registry.queries()[name](spark, sf_dir), db, sf_dir, registry.oracle_sql()[name])


def test_edges_of_the_url_oracle():
    import pandas as pd

    from tests.llm.test_url_filter import PAGES, brute

    with duckdb.connect() as db:
        db.register("pages", pd.DataFrame(PAGES, columns=["page_id", "url", "html"]))
        assert sorted(db.execute(oracles.URL_FILTER).fetchall(), key=str) == brute()


def test_round_trips(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = registry.op3_byte_bpe(spark, sf_dir).collect()
    assert {r.doc_id: r.decoded_sha256 for r in got} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in docs.items()
    }
    names = {"op1": 1, "op2": len(docs), "op4": len(docs), "op6": len(docs), "op7": len(docs), "op9": len(docs), "op10": len(docs)}
    for name, query in registry.queries().items():
        if (start := name.split("_")[0]) in names:
            rows = query(spark, sf_dir).count()
            assert rows == names[start] or start == "op1", name


def test_near_dedup_query_against_brute_force(spark, sf_dir):
    from tests.llm.test_simhash_links import brute_fp, closure

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    fps = {i: brute_fp(t) for i, t in docs.items()}
    pairs = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    roots = closure(pairs, list(fps))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in registry.op9_simhash_near_dedup(spark, sf_dir).collect()}
    assert got == {i: (f"{fps[i]:016x}", roots[i]) for i in docs}


def test_sharding_query_against_plain_dealing(spark, sf_dir):
    import zlib

    from tests.llm.test_sharding import brute

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    got = {r.doc_id: r for r in registry.op4_hilbert_sharding(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for (i, text, _, _), (shard, slot) in zip(rows, brute(rows)):
        raw = (text or "").encode()
        assert (got[i].size, got[i].text_crc32, got[i].shard, got[i].slot) == (len(raw) + 1, zlib.crc32(raw), shard, slot)
        assert got[i].law == "bytes" and got[i].grown_shard is None
