"""The pipeline's stages against the operators' brute force, stage by stage."""

import hashlib
import random

import duckdb

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from girder.llm import language_id, repeats
from girder.llm.common import held_out
from girder.llm.repeats import kept_bytes, merged, whole_chars
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_near_copies import brute_set, like
from tests.llm.test_repeats import brute_spans
from tests.llm.test_simhash_links import closure
from tests.llm.test_word_windows import brute as word_spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def planted(spark):
    db = duckdb.connect()
    rows = db.execute(
        "SELECT doc_id, text, lang, source, n_chars FROM '/root/testdata/sf0.001/documents.parquet' "
        "WHERE length(text) < 3000 ORDER BY doc_id LIMIT 90"
    ).fetchall()
    items = db.execute("SELECT text FROM '/root/testdata/sf0.001/benchmark.parquet' LIMIT 5").fetchall()
    rng = random.Random(1)
    passage = " ".join("".join(rng.choices("aeiou rstln", k=7)) for _ in range(60))
    text = {r[0]: r[1] for r in rows}
    add = [text[rows[3][0]], text[rows[3][0]], text[rows[5][0]] + " " + items[0][0]]
    add += [text[rows[k][0]] + " " + passage for k in (7, 9)] + ["", "123 456", None]
    for k in (11, 13, 17):  # near copies: one word of a text is another
        words = text[rows[k][0]].split(" ")
        words[len(words) // 2] = "otherwise"
        add.append(" ".join(words))
    very_long = " ".join(text[r[0]] for r in rows[20:24]).split(" ")
    add.append(" ".join(rng.sample(very_long, len(very_long)) + rng.choices(very_long, k=8_000)))
    rows += [(10_000 + k, t, "en", "s", len(t or "")) for k, t in enumerate(add)]
    rows += [rows[0], (None, text[rows[15][0]] + " and more", "en", None, None), (20_000, "zu kurz", None, None, 0)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )


def test_each_stage(spark, sf_dir):
    docs = planted(spark)
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["language", "near_dedup", "passages", "decontamination", "tokens"]

    told = stages["language"](spark, docs, sf_dir)
    assert told.columns == COLUMNS
    model = language_id.learn(docs, ~held_out())
    before = docs.collect()
    _, _, out = model.predict([(r.text or "").encode() for r in before])
    told = told.collect()
    assert sorted(told, key=str) == sorted((r for r, gone in zip(before, out) if not gone), key=str)
    assert len(told) >= len(before) - 6

    unique = stages["near_dedup"](spark, spark.createDataFrame(told, docs.schema), sf_dir)
    assert unique.columns == COLUMNS
    sets = [brute_set(r.text) for r in told]
    pairs = [(a, b) for a in range(len(told)) for b in range(a + 1, len(told)) if like(sets[a], sets[b])]
    groups = {}
    for k, root in closure(pairs, list(range(len(told)))).items():
        groups.setdefault(root, []).append(told[k])
    first = lambda rs: min(rs, key=lambda r: (r.doc_id is None, r.doc_id or 0))
    unique = unique.collect()
    assert sorted(unique, key=str) == sorted(map(first, groups.values()), key=str)
    assert {10_000, 10_001, 10_008, 10_009}.isdisjoint(r.doc_id for r in unique)

    cut = stages["passages"](spark, spark.createDataFrame(unique, docs.schema), sf_dir)
    assert cut.columns == COLUMNS
    cut = {r.doc_id: r for r in cut.collect()}
    raw = [r.text.encode() for r in unique]
    by_bytes = brute_spans(raw, pipeline.PASSAGE)
    by_words = word_spans([r.text for r in unique], pipeline.PASSAGE_WORDS)
    for r, text, x, y in zip(unique, raw, by_bytes, by_words):
        want = kept_bytes(text, whole_chars(text, merged([*x, *y]))).decode()
        assert cut[r.doc_id].text == want
        assert cut[r.doc_id].n_chars == len(want)
    assert sum(bool(x) for x in by_bytes) >= 2

    rows = list(cut.values())
    clean = stages["decontamination"](spark, spark.createDataFrame(rows, docs.schema), sf_dir)
    assert clean.columns == COLUMNS
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = clean.collect()
    assert {r.doc_id for r in clean} == {r.doc_id for r in rows if not any(leaks(r.text, t) for t in items)}
    assert 10_002 not in {r.doc_id for r in clean}

    ids = stages["tokens"](spark, spark.createDataFrame(clean, docs.schema), sf_dir).collect()
    assert {r.doc_id: r.text_sha256 for r in ids} == {
        r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in clean
    }


def test_run_and_empty_table(spark, tmp_path, sf_dir):
    assert pipeline.run(spark, sf_dir).count() > 100
    docs = planted(spark).limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.collect() == []
    assert repeats.WINDOW == 400


def test_columns_with_our_names(spark, sf_dir):
    """Extra columns come through every stage but the last, whatever their names."""
    names = ["_k1", "_spans", "_key", "fp", "id", "c1", "keys", "component", "item", "score"]
    docs = planted(spark)
    for k, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{k}-"), F.col("doc_id").cast("string")))
    for name, stage in pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == before.columns, name
        rows = docs.collect()
        assert len(rows) > 50
        assert all(r[n] == (None if r.doc_id is None else f"{k}-{r.doc_id}") for r in rows for k, n in enumerate(names))
        docs = spark.createDataFrame(rows, before.schema)
    assert pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == len(rows)
