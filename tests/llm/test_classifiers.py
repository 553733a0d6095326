"""Language ID and toxicity: arrays against plain loops, held-out accuracy, odd rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from girder.llm import language_id, toxicity
from girder.llm.common import held_out, table
from girder.llm.ngrams import grams, has_letter, symbols


def brute_grams(text, size):
    import unicodedata

    word, words = [], []
    for c in text:
        if unicodedata.category(c)[0] == "L":
            word.append(c.lower() if len(c.lower()) == 1 else c)
        elif word:
            words.append(word)
            word = []
    if word:
        words.append(word)
    out = []
    for w in words:
        marked = ["", *w, ""]
        out += [tuple(marked[i : i + size]) for i in range(len(marked) - size + 1)]
    return out


def test_grams_against_loops():
    texts = ["", " . ", "Ab cÉd", "x", "ß—ö  ab\n\nab", "12a34", "İx", "漢字 and ab"]
    for size in (2, 3, 4):
        seen = {}
        counts = [0] * len(texts)
        for bucket, whose in grams(symbols([t.encode() for t in texts]), (size,), 40):
            per_text = [bucket[whose == k].tolist() for k in range(len(texts))]
            for k, t in enumerate(texts):
                want = brute_grams(t, size)
                assert len(per_text[k]) == len(want)
                counts[k] = len(want)
                for b, g in zip(per_text[k], want):
                    assert seen.setdefault(b, g) == g
        assert counts[2] > 0
    got = has_letter(symbols([t.encode() for t in texts]), len(texts))
    assert got.tolist() == [False, False, True, True, True, True, True, True]


def test_language_scores_do_not_depend_on_the_round():
    texts = ["the cat and the dog " * 5, "der hund und die katze " * 4, "", "le chat et le chien"]
    model = language_id.fit([("en", texts[0]), ("de", texts[1]), ("fr", texts[3])] * 5)
    raw = [t.encode() for t in texts]
    whole, _ = model.logits(raw)
    single = np.concatenate([model.logits([t])[0] for t in raw])
    assert np.allclose(whole, single)
    assert [n for n in model.predict(raw)[0]] == ["en", "de", "und", "fr"]


def test_language_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = language_id.learn(docs, ~held_out())
    found = language_id.identify(docs, model).join(
        docs.select(F.col("doc_id").alias("id"), "lang"), "id"
    )
    row = found.filter(held_out("id")).agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"),
        F.avg(F.col("rejected").cast("int")).alias("out"),
    ).collect()[0]
    assert row["right"] > 0.97 and row["out"] < 0.02


def test_language_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 ...", None), (4, "the and", "en"), (4, "the and", "en"), (5, "der und " * 9000, "de"), (6, "der und der", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn(
        "score", F.lit("clash")
    )
    model = language_id.learn(df)
    got = [(r.id, r.lang_pred) for r in language_id.identify(df, model).collect()]
    assert sorted(got) == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "de"), (6, "de")]
    kept = language_id.accepted(df, model)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} <= {4, 5, 6}
    empty = df.limit(0)
    nothing = language_id.learn(empty)
    assert language_id.identify(empty, nothing).collect() == []
    assert {r.lang_pred for r in language_id.identify(df, nothing).collect()} == {"und"}


def test_toxicity_held_out(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels, ~held_out())
    marks = labels.select(F.col("doc_id").alias("id"), "toxic")
    rows = toxicity.score(docs.join(labels, "doc_id", "left_semi"), model).join(marks, "id")
    rows = rows.filter(held_out("id")).collect()
    hit = sum(r.toxic and r.score >= toxicity.THRESHOLD for r in rows)
    said = sum(r.score >= toxicity.THRESHOLD for r in rows)
    assert hit / sum(r.toxic for r in rows) > 0.85 and hit / said > 0.9


def test_toxicity_odd_rows(spark):
    rng = random.Random(1)
    words = ["calm", "tree", "river", "stone", "cloud"]
    rows = [(i, " ".join(rng.choices(words, k=12)) + (" vilest" if i % 3 == 0 else "")) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "..."), (103, "vilest " * 3), (103, "vilest " * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("toxic", F.lit("clash"))
    labels = spark.createDataFrame(
        [(i, int(i % 3 == 0)) for i in range(60)] + [(100, 1), (101, None), (None, 1)],
        "doc_id long, toxic int",
    )
    model = toxicity.learn(df.drop("toxic"), labels)
    got = {r.id: r.score for r in toxicity.score(df, model).collect()}
    assert all((got[i] >= 0.3) == (i % 3 == 0) for i in range(60))
    assert got[103] >= 0.3 and got[100] == got[101] == got[102] < 0.3
    nothing = toxicity.learn(df.drop("toxic").limit(0), labels)
    assert {r.score for r in toxicity.score(df, nothing).collect()} == {0.0}


def brute_score(model, text):
    """A text's toxicity by a plain loop over its distinct features."""
    import math

    features = set()
    for size in toxicity.SIZES:
        for bucket, _ in grams(symbols([text.encode()]), (size,), toxicity.BITS):
            features |= set(bucket.tolist())
    z = model.bias + sum(float(model.weights[f]) for f in sorted(features))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def test_toxicity_query_against_loops(spark):
    """The query's rows, by the model learned from labels that aren't held out, scored by plain loops."""
    import zlib

    from girder.llm import registry

    sf_dir = "/root/testdata/sf0.001"
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels, ~held_out())
    assert (model.weights > 0).any()
    got = {r.doc_id: r for r in registry.op2_toxicity(spark, sf_dir).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        assert abs(got[i].score - brute_score(model, t)) < 1e-6
        assert got[i].predicted == (got[i].score >= 0.3)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)


def test_held_out_labels_change_nothing(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    more = turned.unionByName(spark.range(10**6, 10**6 + 20_000).select(F.col("id").alias("doc_id"), F.lit(0).alias("quality"), F.lit(1).alias("toxic")).filter(held_out()))
    a, b = (toxicity.sample(docs, x, ~held_out(), "doc_id", "text") for x in (labels, more))
    assert a == b
    relabelled = docs.withColumn("lang", F.when(held_out(), F.lit("xx")).otherwise(F.col("lang")))
    x, y = (language_id.sample(d, "text", "lang", ~held_out()) for d in (docs, relabelled))
    assert x == y and {k for k, _ in x} == {"de", "en", "es", "fr"}


def test_samples_are_bounded_and_take_copies_once(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_PER_LANGUAGE", 50)
    monkeypatch.setattr(toxicity, "SAMPLE_TOXIC", 30)
    monkeypatch.setattr(toxicity, "SAMPLE_CLEAN", 40)
    rows = [(i, f"text number {i} here" if i % 3 else "the same copy", "en" if i % 2 else "de", i % 2) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    found = language_id.sample(df, "text", "lang", None)
    assert sum(t == "the same copy" for _, t in found) <= 2
    assert 30 <= sum(k == "en" for k, _ in found) <= 50 and 30 <= sum(k == "de" for k, _ in found) <= 50
    texts, labels = toxicity.sample(df.select("doc_id", "text"), df.select("doc_id", "toxic"), None, "doc_id", "text")
    assert len(texts) == len(set(zip(texts, labels)))
    assert 20 <= sum(labels) <= 30 and 20 <= len(labels) - sum(labels) <= 40
    monkeypatch.setattr(language_id, "SAMPLE_BYTES", 200)
    assert sum(len(t) for _, t in language_id.sample(df, "text", "lang", None)) <= 200
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 100)
    assert sum(map(len, toxicity.sample(df.select("doc_id", "text"), df.select("doc_id", "toxic"), None, "doc_id", "text")[0])) <= 200


def test_language_query_against_loops(spark):
    """Averaged embeddings, softmax, calibration and rejection by plain loops over n-grams."""
    import math

    from girder.llm import registry

    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents")
    model = language_id.learn(docs, ~held_out())
    got = {r.doc_id: r for r in registry.op6_language_id(spark, sf_dir).collect()}
    for r in docs.collect():
        total, n = np.zeros(len(model.languages)), 0
        for size in language_id.SIZES:
            for bucket, _ in grams(symbols([(r.text or "").encode()]), (size,), language_id.BITS):
                for b in bucket.tolist():
                    total += model.table[b]
                    n += 1
        z = (total / max(n, 1) + model.bias) / model.temperature
        p = [math.exp(x - max(z)) / sum(math.exp(y - max(z)) for y in z) for x in z]
        known = any(c.isalpha() for c in r.text or "")
        best = max(range(len(p)), key=lambda k: p[k])
        row = got[r.doc_id]
        assert row.lang_pred == (model.languages[best] if known else "und")
        assert abs(row.score - (p[best] if known else 0.0)) < 1e-6
        assert row.rejected == (not known or row.score < model.threshold)


def test_more_languages_than_dimensions():
    rng = random.Random(5)
    names = [f"l{k:02d}" for k in range(20)]
    words = {n: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(30)] for n in names}
    rows = [(n, " ".join(rng.choices(words[n], k=20))) for n in names for _ in range(12)]
    model = language_id.fit(rows)
    assert model.table.shape[1] == language_id.DIMENSIONS and len(model.languages) == 20
    fresh = [(n, " ".join(rng.choices(words[n], k=20))) for n in names]
    found = model.predict([t.encode() for _, t in fresh])[0]
    assert sum(a == n for a, (n, _) in zip(found, fresh)) >= 18
