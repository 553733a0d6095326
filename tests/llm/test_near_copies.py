"""Near copies against the likeness of all pairs."""

import random

import corpus_pipeline as pipeline
from girder.llm import near_copies as op
from tests.llm.test_simhash_links import closure


def brute_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def like(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def test_copies_with_a_few_changed_words(spark, sf_dir):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(900)]
    texts = []
    for n in [3, 8, 60, 150, 150, 400, 2500]:
        text = rng.choices(words, k=n)
        texts.append(text)
        for changed in (0, 1, 2, 3, 5):
            copy = list(text)
            for at in rng.sample(range(n), min(n, changed)):
                copy[at] = copy[at].upper() if changed == 5 else rng.choice(words)
            texts.append(copy)
    base = rng.choices(words, k=200)  # a group that is over the limit
    for k in range(70):
        texts.append([*base[:150], str(k), *base[151:]])
    texts = ["", None, " \n", *map(" ".join, texts)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sets = {i: brute_set(t) for i, t in enumerate(texts)}
    pairs = [(a, b) for a in sets for b in sets if a < b and like(sets[a], sets[b])]
    want = set(closure(pairs, list(sets)).values())
    got = dict(pipeline.STAGES)["near_dedup"](spark, df, sf_dir)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)
    assert len(want) < len(texts) - 80


def test_large_group_of_edits_that_are_not_like_its_hubs(spark, sf_dir):
    rng = random.Random(1)
    base = [str(rng.randrange(10**6)) for _ in range(150)]
    texts = []
    for k in range(300):  # two texts with other words at the same places are alike, and like no others
        places = rng.sample(range(5, 145), 3)
        for twin in range(2):
            copy = list(base)
            for at in places:
                copy[at] = f"x{k}-{at}-{twin}"
            texts.append(" ".join(copy))
    df = spark.createDataFrame(
        [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    sets = [brute_set(t) for t in texts]
    pairs = [(a, b) for b in range(len(sets)) for a in range(b) if like(sets[a], sets[b])]
    want = set(closure(pairs, range(len(sets))).values())
    got = dict(pipeline.STAGES)["near_dedup"](spark, df, sf_dir)
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)


def test_lists_in_blocks_are_settled_whole(spark, monkeypatch):
    rng = random.Random(4)
    sets = {}
    for k in range(60):  # threes that are alike, all with the shingles 0 to 39
        own = rng.sample(range(1000, 10**6), 30)
        for j in range(3):
            sets[3 * k + j] = sorted([*range(40), *own, 10**7 + 3 * k + j, -5])
    want = {(a, b) for b in sets for a in range(b) if like({*sets[a]}, {*sets[b]})}
    assert len(want) == 180
    df = spark.createDataFrame([*sets.items()], "fp long, shingles array<long>")
    early = op.rarest(df)
    none = spark.createDataFrame([], "node long, component long")
    for block, columns in ((1 << 16, 1 << 11), (1000, 7)):
        monkeypatch.setattr(op, "BLOCK", block)
        monkeypatch.setattr(op, "COLUMNS", columns)
        assert {tuple(r) for r in op._all_apart(early, none, df).collect()} == want


def test_rarest_shingles_make_no_row_for_each_shingle(spark, monkeypatch):
    rng = random.Random(6)
    sets = {}
    for k in range(40):  # pairs that are alike, all with the shingles 0 to 59
        own = rng.sample(range(1000, 10**6), 60)
        for j in range(2):
            sets[2 * k + j] = sorted([*range(60), *own, 10**7 + 2 * k + j])
    df = spark.createDataFrame([*sets.items()], "fp long, shingles array<long>")
    none = spark.createDataFrame([], "node long, component long")
    want = {(a, b) for b in sets for a in range(b) if like({*sets[a]}, {*sets[b]})}
    assert len(want) == 40
    made = []
    whole = op.written

    def counted(rows, name):
        found = whole(rows, name)
        made.append(found.count())
        return found

    monkeypatch.setattr(op, "written", counted)
    early = op.rarest(df)
    assert made and sum(made) <= sum(len(x) // 5 + 1 for x in sets.values())
    monkeypatch.undo()
    counts = op.tally(df)
    assert counts.sum() == sum(map(len, sets.values())) and counts.max() >= len(sets)
    first = {r.fp: r.at for r in early.filter("at.i = 0").collect()}
    assert all(at.n == 121 for at in first.values())
    for found in (early, op.rarest(df, places=3), op.rarest(df, places=1500)):  # shingles that share places too
        assert {tuple(r) for r in op._all_apart(found, none, df).collect()} == want


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(str(k * k % 997) for k in range(300)).encode()
    whole = op.shingles(text).tolist()
    assert len(whole) == len(brute_set(text.decode()))
    monkeypatch.setattr(op, "PIECE", 7)
    assert op.shingles(text).tolist() == whole
