"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the average of the embeddings of its subwords (character 2- to 4-grams of its words, hashed);
a linear softmax tells the language. Embeddings and softmax are fitted together by stochastic
gradient descent in numpy, on a bounded sample of whole texts and short passages of them. Embeddings
start at zero, so subwords that were never seen draw the average to no language. Probabilities are
calibrated on held-back sample texts by a temperature, and a text is rejected if its probability stays
under a threshold that keeps all but a thousandth of the rightly named calibration texts.

The model goes out with the tasks: 2**BITS rows of at most ``DIMENSIONS`` numbers and as many for each
language. If there are fewer languages than dimensions, embeddings and softmax collapse into one
table of subword scores for each language, which tells the same.

The sample: each language is thinned by a hash of the text to some three times its part, equal texts count
once, what is left is ranked by the hash, and the first are fetched: three scans, however many languages.

Defined results. Null text or text without a letter: ``und``, score 0, rejected. Rows without a label
aren't learned from. A corpus without labelled rows: every text is ``und``. Ties: the language
that sorts first. Repeated rows: each by itself, learned from once. A text longer than
``MAX_SAMPLE_BYTES`` isn't learned from; every text is predicted whole, in rounds that hold one very
long text at most. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from girder.llm.common import first_texts, lean, rounds, small, utf8
from girder.llm.ngrams import grams, has_letter, symbols

SIZES = (2, 3, 4)
BITS = 17
DIMENSIONS = 12
#: Bounds of the sample: texts for each language, bytes of all texts (in equal parts for the languages, but
#: one text each), and bytes of a text (longer ones are not learned from; all texts are predicted whole).
SAMPLE_PER_LANGUAGE = 700
SAMPLE_BYTES = 96 << 20
MAX_SAMPLE_BYTES = 50_000
EPOCHS = 6
MAX_THRESHOLD = 0.4
UNKNOWN = "und"
ROUND = 1 << 18


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # bucket x language, or bucket x dimension
    bias: np.ndarray
    temperature: float
    threshold: float
    weights: np.ndarray | None = None  # dimension x language, if the table isn't of languages

    def logits(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of each language, and whether the text has a letter."""
        n, width = len(texts), self.table.shape[1]
        found = symbols(texts)
        sums, count = np.zeros((n, width)), np.zeros(n)
        for bucket, whose in grams(found, SIZES, BITS):
            count += np.bincount(whose, minlength=n)[:n]
            starts = np.flatnonzero(np.concatenate(([True], whose[1:] != whose[:-1])))
            if len(bucket):
                sums[whose[starts]] += np.add.reduceat(self.table[bucket], starts, axis=0)
        means = sums / np.maximum(count, 1)[:, None]
        scores = means if self.weights is None else means @ self.weights
        return scores + self.bias, has_letter(found, n)

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, calibrated probability and rejection of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        logits, known = self.logits(texts)
        p = softmax(logits / self.temperature)
        best = p.argmax(axis=1)
        score = np.where(known, p[np.arange(len(texts)), best], 0.0)
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), known)]
        return names, score, ~known | (score < self.threshold)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sample(docs: DataFrame, text_col: str, label_col: str, usable: Column | None) -> list[tuple]:
    """(language, text) of some rows of each language, by the order of a hash of the text."""
    rows = docs.select(F.col(label_col).alias("lang"), F.col(text_col).alias("text"))
    if usable is not None:
        rows = docs.filter(usable).select(
            F.col(label_col).alias("lang"), F.col(text_col).alias("text")
        )
    rows = rows.filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
        & (F.octet_length("text") <= MAX_SAMPLE_BYTES)
    )
    hashed = rows.withColumn("h", F.xxhash64("text"))
    # a row for each language: how many distinct texts it has, about
    sizes = hashed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    languages = sizes.count()
    if not languages:
        return []
    every = F.greatest(F.lit(1), F.floor(F.col("n") / (3 * SAMPLE_PER_LANGUAGE)))
    thin = hashed.join(small(sizes.select("lang", every.alias("every")), F.octet_length("lang")), "lang")
    rows = thin.filter(F.pmod("h", "every") == 0).select(F.col("lang").alias("label"), "text")
    return first_texts(rows, F.lit(SAMPLE_PER_LANGUAGE), max(SAMPLE_BYTES // languages, 1))


def _features(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and their shares of each text."""
    out = []
    for i in range(0, len(texts), 64):
        part = texts[i : i + 64]
        found = list(grams(symbols(part), SIZES, BITS))
        if not found:
            out += [(np.zeros(0, np.int64), np.zeros(0, np.float32))] * len(part)
            continue
        bucket = np.concatenate([b for b, _ in found])
        whose = np.concatenate([w for _, w in found])
        order = np.argsort(whose, kind="stable")
        cuts = np.searchsorted(whose[order], np.arange(len(part) + 1))
        for a, b in zip(cuts, cuts[1:]):
            ids, n = np.unique(bucket[order[a:b]], return_counts=True)
            out.append((ids, (n / max(1, n.sum())).astype(np.float32)))
    return out


def _passages(texts: list[bytes], rng: np.random.Generator) -> list[bytes]:
    """A short run of words of each text."""
    out = []
    for t in texts:
        words = t.split()
        n = int(rng.integers(3, 25))
        at = int(rng.integers(0, max(1, len(words) - n)))
        out.append(b" ".join(words[at : at + n]))
    return out


def fit(labelled: list[tuple[str, str]], seed: int = 1) -> Model:
    """The model of (language, text) pairs."""
    languages = sorted({k for k, _ in labelled})
    width = len(languages)
    if not languages:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    place = {k: i for i, k in enumerate(languages)}
    order = rng.permutation(len(labelled))
    texts = [labelled[i][1].encode() for i in order]
    labels = np.array([place[labelled[i][0]] for i in order])
    held = max(1, len(texts) // 5) if len(texts) > 4 else 0
    all_texts = texts + _passages(texts, rng)
    all_labels = np.concatenate((labels, labels))
    features = _features(all_texts)
    place_of = np.arange(len(all_texts)) % len(texts)
    train = np.flatnonzero(place_of >= held)
    weights = rng.normal(0, 1, (DIMENSIONS, width)).astype(np.float32)
    embedded = np.zeros((1 << BITS, DIMENSIONS), np.float32)
    bias = np.zeros(width, np.float32)
    share = np.bincount(all_labels[train], minlength=width) / len(train)
    balance = 1 / np.maximum(share * width, 1e-3)
    steps = EPOCHS * max(1, 4000 // max(1, len(train)))
    for epoch in range(steps):
        rate = 40.0 * (1 - epoch / steps)
        for i in rng.permutation(train):
            ids, f = features[i]
            if not len(ids):
                continue
            x = f @ embedded[ids]
            z = x @ weights + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[all_labels[i]] -= 1
            p *= min(balance[all_labels[i]], 5.0)
            back = weights @ p
            weights -= 0.02 * np.outer(x, p)
            bias -= 0.001 * p
            embedded[ids] -= rate * f[:, None] * back
    narrow = width <= DIMENSIONS
    table = (embedded @ weights if narrow else embedded).astype(np.float32)
    model = Model(languages, table, bias.astype(float), 1.0, 0.0, None if narrow else weights.astype(float))
    check = np.flatnonzero(place_of < held) if held else np.arange(len(all_texts))
    logits, known = model.logits([all_texts[i] for i in check])
    logits, truth = logits[known], all_labels[check][known]
    if not len(truth):
        return model

    def loss(t: float) -> float:
        p = softmax(logits / t)[np.arange(len(truth)), truth]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    model.temperature = float(min(np.geomspace(0.05, 20, 80), key=loss))
    p = softmax(logits / model.temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == truth])
    if len(right):
        model.threshold = float(min(MAX_THRESHOLD, 0.8 * right[len(right) // 1000]))
    return model


def learn(
    docs: DataFrame,
    usable: Column | None = None,
    text_col: str = "text",
    label_col: str = "lang",
) -> Model:
    """The model of a bounded sample of the usable labelled rows."""
    return fit(sample(docs, text_col, label_col, usable))


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, lang_pred, score (calibrated probability) and rejected of every row, over its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            for columns in _predicted(b, 1, shared.value):
                yield pa.RecordBatch.from_arrays([columns[0][0], *columns[1]], schema.names)

    schema = kept.select("id").schema
    schema = schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return kept.mapInArrow(lean(run), schema)


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs that aren't rejected, with their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            for columns, (_, _, rejected) in _predicted(b, place, shared.value):
                whole = pa.RecordBatch.from_arrays(columns, b.schema.names)
                keep = pa.array(~rejected.to_numpy(zero_copy_only=False))
                yield whole.filter(keep)

    return docs.mapInArrow(lean(run), docs.schema)


def _predicted(b: pa.RecordBatch, place: int, model: Model):
    chars, at = utf8(b.column(place))
    data = chars.tobytes()
    for i, j in rounds(at, ROUND):
        part = at[i : j + 1].tolist()
        names, score, out = model.predict([data[x:y] for x, y in zip(part, part[1:])])
        columns = [c.slice(i, j - i) for c in b.columns]
        yield columns, (pa.array(names), pa.array(score), pa.array(out))
