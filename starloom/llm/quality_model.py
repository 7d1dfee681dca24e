"""A quality classifier on random-indexing word vectors.

Random indexing: each word has a sparse random vector of a few plus and minus ones, drawn from its hash; a word's
context vector is the sum of the random vectors of its neighbours.  A document is pooled to the mean context vector of
its words, and the mean random vector of marks that stand for a word's form and place (case, length, signs, repetition),
so words that no sample holds still count.  A two-layer network in numpy gives a logit, which a temperature fitted on
rows set aside turns into a calibrated probability.

Fitting takes a bounded sample of labelled rows (``FIT_ROWS``, by hash order of the id) of those that the caller lets
it learn from; scoring covers every row, one pass over the documents, no shuffle of texts.

Defined cases: a null text is empty and is scored as any other; without labels of both classes every score is the share
of ones, or 0.5 without labels; rows of a null id are never learned from; equal texts get equal scores; an empty table
gives an empty result; other columns (language, source, ids) are never inputs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import arrow_batches, texts

#: Labelled rows that are learned from, size of the vectors, ones in a random vector, neighbours on each side, least
#: documents of a word with a context vector, hidden units, share of rows that the temperature is fitted on.
FIT_ROWS, SIZE, ONES, SIDE, LEAST_DOCUMENTS, HIDDEN, ASIDE = 6_000, 128, 8, 2, 3, 32, 0.15
STEPS, BATCH, RATE, DECAY = 60, 128, 3e-3, 1e-4
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")


def tokens(text: str) -> tuple[list[str], list[str]]:
    """Words and signs in lower case; the marks of each."""
    raw = _TOKEN.findall(text)
    words = [t.lower() for t in raw]
    seen, before, marks = set(), "", []
    for t, w in zip(raw, words):
        if t[0].isalnum():
            marks.append(f"length {min(len(t), 24)}")
            if len(t) > 1 and t.isupper():
                marks.append("upper")
            elif t.isdigit():
                marks.append("digits")
            elif not t.islower() and not t.istitle():
                marks.append("mixed")
        else:
            marks.append(f"sign {t[:3]}")
        if w == before:
            marks.append("same")
        if (before, w) in seen:
            marks.append("again")
        seen.add((before, w))
        before = w
    return words, marks


def random_vector(word: str, size: int = SIZE) -> np.ndarray:
    draw = np.random.default_rng(xxhash.xxh3_64_intdigest(word))
    vector = np.zeros(size, np.float32)
    vector[draw.choice(size, ONES, replace=False)] = np.where(draw.random(ONES) < 0.5, -1, 1)
    return vector


@dataclass
class Model:
    """Word vectors, network and temperature; what the tasks need to score a text."""

    words: dict[str, int] = field(default_factory=dict)
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, SIZE), np.float32))
    marks: dict[str, np.ndarray] = field(default_factory=dict)
    centre: np.ndarray = field(default_factory=lambda: np.zeros(2 * SIZE + 1))
    scale: np.ndarray = field(default_factory=lambda: np.ones(2 * SIZE + 1))
    layers: tuple | None = None
    temperature: float = 1.0
    share: float = 0.5

    def pooled(self, text: str) -> np.ndarray:
        words, marks = tokens(text)
        known = [i for i in map(self.words.get, words) if i is not None]
        context = self.vectors[known].mean(axis=0) if known else np.zeros(SIZE, np.float32)
        form = np.zeros(SIZE, np.float32)
        for mark, n in Counter(marks).items():
            if mark not in self.marks:
                if len(self.marks) > 50_000:
                    self.marks.clear()
                self.marks[mark] = random_vector(mark)
            form += n * self.marks[mark]
        return np.concatenate([context, form / max(1, len(words)), [np.log1p(len(words))]])

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((x - self.centre) / self.scale @ w1 + b1, 0) @ w2 + b2

    def scores(self, batch: list[str]) -> np.ndarray:
        if self.layers is None:
            return np.full(len(batch), self.share)
        x = np.stack([self.pooled(t) for t in batch]) if batch else np.zeros((0, 2 * SIZE + 1))
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def context_vectors(split: list[list[str]]) -> tuple[dict[str, int], np.ndarray]:
    """Of the words that enough documents hold: the sum of their neighbours' random vectors, at unit length."""
    documents = Counter(w for words in split for w in set(words))
    names = {w: i for i, w in enumerate(sorted(w for w, n in documents.items() if n >= LEAST_DOCUMENTS))}
    random = np.stack([random_vector(w) for w in names]) if names else np.zeros((0, SIZE), np.float32)
    random = np.concatenate([random, np.zeros((1, SIZE), np.float32)])  # the last stands for words without a name
    vectors = np.zeros((len(names) + 1, SIZE), np.float32)
    for words in split:
        ids = np.array([names.get(w, len(names)) for w in words], dtype=np.int64)
        around = np.zeros((len(ids), SIZE), np.float32)
        for d in range(1, min(SIDE, len(ids) - 1) + 1):
            around[d:] += random[ids[:-d]]
            around[:-d] += random[ids[d:]]
        np.add.at(vectors, ids, around)
    vectors = vectors[:-1] + random[:-1]  # a word's own vector keeps words of the same contexts apart
    return names, vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def fit(sample: list[tuple[str, int]], seed: int = 9) -> Model:
    labels = np.array([y for _, y in sample], dtype=np.float64)
    model = Model(share=float(labels.mean()) if len(labels) else 0.5)
    if len(set(labels.tolist())) < 2:
        return model
    model.words, model.vectors = context_vectors([tokens(t)[0] for t, _ in sample])
    x = np.stack([model.pooled(t) for t, _ in sample])
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(x))
    aside, own = order[: max(1, int(ASIDE * len(x)))], order[max(1, int(ASIDE * len(x))) :]
    model.centre, model.scale = x[own].mean(axis=0), x[own].std(axis=0) + 1e-3
    z = (x - model.centre) / model.scale
    layers = [draw.normal(0, np.sqrt(2 / z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, np.sqrt(2 / HIDDEN), HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    step = 0
    for _ in range(STEPS):
        for rows in np.array_split(draw.permutation(own), max(1, len(own) // BATCH)):
            if not len(rows):
                continue
            hidden = np.maximum(z[rows] @ layers[0] + layers[1], 0)
            error = (1 / (1 + np.exp(-np.clip(hidden @ layers[2] + layers[3], -30, 30))) - labels[rows]) / len(rows)
            back = np.outer(error, layers[2]) * (hidden > 0)
            slopes = [z[rows].T @ back + DECAY * layers[0], back.sum(axis=0), hidden.T @ error + DECAY * layers[2], np.array([error.sum()])]
            step += 1
            for p, g, m, v in zip(layers, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model.layers = (layers[0], layers[1], layers[2], float(layers[3][0]))
    logits = model.logits(x[aside])

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, -np.where(labels[aside] > 0.5, 1, -1) * logits / t)))

    model.temperature = min(np.geomspace(0.25, 16, 60), key=loss)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.  Rows that are held out, or have no id, are never learned from."""
    spark = docs.sparkSession
    arrow_batches(spark)
    learn = labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("quality"))
    learn = learn.where(F.col("__id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("__id")))
    chosen = learn.groupBy("__id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("__id"), "__id").limit(fit_rows)
    sample = texts(docs, "doc_id").join(chosen, F.col("doc_id") == F.col("__id")).groupBy("doc_id").agg(F.min(F.struct("text", "quality")).alias("row")).orderBy("doc_id")
    model = spark.sparkContext.broadcast(fit([(r.row.text, r.row.quality) for r in sample.collect()]))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = model.value
        for batch in batches:
            yield pd.Series(own.scores(batch.tolist()), dtype="float64")

    scored = texts(docs, "doc_id").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
