"""Language identification with averaged hashed subword embeddings.

A text is the mean of the embeddings of its hashed character n-grams inside words;
a linear layer and a softmax turn it into language probabilities. Embeddings and
layer are trained together by stochastic gradient descent in numpy on a bounded
sample of labelled rows. A fifth of that sample isn't trained on: it sets the
temperature of the softmax and the confidence below which a text is rejected.

A null text, and one without a letter, is ``und`` with score 0 and rejected. Without
any labelled row every text is. Rows don't influence each other's prediction; ties
between languages go to the first by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telestrata.llm.common import id_remainder, ship
from telestrata.llm.subwords import bounded_sample, chunks, ngrams, sums_by_text, words_only

ORDERS = (2, 3, 4)
BITS = 16
DIM = 12
EPOCHS = 5
RATE = 0.5
SAMPLE_PER_LANGUAGE = 400  # the bound on labelled rows that training reads
SAMPLE_MAX_CHARS = 50_000  # longer texts are left out of that sample
REJECT_SHARE = 0.001  # of the texts that calibration knows may be rejected
UNDETERMINED = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # summand of each bucket: logits, or embeddings if those are fewer
    weights: np.ndarray | None  # from embeddings to logits
    bias: np.ndarray
    temperature: float = 1.0
    least_confidence: float = 0.0

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Logits and number of features of each text."""
        points, starts = words_only(texts)
        total = np.zeros((len(texts), self.table.shape[1]))
        number = np.zeros(len(texts))
        for order in ORDERS:
            buckets, places = ngrams(points, order, BITS)
            total += sums_by_text(self.table[buckets], places, starts)
            number += np.diff(np.searchsorted(places, np.append(starts, len(points))))
        mean = total / np.maximum(number, 1)[:, None]
        return (mean if self.weights is None else mean @ self.weights) + self.bias, number

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, calibrated confidence and rejection of each text."""
        if not self.languages or not texts:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        logits, number = self.logits(texts)
        p = softmax(logits / self.temperature)
        p[number == 0] = 0
        best, score = p.argmax(axis=1), p.max(axis=1)
        named = [
            self.languages[b] if n else UNDETERMINED for b, n in zip(best.tolist(), number.tolist())
        ]
        return named, score, (number == 0) | (score < self.least_confidence)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _features(text: str) -> tuple[np.ndarray, np.ndarray]:
    points, _ = words_only([text])
    buckets = np.concatenate([ngrams(points, order, BITS)[0] for order in ORDERS])
    return np.unique(buckets, return_counts=True)


def train(texts: list[str], labels: list[str], seed: int = 7) -> LanguageModel:
    """Fit on rows in the given order; every fifth row calibrates."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    weights = np.zeros((DIM, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    rows = [(*_features(t), languages.index(y)) for t, y in zip(texts, labels)]
    rows = [r for r in rows if len(r[0])]
    held = rows[4::5] if len(rows) >= 5 else rows
    fit = [r for i, r in enumerate(rows) if i % 5 != 4]
    if not fit:
        return LanguageModel([], np.zeros((1, 1), np.float32), None, np.zeros(1))
    for epoch in range(EPOCHS):
        rate = np.float32(RATE * (1 - epoch / EPOCHS))
        for i in rng.permutation(len(fit)):
            buckets, counts, y = fit[i]
            share = (counts / counts.sum()).astype(np.float32)
            x = share @ emb[buckets]
            gap = softmax(x @ weights + bias).astype(np.float32)
            gap[y] -= 1
            back = weights @ gap
            weights -= rate * np.outer(x, gap)
            bias -= rate * gap * np.float32(0.1)
            # Each feature moves by its share; scaled so that long texts also learn.
            emb[buckets] -= rate * len(buckets) ** np.float32(0.5) * np.outer(share, back)
    flat = emb @ weights if len(languages) <= DIM else None
    model = LanguageModel(
        languages,
        emb if flat is None else flat.astype(np.float32),
        weights if flat is None else None,
        bias.astype(np.float64),
    )
    z = np.array([(c / c.sum()) @ (emb[b] @ weights) + bias for b, c, _ in held])
    y = np.array([r[2] for r in held])
    return calibrated(model, z, y)


def calibrated(model: LanguageModel, z: np.ndarray, y: np.ndarray) -> LanguageModel:
    """Temperature by likelihood; rejection below what known texts reach."""
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    top = np.sort(softmax(z / model.temperature).max(axis=1))
    model.least_confidence = min(0.5, float(top[int(REJECT_SHARE * len(top))]))
    return model


def fit(docs: DataFrame, label: str = "lang", doc_id: str = "doc_id", text: str = "text") -> LanguageModel:
    """Train on a bounded sample of the rows with a label whose split isn't held out.

    The driver gets at most ``SAMPLE_PER_LANGUAGE`` texts of each label of at most
    ``SAMPLE_MAX_CHARS`` characters.
    """
    labelled = docs.select(
        F.col(doc_id).cast("string").alias("key"), F.col(label).cast("string").alias("label"),
        F.col(text).alias("text"), id_remainder(doc_id, 3).alias("fold"),
    ).where("label is not null and fold <> 1")
    sample = bounded_sample(
        labelled.where(F.length("text") <= SAMPLE_MAX_CHARS), "label", "key", SAMPLE_PER_LANGUAGE, ["text"]
    )
    rows = sample.select("key", "label", "text", "label_rank").collect()
    rows.sort(key=lambda r: (r["label_rank"], r["label"]))
    return train([r["text"] for r in rows], [r["label"] for r in rows])


PREDICTION = "struct<lang:string,score:double,rejected:boolean>"


def predictor(model: LanguageModel, session):
    """A function on text columns. The model's size is fixed but for the labels' names."""
    shared = ship(session).sparkContext.broadcast(model)

    @F.arrow_udf(PREDICTION)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            langs, scores, rejected = [], [], []
            for a, b in chunks(texts):
                l, s, r = shared.value.predict(texts[a:b])
                langs += l
                scores.append(s)
                rejected.append(r)
            yield pa.StructArray.from_arrays(
                [
                    pa.array(langs, pa.string()),
                    pa.array(np.concatenate([np.zeros(0), *scores])),
                    pa.array(np.concatenate([np.zeros(0, bool), *rejected])),
                ],
                ["lang", "score", "rejected"],
            )

    return predict


def prediction(docs: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """Column of ``(lang, score, rejected)`` for ``text``."""
    return predictor(model, docs.sparkSession)(F.col(text))


def identify(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its language, the confidence, and whether it's rejected."""
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = kept.withColumn("p", prediction(kept, model))
    return found.select(
        "doc_id",
        (id_remainder("doc_id", 3) == 1).alias("held_out"),
        F.col("p.lang").alias("lang_pred"),
        F.col("p.score").alias("score"),
        F.col("p.rejected").alias("rejected"),
    )
