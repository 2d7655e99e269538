"""Toxicity of deobfuscated text.

Written disguises are undone by a noisy channel first. A stretch of text that looks
disguised - digits or signs amid letters, three equal letters in a row, letters spaced
out one by one - becomes a lattice of readings: a sign may stand for a letter, a run
for one or two letters, a gap for nothing. The Viterbi path under a character trigram
model of the whole corpus is the restored text.

The score comes from hashed n-grams inside words of the restored text: the mean of the
strongest evidence that different n-grams of the document give, through a logistic curve.
Evidence is the smoothed log-odds of an n-gram's presence in toxic and other documents.

A null text counts as empty; an empty text has no n-grams and gets the curve's value for no
evidence. Without labelled rows of both kinds every score is 0. Rows don't influence each
other's score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telestrata.llm.common import id_remainder, ship
from telestrata.llm.subwords import (
    bounded_sample,
    chunks,
    code_points,
    letters,
    ngrams,
    words_only,
)

ORDERS = (5, 6)
BITS = 20
TOP = 6  # n-grams whose evidence counts in a document
SAMPLE_PER_CLASS = 4000  # the bound on labelled rows that training reads, per label
SAMPLE_MAX_CHARS = 50_000  # longer texts are left out of that sample

# Letters that a sign or digit may stand for.
STANDS_FOR = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "€": "e",
    "+": "t",
}
GAPS = " .-_*"

# Costs of the channel, in nats.
SUBSTITUTED = 1.0
LITERAL_SIGN = 3.0
COLLAPSED = 0.5
KEPT_RUN = 4.0
CLOSED_GAP = 0.3
KEPT_GAP = 1.0

SIGN = "".join(re.escape(c) for c in STANDS_FOR)
LETTER = r"[^\W\d_]"
SUSPECT = re.compile(
    rf"(?<!\S){LETTER}(?:[ .*_-]{LETTER}){{2,}}(?!\w)"  # spaced out
    rf"|(?<!\S)[^\s{SIGN}]*(?:[{SIGN}]+{LETTER}|{LETTER}[0-9]|({LETTER})\1\1)\S*"
)


# The character model


ALPHABET = 64


@cache
def classes() -> np.ndarray:
    """Class of each code point: 0 no letter, 1-26 a-z, then Latin-1 letters, then any other."""
    table = np.where(letters(), ALPHABET - 1, 0).astype(np.int64)
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    table[0xDF:0x100] = np.where(letters()[0xDF:0x100], 27 + np.arange(33), 0)
    return table


def trigram_counts(texts: list[str]) -> np.ndarray:
    total = np.zeros(ALPHABET**3, np.int64)
    for a, b in chunks(texts):
        points, _ = words_only(texts[a:b])
        c = classes()[points]
        if len(c) > 2:
            total += np.bincount((c[:-2] * ALPHABET + c[1:-1]) * ALPHABET + c[2:], minlength=len(total))
    return total


def corpus_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Character trigrams of every document; at most ``ALPHABET ** 3`` rows reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ALPHABET**3, np.int64)
        for batch in batches:
            total += trigram_counts([t or "" for t in batch.column(0).to_pylist()])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    ship(docs.sparkSession)
    rows = docs.select(text).mapInArrow(count, "at long, n long")
    out = np.zeros(ALPHABET**3, np.int64)
    for at, n in rows.groupBy("at").agg(F.sum("n")).collect():
        out[at] = n
    return out


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Log-probability of each letter after two others, lower orders mixed in."""
    three = counts.reshape(ALPHABET, ALPHABET, ALPHABET).astype(np.float64)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p = (one + 1) / (one.sum() + ALPHABET)
    p = (two + 20 * p) / (two.sum(axis=1, keepdims=True) + 20)
    p = (three + 20 * p) / (three.sum(axis=2, keepdims=True) + 20)
    return np.log(p).astype(np.float32)


# The noisy channel


def _class(letter: str) -> int:
    return int(classes()[ord(letter)])


def lattice(text: str) -> list[list[tuple[int, str, float]]]:
    """Readings from each position: where they end, what they say, what they cost."""
    n, out, i = len(text), [], 0
    arcs: list[list[tuple[int, str, float]]] = [[] for _ in range(n)]
    spaced = bool(re.fullmatch(rf"{LETTER}(?:[ .*_-]{LETTER}){{2,}}", text))
    while i < n:
        c = text[i]
        run = i + 1
        while run < n and text[run] == c:
            run += 1
        if c.isalpha():
            if run - i >= 3:
                arcs[i] += [(run, c, COLLAPSED), (run, c + c, COLLAPSED), (run, c * (run - i), KEPT_RUN)]
                i = run
                continue
            arcs[i].append((i + 1, c, 0.0))
        else:
            if spaced and c in GAPS:
                arcs[i] += [(i + 1, "", CLOSED_GAP), (i + 1, " ", KEPT_GAP)]
            else:
                arcs[i].append((i + 1, c, LITERAL_SIGN if c in STANDS_FOR else 0.0))
            arcs[i] += [(i + 1, letter, SUBSTITUTED) for letter in STANDS_FOR.get(c, "")]
        i += 1
    out = arcs
    return out


def restored_stretch(text: str, logp: np.ndarray) -> str:
    """The likeliest reading of one disguised stretch (lower case).

    States are the last two letter classes; ties keep the reading found first.
    """
    n, arcs = len(text), lattice(text)
    best: list[dict[tuple[int, int], tuple[float, int, tuple[int, int] | None, str]]] = [{} for _ in range(n + 1)]
    best[0][(0, 0)] = (0.0, -1, None, "")
    for i in range(n):
        for state, (cost, *_) in best[i].items():
            for end, said, price in arcs[i]:
                (a, b), total = state, cost + price
                for letter in said:
                    c = _class(letter)
                    if c or b:
                        total -= float(logp[a, b, c])
                    a, b = b, c
                known = best[end].get((a, b))
                if known is None or total < known[0]:
                    best[end][(a, b)] = (total, i, state, said)
    finals = {s: v[0] - float(logp[s[0], s[1], 0]) * bool(s[1]) for s, v in best[n].items()}
    at, state, parts = n, min(finals, key=finals.get), []
    while at > 0:
        _, at, state, said = best[at][state]
        parts.append(said)
    return "".join(reversed(parts))


def suspects(points: np.ndarray) -> np.ndarray:
    """Ascending places in a lower-cased text where something ``SUSPECT`` looks for stands."""
    if len(points) < 2:
        return np.empty(0, np.int64)
    letter = letters()[points]
    low = np.minimum(points, 0x2FFF)
    sign, gap = _signs()[low], _gaps()[low]
    digit = (points >= 48) & (points <= 57)
    found = np.zeros(len(points), bool)
    found[:-1] |= (sign[:-1] & letter[1:]) | (letter[:-1] & digit[1:])
    found[:-2] |= letter[2:] & (points[2:] == points[1:-1]) & (points[2:] == points[:-2])
    found[:-4] |= letter[:-4] & gap[1:-3] & letter[2:-2] & gap[3:-1] & letter[4:]
    return np.flatnonzero(found)


@cache
def _signs() -> np.ndarray:
    return np.isin(np.arange(0x3000), [ord(c) for c in STANDS_FOR])


@cache
def _gaps() -> np.ndarray:
    return np.isin(np.arange(0x3000), [ord(c) for c in GAPS])


MEMO = 100_000


class Restorer:
    def __init__(self, logp: np.ndarray):
        self.logp = logp
        self.memo: dict[str, str] = {}

    def __call__(self, text: str) -> str:
        """``text`` in lower case with its disguised stretches restored.

        A stretch begins at the start of a word, so only words around suspects are tried.
        """
        low = text.lower()
        parts, upto, tried = [], 0, -1
        for at in suspects(code_points(low)).tolist():
            start = at
            while start > max(upto, tried + 1) and not low[start - 1].isspace():
                start -= 1
            if start < upto or start <= tried:
                continue
            tried = start
            if match := SUSPECT.match(low, start):
                parts += [low[upto:start], self._replace(match)]
                upto = match.end()
        return "".join([*parts, low[upto:]]) if parts else low

    def _replace(self, match: re.Match) -> str:
        stretch = match.group()
        if stretch not in self.memo:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[stretch] = restored_stretch(stretch, self.logp)
        return self.memo[stretch]


# The classifier


@dataclass
class ToxicityModel:
    logp: np.ndarray
    odds: np.ndarray  # evidence of each bucket
    slope: float
    offset: float

    def evidence(self, restored: list[str]) -> np.ndarray:
        """Mean of the ``TOP`` largest odds of different n-grams of each text, at least 0."""
        points, starts = words_only(restored)
        which, buckets = [], []
        for order in ORDERS:
            found, places = ngrams(points, order, BITS)
            speaks = self.odds[found] > 0
            which.append(np.searchsorted(starts, places[speaks], side="right") - 1)
            buckets.append(found[speaks])
        pairs = np.unique((np.concatenate(which) << BITS) | np.concatenate(buckets))
        return top_means(pairs >> BITS, self.odds[pairs & ((1 << BITS) - 1)], len(restored))

    def score(self, restored: list[str]) -> np.ndarray:
        if not self.slope:
            return np.zeros(len(restored))
        return 1 / (1 + np.exp(-(self.slope * self.evidence(restored) + self.offset)))


def top_means(which: np.ndarray, odds: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` texts the mean of its ``TOP`` largest odds, missing ones being 0."""
    order = np.lexsort((-odds, which))
    which, odds = which[order], odds[order]
    place = np.arange(len(which)) - np.searchsorted(which, which)
    first = place < TOP
    return np.bincount(which[first], odds[first], minlength=n) / TOP


def _present(text: str) -> np.ndarray:
    points, _ = words_only([text])
    found = np.concatenate([ngrams(points, order, BITS)[0] for order in ORDERS])
    return np.unique(found).astype(np.int32)  # half the driver's memory


def train(texts: list[str], toxic: list[int], totals: tuple[int, int], logp: np.ndarray) -> ToxicityModel:
    """Odds from two thirds of the rows, the curve from the rest.

    ``totals`` are the numbers of labelled rows without and with toxicity, which the
    sample needn't keep in proportion.
    """
    restore = Restorer(logp)
    y = np.array(toxic, bool)
    sets = [_present(restore(t)) for t in texts]
    count = np.zeros((2, 1 << BITS))
    rows = np.zeros(2)
    for i, (buckets, t) in enumerate(zip(sets, toxic)):
        if i % 3:
            count[t, buckets] += 1
            rows[t] += 1
    share = (count + 0.5) / (rows[:, None] + 1)
    odds = np.log(share[1] / share[0])
    if not sets:
        return ToxicityModel(logp, odds.astype(np.float32), 0.0, 0.0)
    heard = [np.maximum(odds[s], 0) for s in sets[::3]]
    which = np.repeat(np.arange(len(heard)), [len(h) for h in heard])
    x = top_means(which, np.concatenate(heard), len(heard))
    seen = y[::3]
    if not rows.all() or seen.all() or not seen.any():
        return ToxicityModel(logp, odds.astype(np.float32), 0.0, 0.0)
    slope, offset = _logistic(x, seen)
    kept = y.sum(), len(y) - y.sum()
    offset += np.log(max(totals[1], 1) / max(totals[0], 1)) - np.log(kept[0] / max(kept[1], 1))
    return ToxicityModel(logp, odds.astype(np.float32), slope, float(offset))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope (at least a little above 0) and offset of a logistic curve, by Newton steps."""
    centre = x.mean()
    a = np.stack([x - centre, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        w -= np.clip(np.linalg.solve(h, a.T @ (p - y) + ridge * w), -5, 5)
    slope = max(float(w[0]), 1e-6)
    return slope, float(w[1] - slope * centre)


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> ToxicityModel:
    """Character model from all documents, classifier from a bounded labelled sample.

    The sample is drawn from ``labels`` alone (the larger label of an id counts), at most
    ``SAMPLE_PER_CLASS`` ids per label, so these ids can be broadcast. Of several texts
    under one id the smallest is used.
    """
    logp = log_probabilities(corpus_counts(docs, text))
    marked = labels.select(
        F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"), id_remainder(doc_id, 5).alias("fold")
    )
    marked = marked.where("id is not null and y in (0, 1) and fold <> 0").groupBy("id").agg(F.max("y").alias("y"))
    ids = bounded_sample(marked, "y", "id", SAMPLE_PER_CLASS, [])
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    texts = texts.where(F.length("text") <= SAMPLE_MAX_CHARS)
    rows = (
        texts.join(F.broadcast(ids.select("id", "y", "label_rows", "label_rank")), "id")
        .groupBy("id", "y", "label_rows", "label_rank")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    rows.sort(key=lambda r: (r["label_rank"], r["y"]))
    totals = {r["y"]: r["label_rows"] for r in rows}
    return train(
        [r["text"] for r in rows], [r["y"] for r in rows], (totals.get(0, 0), totals.get(1, 0)), logp
    )


def scorer(model: ToxicityModel, session):
    """A function on text columns; the model has a fixed size."""
    shared = ship(session).sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        restore = Restorer(shared.value.logp)
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            parts = [shared.value.score([restore(t) for t in texts[a:b]]) for a, b in chunks(texts)]
            yield pa.array(np.concatenate([np.zeros(0), *parts]))

    return score


def restorer(model: ToxicityModel, session):
    """A function on text columns: the text in lower case, disguises undone."""
    shared = ship(session).sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def restore_column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        restore = Restorer(shared.value.logp)
        for batch in batches:
            yield pa.array([None if t is None else restore(t) for t in batch.to_pylist()], pa.string())

    return restore_column


def scores(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its fold, score and verdict."""
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return kept.select(
        "doc_id",
        (id_remainder("doc_id", 5) == 0).alias("held_out"),
        scorer(model, docs.sparkSession)(F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
