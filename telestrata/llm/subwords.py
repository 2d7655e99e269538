"""Hashed character n-grams of many texts at once, and bounded labelled samples."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telestrata.llm.common import fresh, slices

CHUNK = 300_000  # characters handled at once; bounds the memory of a task
SPACE = 32


@cache
def letters() -> np.ndarray:
    """True for every code point that is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    return slices(np.fromiter(map(len, texts), np.int64, len(texts)), CHUNK)


def words_only(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, and where each text begins.

    Texts are lower-cased; every stretch without letters becomes one space, and each
    text begins and ends with one.
    """
    lowered = [t.lower() for t in texts]
    points = code_points(" " + " \0 ".join(lowered) + " ")
    lengths = np.fromiter(map(len, lowered), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths[:-1] + 3)]).astype(np.int64)
    space = ~letters()[points]
    points = np.where(space, np.uint32(SPACE), points)
    keep = np.ones(len(points), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[starts] = True  # two spaces stay between texts, so that they don't run together
    return points[keep], np.cumsum(keep)[starts] - 1


def ngrams(points: np.ndarray, order: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams inside words (a border space may be part), and their places."""
    n = len(points) - order + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    mixed = np.full(n, order, np.uint32)
    inside = np.ones(n, bool)
    for j in range(order):
        part = points[j : j + n]
        mixed = (mixed ^ part) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
        if 0 < j < order - 1:
            inside &= part != SPACE
    # A pair of spaces is the border between two texts.
    inside &= ~((points[:n] == SPACE) & (points[order - 1 :][:n] == SPACE) & (order == 2))
    places = np.flatnonzero(inside)
    return (mixed[places] >> np.uint32(32 - bits)).astype(np.int64), places


def sums_by_text(values: np.ndarray, places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (rows at ascending ``places``) for each text."""
    ends = np.searchsorted(places, np.append(starts[1:], np.iinfo(np.int64).max))
    begins = np.searchsorted(places, starts)
    out = np.zeros((len(starts), *values.shape[1:]), np.float64)
    full = np.flatnonzero(ends > begins)
    if len(full):
        out[full] = np.add.reduceat(values, begins[full], axis=0)
    return out


def bounded_sample(rows: DataFrame, label: str, key: str, cap: int, rest: list[str]) -> DataFrame:
    """At most ``cap`` rows of each label, chosen by a hash of ``key``; with ``label_rows``.

    The labels are counted first (the broadcast side has a row per label); the hash then lets
    through somewhat more than the cap, and only these rows are ranked, so no task receives a
    whole label. ``label_rows`` is the number of rows that the label has in ``rows``.
    """
    draw = fresh("draw", rows)
    u = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(1 << 30))
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("label_rows"))
    near = (
        rows.join(F.broadcast(counts), label)
        .withColumn(draw, u)
        .where(F.col(draw) < F.lit(float(1 << 30)) * (1.3 * cap + 100) / F.col("label_rows"))
    )
    order = Window.partitionBy(label).orderBy(draw, key, *rest)
    ranked = near.withColumn("label_rank", F.row_number().over(order))
    return ranked.where(F.col("label_rank") <= cap).drop(draw)
