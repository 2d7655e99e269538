"""Collocations by SON partitioning.

Phrases of two and three words that keep together, per language. The texts are mined in two
passes over all documents:

1. Every input split belongs to one of ``SHARDS`` shards. Each shard is mined completely, for
   words and phrases alike, at the support divided by the number of shards: a phrase that falls
   short of that in every shard falls short of the support overall. Phrases travel as 64-bit
   hashes, packed by hash range; a collision can only make a phrase look more frequent, so none
   is lost. The locally frequent phrases of all shards are united in a bit table.
2. All phrases that the table knows are counted exactly, as strings. Whatever the table let
   through by chance falls to the support.

The score of a phrase compares its count with those of its two parts, for the cut that keeps
least together: ``floor(1000000 a a / (l r))`` in exact decimals. Phrases that mostly occur
inside a longer frequent one are dropped. The best ``TOP`` of each language are ranked, in steps
that leave a bounded number of rows for the last one.

A task holds a few megabytes of text and a bounded number of counts at a time; a text longer
than that is cut where no phrase passes. What is broadcast is the bit table, 128 MB at most: 16
bits for each candidate while that fits; beyond it more chance phrases are counted in vain.

Defined cases: a null text is empty; a null language is ``und``. Repeated rows and equal texts
count as often as they occur. Ties in score are ordered by count and then by phrase. Without
frequent phrases the result is empty. Extra columns play no part, and ids are not needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telestrata.llm.common import mixed, ship, slices, stored

SUPPORT = 10
SHARDS = 3
LONGEST = 3
TOP = 2000
DROPPED_AT = (50, 100)  # share of a phrase inside a longer one, as a fraction
NO_LANGUAGE = "und"

CHUNK = 2 << 20  # bytes of text that a task looks at together
HELD = 1_500_000  # counts that a task of the first pass holds before it passes them on
BUCKET_BYTES = 16 << 20  # text for each hash range of the first pass
MOST_BITS = 30  # of the bit table, as a power of two
BITS_PER_CANDIDATE = 16

# The characters between pieces and between words, all of them ASCII.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(PIECE_ENDS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


# Phrases of a chunk


@dataclass
class Words:
    """The words of a stretch of texts, in order; at least one."""

    which: np.ndarray  # number of each word in ``spelled``
    spelled: pa.Array  # the different words
    joined: np.ndarray  # whether a word follows the one before it in the same piece
    lang: np.ndarray  # number of each word's language
    hashes: np.ndarray  # of the different words


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (and the last ends)."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.empty(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks_of(texts: pa.Array, langs: np.ndarray, size: int = CHUNK) -> Iterator[Words]:
    """The words of all texts, about ``size`` bytes of text at a time."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    for a, b in slices(sizes, size):
        yield from _chunks(texts.slice(a, b - a), langs[a:b], size)


def _chunks(texts: pa.Array, langs: np.ndarray, size: int) -> Iterator[Words]:
    """The words of one long text or of several short ones."""
    data, at = _bytes_of(texts)
    if not len(data):
        return
    kind = _KIND[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[at] = True
    begins = begins[:-1]
    safe = np.flatnonzero(begins | (kind == 2))
    cuts = safe[np.minimum(np.searchsorted(safe, np.arange(size, len(data), size)), len(safe) - 1)]
    cuts = np.unique(np.concatenate([[0], cuts, [len(data)]]))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        words = _words(data[a:b], kind[a:b], begins[a:b], at, a, langs)
        if words is not None:
            yield words


def _words(data, kind, begins, at, first, langs) -> Words | None:
    import xxhash

    inside = kind == 0
    if not inside.any():
        return None
    start = inside.copy()
    start[1:] &= ~inside[:-1] | begins[1:]
    starts = np.flatnonzero(start)
    before = np.cumsum(inside, dtype=np.int32)
    offsets = np.concatenate([before[starts] - 1, before[-1:]]).astype(np.int32)
    spelled = pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(_LOWER[data[inside]]))
    ).dictionary_encode()
    row = np.searchsorted(at, starts + first, side="right") - 1
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    joined = np.zeros(len(starts), bool)
    joined[1:] = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
    each = (xxhash.xxh64_intdigest(w.as_buffer()) for w in spelled.dictionary.cast(pa.binary()))
    hashes = np.fromiter(each, np.uint64, len(spelled.dictionary))
    return Words(spelled.indices.to_numpy().astype(np.int64), spelled.dictionary, joined, langs[row], hashes)


def phrases(words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length: it, where each different phrase first begins, and how often it occurs.

    A phrase is told from others by the numbers of its words, so nothing is mistaken here.
    """
    here = np.arange(len(words.which))
    known = words.lang
    for length in range(1, LONGEST + 1):
        last = here + length - 1
        # The phrase so far and the word after it, as one number.
        number = known * len(words.spelled) + words.which[last]
        _, first, known, n = np.unique(number, return_index=True, return_inverse=True, return_counts=True)
        yield length, here[first], n
        on = last + 1 < len(words.which)
        on[on] = words.joined[last[on] + 1]
        here, known = here[on], known[on]


def hashed(words: Words, langs: np.ndarray, length: int, first: np.ndarray) -> np.ndarray:
    """64-bit hashes of phrases; ``langs`` are those of the languages."""
    out = mixed(langs[words.lang[first]] + np.uint64(length))
    for i in range(length):
        out = mixed(out ^ words.hashes[words.which[first + i]])
    return out


def _languages(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different languages, the number of each row's, and their hashes."""
    import xxhash

    coded = column.fill_null(NO_LANGUAGE).dictionary_encode()
    hashes = [xxhash.xxh64_intdigest(x) for x in coded.dictionary.to_pylist()]
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.array(hashes, np.uint64)


# First pass: mining the shards


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, and the sum of ``n`` of each."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[at], np.add.reduceat(n, at, dtype=np.int64)


def least_local(support: int) -> int:
    """The support that a phrase reaches in one shard at least."""
    return -(-support // SHARDS)


def _packed(keys: np.ndarray, n: np.ndarray, power: int, shard: int) -> pa.RecordBatch:
    """Sorted keys and their counts, one row for each hash range."""
    bucket = (keys >> np.uint64(64 - power)).astype(np.int32) if power else np.zeros(len(keys), np.int32)
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])[: len(bucket)])
    ends = np.concatenate([at, [len(keys)]]).astype(np.int32)

    def split(values: np.ndarray) -> pa.Array:
        offsets = pa.py_buffer(ends * np.int32(values.itemsize))
        return pa.Array.from_buffers(pa.binary(), len(at), [None, offsets, pa.py_buffer(values)])

    columns = [pa.array(bucket[at]), pa.array(np.full(len(at), shard, np.int32)), split(keys), split(n)]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "shard", "keys", "n"])


def local_counts(docs: DataFrame, power: int, support: int) -> DataFrame:
    """Phrase hashes of ``docs(lang, text)`` and their counts, packed by hash range and shard.

    Counts are cut off at the local support: sums reach it all the same.
    """
    enough = least_local(support)

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() % SHARDS
        held, number = [], 0
        for batch in batches:
            _, lang, salts = _languages(batch.column(0))
            for words in chunks_of(batch.column(1).fill_null(""), lang):
                for length, first, n in phrases(words):
                    held.append((hashed(words, salts, length, first), np.minimum(n, enough).astype(np.uint8)))
                    number += len(n)
                if number >= HELD:
                    held = [_merged(held, enough)]
                    number = len(held[0][0])
                    if number >= HELD // 2:
                        yield _packed(*held[0], power, shard)
                        held, number = [], 0
        keys, n = _merged(held, enough)
        if len(keys):
            yield _packed(keys, n, power, shard)

    return docs.mapInArrow(mine, "bucket int, shard int, keys binary, n binary")


def _merged(held: list, enough: int) -> tuple[np.ndarray, np.ndarray]:
    if not held:
        return np.empty(0, np.uint64), np.empty(0, np.uint8)
    keys, n = summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
    return keys, np.minimum(n, enough).astype(np.uint8)


def _numbers(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in column)])


def locally_frequent(counts: DataFrame, support: int) -> DataFrame:
    """``(bucket, shard, number, keys)``: the phrases that reach the local support in a shard."""
    enough = least_local(support)

    def keep(group: pa.Table) -> pa.Table:
        keys, n = summed(_numbers(group["keys"], np.uint64), _numbers(group["n"], np.uint8))
        keys = keys[n >= enough]
        return pa.table(
            {
                "bucket": group["bucket"].slice(0, 1),
                "shard": group["shard"].slice(0, 1),
                "number": pa.array([len(keys)], pa.int64()),
                "keys": pa.array([keys.tobytes()], pa.binary()),
            }
        )

    schema = "bucket int, shard int, number long, keys binary"
    return counts.groupBy("bucket", "shard").applyInArrow(keep, schema)


def bit_table(candidates: DataFrame, power: int) -> np.ndarray:
    """The united candidates as bits, addressed by the highest bits of a hash; bounded."""
    number = candidates.agg(F.coalesce(F.sum("number"), F.lit(0))).first()[0]
    bits = int(min(MOST_BITS, max(power + 3, 16, np.ceil(np.log2(max(number, 1) * BITS_PER_CANDIDATE)))))
    each = 1 << (bits - power)  # bits of a hash range

    def unite(group: pa.Table) -> pa.Table:
        keys = _numbers(group["keys"], np.uint64)
        place = (keys >> np.uint64(64 - bits)) & np.uint64(each - 1)
        found = np.zeros(each, bool)
        found[place.astype(np.int64)] = True
        return pa.table({"bucket": group["bucket"].slice(0, 1), "bits": [np.packbits(found).tobytes()]})

    out = np.zeros((1 << power, each // 8), np.uint8)
    rows = candidates.groupBy("bucket").applyInArrow(unite, "bucket int, bits binary")
    for bucket, packed in rows.toLocalIterator():
        out[bucket] = np.frombuffer(packed, np.uint8)
    return out.reshape(-1)


# Second pass: exact counts


def _known(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys >> np.uint64(64 - int(len(table) * 8).bit_length() + 1)
    byte = table[(place >> np.uint64(3)).astype(np.int64)]
    return (byte >> (np.uint8(7) - (place & np.uint64(7)).astype(np.uint8))) & 1 == 1


def exact_counts(docs: DataFrame, table: np.ndarray, support: int) -> DataFrame:
    """``(lang, size, phrase, n)``: counts of all frequent phrases of ``docs(lang, text)``.

    Size 0 stands for all words of a language together.
    """
    shared = ship(docs.sparkSession).sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, lang, salts = _languages(batch.column(0))
            for words in chunks_of(batch.column(1).fill_null(""), lang):
                yield _all_words(words, names)
                for length, first, n in phrases(words):
                    likely = _known(shared.value, hashed(words, salts, length, first))
                    # The partial aggregate adds up the chunks of a task.
                    yield _named(words, names, length, first[likely], n[likely])

    counts = docs.mapInArrow(count, "lang string, size int, phrase string, n long")
    totals = counts.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return totals.where((F.col("n") >= support) | (F.col("size") == 0))


def _all_words(words: Words, names: pa.Array) -> pa.RecordBatch:
    n = np.bincount(words.lang, minlength=len(names))
    return pa.RecordBatch.from_pydict(
        {
            "lang": names,
            "size": pa.array(np.zeros(len(n), np.int32)),
            "phrase": pa.array([""] * len(n)),
            "n": pa.array(n.astype(np.int64)),
        }
    )


def _named(words: Words, names: pa.Array, length: int, first: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    parts = [words.spelled.take(pa.array(words.which[first + i])) for i in range(length)]
    return pa.RecordBatch.from_pydict(
        {
            "lang": names.take(pa.array(words.lang[first])),
            "size": pa.array(np.full(len(first), length, np.int32)),
            "phrase": pc.binary_join_element_wise(*parts, " ") if length > 1 else parts[0],
            "n": pa.array(n.astype(np.int64)),
        }
    )


# Scores and ranks


def scored(counts: DataFrame) -> DataFrame:
    """``(lang, phrase, size, a, l, r, score)`` of each phrase of two words or more."""
    long = counts.where("size >= 2").withColumnRenamed("n", "a")
    cuts = long.select(
        "lang", "phrase", "size", "a",
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"),
    ).withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("right", F.expr("substr(phrase, length(left) + 2)"))
    parts = counts.where(f"size between 1 and {LONGEST - 1}")
    cuts = cuts.join(parts.selectExpr("lang", "phrase as left", "n as l"), ["lang", "left"])
    cuts = cuts.join(parts.selectExpr("lang", "phrase as right", "n as r"), ["lang", "right"])
    exact = {c: F.col(c).cast("decimal(15,0)") for c in "alr"}
    score = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * exact["a"] * exact["a"], exact["l"] * exact["r"])
    cuts = cuts.withColumn("score", score)
    least = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return least.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def without_fragments(rows: DataFrame) -> DataFrame:
    """``rows`` without the phrases that mostly occur inside a longer one."""
    longer = rows.where("size >= 3")
    inner = longer.select(
        "lang",
        F.explode(
            F.array(
                F.expr("substr(phrase, 1, length(phrase) - length(substring_index(phrase, ' ', -1)) - 1)"),
                F.expr("substr(phrase, length(substring_index(phrase, ' ', 1)) + 2)"),
            )
        ).alias("phrase"),
        F.col("a").alias("outer"),
    )
    most = inner.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    up, down = DROPPED_AT
    mostly = F.coalesce(F.col("outer") * down >= F.col("a") * up, F.lit(False))
    return rows.join(most, ["lang", "phrase"], "left").where(~mostly).drop("outer")


def ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language with their ``rank``.

    Groups by a hash of the phrase lose all rows that can't be among them, so the last step has a
    bounded number of rows for each language.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for groups in (4096, 16, 1):
        group = F.pmod(F.xxhash64("phrase"), F.lit(groups))
        place = F.row_number().over(Window.partitionBy("lang", group).orderBy(*order))
        rows = rows.withColumn("rank", place).where(F.col("rank") <= top)
    return rows


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, top: int = TOP
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best phrases of each language."""
    ship(docs.sparkSession)
    kept = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    size = kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    power = max(0, int(np.ceil(np.log2(max(size, 1) / BUCKET_BYTES))))
    found = stored(locally_frequent(local_counts(kept, power, support), support), "frequent-phrases")
    counts = stored(exact_counts(kept, bit_table(found, power), support), "phrase-counts")
    best = ranked(without_fragments(stored(scored(counts), "phrase-scores")), top)
    totals = counts.where("size = 0").select("lang", F.col("n"))
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"
    )
