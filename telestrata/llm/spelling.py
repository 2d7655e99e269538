"""Spelling variants by PartEnum signatures.

Words are counted over all texts. Two words are near if they differ by exactly one inserted,
deleted or replaced letter. The letters of such words, as multisets, differ in two elements at
most: seen as binary vectors over (letter, how many-eth of its kind), their Hamming distance is
at most two. The elements are dealt to four parts, so at least two parts of two near words are
equal; every choice of two parts gives a signature, six in all, and near words share one.

Near words also agree in one half, before or after the changed letter. The signature therefore
holds one half of the word too, which keeps words of frequent letters apart; a word is signed
for its own length and for that of a word one letter shorter. Signatures are equi-joined. Inside
the join a sketch of the letters rules most pairs out, and the edit distance decides, so only
near words leave it.

A word's form is its most frequent near word, if that is ten times as frequent; forms are
followed by doubling to the root.

Everything is DataFrame and SQL functions. Defined cases: a null text has no words; an id that
is null is an empty string in the hash. Repeated rows count as often as they occur. Ties between
near words go to the first in code-point order. An empty table has no words; extra columns play
no part.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telestrata.llm.common import stored

LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_RATIO = 10
DELETE_EVERY = 31
PARTS, DIFFERENT = 4, 2  # parts of the vector, and parts in which near words may differ

# The letters of a word, and those that are lower-cased.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)`` of every word of ``docs``; copies end in the partial aggregate.

    Shorter runs can't give a word, as letters are only ever deleted.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}+"), F.lit(0))
    rows = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")
    )
    rows = rows.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    cut = F.expr("concat(substr(run, 1, int(h % length(run))), substr(run, int(h % length(run)) + 2))")
    word = F.when(F.col("h") % DELETE_EVERY == 0, cut).otherwise(F.col("run")).alias("word")
    counts = rows.select(word).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


def elements(word: Column) -> Column:
    """The letter multiset as a set of ``(letter, how many-eth of its kind)``, sorted."""
    letters = F.array_sort(F.split(word, ""))
    return F.transform(
        letters,
        lambda c, i: F.struct(c.alias("c"), (i + 1 - F.array_position(letters, c)).cast("int").alias("k")),
    )


def signatures(counts: DataFrame) -> DataFrame:
    """``(signature, word, n, sketch)``: every signature of every word of ``counts(word, n)``."""
    rows = counts.withColumn("e", elements(F.col("word")))
    bit = "shiftleft(1L, cast(pmod(xxhash64(x.c, x.k), 64) as int))"
    rows = rows.withColumn("sketch", F.expr(f"aggregate(e, 0L, (s, x) -> s ^ {bit})"))
    part = f"pmod(ascii(x.c) + x.k, {PARTS})"
    for p in range(PARTS):
        rows = rows.withColumn(f"p{p}", F.expr(f"xxhash64(filter(e, x -> {part} = {p}))"))
    halves = []
    for shorter in ("length(word)", "(length(word) - 1)"):
        halves.append(f"xxhash64(0, left(word, {shorter} div 2))")
        halves.append(f"xxhash64(1, right(word, {shorter} - {shorter} div 2))")
    # One of the four always repeats another.
    rows = rows.withColumn("half", F.explode(F.expr(f"array_distinct(array({', '.join(halves)}))")))
    kept = list(combinations(range(PARTS), PARTS - DIFFERENT))
    chosen = [f"xxhash64(half, {i}, {', '.join(f'p{p}' for p in each)})" for i, each in enumerate(kept)]
    return rows.select(F.explode(F.expr(f"array({', '.join(chosen)})")).alias("signature"), "word", "n", "sketch")


def near_pairs(counts: DataFrame) -> DataFrame:
    """``(a, a_n, b, b_n)`` of all near words ``a < b``, each pair once."""
    signed = signatures(counts)
    left = signed.selectExpr("signature", "word as a", "n as a_n", "sketch as a_sketch")
    right = signed.selectExpr("signature as b_signature", "word as b", "n as b_n", "sketch as b_sketch")
    near = (
        (F.col("signature") == F.col("b_signature"))
        & (F.col("a") < F.col("b"))
        # A bit of the sketch differs for each element at most, so none is lost.
        & (F.bit_count(F.col("a_sketch").bitwiseXOR(F.col("b_sketch"))) <= DIFFERENT)
        & (F.levenshtein("a", "b", 1) == 1)
    )
    return left.join(right.hint("merge"), near).select("a", "a_n", "b", "b_n").distinct()


def variants(counts: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of ``counts(word, n)``."""
    pairs = near_pairs(counts)
    both = pairs.selectExpr("a as word", "b as other", "b_n as other_n").union(
        pairs.selectExpr("b as word", "a as other", "a_n as other_n")
    )
    # The most frequent one; of equally frequent ones the first.
    most = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("w")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), most.alias("m"))
    rows = counts.join(best, "word", "left")
    is_form = -F.col("m.n") >= FORM_RATIO * F.col("n")
    rows = rows.select(
        "word", "n",
        F.when(is_form, F.col("m.w")).alias("form"),
        F.when(is_form, -F.col("m.n")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )
    rows = stored(rows, "spellings")
    roots = rooted(rows.where("form is not null").select("word", F.col("form").alias("root")))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def rooted(links: DataFrame) -> DataFrame:
    """``(word, root)``: the ends of the chains ``links(word, root)``, each round twice as far.

    A form is ten times as frequent as its word, so chains are short and have no loops.
    """
    while True:
        further = links.select(F.col("word").alias("at"), F.col("root").alias("next"))
        links = stored(
            links.join(further, F.col("root") == F.col("at"), "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        if links.where("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``variants`` of the words of ``docs``."""
    return variants(stored(words(docs, doc_id, text), "word-counts"))
