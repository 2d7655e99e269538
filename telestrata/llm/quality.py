"""Quality rules by a hashed n-gram likelihood ratio.

Words and word pairs are hashed into buckets. Two multinomials are estimated over them,
one from the trusted documents and one from the whole corpus; a document's score is
the mean log-ratio of its n-grams, so length plays no part. A fifth of the trusted documents,
drawn by a hash of the id, takes no part in the estimate; the threshold lies a margin below the
first percentile of their scores. Documents below it go, as do those that fail plain rules on
length and repetition.

Everything is DataFrame and SQL functions. Log-ratios are rounded to millionths and summed as
integers, so a score doesn't depend on the order of the sum.

Defined cases: a null or wordless text has no words, score 0, and fails the rules. A
document is trusted if it has a label and all its labels say so; labels without an id
are ignored. Without trusted documents all log-ratios are 0; without held-out ones the
threshold is ``THRESHOLD``. Every row gets its own
result, also repeated ones; extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telestrata.llm.common import id_remainder, stored

BUCKETS = 1 << 17
SMOOTHING = 1.0
HELD_OUT = 5  # one trusted document in so many sets the threshold
MARGIN = 0.05  # nats below the first percentile of their scores
STEP = 0.005  # nats; the percentile is found in steps of this size
THRESHOLD = -0.15  # least mean log-ratio without held-out documents
SCALE = 1_000_000
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent
WINDOW = 8

# White space and the signs that count as symbols.
SPACE = r"[\x09-\x0D\x20]+"
SYMBOLS = "#*$%&|<>"


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def with_grams(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``words``, their hashes ``g1``, and the hashes of pairs ``g2``.

    ``g2`` has one element for each word; the last one stands for no pair. Each array is a
    column of its own, because Spark would inline a nested expression.
    """
    return (
        docs.withColumn("words", words(F.col(text)))
        .withColumn("g1", F.expr("transform(words, w -> xxhash64(w))"))
        .withColumn("g2", F.expr("zip_with(g1, slice(g1, 2, size(g1)), (a, b) -> xxhash64(a, b))"))
    )


def buckets() -> Column:
    """The bucket of every word and every pair, null for an empty document.

    The generator is an outer one, as Spark would infer a filter on the size for another,
    push it down to the scan and compute the arrays there once more.
    """
    grams = "concat(g1, slice(g2, 1, greatest(size(g2) - 1, 0)))"
    return F.explode_outer(F.expr(f"transform({grams}, g -> cast(pmod(g, {BUCKETS}) as int))"))


def log_ratios(docs: DataFrame, trusted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(bucket, weight)`` of each bucket in the corpus; at most ``BUCKETS`` rows."""
    # The ids grow with the corpus, so they are shuffled at every size.
    ids = trusted.select(F.col(doc_id).alias("id"), F.lit(1).alias("trusted")).hint("merge")
    marked = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(ids, "id", "left")
    counts = (
        with_grams(marked, "text")
        .select("trusted", buckets().alias("bucket"))
        .where("bucket is not null")
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.count("trusted").alias("good"))
    )
    counts = stored(counts, "ngram-counts")
    total = counts.agg(F.sum("raw").alias("all_raw"), F.sum("good").alias("all_good"))
    a = F.lit(SMOOTHING)
    share = lambda n, of: (n + a) / (of + a * BUCKETS)
    ratio = F.log(share(F.col("good"), F.col("all_good")) / share(F.col("raw"), F.col("all_raw")))
    weight = F.when(F.col("all_good") > 0, F.round(ratio * SCALE)).otherwise(0).cast("long")
    return counts.crossJoin(F.broadcast(total)).select("bucket", weight.alias("weight"))


def trusted_ids(labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    known = labels.where(F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.min(label).alias("least"))
    return known.where("least = 1").select(doc_id)


def threshold(held_out: DataFrame) -> DataFrame:
    """One row ``least``: the least score to keep, from the scores of trusted documents.

    Counts per step are exact and bounded by the range of the scores.
    """
    steps = held_out.groupBy(F.floor(F.col("score") / STEP).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("step"))
    total = F.sum("n").over(Window.partitionBy())
    low = steps.select("step", upto.alias("upto"), total.alias("total")).where("upto * 100 >= total")
    return low.agg(F.coalesce(F.min("step") * STEP - MARGIN, F.lit(THRESHOLD)).alias("least"))


def base_features(docs: DataFrame, text: str) -> DataFrame:
    """``docs``, having ``words``, ``g1`` and ``g2``, with the columns of the plain rules."""
    t = f"coalesce(`{text}`, '')"
    eight = docs
    for source, out, step in (("g2", "g4", 2), ("g4", "g8", 4)):
        each = f"zip_with({source}, slice({source}, {step + 1}, size({source})), (a, b) -> xxhash64(a, b))"
        eight = eight.withColumn(out, F.expr(each))
    return (
        eight.withColumn("windows", F.expr(f"slice(g8, 1, greatest(size(g8) - {WINDOW - 1}, 0))"))
        .withColumn(
            "ordered",
            F.expr(
                """case when size(array_distinct(windows)) < size(windows)
                   then sort_array(transform(windows, (w, i) -> named_struct('w', w, 'i', i))) end"""
            ),
        )
        .withColumn(
            "repeated",
            F.expr(
                """sort_array(array_distinct(flatten(filter(
                     zip_with(ordered, slice(ordered, 2, size(ordered)),
                       (a, b) -> case when a.w = b.w then array(a.i, b.i) end),
                     x -> x is not null))))"""
            ),
        )
        .withColumn("lines", F.expr(rf"filter(split({t}, '\\n'), l -> l rlike '[^\\x09-\\x0D\\x20]')"))
        .withColumns(
            {
                "n_words": F.expr("cast(size(words) as bigint)"),
                "word_chars": F.expr("cast(length(array_join(words, '')) as bigint)"),
                "n_symbols": F.expr(
                    f"cast(octet_length({t}) - octet_length(translate({t}, '{SYMBOLS}', '')) as bigint)"
                ),
                "n_dup_lines": F.expr("cast(size(lines) - size(array_distinct(lines)) as bigint)"),
                # Each repeated window adds the words that the next one doesn't add.
                "n_repeat_words": F.expr(
                    f"""coalesce(aggregate(
                          zip_with(repeated, slice(repeated, 2, size(repeated)),
                            (a, b) -> least({WINDOW}, coalesce(b - a, {WINDOW}))),
                          0L, (total, n) -> total + n), 0L)"""
                ),
            }
        )
    )


def judge(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """One row per document: the base columns, ``score`` and ``kept``.

    The weights are broadcast: there are at most ``BUCKETS`` of them.
    """
    trusted = trusted_ids(labels, doc_id, label)
    aside = id_remainder(doc_id, HELD_OUT) == 0
    weights = log_ratios(docs, trusted.where(~aside), doc_id, text)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    featured = base_features(with_grams(rows, "text"), "text")
    grams = featured.select("row", "doc_id", *base, buckets().alias("bucket"))
    scored = (
        grams.join(F.broadcast(weights), "bucket", "left")
        .groupBy("row", "doc_id", *base)
        .agg(
            (F.coalesce(F.sum("weight"), F.lit(0)) / F.greatest(F.count("bucket"), F.lit(1)) / SCALE).alias("score")
        )
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    scored = stored(scored.select("doc_id", *base, failed.alias("base_failed"), "score"), "quality-scores")
    ids = trusted.where(aside).select(F.col(doc_id).alias("doc_id")).hint("merge")
    least = threshold(scored.where(~F.col("base_failed")).join(ids, "doc_id", "left_semi"))
    return scored.crossJoin(F.broadcast(least)).select(
        "doc_id", *base, "base_failed", (~F.col("base_failed") & (F.col("score") >= F.col("least"))).alias("kept"), "score"
    )
