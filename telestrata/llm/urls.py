"""URL filtering by rules and a character language-model ratio.

Rules on hosts and paths decide first; the longest fitting rule wins. The URLs that rules
decide also train two character models, one of accepted and one of rejected URLs. Each is a
variable-order Markov model: the probability of a character after up to four others, where
every order is smoothed with the next lower one by the number of different characters
seen after its context. All other URLs are judged by the difference of the two
log-likelihoods per character; the threshold is the one that decides most rule-decided URLs
as their rules do.

Everything is DataFrame and SQL functions. Log-probabilities are rounded to millionths and
summed as integers, so sums don't depend on their order.

Defined cases: a null URL or one without ``://`` has an empty host and path; no rule fits
it, its score is 0. Without rule-decided URLs of both kinds every other URL is allowed.
Repeated rows count as often as they occur and get equal verdicts; ties between thresholds
go to the lower one, which allows more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telestrata.llm.common import stored

ORDER = 4  # characters of context at most
SCALE = 1_000_000
STEP = 100  # thresholds are multiples of this many millionths per character

# Verdict, host and path prefix of each rule.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://([^/?#]*)", 1)
    return F.translate(after, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, null without one."""
    chain = None
    for verdict, name, prefix in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        value = F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        chain = F.when(fits, value) if chain is None else chain.when(fits, value)
    return chain


def grams(urls: DataFrame) -> DataFrame:
    """A row for every character of ``text``, with the four characters before it.

    Code point 1 stands for the characters before the first.
    """
    padded = f"concat(repeat(char(1), {ORDER}), text)"
    each = f"transform(sequence(1, length(text)), i -> substr({padded}, i, {ORDER + 1}))"
    return urls.withColumn("gram", F.explode_outer(F.expr(f"case when text <> '' then {each} end")))


def log_ratios(counts: DataFrame) -> DataFrame:
    """``(gram, ratio)`` for each gram of ``counts(gram, allow, block)``.

    Goes up the orders: the tables hold distinct grams only, so no row stands for many.
    """
    total = {side: F.sum(side).alias(side) for side in ("allow", "block")}
    below = None
    for order in range(ORDER + 1):
        here = counts.groupBy(F.expr(f"right(gram, {order + 1})").alias("gram")).agg(*total.values())
        here = here.withColumn("context", F.expr(f"left(gram, {order})"))
        context = here.groupBy("context").agg(
            *[F.sum(s).alias(f"{s}_n") for s in total],
            *[F.sum(F.when(F.col(s) > 0, 1).otherwise(0)).alias(f"{s}_kinds") for s in total],
            F.count(F.lit(1)).alias("kinds"),
        )
        joined = here.join(context, "context")
        if below is None:
            # Below all orders every character that occurs is equally likely.
            joined = joined.withColumns({f"{s}_low": 1.0 / F.col("kinds") for s in total})
        else:
            low = below.select(F.col("gram").alias("tail"), *[F.col(f"{s}_p").alias(f"{s}_low") for s in total])
            joined = joined.withColumn("tail", F.expr(f"right(gram, {order})")).join(low, "tail")
        below = joined.select(
            "gram",
            *[
                F.expr(
                    f"({s} + greatest({s}_kinds, 1) * {s}_low) / ({s}_n + greatest({s}_kinds, 1))"
                ).alias(f"{s}_p")
                for s in total
            ],
        )
    ratio = F.round((F.log("allow_p") - F.log("block_p")) * SCALE).cast("long")
    return below.select("gram", ratio.alias("ratio"))


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, score``."""
    base = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    ruled = rule_of(F.col("host"), F.col("path"), rules)
    base = base.withColumn("r", ruled).select("page_id", "host", "path", "r.rule", F.col("r.verdict").alias("by_rule"))
    # Equal URLs are scored once; a host that all share costs nothing more.
    texts = base.groupBy(F.concat("host", "path").alias("text"), "by_rule").agg(F.count(F.lit(1)).alias("n"))
    texts = stored(texts, "urls")
    per_gram = grams(texts).where("gram is not null")
    counts = per_gram.groupBy("gram").agg(
        *[F.sum(F.when(F.col("by_rule") == s, F.col("n")).otherwise(0)).alias(s) for s in ("allow", "block")]
    )
    ratios = stored(log_ratios(stored(counts, "url-grams")), "url-ratios")
    scored = (
        per_gram.join(ratios, "gram")
        .groupBy("text", "by_rule", "n")
        .agg((F.sum("ratio") / F.count(F.lit(1))).alias("mean"))
    )
    scored = stored(scored.withColumn("step", F.floor(F.col("mean") / STEP).cast("long")), "url-scores")
    judged = scored.crossJoin(F.broadcast(threshold(scored)))
    verdict = F.when(F.col("step") >= F.coalesce("least", "step"), "allow").otherwise("block")
    by_text = judged.select("text", (F.col("mean") / SCALE).alias("score"), verdict.alias("by_model")).distinct()
    return (
        base.withColumn("text", F.concat("host", "path"))
        .join(by_text, "text", "left")
        .select(
            "page_id", "host", "path", "rule",
            F.coalesce("by_rule", "by_model", F.lit("allow")).alias("verdict"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
        )
    )


def threshold(scored: DataFrame) -> DataFrame:
    """One row ``least``: the step from which on to allow; null without both kinds.

    Works on totals per step, of which the range of mean log-ratios allows a bounded number
    (about 30 nats by 10,000 steps).
    """
    known = scored.where("by_rule is not null")
    steps = known.groupBy("step").agg(
        F.sum(F.when(F.col("by_rule") == "allow", F.col("n")).otherwise(0)).alias("allow"),
        F.sum(F.when(F.col("by_rule") == "block", F.col("n")).otherwise(0)).alias("block"),
    )
    before = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    # Wrong if everything from this step on is allowed: the allowed below, the blocked from here.
    wrong = F.coalesce(F.sum("allow").over(before), F.lit(0)) - F.coalesce(F.sum("block").over(before), F.lit(0))
    best = steps.withColumn("wrong", wrong).agg(
        F.min(F.struct("wrong", "step")).alias("best"), F.sum("allow").alias("a"), F.sum("block").alias("b")
    )
    return best.select(F.when((F.col("a") > 0) & (F.col("b") > 0), F.col("best.step")).alias("least"))

