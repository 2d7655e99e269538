"""Benchmark decontamination over canonical templates.

A text becomes a sequence of words in which numbers, units after a number, and names
(capitalised words inside a sentence) give way to typed placeholders; the replaced words
are kept as slot values. Windows of eight such forms are hashed and joined with the
windows of the benchmark items. Along one alignment of a document and an item every
slot value of the item must always meet the same value of the document; then the
document may ask the item's question with other numbers and names. A document is
contaminated if consistent alignments cover at least half of an item's windows.

Everything is DataFrame and SQL functions.

Defined cases: a null or empty text has no windows. An item shorter than a window is
matched as a whole, by windows of its own length. A window of fewer than three ordinary
words (for short items: none) is no evidence. Items without other windows, such as sums or rows of
names, are matched by the plain values of their windows instead, if they have at least six words
and numbers; windows of bare numbers are no evidence there either. Items with equal text are reported under the smallest item id. Repeated
documents are judged alike, also under one id; extra columns play no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telestrata.llm.common import fresh, stored

WINDOW = 8
LEAST_WORDS = 3  # ordinary words in a window that counts
LEAST_PLAIN = 6  # words and numbers of an item that is matched by plain values
LEAST_COVER = 0.5
BROADCAST_WINDOWS = 1_000_000  # beyond it the windows are joined by a shuffle

# Words that are units after a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml cl l s sec second seconds min minute minutes "
    "h hr hour hours day days week weeks month months year years usd eur gbp dollar dollars "
    "euro euros cent cents percent degree degrees mph kmh watt watts volt volts"
).split()

# A word or number, with what comes before it if a sentence ends there.
# Possessive, as Java's other quantifiers recurse over groups and end on a long row of numbers.
TOKEN = r"(?:[.!?\n][^\p{L}\p{M}0-9]*+)?+(?:[\p{L}\p{M}]++|[0-9]++(?:[.,][0-9]++)*+)"
_UNITS = ", ".join(f"'{u}'" for u in UNITS)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


#: The token before each token; a line break before the first.
BEFORE = "slice(concat(array(char(10)), tokens), 1, size(tokens))"

# The kind of slot that token k after token p is, else null. Of all first and last characters
# of tokens only digits and sentence ends sort before 'A'; most tokens are lower-case words
# and leave at the first comparison.
KIND = f"""case
    when k >= 'a' and k < '{{' and p >= 'A' then null
    when right(k, 1) < ':' then '#'
    when p = char(10) then null
    when right(p, 1) < ':' and lower(k) in ({_UNITS}) then '%'
    when k < 'A' then null
    when left(k, 1) <> lower(left(k, 1)) and substr(k, 2, 1) <> upper(substr(k, 2, 1)) then '@'
  end"""
PLAIN = r"""case
    when k >= 'a' and k < '{' then k
    when k < 'A' then lower(regexp_replace(k, '^[^\\p{L}\\p{M}0-9]+', ''))
    else lower(k)
  end"""


def form_hashes(texts: DataFrame, text: Column, plain: bool = False) -> DataFrame:
    """``texts`` with ``h``, the hashes of the canonical forms of ``text``, or of its ``plain`` values."""
    forms = f"zip_with(tokens, {BEFORE}, (k, p) -> xxhash64(coalesce({KIND}, {PLAIN})))"
    if plain:
        forms = f"transform(tokens, k -> xxhash64('plain', {PLAIN}))"
    return texts.withColumn("tokens", tokens(text)).withColumn("h", F.expr(forms))


def templated(texts: DataFrame, text: Column, plain: bool = False) -> DataFrame:
    """``texts`` with ``h`` and ``slots``, the kind and value of each slot (null for words).

    Of plain values the words are kept, not the numbers.
    """
    slots = f"zip_with(tokens, {BEFORE}, (k, p) -> concat({KIND}, {PLAIN}))"
    if plain:
        slots = f"transform(tokens, k -> case when {PLAIN} >= ':' then {PLAIN} end)"
    return form_hashes(texts, text, plain).withColumn("slots", F.expr(slots)).drop("tokens")


def with_window_hashes(cells: DataFrame, width: int) -> DataFrame:
    """``cells`` with ``ws``: at each position the hash of the window that begins there.

    The last ``width - 1`` positions have no window and hold hashes that no window has.
    Windows of twice a length are pairs of windows, so eight forms take three passes. Each
    pass is a column of its own, because Spark would inline a nested expression. Generators
    over these columns are outer ones: for others Spark infers a filter on the size, pushes it
    down to the scan and computes everything there once more.
    """
    if width & (width - 1):
        each = f"i -> xxhash64(slice(h, i, {width}), {width})"
        return cells.withColumn(
            "ws",
            F.expr(f"case when size(h) >= {width} then transform(sequence(1, size(h) - {width - 1}), {each}) end"),
        )
    out, length = cells.withColumn("ws", F.col("h")), 1
    while length < width:
        later = f"slice(ws, {length + 1}, size(ws))"
        out = out.withColumn("ws", F.expr(f"zip_with(ws, {later}, (a, b) -> xxhash64(a, b, {length}))"))
        length *= 2
    return out


def windows(cells: DataFrame, width: int) -> DataFrame:
    """One row ``(pos, w, s)`` for each window: its hash and its slot values, beside the rest."""
    rest = [c for c in cells.columns if c not in ("h", "slots")]
    return with_window_hashes(cells, width).select(
        *rest,
        F.expr(
            f"""inline_outer(case when size(slots) >= {width} and size(ws) > 0 then
                transform(sequence(1, size(slots) - {width - 1}), i ->
                  named_struct('pos', i, 'w', ws[i - 1],
                    's', filter(slice(slots, i, {width}), x -> x is not null))) end)"""
        ),
    )


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(item, width, plain, total, item_pos, w, item_slots)`` of the benchmark, a row per window."""
    whole = items.select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    single = whole.where("text is not null").groupBy("text").agg(F.min("item").alias("item"))
    known = _split(templated(single, F.col("text")).drop("text"), 1).where(
        F.col("width") - F.size("s") >= F.when(F.col("width") < WINDOW, 1).otherwise(LEAST_WORDS)
    )
    known = stored(known.withColumn("plain", F.lit(False)), "item-windows")
    bare = single.join(known.select("item").distinct(), "item", "left_anti")
    bare = _split(templated(bare, F.col("text"), plain=True).drop("text"), LEAST_PLAIN).where(F.size("s") > 0)
    known = known.unionByName(bare.withColumn("plain", F.lit(True)))
    totals = known.groupBy("item").agg(F.count(F.lit(1)).alias("total"))
    return known.join(totals, "item").select(
        "item", "width", "plain", "total", F.col("pos").alias("item_pos"), "w", F.col("s").alias("item_slots")
    )


def _split(cells: DataFrame, least: int) -> DataFrame:
    """The windows of items, of their own length for short ones of at least ``least`` forms."""
    parts = []
    for width in range(least, WINDOW + 1):
        fits = F.size("h") >= width if width == WINDOW else F.size("h") == width
        parts.append(windows(cells.where(fits), width).withColumn("width", F.lit(width)))
    return reduce(DataFrame.union, parts).where("pos is not null")


def matches(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(id, print, item, covered, total)`` of each contaminated document and item.

    ``print`` is a hash of the text, so that documents under one id are told apart.
    """
    bench = stored(item_windows(items, item_id, item_text), "template-windows")
    small = bench.count() <= BROADCAST_WINDOWS
    # At most WINDOW widths of either kind.
    kinds = sorted(map(tuple, bench.select("width", "plain").distinct().collect()))
    base = docs.select(
        F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("print"), F.col(text).alias("text")
    ).where("text is not null")
    keys = F.broadcast(bench) if small else bench
    if not kinds:
        return docs.sparkSession.createDataFrame(
            [], base.select("id", "print").schema
            .add("item", items.schema[item_id].dataType).add("covered", "long").add("total", "long")
        )
    # First only hashes pass by; slots are read in documents that share a window.
    near = []
    for width, plain in kinds:
        hashed = form_hashes(base, F.col("text"), plain).select("id", "print", "h")
        every = with_window_hashes(hashed, width).select("id", "print", F.explode_outer("ws").alias("w"))
        known = keys.where((F.col("width") == width) & (F.col("plain") == plain)).select("w")
        near.append(every.join(known, "w", "left_semi").select("id", "print"))
    near = stored(reduce(DataFrame.union, near).distinct().toDF("near_id", "near_print"), "near-items")
    shared = base["id"].eqNullSafe(near["near_id"]) & (base["print"] == near["near_print"])
    suspects = base.join(near, shared, "left_semi")
    parts = []
    for width, plain in kinds:
        cells = templated(suspects, F.col("text"), plain).drop("text")
        known = keys.where((F.col("width") == width) & (F.col("plain") == plain))
        met = windows(cells, width).where("pos is not null").join(known, "w")
        parts.append(met.select(
            "id", "print", "item", "total", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"),
            F.arrays_zip(F.col("item_slots").alias("mine"), F.col("s").alias("theirs")).alias("pairs"),
        ))
    met = reduce(DataFrame.union, parts)
    met = stored(met, "template-matches")
    alignment = ["id", "print", "item", "shift"]
    broken = (
        met.select(*alignment, F.explode("pairs").alias("p"))
        .select(*alignment, "p.mine", "p.theirs")
        .groupBy(*alignment, "mine")
        .agg(F.min("theirs").alias("lo"), F.max("theirs").alias("hi"))
        .where("lo <> hi")
        .select(*alignment)
        .distinct()
    )
    same = [met[c].eqNullSafe(broken[c]) for c in alignment]
    condition = same[0] & same[1] & same[2] & same[3]
    return (
        met.join(broken, condition, "left_anti")
        .select("id", "print", "item", "total", "item_pos")
        .distinct()
        .groupBy("id", "print", "item", "total")
        .agg(F.count(F.lit(1)).alias("covered"))
        .where(F.col("covered") >= F.col("total") * LEAST_COVER)
        .select("id", "print", "item", "covered", "total")
    )


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, item_id, covered, total)`` of each contaminated document and item."""
    return (
        matches(docs, items)
        .groupBy(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "total")
        .agg(F.max("covered").alias("covered"))
    )


def cleaned(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the contaminated ones."""
    bad = stored(matches(docs, items, doc_id, text).select("id", "print").distinct(), "contaminated")
    a, b = fresh("id", docs), fresh("print", docs)
    left = docs.withColumn(a, F.col(doc_id)).withColumn(b, F.xxhash64(F.col(text)))
    bad = bad.toDF("bad_id", "bad_print")
    condition = left[a].eqNullSafe(bad["bad_id"]) & (left[b] == bad["bad_print"])
    return left.join(bad, condition, "left_anti").select(*docs.columns)
