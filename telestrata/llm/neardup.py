"""Near duplicates by ProbMinHash, banding and verification.

A document is the multiset of its five-word shingles (lower-cased words between white
space; a document of fewer words is one shingle). Every shingle sends arrivals of an
exponential process, at a rate that grows with the logarithm of its count; each arrival hits
one component of the signature, which keeps its earliest shingle. A shingle stops as soon as
its next arrival is later than all components. Two components agree with the probability
Jaccard similarity of the documents, which is the Jaccard similarity where shingles don't
repeat. A document with repeated shingles is signed once more with equal rates, so that copies
with other repeats meet as well.

Bands of six components give buckets. A pair of a bucket is verified exactly, unless the sizes
or one-bit sketches of the shingle sets already rule it out, or the number of shingles that come
in other components as well: the Jaccard similarity of the sets must reach 0.8. Large buckets aren't multiplied out: see ``verified_roots``. Linked documents
and equal texts form classes.

A pair of similarity 0.8 shares a bucket with a probability of 0.9993. The bits of the sketches
differ independently; the limit on their differences, a parameter, lies eight deviations away, so
fewer than one in 10 ** 14 such pairs would be ruled out (1,024 switches the sketches off).

Defined cases: equal texts are one class, also empty ones. A null text is a class of its
own. An id with several texts stands for all of them. Rows without id belong to the class
of their text. Repeated rows share a class, and extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telestrata.llm.common import fresh, mixed, ship, slices, stored
from telestrata.llm.components import components

WIDTH = 5
BANDS, ROWS = 24, 6
SIGNATURE = BANDS * ROWS
SIMILAR = (4, 5)  # least similarity, as a fraction
SKETCH = 1024  # bits of a sketch of the shingle set
MOST_UNLIKE = 180  # of them may differ: 8 deviations above those of a similarity of 0.8
CHUNK = 200_000  # shingles that a task handles at once
CENTRES = 8  # members of a bucket that the others are compared with after the smallest
STEPS = ((0, 1), (1, 3), (3, 8), (8, BANDS))  # of 24 parts of the buckets


# Shingles


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the words of a text, in order."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of all shingles of one document, repeats included."""
    if not len(words):
        return np.empty(0, np.uint64)
    width = min(WIDTH, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for j in range(width):
        out = mixed(out ^ words[j : j + n])
    return out


def _lists(batch: pa.Array) -> Iterator[np.ndarray]:
    """The numbers of each list of a batch, without copies."""
    flat = batch.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    ends = batch.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield flat[a:b]


# Signatures


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], size: int = SIGNATURE) -> np.ndarray:
    """One row of ``size`` shingles for each ``(distinct shingles, rates)``."""
    n = len(sets)
    element = np.concatenate([s for s, _ in sets])
    rate = np.concatenate([c for _, c in sets]).astype(np.float64)
    doc = np.repeat(np.arange(n), [len(s) for s, _ in sets])
    earliest = np.full(n * size, np.inf)
    chosen = np.zeros(n * size, np.uint64)
    state, when = element.copy(), np.zeros(len(element))
    while len(element):
        state = mixed(state + np.uint64(0x9E3779B97F4A7C15))
        uniform = ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        when = when - np.log(uniform) / rate
        hit = (mixed(state ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(size)).astype(np.int64)
        slot = doc * size + hit
        np.minimum.at(earliest, slot, when)
        won = earliest[slot] == when
        chosen[slot[won]] = element[won]
        latest = earliest.reshape(n, size).max(axis=1)
        go = when < latest[doc]
        element, rate, doc, state, when = (x[go] for x in (element, rate, doc, state, when))
    return chosen.reshape(n, size)


def band_hashes(rows: np.ndarray) -> np.ndarray:
    """A bucket for each band of each signature; different bands never mean to share one."""
    parts = rows.reshape(len(rows), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for j in range(ROWS):
        out = mixed(out ^ parts[:, :, j])
    return out.view(np.int64)


def sketches(rows: np.ndarray) -> np.ndarray:
    """One bit of each component of ``SKETCH`` components, 64 of them in a number.

    A shingle has a bit of its own in each component, so that the bits of a few shingles don't
    all differ together.
    """
    component = mixed(np.arange(1, SKETCH + 1, dtype=np.uint64))
    bits = (mixed(rows ^ component) & np.uint64(1)).reshape(len(rows), SKETCH // 64, 64)
    return np.bitwise_or.reduce(bits << np.arange(64, dtype=np.uint64), axis=2).view(np.int64)


def unlike(a: str, b: str) -> Column:
    """Number of bits that differ between the sketch columns ``a`` and ``b``."""
    return F.expr(" + ".join(f"bit_count({a}[{i}] ^ {b}[{i}])" for i in range(SKETCH // 64)))


def _chunked(sets: list[tuple[np.ndarray, np.ndarray]], size: int, at_most: int) -> np.ndarray:
    """Signatures of all sets, a bounded number of shingles at a time."""
    cost = np.array([max(len(s), 8 * size) for s, _ in sets], np.int64)
    parts = [signatures(sets[a:b], size) for a, b in slices(cost, at_most)]
    return np.concatenate([np.empty((0, size), np.uint64), *parts])


def _pieces(batch: pa.Array) -> Iterator[list[np.ndarray]]:
    """The lists of a batch, a bounded number of words at a time."""
    lists = list(_lists(batch))
    for a, b in slices(np.array([len(w) for w in lists], np.int64), CHUNK):
        yield lists[a:b]


def _rates(counts: np.ndarray) -> list[np.ndarray]:
    """Rates of each signature of a document: by repeats and, if any shingle repeats, all equal."""
    if not len(counts):
        return []
    return [1 + np.log2(counts), np.ones(len(counts))][: 1 + bool((counts > 1).any())]


def _bands(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        found, sizes = [np.empty(0, np.int64)], [0]
        for piece in _pieces(batch):
            sets = [np.unique(shingles(w), return_counts=True) for w in piece]
            rates = [_rates(n) for _, n in sets]
            each = [(s, rate) for (s, _), mine in zip(sets, rates) for rate in mine]
            rows = iter(band_hashes(_chunked(each, SIGNATURE, CHUNK)))
            for mine in rates:
                # Both signatures may name the same bucket.
                found.append(np.unique([next(rows) for _ in mine]).astype(np.int64))
                sizes.append(len(found[-1]))
        offsets = np.cumsum(sizes).astype(np.int32)
        yield pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found)))


SETS = "struct<shingles:array<long>,sketch:array<long>>"


def _shingle_sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.concat_arrays([_sets_of([]), *map(_sets_of, _pieces(batch))])


def _sets_of(words: list[np.ndarray]) -> pa.Array:
    """``(shingles, sketch)`` of some documents."""
    sets = [np.unique(shingles(w)) for w in words]
    rows = _chunked([(s, np.ones(len(s))) for s in sets if len(s)], SKETCH, CHUNK)
    flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
    lists = []
    for values, sizes in (
        (flat, [len(s) for s in sets]),
        (sketches(rows).ravel(), [SKETCH // 64 * bool(len(s)) for s in sets]),
    ):
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        lists.append(pa.ListArray.from_arrays(offsets, pa.array(values)))
    return pa.StructArray.from_arrays(lists, ["shingles", "sketch"])


# Links and classes


def signed(docs: DataFrame) -> DataFrame:
    """``(id, print, bands)`` of each row of ``docs(id, text)`` with a text; written once."""
    ship(docs.sparkSession)
    return stored(
        docs.where("text is not null").select(
            "id",
            F.md5(F.col("text").cast("binary")).alias("print"),
            F.arrow_udf(_bands, "array<long>")(word_hashes(F.col("text"))).alias("bands"),
        ),
        "signed",
    )


def representatives(signatures: DataFrame) -> DataFrame:
    """One ``(print, bands, rep)`` per text; copies end in the partial aggregate."""
    return signatures.groupBy("print", "bands").agg(F.min("id").alias("rep"))


def _taken(low: int, high: int) -> Column:
    """The buckets of a document that fall into some of the steps; hashes deal them evenly."""
    return F.filter("bands", lambda b: F.pmod(b, F.lit(BANDS)).between(low, high - 1))


def sharing(reps: DataFrame) -> DataFrame:
    """``(rep)`` of the documents of ``reps(rep, bands)`` that share a bucket with another.

    Goes by steps over the buckets and looks only at documents not found yet: a member of a large
    group shows in one of its first buckets.
    """
    every = reps.select(F.explode("bands").alias("bucket"), "rep")
    shared = every.groupBy("bucket").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"))
    shared = stored(shared.where("lo <> hi").select("bucket"), "shared-buckets")
    left, found = reps, []
    for low, high in STEPS:
        here = left.select(F.explode(_taken(low, high)).alias("bucket"), "rep")
        found.append(stored(here.join(shared, "bucket", "left_semi").select("rep").distinct(), "sharing"))
        left = left.join(found[-1], "rep", "left_anti")
    return reduce(DataFrame.union, found)


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(rep, shingles, sketch, size)`` of the documents that share a bucket with another."""
    ship(docs.sparkSession)
    texts = docs.withColumnRenamed("id", "rep").where("text is not null")
    found = F.arrow_udf(_shingle_sets, SETS)(word_hashes(F.col("text")))
    near = texts.join(wanted, "rep", "left_semi").select("rep", found.alias("s"))
    return near.select("rep", "s.*", F.size("s.shingles").alias("size"))


def with_shared(sets: DataFrame, roots: DataFrame) -> DataFrame:
    """``sets`` with ``shared``, how many of the shingles other components under ``roots`` have as well.

    Two documents of different components have at most the smaller of their two numbers in common,
    however many documents share a passage.
    """
    keyed = rooted(sets, roots).withColumn("of", F.xxhash64("rep", "shingles"))
    each = keyed.select("of", "root", F.explode("shingles").alias("shingle"))
    held = each.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    several = stored(held.where("lo <> hi").select("shingle"), "shared-shingles")
    own = each.drop("root").distinct().join(several, "shingle", "left_anti")
    own = own.groupBy("of").agg(F.count(F.lit(1)).alias("n"))
    shared = F.col("size") - F.coalesce("n", F.lit(0))
    return keyed.join(own, "of", "left").select(*sets.columns, shared.alias("shared"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs(a, b)`` whose shingle sets are similar enough."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
    up, down = SIMILAR
    common = F.size(F.array_intersect("x", "y"))
    similar = common * down >= (F.size("x") + F.size("y") - common) * up
    return pairs.join(right, "b").join(left, "a").where(similar).select("a", "b")


def rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with ``root``, that of ``rep`` under ``roots(node, root)``."""
    named = roots.withColumnRenamed("node", "rep")
    return rows.join(named, "rep", "left").withColumn("root", F.coalesce("root", "rep"))


MEMBER = ("rep", "root", "sketch", "size", "shared")


def _chosen(posts: DataFrame, turn: str) -> DataFrame:
    """The members of each bucket that all others of it are compared with.

    In the last turn with their buckets and with ``most``, the bucket's largest component.
    """
    columns = [*MEMBER, "bands", "most"] if turn == "all" else MEMBER
    member = F.struct(*MEMBER)
    if turn == "smallest":
        found = posts.groupBy("bucket").agg(F.min(member).alias("m"))
    elif turn == "few":
        group = F.pmod(F.xxhash64("bucket", "rep"), F.lit(CENTRES)).alias("g")
        found = posts.groupBy("bucket", group).agg(F.min_by(member, F.xxhash64("rep")).alias("m"))
    else:
        parts = posts.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
        largest = parts.groupBy("bucket").agg(F.max(F.struct("n", "root"))["root"].alias("most"))
        outside = posts.join(largest, "bucket").where("root <> most")
        found = outside.select("bucket", F.struct(*columns).alias("m"))
    return found.select("bucket", *[F.col(f"m.{c}").alias(f"c_{c}") for c in columns])


def verified_roots(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``(node, root)`` of the components of all similar pairs in a bucket.

    ``members`` is ``(rep, bands, sketch, size)``. Members are compared with chosen ones of their
    buckets: with the smallest, in steps over the buckets, then with a few drawn by a hash, and at
    last with all outside the bucket's largest component. After each turn components are formed
    anew; buckets whose members are of one component are settled, and members of one component are
    never compared again. So a group of near copies meets in few of its buckets, and the last
    turn covers every pair of different components: no pair is left out. It begins with a count of the
    shingles that components share, so that a common passage doesn't make pairs of all its documents.
    """
    up, down = SIMILAR
    members, roots = members.withColumns({"root": F.col("rep"), "shared": F.col("size")}), None
    for turn, low, high in [*(("smallest", *step) for step in STEPS), ("few", 0, BANDS), ("all", 0, BANDS)]:
        if turn == "all":
            found = with_shared(sets, roots).select("rep", "size", "sketch", "shared")
            members = members.drop("size", "sketch", "shared").distinct().join(found, "rep")
            members = stored(members.where(F.col("shared") * down >= F.col("size") * up), "members")
        posts = members.withColumn("bucket", F.explode(_taken(low, high)))
        posts = posts if turn == "all" else posts.drop("bands")
        several = posts.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        posts = stored(posts.join(several.where("lo <> hi").select("bucket"), "bucket", "left_semi"), "unsettled")
        # Similar sets are at most one step of size apart.
        step = lambda size: F.floor(F.log(size) / F.log(F.lit(down / up))).cast("int")
        steps = F.array(*[step("c_size") + i for i in (-1, 0, 1)])
        chosen = _chosen(posts, turn).withColumn("c_step", F.explode(steps)).withColumnRenamed("bucket", "c_bucket")
        plausible = (
            (F.col("bucket") == F.col("c_bucket"))
            & (step("size") == F.col("c_step"))
            & (F.col("root") != F.col("c_root"))
            & (F.col("size") * down >= F.col("c_size") * up)
            & (F.col("c_size") * down >= F.col("size") * up)
            & (F.least("shared", "c_shared") * (up + down) >= (F.col("size") + F.col("c_size")) * up)
            & (unlike("sketch", "c_sketch") <= MOST_UNLIKE)
        )
        if turn == "all":
            # Of two members outside the largest component one is the chosen one, and two that
            # share several buckets are compared in the first of these.
            first = F.array_min(F.array_intersect("bands", "c_bands"))
            plausible &= ((F.col("root") == F.col("c_most")) | (F.col("rep") < F.col("c_rep"))) & (F.col("bucket") == first)
        pairs = posts.join(chosen, plausible).select(
            F.least("rep", "c_rep").alias("a"), F.greatest("rep", "c_rep").alias("b")
        )
        links = verified(stored(pairs.distinct(), "pairs"), sets)
        if roots is not None:
            links = links.union(roots.selectExpr("node as a", "root as b"))
        roots = components(links)
        if turn != "all":
            members = stored(rooted(members.drop("root"), roots), "members")
    return roots


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One ``(doc_id, class_id)`` per row of ``docs``; the smallest id names the class."""
    kept = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    prints = signed(kept)
    return _membership(kept, prints).select(F.col("id").alias("doc_id"), "class_id")


def _roots(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """``(print, class_id)`` of each text that has an id."""
    reps = stored(representatives(prints), "representatives")
    named = reps.where("rep is not null").select("rep", "bands")
    sets = stored(shingle_sets(docs, sharing(named)), "shingle-sets")
    members = named.join(sets.select("rep", "sketch", "size"), "rep")
    # An id with several texts joins the groups of equal texts that it is in.
    several = prints.groupBy("id").agg(F.min("print").alias("lo"), F.max("print").alias("hi"))
    several = several.where("id is not null and lo <> hi").select("id")
    own = prints.select("id", "print").join(several, "id", "left_semi").join(reps, "print")
    found = verified_roots(members, sets).selectExpr("node as a", "root as b")
    roots = components(found.union(own.selectExpr("id as a", "rep as b")))
    found = reps.where("rep is not null").join(roots, reps["rep"] == roots["node"], "left")
    return found.select("print", F.coalesce("root", "rep").alias("class_id"))


def _membership(docs: DataFrame, prints: DataFrame) -> DataFrame:
    classed = prints.select("id", "print").join(_roots(docs, prints), "print", "left")
    whole = classed.select("id", F.coalesce("class_id", "id").alias("class_id"))
    return whole.union(docs.where("text is null").selectExpr("id", "id as class_id"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class: that with the smallest id.

    Of rows that repeat that id the one with the smallest text stays. Rows without id go
    if a row with id has their text; otherwise one of each text stays. Rows whose text and
    id are both null stay.
    """
    kept = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    prints = signed(kept)
    members = stored(_membership(kept, prints).where("id is not null"), "classes")
    name = fresh("id", docs)
    gone = members.where("id <> class_id").select(F.col("id").alias(name)).distinct()
    gone = stored(gone, "gone")
    again = members.groupBy("id").count().where("count > 1").select(F.col("id").alias(name))
    again = stored(again, "repeated")
    left = docs.where(F.col(doc_id).isNotNull()).withColumn(name, F.col(doc_id))
    left = left.join(gone, name, "left_anti")
    once = left.join(again, name, "left_anti").drop(name)
    rank = fresh("rank", docs)
    order = Window.partitionBy(name).orderBy(F.col(text).asc_nulls_last())
    first = left.join(again, name, "left_semi").withColumn(rank, F.row_number().over(order))
    first = first.where(F.col(rank) == 1).drop(rank, name)
    nameless = docs.where(F.col(doc_id).isNull())
    bare = nameless.where(F.col(text).isNull())
    known = prints.where("id is not null").select(F.col("print").alias(name)).distinct()
    spare = nameless.where(F.col(text).isNotNull()).withColumn(name, F.md5(F.col(text).cast("binary")))
    spare = spare.join(known, name, "left_anti").dropDuplicates([name]).drop(name)
    columns = docs.columns
    return once.select(*columns).union(first.select(*columns)).union(spare.select(*columns)).union(bare)
