"""Operators that compare rows: duplicates, benchmark questions, URLs, archives, components."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from telestrata.llm import decontam, neardup, urls, warc
from telestrata.llm.components import components

DOCS = "doc_id long, text string, lang string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en") for i, t in rows], DOCS)


# Near duplicates


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_classes(rows):
    """Class of each id, by comparing all pairs."""
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in rows:
        for j, t in rows:
            a, b = shingles(s), shingles(t)
            same = s is not None and s == t
            if same or (a and b and 5 * len(a & b) >= 4 * len(a | b)) or i == j:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


def near_copies(seed, n_groups=12, size=9, words=120):
    rng = random.Random(seed)
    rows = []
    for _ in range(n_groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(words)]
        for _ in range(rng.randrange(1, size)):
            copy = list(base)
            for _ in range(rng.randrange(0, 7)):
                copy[rng.randrange(words)] = f"x{rng.randrange(9999)}"
            rows.append(" ".join(copy))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(spark, seed):
    rows = near_copies(seed)
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(frame(spark, rows)).collect()}
    assert got == brute_classes(rows)


def test_short_texts_at_the_least_similarity(spark):
    """Pairs of 4 and 5, 8 and 10, 16 and 20 shingles, all of similarity 0.8."""
    rng, rows = random.Random(8), []
    for n, more in ((8, 1), (12, 2), (20, 4)) * 70:
        words = [f"w{rng.randrange(10**6)}" for _ in range(n + more)]
        rows += [" ".join(words[:n]), " ".join(words)]
    rows = list(enumerate(rows))
    want = brute_classes(rows)
    assert all(want[i] == i - i % 2 for i, _ in rows)
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(frame(spark, rows)).collect()}
    assert got == want


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        copy = list(base)
        copy[rng.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    got = neardup.classes(frame(spark, rows)).select("class_id").distinct().collect()
    assert [r[0] for r in got] == [0]


def test_chains_are_kept_by_later_rounds(spark):
    """One bucket in which only neighbours are similar, the last one not to the first centre."""
    base = [f"w{i}" for i in range(200)]
    step = lambda a: base[a : a + 150]
    rows = [(i, " ".join(step(a))) for i, a in enumerate((0, 12, 24, 36))]
    assert brute_classes(rows) == {0: 0, 1: 0, 2: 0, 3: 0}
    docs = frame(spark, rows).withColumnRenamed("doc_id", "id")
    sets = neardup.shingle_sets(docs, docs.selectExpr("id as rep"))
    members = sets.select("rep", F.array(F.lit(7)).alias("bands"), "sketch", "size")
    roots = neardup.verified_roots(members, sets)
    assert {(r["node"], r["root"]) for r in roots.collect()} == {(1, 0), (2, 0), (3, 0)}


def test_common_passages_make_no_pairs(spark, monkeypatch):
    """Two buckets of documents that share most of their words, of which only two are similar."""
    passage = [f"p{i}" for i in range(160)]
    rows = [(i, " ".join(passage + [f"x{i}_{j}" for j in range(30)])) for i in range(30)]
    rows.append((30, rows[7][1].rsplit(" ", 2)[0]))
    assert brute_classes(rows)[30] == 7 and len(set(brute_classes(rows).values())) == 30
    docs = frame(spark, rows).withColumnRenamed("doc_id", "id")
    sets = neardup.shingle_sets(docs, docs.selectExpr("id as rep"))
    members = sets.select("rep", F.array(F.lit(7), F.lit(9)).alias("bands"), "sketch", "size")
    compared, keep = [], neardup.stored

    def counted(df, name):
        out = keep(df, name)
        compared.extend([out.count()] if name == "pairs" else [])
        return out

    monkeypatch.setattr(neardup, "stored", counted)
    roots = neardup.verified_roots(members, sets)
    assert {(r["node"], r["root"]) for r in roots.collect()} == {(30, 7)}
    assert compared[-1] <= 1


def test_odd_rows(spark):
    rows = [(4, None), (5, None), (6, ""), (7, ""), (8, "one two"), (9, "one two"), (None, "one two"), (None, "alone"), (10, "same id"),
            (10, "other text under it"), (11, "other text under it"), (12, "  ")]
    docs = frame(spark, rows).withColumn("class_id", F.lit("mine")).withColumn("id", F.lit(1))
    got = Counter((r["doc_id"], r["class_id"]) for r in neardup.classes(docs).collect())
    assert got == Counter({(4, 4): 1, (5, 5): 1, (6, 6): 1, (7, 6): 1, (8, 8): 1, (9, 8): 1, (None, 8): 1, (None, None): 1,
                           (10, 10): 2, (11, 10): 1, (12, 12): 1})
    kept = neardup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect()) == [
        (-1, "alone"), (4, ""), (5, ""), (6, ""), (8, "one two"), (10, "other text under it"), (12, "  ")]
    assert neardup.classes(docs.limit(0)).count() == 0 and neardup.deduplicated(docs.limit(0)).count() == 0


def test_repeated_rows_leave_one(spark):
    docs = frame(spark, [(1, "a b c d e f g")] * 3 + [(2, "q r s t u v")])
    assert sorted(r["doc_id"] for r in neardup.deduplicated(docs).collect()) == [1, 2]


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(3)
    elements = rng.integers(1, 2**63, 300, dtype=np.uint64)
    a = np.sort(elements[:200]), rng.integers(1, 5, 200)
    b = np.sort(elements[100:]), rng.integers(1, 5, 200)
    rows = neardup.signatures([a, b])
    weights = [dict(zip(x.tolist(), w.tolist())) for x, w in (a, b)]
    common = set(weights[0]) & set(weights[1])
    want = sum(
        1 / sum(max(weights[0].get(j, 0) / weights[0][i], weights[1].get(j, 0) / weights[1][i]) for j in set(weights[0]) | set(weights[1]))
        for i in common
    )
    assert abs((rows[0] == rows[1]).mean() - want) < 4 * math.sqrt(want / neardup.SIGNATURE)


def test_copies_with_other_repeats_share_a_bucket():
    rng = np.random.default_rng(4)
    for _ in range(40):
        words = rng.integers(1, 2**62, 154)
        often = np.concatenate([np.tile(words[:54], 20), words[54:]])
        batch = pa.array([words.tolist(), often.tolist(), []], pa.list_(pa.int64()))
        a, b, none = [set(x) for x in next(neardup._bands(iter([batch]))).to_pylist()]
        assert a & b and len(a) == neardup.BANDS < len(b) and not none


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in root if find(n) != n}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Decontamination


ITEM = "Anna buys 12 apples at the green market and Paul pays 30 euros for all of them today"


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, ITEM), (2, ITEM), (3, "Who wrote it?"), (4, None), (5, ""), (6, "1 2 3 4 5 6 7 8 9 10"), (7, ITEM.replace("market", "river") + " once"), (8, ITEM.replace("Paul", "she"))]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_reparameterised_questions_are_found(spark, items):
    again = ITEM.replace("Anna", "Maria").replace("Paul", "Ivan").replace("12", "7").replace("30", "45")
    mixed = again.replace("Ivan pays 45", "Ivan pays 45") + ". It rained. " + ITEM
    rows = [
        (0, "Some words before. " + ITEM + ". Some words after."), (1, "Before it. " + again), (2, ITEM.replace("Paul", "she").upper()), (3, "nothing of this kind at all in here"),
        (4, None), (5, ""), (6, "so who wrote it then"), (7, "1 2 3 4 5 6 7 8 9 10"), (8, mixed), (None, again), (9, " ".join(ITEM.split()[:9])),
        (10, "word " * 30000),
    ]
    docs = frame(spark, rows).withColumn("item_id", F.lit("x")).withColumn("print", F.lit(0))
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, items).collect()}
    for doc in (0, 1, 8, None):
        assert (doc, 1) in got, doc
    assert (2, 8) in got
    assert (6, 3) in got and not {(d, i) for d, i in got if d in (3, 4, 5, 7, 10) or i == 2}
    left = decontam.cleaned(docs, items)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5, 7, 9, 10]


def test_inconsistent_slots_break_an_alignment(spark):
    item = "if Anna gives Paul an orange then Anna shall thank Paul and Anna will smile"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    same = item.replace("Anna", "Mia").replace("Paul", "Leo")
    other = "if Mia gives Leo an orange then Tom shall thank Max and Ida will smile"
    got = decontam.contaminated(frame(spark, [(1, same), (2, other)]), items).collect()
    assert [r["doc_id"] for r in got] == [1]


def test_verbatim_passages_equal_brute_force(spark):
    import re

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    words = lambda t: re.findall(r"\w+", t.lower())
    index, total = defaultdict(set), {}
    for r in items.collect():
        w = words(r["text"])
        total[r["item_id"]] = max(1, len(w) - 7)
        for i in range(total[r["item_id"]]):
            index[tuple(w[i : i + 8])].add(r["item_id"])
    want = set()
    for r in docs.collect():
        w = words(r["text"])
        met = Counter(item for x in {tuple(w[i : i + 8]) for i in range(len(w))} for item in index.get(x, ()))
        want |= {r["doc_id"]} if any(n >= total[i] / 2 for i, n in met.items()) else set()
    assert want and {r["doc_id"] for r in decontam.contaminated(docs, items).collect()} == want


def test_empty_tables(spark, items):
    docs = frame(spark, [(1, ITEM)])
    assert decontam.contaminated(docs, items.limit(0)).count() == 0
    assert decontam.contaminated(docs.limit(0), items).count() == 0
    assert decontam.cleaned(docs, items.limit(0)).count() == 1


# URLs


URLS = [
    "http://WWW.Example.com/en/1?x#y", "https://a.example.com/en/2", "https://other.com/x", "http://x.net/es/1", "http://x.net/fr/2", "http://x.net/de/3",
    "http://y.org/es/4", "ftp://com/", "http://com", "nothing", None, "http://net.es/fr/", "HTTP://ÄB.NET/fr/", "x://y://z.com/a", "http://notexample.com/en/1", "http://a.net\n/es/",
]


def brute_rule(host, path):
    fits = [(len(h + p), v, h + p) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (lambda m: (m[2], m[1]))(max(fits)) if fits else (None, None)


def test_url_rules_and_model(spark):
    rows = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit("own"))
    got = {r["page_id"]: r for r in urls.judge(rows).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut], rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        rule, verdict = brute_rule(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), url
        assert got[i]["verdict"] == verdict or rule is None and got[i]["verdict"] in ("allow", "block")
    assert got[9]["score"] == got[10]["score"] == 0


def brute_ratio(texts, text):
    """Mean log-ratio of ``text`` under models of ``texts`` [(text, verdict)]."""
    pad = "\x01" * urls.ORDER
    every = [(t, v) for t, v in texts]
    total = 0
    for i in range(len(text)):
        full = (pad + text)[i : i + urls.ORDER + 1]
        logs = {}
        for side in ("allow", "block"):
            p = 1.0 / len({c for t, _ in every for c in t})
            for order in range(urls.ORDER + 1):
                tail = full[len(full) - order - 1 :]
                seen = Counter()
                for t, v in every:
                    padded = pad + t
                    for j in range(urls.ORDER, len(padded)):
                        if padded[j - order : j] == tail[:-1] and v == side:
                            seen[padded[j]] += 1
                kinds = max(len(seen), 1)
                p = (seen[tail[-1]] + kinds * p) / (sum(seen.values()) + kinds)
            logs[side] = math.log(p)
        total += round((logs["allow"] - logs["block"]) * urls.SCALE)
    return total / len(text) / urls.SCALE


def test_url_scores_equal_brute_force(spark):
    rows = spark.createDataFrame(list(enumerate(URLS[:8])), "page_id long, url string")
    got = urls.judge(rows).collect()
    by_rule = {r["page_id"]: brute_rule(r["host"], r["path"])[1] for r in got}
    texts = [(r["host"] + r["path"], by_rule[r["page_id"]]) for r in got]
    for r in got:
        assert r["score"] == pytest.approx(brute_ratio(texts, r["host"] + r["path"]), abs=2e-6)


def test_urls_without_rules_or_rows(spark):
    rows = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x")], "page_id long, url string")
    assert [r["verdict"] for r in urls.judge(rows).collect()] == ["allow", "allow"]
    assert urls.judge(rows.limit(0)).count() == 0


# Archives


def test_archives_round_trip(spark):
    long = "é<p>\r\n\r\nWARC/1.1\r\n" * 9000
    pages = [(0, "u", "b"), (1, None, long), (2, "u\nv", None), (3, "u", "a"), (4, "u", long), (5, "u", ""), (None, "u", "b"), (6, "u", "0\r\n\r\n"), (3, "u", "a")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("row", F.lit("mine"))
    got = sorted(warc.round_trip(df.select("page_id", "url", "html")).collect(), key=str)
    want = []
    first = {}
    for i, _, html in pages:
        body = (html or "").encode()
        first.setdefault(body, []).append(i)
    for body, ids in first.items():
        smallest = min(ids, key=lambda i: -1 if i is None else i)
        ids = list(ids)
        ids.remove(smallest)
        want.append((smallest, len(body), warc.digest(body), "response", None))
        want += [(i, len(body), warc.digest(body), "revisit", smallest) for i in ids]
    assert got == sorted([tuple(w) for w in want], key=lambda w: str(_row(w)))
    assert warc.round_trip(df.select("page_id", "url", "html").limit(0)).count() == 0


def _row(values):
    from pyspark.sql import Row

    return Row("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")(*values)


def test_small_payloads_stay_responses(spark):
    df = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = {r["page_id"]: r["record_type"] for r in warc.round_trip(df, least=5).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_broken_archives_raise(spark, tmp_path):
    body = list(warc.records(1, 1, "u", b"x" * 50_000, None))
    assert len(body) > 2
    for name, parts in {"missing": body[:1] + body[2:], "cut": [body[0], body[1][:-1], *body[2:]]}.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / "part-0.warc").write_bytes(b"".join(p + b"\r\n\r\n" for p in parts))
        with pytest.raises(Exception, match="segments|record"):
            warc.summaries(warc.reassembled(spark, str(folder))).collect()


def test_chunked_framing():
    for size in (0, 1, warc.CHUNK, 3 * warc.CHUNK + 7):
        payload = bytes(i % 251 for i in range(size))
        assert warc.dechunked(warc.chunked(payload)) == payload
    for broken in (b"5\r\nabc", b"zz\r\n", b"", b"3\r\nabcd\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(broken)
