"""Operators that judge or change each document by itself."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from telestrata.llm import bpe, langid, pii, quality, sentencepiece, toxicity
from telestrata.llm.queries import vocabulary

DOCS = "doc_id long, text string, lang string"


def documents(spark, *texts, **extra):
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


# Personal data

HARD = [
    None, "", "a@b@c.com x@y.z.", "mail@host", "x.y@a-b.co.uk,n@o.p@q.r", "1.2.3.4.5.6.7.8", "1.2.3.999 01.02.03.04",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111 1111 1111 1112", "12 34", "+1 (212) 555-0199 ++49 30 901820()",
    "+123", "é4111111111111111é", "1" * 5000, "5 " * 2000, "@" * 3000, "+1.2.3.4-5.6.7.8.9.0.1",
    "10.0.0.1.255.255.255.255 0.0.0.0", "a%b+c@d.e--f.g", "٣.٣.٣.٣ 4١١١",
]


def brute_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = digits(m.group())
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        if 14 <= len(d) <= 19 and sum(x // 10 + x % 10 for x in doubled) % 10 == 0:
            found.append(("card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(digits(m.group())) <= 15:
            found.append(("phone", m))
    order = {k: i for i, k in enumerate(pii.BASE_KINDS)}
    return sorted(((k, *m.span()) for k, m in found), key=lambda s: (s[1], order[s[0]]))


def test_pii_base_spans_equal_plain_patterns(spark):
    rows = pii.digests(documents(spark, *HARD, spans="own")).collect()
    assert len(rows) == len(HARD)
    for row in rows:
        text = HARD[row["doc_id"]] or ""
        want = brute_spans(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), text[:40]
        assert row["n_card"] == sum(k == "card" for k, *_ in want)


def test_pii_adds_accounts_and_addresses():
    found = lambda t: [(k, t[a:b]) for k, a, b in pii.find_spans(t)]
    assert found("IBAN: DE89 3704 0044 0532 0130 00.") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert ("account", "ab12cd34ef") in found('token = "ab12cd34ef" here')
    assert found("my account is closed, tokens too") == []
    assert ("url", "ftp://me@host/x") in found("see ftp://me@host/x now")
    assert found("see https://host.example/x now") == []


def test_pii_cues_of_any_case_and_identifiers_of_any_length():
    found = lambda t: [(k, t[a:b]) for k, a, b in pii.find_spans(t)]
    for cue in ("API Key", "Api Key", "Tax ID", "ToKeN", "\u0130 API Key"):
        assert found(f"my {cue}: ab-cd9ef now") == [("account", "ab-cd9ef")], cue
    for n in (200, 5000):
        secret, user = "a1" * n, "me" * n
        assert found(f"token={secret} now") == [("account", secret)]
        assert ("url", f"ftp://{user}@host/x") in found(f"see ftp://{user}@host/x now")
    run = "1/token" * 3 + "1"
    assert found(f"token={run} token 2bcde") == [("account", run), ("account", "2bcde")]


def test_pii_mask_keeps_columns_and_lengths(spark):
    docs = documents(spark, "to a@b.co now", None, "", masked="mine").withColumn("n_chars", F.lit(99))
    rows = pii.mask(docs).orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == ["to <EMAIL> now", None, ""]
    assert [r["n_chars"] for r in rows] == [14, 99, 0]
    assert rows[0]["masked"] == "mine" and pii.mask(docs).columns == docs.columns
    assert pii.mask(docs.limit(0)).count() == 0


# Token counts


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    texts = ["", "don't  stop\n\n now", "<|endoftext|>a <|endoftext|> b", "日本語 🙂 x", "a" * 3000, " \u00a0\u3000x\x85", "é" * 50,
             "12345 6.7%", "\ttab\r\n", "ǅ ²½ ٣", "the " * 500]
    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    counted = bpe.with_token_counts(documents(spark, *texts, None, n_tokens_="x"), path).collect()
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts] + [0]
    assert [r["n_tokens"] for r in sorted(counted, key=lambda r: r["doc_id"])] == want


# SentencePiece


def test_pieces_equal_the_library_and_decode(spark):
    import sentencepiece as library

    path = vocabulary("piece_bpe_32k.model")
    own = library.SentencePieceProcessor(model_file=path)
    texts = ["", "the  thing\n\tis", "   ", " " * 37 + "x", "日本語🙂", "thethethe" * 200, "naïve co-operation", "<s> <0x41>"]
    docs = documents(spark, *texts, None, pieces="clash")
    rows = sentencepiece.encoded(docs, path).orderBy("doc_id").collect()
    assert [r["pieces_"] for r in rows] == [own.encode(t) for t in texts] + [[]]
    assert all(r["round_trip"] for r in rows) and rows[0]["pieces"] == "clash"
    assert sentencepiece.encoded(docs.limit(0), path).count() == 0


def test_shared_prefixes_give_what_single_words_give():
    with open(vocabulary("piece_bpe_32k.model"), "rb") as file:
        model = sentencepiece.Model(file.read())
    words = sorted({"▁inter", "▁internal", "▁internet", "▁international", "▁in", "▁inn", "▁interné"})
    assert model.encode_sorted(words) == [model.encode_sorted([w])[0] for w in words]


# Language


@pytest.fixture(scope="module")
def language_model():
    words = {"aa": "kato mela tuno rika", "bb": "schrum pfelz knost gruft", "cc": "ïlé öré àmè ûné"}
    texts, labels = [], []
    for i in range(60):
        for label, pool in words.items():
            w = pool.split()
            texts.append(" ".join(w[(i * j) % 4] for j in range(1, 9)))
            labels.append(label)
    return langid.train(texts, labels)


def test_language_is_learned_and_rejected(spark, language_model):
    docs = documents(spark, "kato rika", "Knost GRUFT!", "ûné öré", None, "", "123 %", "mela " * 20000, lang_pred="x")
    rows = langid.identify(docs, language_model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in rows] == ["aa", "bb", "cc", "und", "und", "und", "aa"]
    assert [r["rejected"] for r in rows] == [False] * 3 + [True] * 3 + [False]
    assert all(0 <= r["score"] <= 1 for r in rows) and rows[3]["score"] == 0


def test_language_without_labels(spark):
    docs = documents(spark, "some text", None).withColumn("lang", F.lit(None).cast("string"))
    model = langid.fit(docs)
    assert [r["lang_pred"] for r in langid.identify(docs, model).collect()] == ["und", "und"]
    assert langid.identify(docs.limit(0), model).count() == 0


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs, langid.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    held = rows.where("held_out").selectExpr("avg(int(lang_pred = lang)) as share", "sum(int(rejected)) as gone").first()
    assert held["share"] > 0.97 and held["gone"] == 0


# Toxicity


@pytest.fixture(scope="module")
def toxic_model():
    calm = ["the little house stands near a river and people idle in the garden " * 2 for _ in range(40)]
    rude = [c + " you total idiot and loser" for c in calm]
    texts = [t + f" number {i % 7}" for i, pair in enumerate(zip(calm, rude)) for t in pair]
    logp = toxicity.log_probabilities(toxicity.trigram_counts(texts))
    return toxicity.train(texts, [0, 1] * 40, (40, 40), logp)


def test_disguises_are_undone(toxic_model):
    restore = toxicity.Restorer(toxic_model.logp)
    for written in ("1d10t", "i d i o t", "idiiiiot", "id!ot"):
        assert "idiot" in restore(f"you {written} there"), written
    assert restore("the% house!! 3 rivers, a.b") == "the% house!! 3 rivers, a.b"


def test_best_path_equals_all_paths(toxic_model):
    """Viterbi against every reading of short stretches."""
    logp = toxic_model.logp

    def readings(text, at=0):
        if at == len(text):
            yield "", 0.0
            return
        for end, said, cost in toxicity.lattice(text)[at]:
            for rest, more in readings(text, end):
                yield said + rest, cost + more

    def total(said, cost):
        a = b = 0
        for c in map(toxicity._class, said + " "):
            if c or b:
                cost -= float(logp[a, b, c])
            a, b = b, c
        return cost

    for text in ("1d10t", "l0ser", "h0use", "aaab1", "a b c", "5t4nds"):
        best = min(total(*r) for r in readings(text))
        got = toxicity.restored_stretch(text, logp)
        assert any(said == got and abs(total(said, cost) - best) < 1e-4 for said, cost in readings(text))


def test_toxic_scores(spark, toxic_model):
    docs = documents(spark, "near a river you l0ser", "people in the garden", None, "", "river " * 30000, score="x")
    rows = toxicity.scores(docs, toxic_model).orderBy("doc_id").collect()
    assert [r["predicted"] for r in rows] == [1, 0, 0, 0, 0]
    assert rows[2]["score"] == rows[3]["score"]


def test_toxicity_without_labels(spark):
    docs = documents(spark, "some text here", None)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert {r["score"] for r in toxicity.scores(docs, model).collect()} == {0.0}


def test_toxicity_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    known = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    rows = toxicity.scores(known, toxicity.fit(known, labels)).join(labels, "doc_id").where("held_out")
    got = rows.selectExpr("avg(int(predicted = toxic)) as right", "sum(int(predicted = 1 and toxic = 0)) as wrong").first()
    assert got["right"] > 0.92 and got["wrong"] <= 8


# Quality rules


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(n - 7)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    return n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), again, len(covered)


def test_quality_base_columns(spark):
    cycle = " ".join("abcdefghijk"[i % 11] for i in range(60))
    texts = [None, "", " \t\n", "a b c", "x " * 30, cycle, cycle + " end " + cycle, "l1\nl1\n \n \nl1 ", "a\x0bb\u00a0c\x85d #*$%&|<>", "é " * 9,
             " ".join(map(str, range(3000)))]
    docs = documents(spark, *texts, n_words=5, row="x", bucket=1)
    labels = spark.createDataFrame([(5, 1), (5, 0), (10, 1), (None, 1)], "doc_id long, quality int")
    rows = quality.judge(docs.select("doc_id", "text", "row", "bucket"), labels).orderBy("doc_id").collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(r[c] for c in names) for r in rows] == [brute_base(t) for t in texts]
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_quality_scores_equal_brute_force(spark):
    import math
    from collections import Counter

    texts = ["good words here " * 10, "good plain words " * 12, "bad!! junk## " * 15, "good junk## here " * 8, None]
    docs = documents(spark, *texts)
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 0)], "doc_id long, quality int")
    # Buckets by the engine's own hash of words and pairs.
    grams = []
    for t in texts:
        w = (t or "").split()
        hashed = [r[0] for r in spark.createDataFrame([(x,) for x in w] or [("",)], "w string").select(F.xxhash64("w")).collect()][: len(w)]
        pairs = list(zip(hashed, hashed[1:]))
        both = hashed + [r[0] for r in spark.createDataFrame(pairs or [(0, 0)], "a long, b long").select(F.xxhash64("a", "b")).collect()][: len(pairs)]
        grams.append([g % quality.BUCKETS for g in both])
    raw = Counter(g for gs in grams for g in gs)
    good = Counter(g for gs in grams[:2] for g in gs)
    share = lambda c, g: (c[g] + 1) / (sum(c.values()) + quality.BUCKETS)
    for row in quality.judge(docs, labels).collect():
        gs = grams[row["doc_id"]]
        want = sum(round(1e6 * math.log(share(good, g) / share(raw, g))) for g in gs) / max(len(gs), 1) / 1e6
        assert row["score"] == pytest.approx(want, abs=1e-5)


def test_quality_repeated_rows_and_empty_tables(spark):
    docs = documents(spark, "one two three " * 10).union(documents(spark, "one two three " * 10))
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.judge(docs, labels).collect()
    assert len(rows) == 2 and len(set(rows)) == 1 and rows[0]["score"] == 0
    assert quality.judge(docs.limit(0), labels).count() == 0


def test_quality_on_labelled_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judge(docs, labels).join(labels, "doc_id").where("not base_failed")
    wrong = {(r["quality"], r["kept"]): r["count"] for r in rows.groupBy("quality", "kept").count().collect()}
    assert wrong.get((1, False), 0) == 0 and wrong.get((0, True), 0) <= 2
