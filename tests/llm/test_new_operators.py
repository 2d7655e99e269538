"""Page text, spelling variants and collocations against brute force and hand-made inputs."""

from __future__ import annotations

import html as htmllib
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from telestrata.llm import collocations, mainhtml, spelling

LONG = "A paragraph that is long enough to stand out from menus, notices and other small pieces of a page. "


# Page text


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>Name</title><style>p{{x:y}}</style></head><body>{body}</body></html>"


def test_articles_keep_all_their_blocks():
    body = (
        "<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class='ad'>Buy this</div>"
        f"<article><header><h1>Head&amp;line</h1></header><p>{LONG}</p><p>Short.</p><ul><li>One<li>Two</ul>"
        "<form><input><label>Your mail</label></form><script>var a='<p>no</p>';</script>"
        "<section id='comments'><p>First!</p></section></article><aside>More</aside><footer>&copy; us</footer>"
    )
    assert mainhtml.main_text(page(body)) == "\n\n".join(["Head&line", LONG.strip(), "Short.", "One", "Two"])


def test_unmarked_pages_are_cut_by_density():
    links = "".join(f"<li><a href=/{i}>link {i}</a></li>" for i in range(12))
    body = (
        f"<div><ul>{links}</ul></div><div><div><h2>Title</h2><p>{LONG}<br>{LONG}</p><p>Brief one.</p><p>{LONG * 3}</p></div></div>"
        f"<div><p><a href=/x>all</a> <a href=/y>rights</a> <a href=/z>reserved</a></p></div>"
    )
    assert mainhtml.main_text(page(body)).split("\n\n") == ["Title", (LONG * 2).strip(), "Brief one.", (LONG * 3).strip()]


@pytest.mark.parametrize("name", ["ad", "cookie-notice", "sidebar left", "adBox", "post-comments", "site-header"])
def test_named_blocks_go(name):
    assert mainhtml.main_text(page(f"<div class='{name}'><p>{LONG}</p></div><div><p>{LONG}text</p></div>")) == LONG + "text"


@pytest.mark.parametrize("name", ["has-sidebar", "no-comments", "gradient", "entry-header", "readmore"])
def test_other_names_stay(name):
    assert mainhtml.main_text(page(f"<div class='{name}'><p>{LONG}</p></div>")) == LONG.strip()


def test_broken_pages():
    assert mainhtml.main_text(None) == mainhtml.main_text("") == mainhtml.main_text("<p></p><!-- x") == ""
    assert mainhtml.main_text("plain &lt;text&gt; &#8212; &eacute;\n\t x") == "plain <text> — é x"
    assert mainhtml.main_text(f"<article><p><b>{LONG}<p>{LONG}</b></article><footer>end") == LONG.strip() + "\n\n" + LONG.strip()
    assert mainhtml.main_text("<![if x]><p>seen</p><![bad") == "seen"
    assert mainhtml.main_text("</p></div><p>seen<") == "seen<"


@pytest.mark.parametrize("part", ["<", "<a ", "<div>x", "<b>", "<!--", "<![x", "<p>x", "</", "<a href='", "<?", "<script>", "<li>y<ul>"])
def test_endless_pages_end(part):
    mainhtml.main_text(part * 5000)


def test_page_rows(spark):
    rows = [(1, "u", page(f"<p>{LONG}</p>"), "x"), (1, "u", page(f"<p>{LONG}</p>"), "x"), (None, None, None, None), (2, "v", "", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, mainhtml.texts(pages).collect()), key=str)
    text = LONG.strip()
    assert got == sorted([(1, "u", text, len(text))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert mainhtml.texts(pages.limit(0)).count() == 0
    kept = mainhtml.extracted(pages)
    assert kept.columns == [*pages.columns, "main_text"]


def test_page_text_of_all_pages(spark):
    """The test pages mark their article; its blocks are cut out here by patterns."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    sources = {r.page_id: r.html for r in pages.collect()}
    for row in mainhtml.texts(pages).collect():
        inner = re.search(r"<article>(.*?)</article>", sources[row.page_id], re.S).group(1)
        blocks = [htmllib.unescape(re.sub(r"<[^>]+>", " ", b)) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert row.text == "\n\n".join(" ".join(b.split()) for b in blocks if b.strip())


# Spelling


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def plain_words(rows) -> Counter:
    out = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return Counter({w: n for w, n in out.items() if len(w) >= 7 and n >= 2})


def plain_variants(counts: Counter) -> dict:
    found = {w: [] for w in counts}
    for a, b in combinations(sorted(counts), 2):
        if near(a, b):
            found[a].append(b)
            found[b].append(a)
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(found[w]), counts[form[w]] if form[w] else None)
    return out


def as_variants(df) -> dict:
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_words_with_deletions(spark):
    rng = random.Random(5)
    stems = ["Lantern", "harbour", "überfluß", "élèves", "SILENCES", "ordinary", "abcdefgh÷x"]
    rows = [(i % 40, " ".join(rng.choices(stems, k=30)) + ", \n x1longword 🙂lanterns") for i in range(60)]
    rows += [(None, "lanterns lanterns"), (3, None), (4, ""), (5, "a" * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.word: r.n for r in spelling.words(docs).collect()} == dict(plain_words(rows))


def test_near_words_against_all_pairs(spark):
    rng = random.Random(7)
    counts = Counter()
    for _ in range(60):
        word = "".join(rng.choices("abné", k=rng.randint(7, 9)))
        counts[word] = rng.choice([2, 20, 250, 3000])
        for _ in range(6):
            i, c = rng.randrange(len(word)), rng.choice("abné")
            other = rng.choice([word[:i] + c + word[i:], word[:i] + word[i + 1 :], word[:i] + c + word[i + 1 :], word[::-1]])
            if len(other) >= 7:
                counts.setdefault(other, rng.choice([2, 3, 30]))
    # A chain of forms, and two forms of equal number.
    counts |= {"zyxwvuts": 2, "zyxwvutsr": 40, "zyxwvutsrq": 400, "qqqqqqqa": 50, "qqqqqqqb": 50, "qqqqqqqc": 5}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got, wanted = as_variants(spelling.variants(frame)), plain_variants(counts)
    assert got == wanted
    assert got["zyxwvuts"][:2] == ("zyxwvutsr", "zyxwvutsrq") and got["qqqqqqqc"][0] == "qqqqqqqa"


def test_spelling_of_odd_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, word string, n string")
    assert spelling.groups(docs).count() == 0
    rows = [(1, "harbours harbours", "harbour", "1")] * 2 + [(None, None, None, None)]
    docs = spark.createDataFrame(rows, docs.schema)
    assert as_variants(spelling.groups(docs)) == plain_variants(plain_words((r[0], r[1]) for r in rows))


# Collocations


def plain_collocations(rows, support=10, top=2000) -> list:
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    frequent = {key: n for key, n in counts.items() if len(key[1]) > 1 and n >= support}
    found = {}
    for (lang, p), a in frequent.items():
        longer = [n for (g, q), n in frequent.items() if g == lang and len(q) == 3 > len(p) and p in (q[:2], q[1:])]
        if any(100 * n >= 50 * a for n in longer):
            continue
        cuts = [(1_000_000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), -a, l, r, totals[lang], -score)
        for lang, rows_ in found.items()
        for i, (score, a, p, l, r) in enumerate(sorted(rows_)[:top])
    )


def collocation_rows(seed: int, n: int) -> list:
    rng = random.Random(seed)
    vocabulary = ["a", "A", "bé", "c", "dÉ", "e e", "f-f", "Gg"]
    ends = [" ", " ", "\t ", " ", " ", ", ", ".", "\n", "\r\n", " ; "]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice(ends) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", "fr", None]), text))
    return [*rows, ("en", None), (None, ""), ("xx", "one two three"), ("fr", "...,;")]


def test_collocations_against_brute_force(spark, monkeypatch):
    rows = collocation_rows(3, 150)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    wanted = plain_collocations(rows)
    assert len(wanted) > 100
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == wanted
    # Many chunks and hash ranges.
    monkeypatch.setattr(collocations, "BUCKET_BYTES", 1000)
    assert sorted(map(tuple, collocations.collocations(docs, top=7).collect())) == plain_collocations(rows, top=7)


def test_chunks_lose_no_phrase():
    rows = collocation_rows(11, 40) + [("en", "word " * 3000), ("en", "a b. " * 2000)]
    texts = pa.array([t or "" for _, t in rows])
    langs = np.array([hash(g) % 3 for g, _ in rows])
    totals = []
    for size in (1 << 30, 64):
        counts = Counter()
        for words in collocations.chunks_of(texts.slice(1), langs[1:], size):
            spelled = words.spelled.to_pylist()
            for k, first, n in collocations.phrases(words):
                for f, m in zip(first.tolist(), n.tolist()):
                    counts[int(words.lang[f]), tuple(spelled[w] for w in words.which[f : f + k])] += m
        totals.append(counts)
    assert totals[0] == totals[1] and totals[0][int(langs[-2]), ("word",) * 3] == 2998


def test_local_support_is_never_missed():
    for support in range(1, 40):
        least = collocations.least_local(support)
        assert collocations.SHARDS * (least - 1) < support


def test_collocations_of_odd_tables(spark):
    empty = spark.createDataFrame([], "lang string, text string, n long, phrase string")
    assert collocations.collocations(empty).count() == 0
    rows = [("en", "big deal", 1, "x")] * 12 + [(None, None, None, None)]
    docs = spark.createDataFrame(rows, empty.schema)
    assert list(map(tuple, collocations.collocations(docs).collect())) == [("en", 1, "big deal", 12, 12, 12, 24, 1_000_000)]
    huge = spark.createDataFrame([("en", 2, "p q", 10**13), ("en", 1, "p", 10**13), ("en", 1, "q", 2 * 10**13)], "lang string, size int, phrase string, n long")
    assert collocations.scored(huge).first().score == 500_000


# Cases of earlier operators


def test_decontamination_of_long_rows_of_numbers(spark):
    from telestrata.llm import decontam

    items = spark.createDataFrame(
        [(1, "Compute 3 + 4 * 5 - 6 / 7 + 8 * 9 = ?"), (2, "Anna Berta Carla Dora Emma Fanny Gerda Hanna"), (3, "7"),
         (4, "what is the weight of a 12 kg stone on the moon")],
        "item_id long, text string",
    )
    docs = spark.createDataFrame(
        [(1, "1," * 8000 + "1"), (2, "And 1 2 3. Compute 3 + 4 * 5 - 6 / 7 + 8 * 9 = ? Well."), (3, "Compute 4 + 4 * 5 - 6 / 7 + 8 * 9"),
         (4, "x anna berta carla dora emma fanny gerda hanna y"), (5, "a 7 b"), (6, "So what is the weight of a 35 kg stone on the moon now")],
        "doc_id long, text string",
    )
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()}
    assert got == {(2, 1), (4, 2), (6, 4)}


def test_quality_threshold_comes_from_held_out_documents(spark):
    from telestrata.llm import quality

    scores = spark.createDataFrame([(i / 100,) for i in range(200)], "score double")
    assert quality.threshold(scores).first().least == pytest.approx(0.01 - quality.MARGIN, abs=quality.STEP)
    assert quality.threshold(scores.limit(0)).first().least == quality.THRESHOLD


def test_accounts_in_groups():
    from telestrata.llm.pii import find_spans

    spans = lambda t: [(k, t[a:b]) for k, a, b in find_spans(t)]
    assert spans("IBAN: DE89 3704 0044 0532 0130 00.") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert spans("account number 12345 678, then") == [("account", "12345 678")]
    assert spans("account noted by 3 people") == []


def test_coding_of_odd_texts_in_small_stretches(spark, monkeypatch):
    import sentencepiece as library

    from telestrata.llm import sentencepiece
    from telestrata.llm.queries import vocabulary

    path = vocabulary("piece_bpe_32k.model")
    with open(path, "rb") as file:
        model = sentencepiece.Model(file.read())
    reference = library.SentencePieceProcessor(model_file=path)
    rng = random.Random(9)
    texts = ["", None, " ", "▁", "a▁ b", " \n\t x", "ab" * 4000, "日本語 🙂 é̂", "the the the the"]
    texts += ["".join(rng.choice("abt hé▁\n日1") for _ in range(rng.randint(0, 80))) for _ in range(200)]
    monkeypatch.setattr(sentencepiece, "CHUNK", 200)
    monkeypatch.setattr(sentencepiece, "MEMO_CHARACTERS", 50)
    monkeypatch.setattr(sentencepiece, "MEMO", 10)
    parts = [sentencepiece._encoded(model, p) for p in sentencepiece._stretches(pa.array(texts))]
    assert [ids for p in parts for ids in p.to_pylist()] == [reference.encode(t or "") for t in texts]
    back = [t.decode() for p in parts for t in sentencepiece._decoded(model, p).to_pylist()]
    assert back == [(t or "").replace("▁", " ") for t in texts]
    model.forget()
    assert not model.fits and not model.known


def test_words_are_segmented_together(monkeypatch):
    """Only very long words are walked one by one; all get the library's pieces."""
    import sentencepiece as library

    from telestrata.llm import sentencepiece
    from telestrata.llm.queries import vocabulary

    path = vocabulary("piece_bpe_32k.model")
    with open(path, "rb") as file:
        model = sentencepiece.Model(file.read())
    reference = library.SentencePieceProcessor(model_file=path)
    rng = random.Random(4)
    short = [p.replace("▁", " ") for p in model.ids if len(p) < 6]
    texts = ["".join(rng.choices([*short, "\n", "🙂", "\u0378"], k=rng.randint(0, 40))) for _ in range(400)]
    walked, walk = [], model.encode_sorted
    monkeypatch.setattr(model, "encode_sorted", lambda words: walked.extend(words) or walk(words))
    coded = sentencepiece._encoded(model, pa.array([*texts, "ab" * 200 + " inter"]))
    assert coded.to_pylist() == [reference.encode(t) for t in [*texts, "ab" * 200 + " inter"]]
    assert walked == ["▁" + "ab" * 200]


def test_coding_columns(spark):
    from telestrata.llm import sentencepiece
    from telestrata.llm.queries import vocabulary

    path = vocabulary("piece_bpe_32k.model")
    docs = spark.createDataFrame([(1, "a b", 5, "x")] * 2 + [(None, None, None, None)], "doc_id long, text string, pieces int, coded string")
    rows = sentencepiece.encoded(docs, path).collect()
    assert rows[0].asDict().keys() == {"doc_id", "text", "pieces", "coded", "pieces_", "n_pieces", "round_trip"}
    assert [(r.n_pieces, r.round_trip) for r in rows] == [(2, True)] * 2 + [(0, True)]
    both = sentencepiece.with_text(sentencepiece.with_pieces(docs, path, out="ids"), path, "ids")
    assert [r.decoded for r in both.collect()] == ["a b", "a b", ""]


def test_pieces_and_masks_leave_in_small_batches(monkeypatch):
    """No task holds the results of a whole Arrow batch."""
    from telestrata.llm import pii, sentencepiece
    from telestrata.llm.queries import vocabulary

    class Shared:
        with open(vocabulary("piece_bpe_32k.model"), "rb") as file:
            value = file.read()

    monkeypatch.setattr(sentencepiece.F, "arrow_udf", lambda kind: lambda f: f)
    texts = [None, "", "mail jo.doe@example.org " * 9000, *["some words of a text " * 500] * 300]
    batch = pa.array(texts, pa.string())
    for work in (sentencepiece.coder(Shared), sentencepiece.encoder(Shared), pii._masked_text):
        sizes = [len(part) for part in work(iter([batch, batch.slice(0, 0)]))]
        assert sum(sizes) == len(texts) and max(sizes) <= (1 << 20) // len(texts[-1]) + 2
