"""Page text, language, toxicity, fingerprints, token counts."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.samples import ODD, docs
from vidstrata.llm import fingerprints, html_text, language, token_counts, toxicity
from vidstrata.llm.common import held_out

SF = "/root/testdata/sf0.01"

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><a href="/">Site</a></header><nav class="menu"><ul><li><a>Home</a><li><a>News</a></ul></nav>
<div class="cookie-notice">We use cookies</div>
<article><h1>A &amp; B</h1><p>First  line
 of <b>te</b>xt &eacute;&#233;&nbsp;x.<p>Second 1 < 2 <script>var x = "</p>";</script> goes on.
<div class="ad">Buy now</div><ul><li>one<li>two</ul><form><input><button>Send</button></form><p>Last.</article>
<section id="comments"><article><p>Nice read</p></article></section><aside>More</aside><footer>&copy; us</footer></body></html>"""
MAIN = "A & B\nFirst line of text éé x.\nSecond 1 < 2 goes on.\none\ntwo\nLast."


@pytest.fixture(scope="module")
def weights(spark):
    return html_text.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def test_article_without_its_surroundings(weights):
    assert html_text.extract(PAGE, weights) == MAIN


def test_page_without_an_article_element(weights):
    page = PAGE.replace("<article><h1>", "<div class='story'><h1>").replace("</article>\n", "</div>\n")
    assert html_text.extract(page, weights) == MAIN


WRAPPERS = ["has-sidebar", "with-sidebar", "no-sidebar", "content-sidebar", "sticky-nav", "has-banner", "comments-open", "legal-page"]


@pytest.mark.parametrize("name", WRAPPERS)
def test_named_wrapper_of_the_page(weights, name):
    within = PAGE.replace("<body>", f"<body><div>Our site</div><div class='{name}'><div id='x {name}'>").replace("</body>", "</div></div></body>")
    plain = within.replace("<article><h1>", "<div class='story'><h1>").replace("</article>\n", "</div>\n")
    itself = PAGE.replace("<article><h1>", f"<article class='post {name}'><h1>")
    assert [html_text.extract(p, weights) for p in (within, plain, itself)] == [MAIN] * 3


def test_named_wrapper_of_labelled_pages(spark):
    rows = [(f"<body><div class='has-sidebar'><div class='x'>{'side ' * 9}</div><article><p class='y'>{'text ' * 9}</p></article></div></body>",)]
    weights = html_text.fit(spark.createDataFrame(rows, "html string"))
    assert weights.word[html_text.slot(".y")] > 0 > weights.word[html_text.slot(".x")]


def test_named_elements_beside_the_text(weights):
    story = "<div class='story'><p>" + "word " * 50 + "</p></div>"
    for name in ("comments", "related-posts", "cookie-notice"):
        page = f"<body>{story}<div class='{name}'><p>{'other ' * 200}</p></div></body>"
        assert html_text.extract(page, weights) == " ".join(["word"] * 50)
        assert html_text.extract(f"<div class='has-sidebar'>{page}</div>", weights) == " ".join(["word"] * 50)
    assert html_text.extract(f"<body><p>Our site</p><div class='sidebar'>{story * 8}</div></body>", weights).count("word") == 400
    parts = "".join(f"<div class='legal-part'><p>{x} {'word ' * 30}</p></div>" for x in "abc")
    assert html_text.extract(f"<body><p>Terms</p>{parts}</body>", weights).count("word") == 90


def words(name, n=30):
    return " ".join([name] * n)


AROUND = "<body><nav><a>Home</a></nav>{}<footer>Imprint</footer></body>"


@pytest.mark.parametrize(
    "page, text",
    [
        # title and intro beside the article in main
        (f"<main><h1>Title</h1><p>{words('intro', 5)}</p><article><p>{words('body')}</p></article></main>", f"Title\n{words('intro', 5)}\n{words('body')}"),
        # a title of some words outside of the article, without main
        (f"<div><h1>{words('title', 8)}</h1></div><article><p>{words('body')}</p></article>", f"{words('title', 8)}\n{words('body')}"),
        # a story in several articles
        ("".join(f"<article><p>{words(x)}</p></article>" for x in "abc"), "\n".join(words(x) for x in "abc")),
        ("<main>" + "".join(f"<article><p>{words(x)}</p></article>" for x in "abc") + "</main>", "\n".join(words(x) for x in "abc")),
        # articles within the article
        (f"<article><p>{words('a')}</p><article><p>{words('b', 50)}</p></article><p>{words('c')}</p></article>", f"{words('a')}\n{words('b', 50)}\n{words('c')}"),
        # text without an article before one that has less
        (f"<div><p>{words('a', 40)}</p></div><article><p>{words('b')}</p></article>", f"{words('a', 40)}\n{words('b')}"),
    ],
)
def test_whole_region_is_returned(weights, page, text):
    assert html_text.extract(AROUND.format(page), weights) == text


@pytest.mark.parametrize("page, text", [(None, ""), ("", ""), ("<p", ""), ("<!-- x", ""), ("<article><p>cut &am", "cut &am"), ("<script>x", "")])
def test_odd_pages(weights, page, text):
    assert html_text.extract(page, weights) == text


def test_article_in_a_wrapper_with_text_beside_it(weights):
    for beside in (20, 30, 200):
        page = f"<body><div class='has-sidebar'><article><p>{words('story', 300)}</p></article></div><p>{words('other', beside)}</p></body>"
        assert html_text.extract(page, weights).count("story") == 300
    comments = f"<div class='comments'><article><p>{words('other', 300)}</p></article></div>"
    assert html_text.extract(f"<body><div class='story'><p>{words('story', 60)}</p></div>{comments}</body>", weights) == words("story", 60)


def test_page_of_open_elements(weights):
    """What is kept of a page grows with its length, however deep its elements lie."""
    import tracemalloc

    page = "<div>word and more" * 40_000
    tracemalloc.start()
    assert html_text.extract(page, weights).count("word") == 40_000
    found = np.zeros((4, html_text.SLOTS + 1), dtype=np.int64)
    html_text.counts(html_text.parse("<article>" + page), found)
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    # each word counts once for a slot, however often the elements around it have it
    assert found[1, html_text.slot("<div")] == 120_000 == found[1, html_text.slot("<article")]


def test_region_is_the_best_of_all_spans(weights):
    rng = random.Random(7)
    tags = ["<div>", "</div>", "<p>", "</p>", "<ul><li>", "</ul>", "<article>", "</article>", "<a>", "</a>", "<nav>", "</nav>", "<b>"]
    for _ in range(60):
        page = html_text.parse("".join(rng.choice(tags) + rng.choice(["", "a ", "x y ", "many words of text "]) for _ in range(25)))
        odds = weights.odds(page)
        scores = [weights.score(item, odds) for item in page.items]
        best = max((sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=0.0)
        start, end = html_text.region(page, weights)
        assert abs(sum(scores[start:end]) - max(best, 0.0)) < 1e-6


def test_very_long_page(weights):
    page = "<article>" + "<p><b>word <i>x" * 20000
    assert html_text.extract(page, weights).count("\n") == 19999


def test_main_text_of_test_pages(spark, weights):
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = html_text.main_text(pages, weights).collect()
    assert len(rows) == pages.count()
    for r in rows:
        own = re.sub(r"<[^>]*$", "", re.search(r"<article>(.*?)(</article>|$)", r.html, re.S).group(1))
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)[^>]*>", own))
        assert r.text == "\n".join(b for b in blocks if b)


def test_pages_without_labels_and_none(spark):
    pages = spark.createDataFrame([(1, "u", "<p>some words here</p>", "own"), (2, "u", None, "own")], "page_id long, url string, html string, text string")
    weights = html_text.fit(pages)
    assert {r.page_id: r.text for r in html_text.main_text(pages, weights).collect()} == {1: "some words here", 2: ""}
    assert html_text.main_text(pages.where("false"), html_text.fit(pages.where("false"))).collect() == []


def test_language_of_held_out_texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = held_out(F.col("doc_id"))
    model = language.fit(rows.where(~out))
    assert model.families == ["germanic", "romance"]
    found = language.detect(rows.where(out), model).select("lang", "language.*").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.99
    assert all(0 <= r.score <= 1 for r in found)


def test_language_keeps_columns_of_any_name(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    given = docs(spark, ["the end", None]).withColumn("__guess", F.lit(5)).withColumn("apart_0", F.lit(6))
    found = language.detect(given, language.fit(rows)).collect()
    assert {(r["__guess"], r["apart_0"]) for r in found} == {(5, 6)}


def test_language_of_odd_texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(rows)
    given = docs(spark, ODD).withColumn("language", F.lit("own"))
    found = {r.doc_id: r.language for r in language.detect(given, model).collect()}
    for i, text in enumerate(ODD):
        known = text is not None and any(c.isalpha() for c in text)
        assert (found[i].lang_pred == "und") == (not known)
        assert 0 <= found[i].score <= 1
    none = language.fit(rows.where("false"))
    assert {r.language.lang_pred for r in language.detect(given, none).collect()} == {"und"}
    one = language.fit(rows.where("lang = 'fr'"))
    assert {tuple(r.language) for r in language.detect(docs(spark, ["abc"]), one).collect()} == {("fr", 1.0)}


def test_toxicity_of_held_out_texts(spark):
    rows, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = held_out(F.col("doc_id"))
    model = toxicity.fit(rows.where(~out), labels)
    found = toxicity.score(rows.where(out).join(labels, "doc_id"), model).select("toxic", "toxicity.score").collect()
    guess = np.array([r.score >= 0.5 for r in found])
    truth = np.array([r.toxic == 1 for r in found])
    assert truth.sum() > 50
    assert guess[truth].mean() > 0.9
    assert guess[~truth].mean() < 0.01


def test_toxicity_of_odd_texts_and_labels(spark):
    rows, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    given = docs(spark, ODD)
    for known in (labels, labels.where("toxic = 0"), labels.where("false"), labels.unionByName(labels)):
        found = toxicity.score(given, toxicity.fit(rows, known)).collect()
        assert len(found) == len(ODD)
        assert all(0 <= r.toxicity.score <= 1 for r in found)
    assert toxicity.score(given.where("false"), toxicity.fit(rows.where("false"), labels)).collect() == []


def test_toxic_word_does_not_share_its_counts(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [f"{a}{b}{c}" for a in letters for b in letters for c in letters]
    slots = {}
    hashes = toxicity.Words([" ".join(words).encode()], toxicity.ALNUM_WORDS).hash
    for word, h in zip(words, hashes.tolist(), strict=True):
        slots.setdefault(h % (1 << 18), []).append(word)
    bad, good = next(x[:2] for x in slots.values() if len(x) > 1)  # the same 18 last bits
    rows = [(i, f"so {bad} is it", 1) if i < 20 else (i, f"so {good} is it {i}", 0) for i in range(220)]
    known = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(known.drop("toxic"), known.drop("text"))
    found = model.word_scores(toxicity.Words([f"{bad} {good}".encode()], toxicity.ALNUM_WORDS))
    assert found[0] > 1 and found[1] == toxicity.LOWEST


def test_counts_of_forms_equal_the_definition(spark, monkeypatch):
    texts = ["abcd abcdefgh x x", "abcdx", "", "é abcd", "x"]
    rows = [(t.encode(), i % 2 == 0) for i, t in enumerate(texts)]
    want = {}
    for text, toxic in rows:
        words = toxicity.Words([text], toxicity.ALNUM_WORDS)
        for h in {h for h in toxicity.units(words, np.arange(len(words.hash))).ravel().tolist() if h}:
            n = want.setdefault(h, [0, 0])
            n[0 if toxic else 1] += 1
    assert len(want) == 10
    known = spark.createDataFrame(rows, "text binary, toxic boolean").repartition(2)
    for held in (1 << 20, 1):
        monkeypatch.setattr(toxicity, "HELD", held)
        assert {r.form % (1 << 64): [r.bad, r.good] for r in toxicity.counts(known).collect()} == want


def test_segments_take_time_in_proportion():
    import time

    took = []
    for n in (20_000, 160_000):
        scores = np.where(np.arange(2 * n) % 2 == 0, 1.0, -2.0)
        total = np.concatenate([[0.0], np.cumsum(scores)])
        begun = time.perf_counter()
        assert len(toxicity.maximal(np.flatnonzero(scores > 0), total)) == n
        took.append(time.perf_counter() - begun)
    assert took[1] < 5 and took[1] < 40 * took[0]


def test_maximal_segments_equal_the_definition():
    rng = random.Random(4)
    for _ in range(200):
        scores = [rng.choice([-3, -2, -1, 1, 2, 4]) for _ in range(rng.randrange(1, 14))]
        total = np.concatenate([[0], np.cumsum(scores)])

        def split(a, b):  # the best segment, shortest and first, then left and right of it
            best = max(((total[j] - total[i], i - j, -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
            if best[0] <= 0:
                return []
            i = -best[2]
            j = i - best[1]
            return split(a, i) + [(i, j)] + split(j, b)

        found = toxicity.maximal(np.flatnonzero(np.array(scores) > 0), total)
        gains = sorted(total[j] - total[i] for i, j in found)
        assert gains == sorted(total[j] - total[i] for i, j in split(0, len(scores)))


def test_fingerprints_of_texts_edits_and_neighbours(spark):
    texts = [*ODD, "one two three four", "one two three four", "one two three five " * 20]
    found = {r.doc_id: r for r in fingerprints.with_next(docs(spark, texts)).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        own, following = text or "", (texts[i - 1] if i else texts[-1]) or ""
        half = len(own) // 2
        changed = own[: len(own) - half] + following[:half]
        marks = fingerprints.fingerprints([t.encode() for t in (own, changed, following)])
        assert found[i].n_chars == len(own)
        assert found[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert (found[i].fingerprint, found[i].edited_fingerprint) == (marks[0].hex(), marks[1].hex())
        assert found[i].near_edited == fingerprints.likeness(marks[0], marks[1])
        assert found[i].near_next == fingerprints.likeness(marks[0], marks[2])
    assert found[10].fingerprint == found[11].fingerprint


def test_fingerprints_of_one_and_no_document(spark):
    one = fingerprints.with_next(docs(spark, ["abcd"])).collect()
    assert [(r.near_next, r.edited_sha256) for r in one] == [(1.0, hashlib.sha256(b"abab").hexdigest())]
    assert fingerprints.with_next(docs(spark, ["x"]).where("false")).collect() == []


def test_all_fingerprints_within_the_radius(spark):
    rng = random.Random(1)
    marks = [f"{rng.getrandbits(256):064x}" for _ in range(60)]
    for m in marks[:40]:
        value = int(m, 16)
        for b in rng.sample(range(256), rng.randrange(0, 6)):
            value ^= 1 << b
        marks.append(f"{value:064x}")
    own = sorted(set(marks))
    near = {(a, b, (int(a, 16) ^ int(b, 16)).bit_count()) for i, a in enumerate(own) for b in own[i + 1 :]}
    found = fingerprints.within_radius(spark.createDataFrame([(m,) for m in [*marks, None]], "fingerprint string"), 3)
    assert {tuple(r) for r in found.collect()} == {x for x in near if x[2] <= 3}


def test_hot_blocks_are_split(spark, monkeypatch):
    rng = random.Random(2)
    shared = rng.getrandbits(110)
    values = [shared << 146 | rng.getrandbits(146) for _ in range(150)]
    values += [v ^ sum(1 << b for b in rng.sample(range(256), rng.randrange(1, 6))) for v in values]
    own = sorted({f"{v:064x}" for v in values})
    near = {(a, b, (int(a, 16) ^ int(b, 16)).bit_count()) for i, a in enumerate(own) for b in own[i + 1 :]}
    given = spark.createDataFrame([(m,) for m in own], "fingerprint string")
    monkeypatch.setattr(fingerprints, "HOT", 20)
    sizes = fingerprints.block_tables(given, 3).groupBy("table", "key").count()
    assert sizes.agg(F.max("count")).first()[0] <= 20
    assert {tuple(r) for r in fingerprints.within_radius(given, 3).collect()} == {x for x in near if x[2] <= 3}


@pytest.mark.parametrize("hot", [6, 25, 1000])
@pytest.mark.parametrize("radius", [0, 3, 7])
def test_neighbours_within_the_radius(spark, monkeypatch, radius, hot):
    """Far and near marks, a dense group, copies, a null; keys split by further blocks and by tiles."""
    rng = random.Random(radius)
    values = [rng.getrandbits(256) for _ in range(40)] + [0]
    values += [v ^ sum(1 << b for b in rng.sample(range(256), rng.randrange(1, 10))) for v in values for _ in range(2)]
    values += [values[0] ^ sum(1 << b for b in rng.sample(range(20), rng.randrange(1, 7))) for _ in range(80)]
    values += [values[0]] * 5 + [values[1]] * 2
    marks = [f"{v:064x}" for v in values]
    given = spark.createDataFrame([*enumerate(marks), (-1, None)], "mark int, fingerprint string").repartition(3)
    monkeypatch.setattr(fingerprints, "HOT", hot)
    found = {r["mark"]: r.near_documents for r in fingerprints.with_neighbours(given, radius).collect()}
    assert found.pop(-1) == 0
    assert found == {i: sum((v ^ w).bit_count() <= radius for w in values) - 1 for i, v in enumerate(values)}
    own = given.where("fingerprint is not null").groupBy(F.unhex("fingerprint").alias("mark")).agg(F.count("*").alias("n"))
    sizes = fingerprints.block_units(own, radius).groupBy("key", "further", "cell").count().agg(F.max("count")).first()[0]
    assert (sizes or 0) <= 2 * hot + 20  # tiles are dealt by hash


def test_neighbours_of_nothing(spark):
    assert fingerprints.with_neighbours(spark.createDataFrame([], "doc_id long, fingerprint string")).collect() == []
    found = fingerprints.with_neighbours(spark.createDataFrame([(1, "00" * 32), (2, None)], "near_documents long, fingerprint string"), into="near")
    assert sorted(tuple(r) for r in found.select("near_documents", "near").collect()) == [(1, 0), (2, 0)]
    with pytest.raises(ValueError, match="radius"):
        fingerprints.with_neighbours(found, 40)


def test_section_tokens_add_up(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text for r in rows.select("text").collect()] + ODD
    found = token_counts.section_tokens(docs(spark, texts)).collect()
    own = token_counts.encoder(None)
    for i, text in enumerate(texts):
        sections = sorted((r for r in found if r.doc_id == i), key=lambda r: r.section)
        lines = (text or "").splitlines(keepends=True) if "\x0b" not in (text or "") else None
        assert sum(r.tokens for r in sections) == len(own.ends(text or ""))
        assert sum(r.n_chars for r in sections) == len(text or "")
        assert [r.n_chars for r in sections] == ([len(x) for x in lines] or [0])


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_crossing_tokens_follow_the_rule(rule):
    text = "The café costs 12 €, über alles; wonderfully internationalisation."
    raw = text.encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    ends = token_counts.encoder(None).ends(text)
    bounds = [len(text[:c].encode()) for c in (2, 5, 6, 12, 30, 45, len(text))]
    found, crossing = token_counts.allot(ends, np.array(bounds), chars, rule)
    want, crossed = [0.0] * len(bounds), [0] * len(bounds)
    for start, end in zip([0, *ends[:-1]], ends, strict=True):
        parts = [0] * len(bounds)
        touched = []
        low = 0
        for s, high in enumerate(bounds):
            if max(start, low) < min(end, high):
                touched.append(s)
                parts[s] = int(chars[min(end, high)] - chars[max(start, low)])
            low = high
        if len(touched) > 1:
            for s in touched:
                crossed[s] += 1
        if rule == "first" or not sum(parts):
            want[touched[0]] += 1
        elif rule == "majority":
            want[max(touched, key=lambda s: (parts[s], -s))] += 1
        else:
            for s in touched:
                want[s] += parts[s] / sum(parts)
    assert np.allclose(found, want)
    assert crossing.tolist() == crossed and sum(crossed) > 0


def test_unknown_rule(spark):
    with pytest.raises(ValueError, match="rule"):
        token_counts.section_tokens(docs(spark, ["x"]), rule="last")


def test_no_documents(spark):
    assert token_counts.section_tokens(docs(spark, ["x"]).where("false")).collect() == []
