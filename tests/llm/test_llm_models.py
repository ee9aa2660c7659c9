"""Language, page and quality models: exactness of their sums, held-out accuracy, odd inputs."""

import itertools
import math
import textwrap

import awkward
import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sparkrank.llm import html_extract, langid, site_quality
from sparkrank.llm.quality_rules import quality_rules
from sparkrank.llm.queries import QUERIES

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def languages(spark, small):
    return langid.learn_languages(spark.read.parquet(f"{small}/documents.parquet"), PIECES)


def test_forward_sums_all_segmentations():
    vocabulary = langid.pieces(PIECES)
    number = {t: n for n, t in enumerate(vocabulary.texts) if n}
    probability = np.random.default_rng(1).random((vocabulary.count, 3))
    probability /= probability.sum(0)
    words = ["the", "über", "zqx", "中文字", "anthing", "ﬀ", "a" * 40, "éeau"]
    found = langid.forward(vocabulary, words, probability)
    for row, word in enumerate(words):
        text = "▁" + word
        for lang in range(3):
            total = [1.0] + [0.0] * len(text)
            for end in range(1, len(text) + 1):
                for start in range(end):
                    piece = number.get(text[start:end], 0 if start == end - 1 else None)
                    if piece is not None:
                        total[end] += total[start] * probability[piece, lang]
            assert found[row, lang] == pytest.approx(math.log(total[-1]), rel=1e-9)


def test_expected_counts_of_long_words(monkeypatch):
    """A word of 200 code points counts whole, and logarithms give what products give."""
    vocabulary = langid.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    words = ["stone" * 40, "turning", "a", "überhaupt" * 9]
    probability = np.random.default_rng(2).random(vocabulary.count) + 0.01
    probability /= probability.sum()
    chars = np.array([1, *map(len, vocabulary.texts[1:])])

    def covered(some):
        total = np.zeros(len(some))
        for rows, found, n in langid.expected_counts(vocabulary, some, lambda rows, found: probability[found]):
            np.add.at(total, rows, n * chars[found])
        return total

    assert np.allclose(covered(words), [len(w) + 1 for w in words])
    plain = [w for w in words if len(w) < 60]
    first = langid.expected_counts(vocabulary, plain, lambda rows, found: probability[found])
    monkeypatch.setattr(langid, "PLAIN", 0)
    again = langid.expected_counts(vocabulary, plain, lambda rows, found: probability[found])
    assert all(np.allclose(a[2], b[2]) for a, b in zip(first, again))


def test_expected_counts_are_whole():
    vocabulary = langid.pieces(PIECES)
    probability = np.full(vocabulary.count, 1 / vocabulary.count)
    words = ["the", "q", "antheredly"]
    spread = np.zeros(len(words))
    for rows, found, n in langid.expected_counts(vocabulary, words, lambda rows, found: probability[found]):
        lengths = np.array([len(vocabulary.texts[p]) or 1 for p in found])
        np.add.at(spread, rows, n * lengths)  # pieces cover each character once
    assert spread == pytest.approx([len(w) + 1 for w in words])


def test_languages_of_held_out_documents(spark, small):
    found = QUERIES["op1_language_id"](spark, small).toPandas()
    docs = duckdb.sql(f"SELECT doc_id, lang FROM '{small}/documents.parquet'").df()
    both = found.merge(docs, on="doc_id")
    assert len(both) == len(docs)
    held = both[both["held_out"]]
    assert len(held) > 10 and (held["lang_pred"] == held["lang"]).mean() > 0.95
    assert both["score"].between(0, 1).all()
    import zlib

    assert (both["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in both["doc_id"]]).all()


def test_language_of_odd_texts(spark, languages):
    found = {r["doc_id"]: r for r in langid.identify(awkward.docs(spark), languages).collect()}
    for i in (1, 2, 3, 17):
        assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)
    assert found[15]["lang_pred"] != "und" and found[None]["held_out"] is False
    docs = awkward.docs(spark)
    kept = langid.keep_identified(docs, languages)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id < 20").collect()) == [4, 4, *range(5, 17), 18, 19][:3] + [
        i for i in (6, 7, 8, 9, 11, 12, 13, 14, 15, 16, 18, 19)
    ]


def test_languages_of_some_thousand_rows_give_all(spark, monkeypatch):
    counted, write = [], langid.materialize
    monkeypatch.setattr(langid, "materialize", lambda df, name: counted.append(write(df, name)) or counted[-1])
    rows = [(n, "word" + "".join("abcdefghij"[int(d)] for d in str(n)), "en") for n in range(3000)]
    langid.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), PIECES, rounds=1)
    assert counted[0].count() == 3000


def test_nothing_to_learn_from(spark):
    docs = awkward.docs(spark).withColumn("lang", F.lit(None).cast("string"))
    model = langid.learn_languages(docs, PIECES)
    assert {r["lang_pred"] for r in langid.identify(docs, model).collect()} == {"und"}
    assert langid.identify(awkward.docs(spark, []), model).count() == 0


def test_messages_give_exact_marginals():
    page = html_extract.parse("<div><h1>One</h1><p>Two words.</p><ul><li><a href=x>x</a></li></ul></div><p>Three.</p>")
    n = len(page.parents)
    assert 6 <= n <= 12
    model = html_extract.Model({"tag h1": 0.7, "tag p": 0.4, "tag li": -0.9, "links 3": -0.8, "ends True": 0.5}, (2.0, -1.5))
    weight = [0.0, 0.0]
    content = [0.0] * n
    child = lambda parent, c: (lambda a: a if c else 1 - a)(1 / (1 + math.exp(-model.stay[1 - parent])))
    for labels in itertools.product((0, 1), repeat=n):
        w = math.exp(sum(model.evidence(page, i) for i in range(n) if labels[i]))
        for i in range(1, n):
            w *= child(labels[page.parents[i]], labels[i])
        weight[0] += w
        for i in range(n):
            content[i] += w * labels[i]
    want = [math.log(c / (weight[0] - c)) for c in content]
    assert model.marginals(page) == pytest.approx(want, abs=1e-9)


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><article>no";</script></head><body>
<header class="site"><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav><div id="cookie-notice">We use cookies.</div>
<div class="sidebar"><p>Side text, long enough to be a paragraph of its own.</p></div><article><h1>The  Title</h1>
<p>First &lt;para&gt; with <a href=x>a li<b>nk</b></a> &amp; more&nbsp;text.<br>After the break.<p>Second, <i>unclosed<p>Third.
<div class="ad">Buy now.</div><form><label>Name</label><input name=q><button>Go</button></form><!-- <p>no</p> -->
<aside>Aside.</aside><p hidden>Hidden.</p><section class="comments"><div class="comment"><p>I like this a lot, thank you for it all.</p></div>
<div class="comment"><p>Another comment that looks like content, it is long.</p></div></section></article><footer>&copy; me</footer>"""


def test_page_parts(spark):
    want = "The Title First <para> with a link & more text. After the break. Second, unclosed Third."
    rows = [(1, PAGE), (2, None), (3, ""), (4, "<p"), (5, "<" * 3000), (6, "<div>" * 3000 + "x"), (1, PAGE)]
    pages = spark.createDataFrame(rows, "page_id bigint, html string").withColumns({"text": F.lit("old"), "url": F.lit("u"), "id": F.lit(1)})
    found = html_extract.extract(pages)
    assert sorted(found.columns) == ["id", "n_chars", "page_id", "text", "url"]
    texts = [(r["page_id"], r["text"]) for r in found.collect()]
    assert texts.count((1, want)) == 2 and (2, "") in texts and (3, "") in texts and len(texts) == 7
    assert all(r["n_chars"] == len(r["text"]) for r in found.collect())
    assert html_extract.extract(pages.filter("false")).count() == 0


@pytest.mark.parametrize("tag, names", [
    ("section", "id='social-impact'"), ("div", "class='text with-sidebar'"), ("div", "class='no-sidebar has-comments'"),
    ("article", "class='post category-social comments-open'"), ("main", "class='search form'"), ("div", "id='searchOfTruth'"),
])
def test_compound_names_keep_their_text(tag, names):
    model = html_extract.fit({})
    inner = f"<h2 id='related-work'>Related work</h2><{tag} {names}><h3 id='form'>Form</h3><p>One sentence.</p><p>And another.</p></{tag}><p>End.</p>"
    page = f"<body class='search widget'><article><h1>Title</h1>{inner}</article></body>"
    assert model.text(page) == "Title Related work Form One sentence. And another. End."
    if tag in ("article", "main"):
        assert model.text(f"<body><{tag} {names}><p>One sentence.</p></{tag}></body>") == "One sentence."


@pytest.mark.parametrize("names", [
    "class='sidebar'", "class='comment-list'", "id='cookie-notice'", "class='commentList'", "class='x related-posts'", "class='wp-block-search'",
    "class='main-nav'", "id='sidebar-2'", "class='td-post-sharing'", "role='search'",
])
def test_whole_names_of_other_parts_lose_their_text(names):
    page = f"<article><p>One sentence.</p><div {names}><p>A paragraph here.</p><p>Another.</p></div><p>End.</p></article>"
    assert html_extract.fit({}).text(page) == "One sentence. End."


@pytest.mark.parametrize("icon", [
    "<svg/>", "<svg />", "<svg class='icon' viewBox=\"0 0 1 1\"/>", "<svg class=x />", "<svg hidden/>", "<math/>", "<SVG id='a' />",
    "<svg><path d='M0'/></svg>", "<svg class=x/></svg>", "<svg><title>Icon</title></svg>",
])
def test_icons_end_where_they_are_closed(icon):
    page = f"<nav><a href=/>{icon}Menu</a></nav><article><p>One {icon}sentence.</p><p>And another.</p></article><footer>{icon}</footer>"
    assert html_extract.fit({}).text(page) == "One sentence. And another."
    assert html_extract.fit({}).text(page.replace(f"<footer>{icon}</footer>", "<svg><g></g></svg>")) == "One sentence. And another."


def test_articles_of_all_pages(spark, small):
    import html
    import re

    found = {r["page_id"]: r for r in QUERIES["op4_html_extraction"](spark, small).collect()}
    pages = duckdb.sql(f"SELECT page_id, html FROM '{small}/pages.parquet'").fetchall()
    assert len(found) == len(pages)
    for i, source in pages:
        inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
        inner = re.sub(r"<[^>]*>", "", re.sub(r"<br>|</?p>|</?h1>", " ", inner))
        assert found[i]["text"] == " ".join(html.unescape(inner).split())


def test_site_quality_of_unseen_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    seen = labels.filter("crc32(cast(cast(doc_id AS string) AS binary)) % 3 <> 0")
    found = site_quality.site_quality(docs, seen, "source", "lang")
    judged = found.join(labels.join(seen, "doc_id", "left_anti"), "doc_id").select("kept", labels["quality"].alias("label")).toPandas()
    assert len(judged) > 80
    assert (judged["kept"] == (judged["label"] == 1)).mean() > 0.95
    assert judged[judged["label"] == 1]["kept"].mean() > 0.97


def test_sparse_sites_shrink_more(spark):
    rows = [(n, "fair words here. " * 5, "big" if n < 200 else f"small{n}") for n in range(230)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, site string").withColumn("p", F.lit("x"))
    labels = spark.createDataFrame([(n, int(n % 4 == 0 and n < 200)) for n in range(230)], "doc_id bigint, quality int")
    rates = {r["host"]: r["host_rate"] for r in site_quality.site_quality(docs, labels, "site", "p").collect()}
    base = 50.5 / 231
    assert abs(rates["big"] - 0.25) < abs(rates["small229"] - 0.0)
    assert 0 < rates["small229"] < base < rates["big"] < 0.26


def plain_pull(groups):
    """``groups`` of (good, n, parent's rate)."""
    groups = [g for g in groups if g[1] > 1]
    spread = sum(n * (good / n - p) ** 2 for good, n, p in groups)
    noise = [p * (1 - p) for _, _, p in groups]
    more = sum(n * v for (_, n, _), v in zip(groups, noise)) - sum(noise)
    r = (spread - sum(noise)) / max(1e-9, more)
    return min(1000.0, max(2.0, 1 / r - 1)) if r > 0 else 1000.0


@pytest.mark.parametrize("wide", [False, True])
def test_site_posteriors_against_a_plain_version(spark, monkeypatch, wide):
    if wide:
        monkeypatch.setattr(site_quality, "fits", lambda df: False)
    rng = np.random.default_rng(3)
    # One host holds a third of all, one has a single labelled document.
    hosts = ["hot" if n % 3 == 0 else "one" if n == 1 else f"h{n % 17}" for n in range(300)]
    rows = [(n, "plain words " * int(rng.integers(1, 30)) + "!!" * int(rng.integers(0, 9)), hosts[n], f"p{n % 2}") for n in range(300)]
    label = {n: int(rng.random() < (0.8 if hosts[n] == "hot" else 0.3)) for n in range(300) if n % 4 < 2}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, site string, part string")
    labels = spark.createDataFrame(list(label.items()), "doc_id bigint, quality int")
    found = {r["doc_id"]: r for r in site_quality.site_quality(docs, labels, "site", "part").collect()}
    assert len(found) == 300

    own = {i: (label.get(i, r["text_score"]) * (w := 1.0 if i in label else 0.25), w) for i, r in found.items()}

    def total(ids):
        return tuple(math.fsum(own[i][j] for i in ids) for j in (0, 1))

    by_path, by_host = {}, {}
    for i, r in found.items():
        by_path.setdefault((r["host"], r["path"]), []).append(i)
        by_host.setdefault(r["host"], []).append(i)
    good, n = total(found)
    base = (good + 0.5) / (n + 1)
    pull = plain_pull([(*total(ids), base) for ids in by_host.values()])
    rates = {h: (total(ids)[0] + pull * base) / (total(ids)[1] + pull) for h, ids in by_host.items()}
    path_pull = plain_pull([(*total(ids), rates[h]) for (h, _), ids in by_path.items()])
    logit = lambda p: math.log(p / (1 - p))
    for i, r in found.items():
        rest = lambda ids: total([x for x in ids if x != i])  # noqa: B023, E731
        (g0, n0), (g1, n1), (g2, n2) = rest(found), rest(by_host[r["host"]]), rest(by_path[r["host"], r["path"]])
        start = (g0 + 0.5) / (n0 + 1)
        rate = (g2 + path_pull * (g1 + pull * start) / (n1 + pull)) / (n2 + path_pull)
        odds = logit(r["text_score"]) + logit(rate) - logit(start)
        assert r["host_rate"] == pytest.approx(rates[r["host"]], rel=1e-9)
        assert r["path_rate"] == pytest.approx(rate, rel=1e-9)
        assert r["quality"] == pytest.approx(1 / (1 + math.exp(-odds)), rel=1e-9)


def test_own_label_does_not_reach_the_posterior_by_the_site(spark):
    rows = [(n, "fair words here. " * 5, "alone" if n == 0 else f"h{n % 5}", "p") for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, site string, part string")
    found = []
    for own in (0, 1):
        labels = spark.createDataFrame([(0, own)] + [(n, n % 2) for n in range(1, 60)], "doc_id bigint, quality int")
        row = site_quality.site_quality(docs, labels, "site", "part").filter("doc_id = 0").first()
        found.append((row["path_rate"], row["host_rate"]))
    assert abs(found[0][0] - found[1][0]) < 1e-9 and found[0][1] < found[1][1]


def test_site_quality_of_odd_rows(spark):
    docs = awkward.docs(spark)
    empty = spark.createDataFrame([], "doc_id bigint, quality int")
    found = site_quality.site_quality(docs, empty, "source", "lang").collect()
    assert len(found) == len(awkward.texts())
    assert {round(r["quality"], 6) for r in found} == {0.5} and all(r["kept"] for r in found)
    labels = spark.createDataFrame([(4, 1), (4, 0), (9, 1), (None, 0), (12, None), (77, 0)], "doc_id bigint, quality int")
    assert site_quality.site_quality(docs, labels, "source", "lang").count() == len(awkward.texts())
    assert site_quality.site_quality(awkward.docs(spark, []), labels, "source", "lang").count() == 0
    sites = site_quality.url_sites(
        spark.createDataFrame([("http://a.b/en/12?x=1",), ("https://c.d/7.html",), (None,), ("nothing",), ("http://z.z/en/12",)], "url string")
    )
    assert {tuple(r) for r in sites.collect()} == {(12, "a.b", "en"), (7, "c.d", "7.html")}


def test_quality_rules(spark):
    found = quality_rules(awkward.docs(spark)).collect()
    got = [(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in found]
    assert sorted(got, key=repr) == sorted([(i, *brute.rules(t or "")) for i, t in awkward.texts()], key=repr)
    assert all(not r["kept"] for r in found if r["base_failed"])
    assert quality_rules(awkward.docs(spark, [])).count() == 0


def test_lines_that_fail(spark):
    good = "This is a plain sentence of prose that goes on for a while and then it ends."
    bad = ["Home | News | Sport | About us | Contact", "Menu", "All rights reserved by the owner 2024.", "%%% buy### now$$$ this&&& is***", "WOW!! THIS!! IS!! GREAT!! NEWS!!"]
    docs = spark.createDataFrame([(1, "\n".join([good, *bad, good])), (2, "\n".join([good] + [b * 4 for b in bad])), (3, good + "\nAnother line says other things, at some length, before it too comes to its end.")], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in quality_rules(docs).collect()}
    assert found[1]["clean_text"] == good + "\n" + good and found[1]["n_failed_lines"] == 5
    assert not found[2]["kept"] and found[3]["kept"] and found[3]["lost_chars"] == 0


PROSE = (
    "The river rises in the hills behind the old town and runs past two mills before it meets the road. "
    "In dry summers it is little more than a brook, but the floods of spring have taken three bridges since then. "
    "Der Müller Zum Alten Rad Kaufte Das Haus Am Ufer Und Baute Dort Eine Neue Scheune Aus Stein Und Holz. "
    "Nobody remembers who planted the poplars along the bank, nor why they stand in pairs up to the weir."
)


@pytest.mark.parametrize("width", [40, 50, 60, 72])
def test_wrapped_prose_is_judged_as_prose(spark, width):
    lines = textwrap.wrap(PROSE, width)
    titles = ["Ten gardens worth the long journey", "What the new timetable means", "Older houses and their cellars today",
              "A walk along the northern harbour wall", "Recipes from the island kitchens", "Letters to the editor of this week"]
    texts = [PROSE, "\n".join(lines), "  " + "\r\n  ".join(lines), "\n".join(lines) + "\n\nMenu\n", "\n".join(titles * 3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in quality_rules(docs).collect()}
    assert [found[i]["n_failed_lines"] for i in range(4)] == [0, 0, 0, 1]
    assert [found[i]["kept"] for i in range(4)] == [True] * 4
    assert found[4]["n_failed_lines"] == 18


def test_quality_rules_run_no_python(spark, small):
    plan = QUERIES["op10_quality_rules"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
