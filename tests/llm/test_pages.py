"""URL rules and page text."""

import html
import re

import numpy as np
import pytest

from kinelane.llm import common, page_text, url_rules

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def package_on_executors(spark):
    common.shipped(spark)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SMALL}/pages.parquet")


def test_odd_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "http://ORG", "http://org/", "https://a.b.Example.ORG/en/1x?q#f",
        "http://example.org/en/2", "http://example.org/es/", "http://notexample.org/es/1", "x://com/fr/a",
        "http://a.com/de/", "http://example.org?x=/es/", "http://u@h.org:80/es/", "a://b.com/fr/://c.org/",
    ]
    rows = [(i, u, "x", "y") for i, u in enumerate(urls)] + [(14, urls[14], "x", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = {r.page_id: r for r in url_rules.judge(df).collect()}
    assert url_rules.judge(df).count() == len(rows)
    assert [(got[i].host, got[i].path) for i in (0, 2, 4, 6, 12)] == [
        ("", ""), ("", ""), ("org", ""), ("a.b.example.org", "/en/1x"), ("example.org", "")
    ]
    rules = [got[i].rule for i in range(len(urls))]
    assert rules == [None, None, None, None, None, "org/", "example.org/en/1", "org/", "example.org/es/",
                     "org/", "com/fr/", "com/de/", None, None, "com/fr/"]
    assert [i for i in got if got[i].verdict == "block"] == [6, 8, 11]
    assert url_rules.judge(df.limit(0)).count() == 0


def test_equal_digests_do_not_decide(tmp_path, monkeypatch):
    """With one digest for all keys only whole strings tell them apart."""
    monkeypatch.setattr(url_rules, "digests", lambda keys: np.array([7 for _ in keys], np.uint64))
    url_rules.write_digests(url_rules.RULES, str(tmp_path), "r")
    table = url_rules.Digests("r", at=lambda name: str(tmp_path / name))
    keys = [f"{r.host}{r.path}" for r in url_rules.RULES]
    found = table.find([*keys, "other/"])
    assert sorted(found[:5]) == list(range(5)) and found[5] == -1
    assert [table.string(p) for p in found[:5]] == keys


def test_no_rules(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert url_rules.judge(df, []).first().verdict == "allow"


def plain_article(text):
    body = re.search(r"<article>(.*)</article>", text, re.S)[1]
    blocks = [
        " ".join(html.unescape(re.sub(r"<br>|</?b>", lambda m: " " * (m[0] == "<br>"), b)).split())
        for b in re.split(r"</?(?:p|h1)>", body)
    ]
    return "\n\n".join(b for b in blocks if b)


def test_articles(pages):
    truth = {r.page_id: plain_article(r.html) for r in pages.collect()}
    rows = page_text.extracted(pages).collect()
    assert {r.page_id: r.text for r in rows} == truth
    assert all(r.n_chars == len(r.text) for r in rows)


def test_noise_in_and_around_an_article():
    page = """<body class="with-sidebar"><header><h1>Site</h1></header><div id=cookie-notice>We use cookies</div>
    <main><article><header><h2>Title &amp; more</h2></header><p>One<script>var a = "</p>";</script> two
    <p>Three <b>bold</b><br>four<ul><li>first<li>second</ul><aside>Also read</aside>
    <div class="share-buttons">Share</div><form><input>Mail</form><!-- no -->
    <table><tr><td>a<td>b</table><section class="comments"><article>Nice!</article></section></article></main>
    <footer>&copy;</footer>"""
    assert page_text.main_text(page, frozenset()) == "\n\n".join(
        ["Title & more", "One two", "Three bold four", "first", "second", "a", "b"]
    )


@pytest.mark.parametrize("page,expected", [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\n\nb"), ("<p", "<p"),
    ("<div><!-- open", ""), ("<article></article>", ""), ("&lt;p&gt; &am &#x41;", "<p> &am A"),
    ("<b><i>x</b>y</i>", "xy"), ("<style>p{}", ""), ("</p></p>z", "z"),
])
def test_broken_pages(page, expected):
    assert page_text.main_text(page, frozenset()) == expected


def test_the_site_tells_what_repeats(spark):
    """Without a stated article, what is the same on most pages of a host goes."""
    def page(i):
        own = f"<div class=text><p>Story {i} begins</p><p>and ends with {i * 7}</p></div>"
        return f"<body><div class=top>Welcome to the site</div>{own}<div class=low>All rights kept</div></body>"

    rows = [(i, f"http://a.org/{i}", page(i)) for i in range(12)]
    rows += [(50, "http://b.org/", page(50)), (51, None, None), (52, "http://a.org/x", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in page_text.extracted(df).collect()}
    assert got[3] == "Story 3 begins\n\nand ends with 21"
    # One page of a site cannot tell.
    assert got[50].startswith("Welcome to the site") and got[50].endswith("All rights kept")
    assert got[51] == got[52] == ""
    assert page_text.extracted(df.limit(0)).count() == 0


def test_the_site_judges_beside_and_within_a_stated_article(spark):
    """Main text beside a stated teaser stays; what repeats goes, within an article too."""
    def page(i):
        teaser = f"<article><h3>Teaser {i}</h3><div class=box>Read it in our shop</div></article>"
        own = f"<div class=text><p>Story <b>{i}</b> begins</p><p>and ends with {i * 7}</p></div>"
        return f"<body><div class=top>Welcome to the site</div>{own}{teaser}</body>"

    df = spark.createDataFrame(
        [(i, f"http://a.org/{i}", page(i)) for i in range(12)] + [(50, "http://b.org/", page(50))],
        "page_id long, url string, html string",
    )
    got = {r.page_id: r.text for r in page_text.extracted(df).collect()}
    assert got[3] == "Story 3 begins\n\nand ends with 21\n\nTeaser 3"
    # One page of a site cannot tell, so what it states holds.
    assert got[50] == "Teaser 50\n\nRead it in our shop"


def test_copies_of_a_page_are_one_and_rare_menus_go(spark):
    """Copies do not make their text boilerplate; a menu on few of many pages does."""
    rows = [(i, "http://a.org/", "<body><div class=text><p>The same story</p></div></body>") for i in range(8)]
    menu = "<div class=top>Sports section</div>"
    for i in range(100):
        own = f"<div class=text><p>Story {i}</p></div>"
        rows.append((100 + i, f"http://b.org/{i}", f"<body>{menu if i < 6 else ''}{own}</body>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in page_text.extracted(df).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == "The same story" for i in range(8))
    assert all(got[100 + i] == f"Story {i}" for i in range(100))


def test_importance_of_branches(spark):
    rows = [(f"p{i}", "h", f"<div class=same>same</div><div class=own>text {i}</div>") for i in range(8)]
    df = spark.createDataFrame(rows, "page_id string, host string, html string")
    found = page_text.importances(page_text.site_tree(df), df).collect()
    low, high = min(found, key=lambda r: r.importance), max(found, key=lambda r: r.importance)
    assert low.importance < 0.2 and high.importance > 0.6 and {r.n_pages for r in found} == {8}
