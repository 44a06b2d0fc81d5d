"""Main text of pages."""

import html
import re
import time

import pytest

from seriesloom.llm import html_text as ht

LONG = " ".join(f"word{i}" for i in range(60))

CASES = [
    (None, ""), ("", ""), ("  \n", ""), ("just  text\n here", "just text here"), ("<p>a<b>b</p><p>c</p>", "ab\nc"),
    (f"<body><nav><a href=x>menu</a></nav><article><h1>T</h1><p>{LONG}</p><p>short</p></article><footer>f</footer>",
     f"T\n{LONG}\nshort"),
    (f"<body><div class='sidebar'><p>{LONG}</p></div><div id=content><h2>T &amp; U</h2><p>{LONG}<p>two&nbsp;parts"
     f"<div class=comments><p>{LONG} first!</div></div>", f"T & U\n{LONG}\ntwo parts"),
    (f"<body><main><section><h2>A</h2><p>{LONG}</p></section><section><p>b</p></section></main>"
     f"<div class='cookie-notice'>We use cookies {LONG}</div>", f"A\n{LONG}\nb"),
    (f"<body><article><p>x<script>var t='</p>';</script>y</p><form>{LONG}</form><style>p{{}}</style><p>{LONG}"
     "<!-- no --><br>z</article>", f"xy\n{LONG} z"),
    (f"<body><div><p>{LONG}</p><p>{LONG}</p></div><div><p>{LONG}</p><p>{LONG}</p></div>", "\n".join([LONG] * 4)),
    ("<div>" * 3000 + "deep" + "</div>" * 5, "deep"),
    (f"<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><p>{LONG}", f"one\ntwo\na\nb\n{LONG}"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_pages(page, text):
    assert ht.main_text(page) == text


WRAPPED = "<div class='sidebar'><p>side</p></div><div><h1>T</h1><p>{0}</p><p>{0} end</p></div>".format(LONG)
WANT = f"T\n{LONG}\n{LONG} end"


@pytest.mark.parametrize("mark", ["class='layout has-sidebar'", "class='page with-header'", "class='no-ads'", "id='search-page'",
                                  "class='post social-share-enabled'", "class='menuEnabled overflow-hidden'"])
def test_wrappers_of_the_article_stay(mark):
    assert ht.main_text(f"<body><div {mark}>{WRAPPED}</div><div class=comments><p>{LONG}</p></div>") == WANT
    article = WRAPPED.replace("<div><h1>", "<article><h1>").replace("end</p></div>", "end</p></article>")
    assert ht.main_text(f"<body><div {mark}>{article}</div><div class=comments><p>{LONG * 3}</p></div>") == WANT
    assert ht.main_text(f"<body><form {mark}>{article}</form><div class=share>{LONG}</div>") == WANT


def test_state_words_do_not_cut_a_part():
    page = f"<body><div><p>{LONG}</p><p>{LONG}</p></div><div class='no-ads'><p>{LONG}</p><p>{LONG} end</p></div>"
    assert ht.main_text(page) == f"{LONG}\n{LONG}\n{LONG}\n{LONG} end"


@pytest.mark.parametrize("part", [
    "<div class='market-share-table'><p>shares by year</p></div>", "<section class='related-work'><h2>Related work</h2></section>",
    "<div class='search-method'><p>We searched.</p></div>", "<div class='entry-header'><h1>Heading</h1></div>",
    "<div class='header'><h1>Heading</h1></div>"])
@pytest.mark.parametrize("around", ["<article><p>{0}</p>{1}<p>{0}</p></article>", "<main><div><p>{0}</p>{1}<p>{0}</p></div></main>",
                                    "<div id=text><p>{0}</p>{1}<p>{0}</p></div>"])
def test_one_word_of_a_class_does_not_cut_the_article(part, around):
    own = re.sub("<[^>]+>", "", part)
    assert ht.main_text("<body>" + around.format(LONG, part) + "</body>") == f"{LONG}\n{own}\n{LONG}"


@pytest.mark.parametrize("part", [
    "<div class='ad'>buy {0}</div>", "<div class='google-ads'>buy</div>", "<div class='reader-comments'><p>{0}</p></div>",
    "<div class='comment-body'><p>first!</p></div>", "<div class='share-buttons'>Share</div>", "<div id=cookieNotice>We use cookies</div>",
    "<ul class='more-related-stories'><li><a href=x>one story</a><li><a href=y>another</a></ul>",
    "<div class='sidebar-left'><p>{0}</p></div>", "<div class='newsletter-signup'><p>Join {0}</p></div>"])
def test_parts_that_are_no_text_are_cut_inside_the_article(part):
    assert ht.main_text(f"<body><article><p>{LONG}</p>{part.format(LONG)}<p>{LONG} end</p></article>") == f"{LONG}\n{LONG} end"


def test_work_grows_with_the_page_however_deep_it_nests():
    began = time.process_time()
    deep = 40_000
    assert ht.main_text("<div>" * deep + "deep") == "deep"
    assert ht.main_text("<div><p>" + "<b><i>" * deep + "x") == "x"
    assert ht.main_text("<p><div>" + "<b>" * deep + "x" + "<span>y</span></u>" * deep) == "x" + "y" * deep
    assert ht.main_text("<ul>" + "<li><b>" * deep + "x").endswith("x")
    assert time.process_time() - began < 30


def test_comments_of_an_article_are_cut():
    notes = "".join(f"<article class='comment-body'><p>{LONG} {i}</p></article>" for i in range(6))
    assert ht.main_text(f"<body><article><h1>T</h1><p>{LONG}</p></article><div class=comments>{notes}</div>") == f"T\n{LONG}"


def test_given_pages_equal_their_articles(spark):
    """The given pages mark their text as an article; its blocks are cut out by hand here."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    given = {r["page_id"]: r["html"] for r in pages.collect()}
    rows = ht.extract(pages).collect()
    assert len(rows) == len(given)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", given[r["page_id"]], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split())
                  for b in re.split(r"</?(?:h1|p|ul|li|div)[^>]*>", inner)]
        want = "\n".join(b for b in blocks if b)
        assert (r["text"], r["n_chars"]) == (want, len(want))


def test_tables(spark):
    rows = [(1, "u", "<p>a", "t"), (1, "u", "<p>a", "t"), (None, None, None, "t"), (2, "u", "<p>" + "long " * 200_000, "t")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted([tuple(r) for r in ht.extract(df).collect()], key=str)
    assert got == sorted([(1, "u", "a", 1)] * 2 + [(None, None, "", 0), (2, "u", ("long " * 200_000).strip(), 999_999)],
                         key=str)
    assert ht.extract(df.limit(0)).count() == 0
