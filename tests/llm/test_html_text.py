from __future__ import annotations

import pytest

from bagdiff.llm import html_text
from bagdiff.llm.html_text import main_text

LONG = "This is the first paragraph of the story, and it has a number of the words that are in every text."
MORE = "It was not the only one: the second is as long as the first was, and it is in the same article."


def test_article_without_what_surrounds_it():
    page = f"""<!DOCTYPE html><html lang="en"><head><title>Title &amp; more</title><style>p{{}}</style>
    <script>var t="</p><p>{LONG}</p>";</script></head><body><header><h2>Site of the day</h2></header>
    <nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About</a></li></ul></nav><!-- <p>{LONG}</p> -->
    <div class="ad">Buy the best of the best of all of them here today, it is the offer of the year for you.</div>
    <article><h1>The  title</h1><p>{LONG}</p><p>Short.</p><p>{MORE}</p>
    <form><label>Your mail to the editors of the paper</label><input name=q></form>
    <section class="reader-comments"><p>{LONG.upper()}</p></section></article>
    <aside><p>{MORE.upper()}</p></aside><div id="cookie-notice">{MORE}</div><footer>&copy; 2024 of the site</footer></body></html>"""
    assert main_text(page) == f"The title\n{LONG}\nShort.\n{MORE}"


def test_without_article_element_short_blocks_follow_their_neighbours():
    page = f"""<body><div><a href=1>One</a> <a href=2>Two</a></div><p>menu</p><div><a href=3>Three</a></div>
    <h2>Head</h2><p>{LONG}</p><p>Yes.</p><p>{MORE}</p><p>Bye.</p><div><a href=4>More of it</a></div><p>tail</p></body>"""
    assert main_text(page) == f"Head\n{LONG}\nYes.\n{MORE}\nBye."


def test_class_names():
    def page(attributes):
        return f"<body><div {attributes}><p>{LONG}</p></div><p>{MORE}</p></body>"

    gone = ["class=ad", 'class="box site-ads"', "id='comments'", 'role="navigation"', 'class="page-header"', "hidden", 'style="display: none"', "class='Cookie_Notice'"]
    kept = ["class=additional", 'class="has-sidebar"', "class='ad-free wide'", 'class="article-header"', 'id="content" class="no-comments"', 'data-hidden="x"']
    assert [main_text(page(x)) for x in gone] == [MORE] * len(gone)
    assert [main_text(page(x)) for x in kept] == [f"{LONG}\n{MORE}"] * len(kept)


@pytest.mark.parametrize(
    "open_tag",
    [
        "<article class='post comments-open'>",
        "<article class='post category-advertising tag-newsletter'>",
        "<div id='main-with-sidebar'>",
        "<main class='layout sidebar-right'>",
        "<div class='layout sidebar-right'><article>",
    ],
)
def test_names_of_what_holds_the_article_are_no_verdict(open_tag):
    body = f"<h1>Title</h1><p>{LONG}</p><p>{MORE}</p><p>{LONG}</p>"
    aside = f"<div class='comments'><p>{MORE.upper()}</p></div>"
    for page in (f"{open_tag}{body}{aside}", f"<body>{open_tag}{body}{aside}</body>"):
        assert main_text(page) == f"Title\n{LONG}\n{MORE}\n{LONG}"


def test_names_hold_against_an_article_outside_and_for_small_parts():
    comments = f"<div class='comments'>{f'<p>{MORE}</p>' * 9}</div>"
    assert main_text(f"<article><p>{LONG}</p></article>{comments}") == LONG
    assert main_text(f"<article><p>{LONG}</p>{comments}</article>") == LONG
    assert main_text(f"<div class='related'><article><p>{MORE}</p></article></div><p>{LONG}</p><p>{LONG}</p>") == f"{LONG}\n{LONG}"
    assert main_text(f"<article hidden><p>{LONG}</p></article><p>{MORE}</p>") == MORE


def test_names_do_not_count_if_they_leave_no_text():
    assert main_text(f"<div class='promo'><p>{LONG}</p></div><div class='notice'><p>{MORE}</p></div>") == f"{LONG}\n{MORE}"


def test_long_blocks_with_few_stop_words_and_page_edges_are_not_text():
    imprint = "Acme Media Ltd, 12 Example Street, London EC1A 1BB, phone 020 7946 0000, registered 01234567, VAT GB 123 4567 89"
    story = f"<h1>Title</h1><p>{LONG}</p><p>Yes.</p><p>{MORE}</p>"
    assert main_text(f"<body>{story}<p>{imprint}</p></body>") == f"Title\n{LONG}\nYes.\n{MORE}"
    assert main_text(f"<body><div>{imprint}</div>{story}</body>") == f"Title\n{LONG}\nYes.\n{MORE}"
    assert main_text(f"<p>Site</p>{story}<p>End.</p><p>Top</p>") == f"Title\n{LONG}\nYes.\n{MORE}\nEnd."
    # inside a marked article a listing stays, and so does its last short block
    assert main_text(f"<article>{story}<p>{imprint}</p><p>One</p><p>Two</p></article>").endswith(f"{MORE}\n{imprint}\nOne\nTwo")


def test_few_stop_words_of_another_language_reject_nothing():
    words = "qwrt zxcv bnmk plkj hgfd qazw sxed crfv tgby hnuj mikl the of "
    mixed = "qwrt zxcv bnmk plkj hgfd qazw sxed crfv tgby hnuj mikl dfgh the of and qwop asdf "
    assert main_text(f"<p>{words * 3}</p><p>{mixed.replace(' the of and', '')}</p>").count("\n") == 1


def test_references_spaces_and_broken_markup():
    page = f"<article><p><b>A &lt;b&gt; &amp;amp; c&eacute;\n\t x<br><p>{LONG}<p>One &#x41;&nbsp;two"
    assert main_text(page) == f"A <b> &amp; cé x\n{LONG}\nOne A two"


def test_link_dense_blocks_inside_the_article_go():
    links = " ".join(f'<a href="/{i}">Story number {i} of the day</a>' for i in range(6))
    assert main_text(f"<main><p>{LONG}</p><ul><li>{links}</li></ul><p>{MORE}</p></main>") == f"{LONG}\n{MORE}"


@pytest.mark.parametrize("page", ["", " ", "<html><body></body></html>", "<script>x", "<!-- x", "<nav>Menu</nav>", "<", "<a"])
def test_pages_without_text(page):
    assert main_text(page) in ("", page if page in ("<", "<a") else "")


def test_unknown_language_and_only_short_blocks():
    words = "qwrt zxcv bnmk plkj hgfd qazw sxed crfv tgby hnuj mikl " * 3
    assert main_text(f"<p>{words}</p><nav>{words}</nav>") == words.strip()
    assert main_text("<p>One</p><p>Two</p><footer>Three</footer>") == "One\nTwo"


def test_hidden_is_an_attribute_of_its_own():
    body = f"<h1>Title</h1><p>{LONG}</p><p>{MORE}</p>"
    for tag in (
        '<article title="The hidden cost of rain">',
        '<main data-title="A hidden gem">',
        '<div class="container hidden md:block">',
        "<div data-note='style=\"display:none\" hidden'>",
        '<section title="class=ad id=comments">',
        "<article hidden>",  # the only text there is
    ):
        assert main_text(f"<body>{tag}{body}</body>") == f"Title\n{LONG}\n{MORE}", tag
    assert main_text(f"<body><p>{LONG}</p><div HIDDEN=''><p>{MORE}</p></div></body>") == LONG
    assert main_text(f"<body><article hidden><p>{LONG}</p></article><article><p>{MORE}</p></article></body>") == MORE


def test_links_hold_blocks():
    """Cards of related stories: everything up to the end of the link is its text."""
    card = f"<a href='/x'><div><h3>Another story</h3><p>{LONG}</p></div></a>"
    assert main_text(f"<body><div><p>{MORE}</p></div><div>{card * 3}</div></body>") == MORE
    # a link that is never closed ends with what encloses it; without an address it is none
    assert main_text(f"<body><p>{LONG} <a href=x>more</p><p>{MORE}</p></body>") == f"{LONG} more\n{MORE}"
    assert main_text(f"<body><a name=top><p>{LONG}</p><p>{MORE}</p></body>") == f"{LONG}\n{MORE}"


def test_long_hostile_pages_take_linear_time():
    import time

    pages = [
        "<a " * 100_000,
        "<div>" * 50_000 + "</section>" * 100_000,
        '<div class="ad">x ' * 50_000,
        "<script " * 100_000,
        "<!" * 100_000,
        "<p hidden=" * 100_000,
        "<a href=" + "x" * 300_000 + ">",
        "<p " + "a= " * 100_000 + ">",
    ]
    for page in pages:
        began = time.thread_time()
        main_text(page)
        assert time.thread_time() - began < 8, page[:30]


def test_hostile_markup_ends_soon():
    for page in ("<" * 200_000, '<a "' * 50_000, "<p>" * 50_000 + LONG, "<!--" * 50_000, "<div class='" * 30_000):
        main_text(page)


def test_supplied_pages_give_their_article(spark):
    """The text between the article's tags, cut at its block tags."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in html_text.with_main_text(pages).collect():
        own = r.html[r.html.index("<article>") : r.html.index("</article>")]
        own = re.sub(r"</?b>", "", own).replace("<br>", " ")
        blocks = [" ".join(html.unescape(b).split()) for b in re.split(r"<[^>]*>", own)]
        assert r.main_text == "\n".join(b for b in blocks if b)


def test_odd_rows(odd_docs, no_docs):
    got = html_text.with_main_text(odd_docs.drop("main_text"), "text")
    by = {r.doc_id: r.main_text for r in got.collect()}
    assert by[3] == by[4] == by[5] == "" and len(by[6]) > 400_000
    assert html_text.with_main_text(no_docs, "text").count() == 0
