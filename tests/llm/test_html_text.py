"""HTML extraction on made pages and on the given ones."""

from __future__ import annotations

import html
import re

from tillstone.llm.html_text import extract_text, main_text

LONG = "The rest of the story is that it was in the hands of a few people who had been there for years and it was good."


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a = "</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">We use cookies.</div>
    <!-- ad --><article><h1>Head &amp; line</h1><p>{LONG}<br>Caf&eacute;&nbsp;&#233;<p><b>Un</b>closed &lt;b&gt;</p><aside>Side</aside><p>End.</p>
    <form><input><label>Mail</label></form><div id="comments"><div><p>{LONG}</p></div></div></article><div class="ad">Buy</div><footer>&copy; me</footer>"""
    assert main_text(page) == f"Head & line {LONG} Café é Unclosed <b> End."


def test_densities_where_there_is_no_article():
    menu = "".join(f'<li><a href="{i}">Some menu entry {i}</a></li>' for i in range(9))
    list_ = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omega sigma tau upsilon phi chi psi."
    page = f"<body><ul>{menu}</ul><div>Top</div><h2>Story</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p><div>{list_}</div><div>Small print</div></body>"
    assert main_text(page) == f"Story {LONG} Short. {LONG}"


def test_articles_are_one_feature_among_others():
    menu = '<nav><a href="/">Home</a></nav>'
    cards = "".join(f'<article><h3><a href="/{i}">Another story to read {i}</a></h3><p>More.</p></article>' for i in range(3))
    comment = f'<article class="comment-body"><p>{LONG}</p></article>'
    page = f"<body>{menu}<div><h1>Story</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>{cards}{comment}<footer>Us</footer></body>"
    assert main_text(page) == f"Story {LONG} Short. {LONG}"
    # density is looked at inside of articles, and short blocks follow their neighbours
    links = "".join(f'<li><a href="{i}">Some related entry {i}</a></li>' for i in range(4))
    names = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omega sigma tau upsilon phi chi psi."
    page = f"<article class='node--promoted has-comments'><p>{LONG}</p><p>Kept.</p><ul>{links}<li>Tail</li><li><a>{names}</a></li></ul><p>{names}</p></article><p>c"
    assert main_text(page) == f"{LONG} Kept."
    # a language without known stop words, and an article of short blocks only
    assert main_text(f"{menu}<article><h1>Lista</h1><p>{names}</p><p>Kres.</p></article><div>Note</div>") == f"Lista {names} Kres."
    assert main_text(f"{menu}<article><p>Tiny.</p></article><footer>Us</footer>") == "Tiny."


def test_page_without_known_stop_words_or_article():
    menu = "".join(f'<li><a href="{i}">Pozycja w menu {i}</a></li>' for i in range(9))
    story = "Wczoraj wieczorem mieszkańcy miasta zebrali się przed ratuszem, gdzie burmistrz ogłosił nowe plany rozbudowy."
    page = f"<body><ul>{menu}</ul><h1>Ratusz</h1><p>{story}</p><p>Krótko.</p><p>{story}</p><div class='comments'><p>{story}</p></div><footer>{story}</footer>"
    assert main_text(page) == f"Ratusz {story} Krótko. {story}"
    # known stop words anywhere decide for the whole page
    assert main_text(f"<body><p>{LONG}</p><div>{story}</div>") == LONG


def test_broken_and_empty_pages():
    assert main_text(None) == "" and main_text("") == "" and main_text("<p>") == ""
    assert main_text("plain a < b text") == "plain a < b text"
    assert main_text("<article><p>a<p title=\"x > y\">b</article><p>c") == "a b"
    assert main_text("<article>x<script>never closed") == "x"
    assert main_text(f"<article><p>{LONG}<p title='{'x > y ' * 3000}'>b</p></article>") == f"{LONG} b"
    assert main_text(f"<article><noscript>enable js<p>{LONG}<select><option>one<option>two</p><p>{LONG}</article>") == f"{LONG} {LONG}"
    assert main_text(f"<article><p class=a\"b>{LONG}</p><p>It's {LONG}</p></article>") == f"{LONG} It's {LONG}"
    main_text("<div " + '"' * 5000 + "<" * 2000 + "x")  # ends
    assert len(main_text("<article>" + "<div>" * 3000 + "word " * 50000)) == 249999


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for row in extract_text(pages).join(pages, ["page_id", "url"]).collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        plain = re.sub(r"<(?:/?p|/?h1|br)>", " ", article)
        expected = " ".join(html.unescape(re.sub(r"</?b>", "", plain)).split())
        assert row.text == expected and row.n_chars == len(expected)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "u", "<p>a", "x"), (1, "u", "<p>a", "x"), (None, None, None, "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, extract_text(pages).collect()), key=str)
    assert got == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)], key=str)
    assert extract_text(pages.limit(0)).collect() == []
