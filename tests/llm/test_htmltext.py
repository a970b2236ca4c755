import html
import re
import time

import pytest

from loanframe.llm.htmltext import extract_main_text, main_text

LONG = "It was the best of the times and the worst of the times, and we had all of it before us in the spring."
MORE = "There was a king with a large jaw on the throne, and a queen with a plain face was on the throne too."


def page(body):
    return f"<!DOCTYPE html><html><head><title>A title</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "body",
    [
        "<nav><a href=x>Home</a><p>{L}</p></nav><article><h1>Head</h1><p>{L}</p><p>Yes.</p></article><footer>{M}</footer>",
        "<header><p>{M}</p></header><main><h1>Head</h1><p>{L}<p>Yes.</main><aside><p>{M}</p></aside>",
        "<div class='cookie-notice'>{M}</div><div id=post><h1>Head</h1><p>{L}</p><p>Yes.</p><p>{L}</p></div>"
        "<div class=\"comments\"><p>{M}</p><article class='comment'><p>{M}</p></article></div>",
        "<script>var t='</p><article>{M}';</script><article><header><h1>Head</h1></header><p>{L}</p>Yes."
        "<form><p>{M}</p><input></form><div role=complementary>{M}</div></article>",
        "<article><h1>Head</h1><p>{L}</p><!-- <p>{M}</p> --><p>Yes.</p><div style='display: none'>{M}</div><footer>{M}",
        "<div class=sidebar><ul><li><a href=1>{M}</a></li></ul></div><article><h1>Head</h1><p>{L}</p><p>Yes.</p></article>",
        "<div class='layout has_sidebar'><main><h1>Head</h1><p>{L}</p><p>Yes.</p></main><div id=newsletterBox>{M}</div></div>",
        "<div id=site-header><p>{M}</p></div><div class=entry-header><h1>Head</h1></div><p>{L}</p><p>Yes.</p><p>{L}</p>",
        "<nav><a href=/>x</a><div><article><h1>Head</h1><p>{L}</p><p>Yes.</p></article></div>",
    ],
)
def test_layouts(body):
    got = main_text(page(body.replace("{L}", LONG).replace("{M}", MORE)))
    got = got.split("\n")
    assert got[:3] == ["Head", LONG, "Yes."], got
    assert MORE not in got


def test_two_passes_without_a_marked_article():
    links = "".join(f"<li><a href=/{i}>Item number {i} of the list</a></li>" for i in range(9))
    body = (
        f"<table><tr><td><a href=/>Start</a></td></tr></table><ul>{links}</ul><p>Short before</p>"
        f"<h2>Heading</h2><p>{LONG}</p><p>Between.</p><p>{MORE}</p>"
        f"<p>{'buy now cheap price shop ' * 6}</p><p>After all</p><ul>{links}</ul>"
    )
    assert main_text(page(body)).split("\n") == ["Heading", LONG, "Between.", MORE]


def test_pages_with_little_to_go_by():
    links = "<ul><li><a href=/>Start here</a></li><li><a href=/x>More of it</a></li></ul>"
    short = f"<nav>{links}</nav>{links}<h1>Title</h1><p>Short one.</p><p>And two.</p><footer>Imprint of us</footer>"
    assert main_text(page(short)).split("\n") == ["Title", "Short one.", "And two."]
    polish = "Litwo! Ojczyzno moja! ty jesteś jak zdrowie; ile cię trzeba cenić, ten tylko się dowie, kto cię stracił."
    assert main_text(page(f"<div>{links}</div><h2>Tytuł</h2><p>{polish}</p><p>Tak.</p><p>{polish}</p>")).split("\n") == [
        "Tytuł", polish, "Tak.", polish]
    content = f"<div class=banner>Hello {MORE}</div><div id=content><h1>Title</h1><p>Short.</p><p>{LONG[:70]}</p><div class=share>Like us</div></div><p>{LONG[:60]}</p>"
    assert main_text(page(content)).split("\n") == ["Title", "Short.", LONG[:70]]


def test_references_white_space_and_inline_tags():
    body = "<article><p>a&nbsp;&lt;b&gt; &amp;amp; caf&eacute;&#33;\n\t x<b>y</b>z<br>w &am</p></article>"
    assert main_text(page(body)) == "a <b> &amp; café! xyz w &am"


def test_inline_adverts_go_and_links_stay():
    body = "<article><p>One <a class='related' href=x>two</a> <span class=ad>buy <span>now</span> cheap</span>three "
    assert main_text(page(body + "<em hidden>x</em>four.</p></article>")) == "One two three four."


def test_raw_elements_that_close_themselves():
    body = f"<article><p>{LONG}</p><svg class=\"i\"/><p>Yes.</p><iframe src='/a/b' /><p>{MORE}</p><svg><text>no</text></svg></article>"
    assert main_text(page(body)).split("\n") == [LONG, "Yes.", MORE]


@pytest.mark.parametrize(
    "opening",
    [
        "<article class='post category-legal tag-search'>",
        "<div class='post-content has-share'>",
        "<div id=related-work-section>",
        "<main class=search-page><article class='type-form'>",
        "<div class=layout-with-sidebar><section class='banner-large'>",
    ],
)
def test_a_word_does_not_overrule_what_holds_the_text(opening):
    body = f"<nav>{MORE}</nav>{opening}<h1>Head</h1><p>{LONG}</p><p class=legal-case>Yes.</p><p>{LONG}</p>"
    after = f"</section></article></main></div><div class=promo-box>{MORE}</div><article class=teaser><p>{MORE}</p></article>"
    got = main_text(page(body + after)).split("\n")
    assert got == ["Head", LONG, "Yes.", LONG]
    assert MORE not in main_text(page(body + f"<p class=copyright>{MORE}</p>" + after)) or "div" in opening


def test_lists_of_links_in_an_article_stay():
    items = "<ul><li><a href=/1>The first of the links</a></li><li>A plain one</li><li><a href=/2>The second</a></li></ul>"
    body = f"<ul><li><a href=/>Home</a></li></ul><article><p>{LONG}</p>{items}<p>{MORE}</p></article>{items}"
    assert main_text(page(body)).split("\n") == [LONG, "The first of the links", "A plain one", "The second", MORE]


@pytest.mark.parametrize("tags", ["<div>", "<div class=menu>", "<div></section>", "<main><header>", "<article><p>x", "<div>x</div><div>", "<p class=ad>x<div>"])
def test_deep_pages_take_linear_time(tags):
    start = time.process_time()
    main_text(tags * 100_000)
    main_text("<div class=menu>x" * 20_000 + "</div>" * 20_000)
    assert time.process_time() - start < 20


@pytest.mark.parametrize("text", [None, "", " ", "<", "<p", "<!--", "<script>x", "<a href='x", "</article>", "<p><p><p>"])
def test_odd_pages(text):
    assert isinstance(main_text(text), str)


def test_rows(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>", "old"), (None, None, None, None)] * 2
    rows.append((3, "u", "<article>" + f"<p>{LONG}</p>" * 20_000, "x"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string, TEXT string")
    out = extract_main_text(df)
    assert out.columns == ["page_id", "url", "html", "text", "n_chars"]
    got = sorted((r.page_id or 0, r.text[:20], r.n_chars) for r in out.collect())
    assert got == [(0, "", 0)] * 2 + [(1, LONG[:20], len(LONG))] * 2 + [(3, LONG[:20], 20_000 * (len(LONG) + 1) - 1)]
    assert extract_main_text(df.filter("false")).count() == 0


def test_query_equals_the_articles(spark):
    """The given pages mark their article; a plain reading of it is the reference."""
    from loanframe.llm.queries import op9_html_extraction

    def plain(text):
        m = re.search(r"<article>(.*?)(</article>|\Z)", text, re.S)
        parts = re.split(r"</?(?:p|h1)>", m[1]) if m else []
        parts = [" ".join(html.unescape(re.sub("</?b>", "", x.replace("<br>", " "))).split()) for x in parts]
        return "\n".join(x for x in parts if x)

    d = "/root/testdata/sf0.01"
    want = {r.page_id: plain(r.html) for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in op9_html_extraction(spark, d).collect()}
    assert got == {k: (t, len(t)) for k, t in want.items()}
