import html
import random
import re

import pytest

from crossmap.llm import html_text, queries
from tests.llm import data

ARTICLE = "<p>First paragraph of the story, with <b>bold</b> words; it goes on.</p><p>Yes.</p><p>Another long paragraph, which says more, and more.</p>"


@pytest.mark.parametrize("around", [
    "<nav><ul><li><a href='/a'>Home</a></li></ul></nav><article>{}</article><footer>&copy; 2020</footer>",
    "<header><h2>Site name</h2></header><div id='content'>{}</div><div class='sidebar'><p>Related, things; to read.</p></div>",
    "<main>{}</main><section id=comments><p>Great post, I agree, really, with all.</p></section>",
    "<aside>Notice, please, read.</aside><article>{}</article><form><p>Sign up, now, here.</p><input name=x></form>",
    "<div class='cookie-notice'><p>We use cookies, as others do, here.</p></div><div class=main><div>{}</div></div><script>var a='<p>x</p>';</script>",
    "<article>{}<div class='ad'><p>Buy this, now, it is good.</p></div><div class='comment-list'><p>First, indeed, yes.</p></div></article>",
])
def test_only_the_article_is_left(around):
    page = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>" + around.format(ARTICLE) + "</body></html>"
    assert html_text.main_text(page) == "First paragraph of the story, with bold words; it goes on. Yes. Another long paragraph, which says more, and more."


LONG = "".join(f"<p>Paragraph {i} of the long body, which goes on, and on; it says more.</p>" for i in range(30))
LAST = "<p>The last paragraph, which closes the story, and ends it.</p>"


@pytest.mark.parametrize("page", [
    "<div><div>{}</div><div>{}</div></div>",
    "<div><div>{}</div><div><div>{}</div></div></div>",
    "<section>{}</section><section>{}</section>",
    "<table><tr><td>{}</td><td>{}</td></tr></table>",
    "<main><article>{}</article><section>{}</section></main>",
    "<main>{}</main><div>{}</div>",
    "<article>{}</article><article>{}</article>",
    "<article>{}</article><article><header>{}</header></article>",
])
@pytest.mark.parametrize("first, second", [(LONG, LAST), (LAST, LONG)])
def test_short_parts_beside_the_container_stay(page, first, second):
    wanted = " ".join(re.sub("<[^>]*>", " ", first + second).split())
    assert html_text.main_text("<html><body>" + page.format(first, second) + "</body></html>") == wanted


def test_references_white_space_and_cut_pages():
    assert html_text.main_text("<article><h1>A &amp; B</h1><p>One\n  two&nbsp;&eacute;, and three.<p>Four <br> five") == "A & B One two é, and three. Four five"
    assert html_text.main_text("<article><p>a &lt;b&gt; c, d.</p><!-- not this --></article") == "a <b> c, d."


@pytest.mark.parametrize("source", [None, "", "   ", "<html></html>", "<script>only code", "<nav><a href=x>y</a></nav>"])
def test_no_content(source):
    assert html_text.main_text(source) == ""


def test_long_pages_are_read_whole():
    text = " ".join(f"Sentence {i}, as it is." for i in range(30_000))
    assert html_text.main_text(f"<article><p>{text}</p></article>") == text
    assert html_text.main_text("<article>" + "<p>a, b.</p>" * 20_000 + "</article>") == " ".join(["a, b."] * 20_000)


def test_rows(spark):
    source = spark.createDataFrame([(1, "u", "<article><p>x, y.</p></article>", "k"), (1, "u", "<article><p>x, y.</p></article>", "k"), (None, None, None, "k")], "page_id bigint, url string, html string, text string")
    assert data.rows(html_text.extract_text(source)) == [(1, "u", "x, y."), (1, "u", "x, y."), (None, None, "")]
    assert html_text.extract_text(source.limit(0)).collect() == []


def test_registered(spark):
    found = {r.page_id: r for r in queries.REGISTERED["op1_html_text"](spark, data.SMALL).collect()}
    pages = data.columns("pages", "page_id", "html")
    assert len(found) == len(pages)
    for page_id, source in pages:
        article = source.split("<article>")[1].split("</article>")[0].replace("<b>", "").replace("</b>", "")
        wanted = " ".join(html.unescape(re.sub(r"</?(?:p|h1|br)>", " ", article)).split())
        assert (found[page_id].text, found[page_id].n_chars) == (wanted, len(wanted))


STORY = "".join(f"<p>Paragraph {i} of the story, which goes on for a while, and says what it has to say.</p>" for i in range(8))
TOLD = " ".join(re.sub("<[^>]*>", " ", STORY).split())


@pytest.mark.parametrize("page", [
    '<div class="content-sidebar-wrap"><article>{}</article></div>',
    '<div class="layout has-sidebar"><article>{}</article></div>',
    '<form id="aspnetForm"><div><article>{}</article></div></form>',
    "<form><main>{}</main></form>",
    "<form><div>{}</div></form>",
    '<div class="page logged-in login-enabled">{}</div>',
    '<div class="page logged-in login-enabled"><div>{}</div></div>',
    '<form><div class="has-sidebar"><div id="menu-open">{}</div></div></form>',
    '<article>{}</article><div class="widget"><article class="teaser"><p>Another story, shortly told, elsewhere.</p></article></div>',
    '<div id="search-page"><article>{}</article><div id="comments"><p>I agree, with all of it, really.</p></div></div>',
])
def test_parts_that_hold_the_story_are_kept_whatever_their_names(page):
    assert html_text.main_text("<html><body>" + page.replace("{}", STORY) + "</body></html>") == TOLD


@pytest.mark.parametrize("part", ['<section id="related-work">{}</section>', '<div id="social-policy">{}</div>', '<h2 id="menu-items">{}</h2>', '<p id="login">{}</p>'])
@pytest.mark.parametrize("container", ["<article>{}</article>", "<main>{}</main>"])
def test_identifiers_inside_an_article_say_nothing(container, part):
    inner = "Earlier work, by others, is told of here."
    assert html_text.main_text(container.format(STORY + part.format(inner) + STORY)) == f"{TOLD} {inner} {TOLD}"


def test_running_text_under_a_compound_identifier_stays():
    inner = "Earlier work, by others, is told of here. " * 8
    page = f'<div>{STORY}<section id="related-work"><p>{inner}</p></section></div>'
    assert html_text.main_text(page) == f"{TOLD} {inner.strip()}"
    linked = "<ul>" + "".join(f"<li><a href=/{i}>Story number {i}, of the week.</a></li>" for i in range(12)) + "</ul>"
    assert html_text.main_text(f'<div>{STORY}<section id="related-stories">{linked}</section></div>') == TOLD


def test_elements_inside_words_do_not_cut_them():
    page = "<article><p>super<wbr>cali<nobr>fragil</nobr>istic, a <b>b</b>, c<x-mark>d</x-mark>e; <img src=x>and so on.</p></article>"
    assert html_text.main_text(page) == "supercalifragilistic, a b, cde; and so on."


def test_comments_do_not_become_the_story():
    comments = "".join(f'<div class="comment"><p>Comment {i}, which is long, and says a lot, about everything that was told.</p></div>' for i in range(40))
    assert html_text.main_text(f"<div><h1>Title</h1>{STORY}</div><div class='comments'>{comments}</div>") == f"Title {TOLD}"
    assert html_text.main_text(f"<div class='wrap sidebar-left'><article>{STORY}</article><ol class='comment-list'>{comments}</ol></div>") == TOLD


@pytest.mark.parametrize("seed", range(40))
def test_made_up_pages(seed):
    """Pages of known content: the story inside random wrappers, with parts beside it that do not belong to it."""
    source = random.Random(seed)
    wrappers = ['<div>{}</div>', '<form action="/x">{}</form>', '<div class="layout has-sidebar">{}</div>', '<div id="page-with-menu">{}</div>', '<section class="l-content">{}</section>',
                '<table><tr><td>{}</td></tr></table>', '<div class="logged-in">{}</div>', '<center>{}</center>', '<div role="search-results">{}</div>']
    beside = ['<nav><ul><li><a href="/a">Home, sweet home.</a></li></ul></nav>', '<div class="cookie-banner"><p>We use cookies, as others do, to see who reads.</p></div>',
              '<aside><p>Other things, to read, are here.</p></aside>', '<div class="sidebar"><p>Latest, and greatest, of all.</p></div>', '<footer><p>All rights, reserved, by us.</p></footer>',
              '<div id="comments"><p>Great post, I agree, with all of it.</p></div>', '<script>var a = "<p>x, y, z.</p>";</script>', '<div class="ad"><p>Buy this, now, it is cheap.</p></div>']
    parts = source.sample(beside, source.randrange(len(beside)))
    around = source.choice(["{}", "<article>{}</article>", "<main>{}</main>", "<div>{}</div>"])
    at = source.randrange(len(parts) + 1)
    page = "".join([*parts[:at], around.replace("{}", STORY), *parts[at:]])
    for _ in range(source.randrange(4)):
        page = source.choice(wrappers).replace("{}", page)
    assert html_text.main_text(f"<html><head><title>T</title></head><body>{page}</body></html>") == TOLD
