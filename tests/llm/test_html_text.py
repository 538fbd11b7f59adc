"""Main text of pages: shapes of markup, and every given page against an extractor written apart."""

import time
from html.parser import HTMLParser

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from namewright.llm import html_text

LONG = "The plan was made by the people of the town and it is now in the hands of those who live there."
ARTICLE = "<html><body><nav><a href=/>Home</a></nav><article>{}</article><footer>us</footer></body></html>"


@pytest.mark.parametrize(
    ("inner", "want"),
    [
        ("<p>text <button>Subscribe now</button> tail</p>", ["text tail"]),
        ("<p>text <span class='ad'>Buy this now</span>tail</p>", ["text tail"]),
        ("<p>before <label>Your mail</label> after</p>", ["before after"]),
        ("<p>a <svg><g><text>axis</text></g></svg> b</p>", ["a b"]),
        ("<p>pick <select><option>one<option>two</select> of them</p>", ["pick of them"]),
        ("<p>in <button><div>deep</div></button> one block</p>", ["in one block"]),
        ("<p>first <span class=ad>lost</p><p>second</p>", ["first", "second"]),
        ("<p>first <span class=ad>lost<p>second<h2>third</h2>", ["first", "second", "third"]),
        ("<h1><a href=/x>A linked heading</a></h1><p>text</p>", ["A linked heading", "text"]),
        ("<p>text</p><ol><li><a href=/1>One source</a><li><a href=/2>Another</a></ol>", ["text", "One source", "Another"]),
        ("<p class='search-history'>kept</p><p class='ad-container'>gone</p><div id=ad-12>gone</div>", ["kept"]),
        ("<p>one</p><div class='comment-list'><p>said " + LONG + "</p></div><p>two</p>", ["one", "two"]),
        ("<header><h1>Title</h1></header><p>1 < 2 &amp; <!-- > --> 3 &lt; 4</p>", ["Title", "1 < 2 & 3 < 4"]),
        ("<p>a<span class=share><p>not shown</p></span></p>", ["a", "not shown"]),
        ("<p>x <math><mi>y</mi></math></p>", ["x y"]),
    ],
)
def test_shapes(inner, want):
    assert html_text.main_text(ARTICLE.format(inner)).split("\n\n") == want


def test_outside_of_articles():
    page = f"<h1>Head</h1><p>{LONG}</p><ul><li><a href=/a>A list of links to other pages of this site</a></ul><p>{LONG}</p>"
    assert html_text.main_text(page).split("\n\n") == ["Head", LONG, LONG]


@pytest.mark.parametrize(
    "page", ["<a " * 350_000, '<a "\' >' * 150_000, "<p class=ad><span class=ad>" * 40_000, "<b " * 300_000 + ">", "<!-- " * 200_000]
)
def test_broken_pages_take_linear_time(page):
    begin = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - begin < 5


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<span class=ad>", "</span>", "<button>", "</button>", "<div>", "</div>", "a ",
                                 "<article>", "</article>", "<h2>", "</h2>", "<br>", "<", ">", "<!--", "-->", "&lt;", '"'])))
def test_any_order_of_tags(parts):
    for block in html_text.blocks("".join(parts)):
        assert block.text == block.text.strip() and 0 <= block.link_chars <= len(block.text)


class ArticleText(HTMLParser):
    """Blocks inside of article elements, as the standard library's parser meets them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.words, self.inside = [], [], 0

    def cut(self):
        text = " ".join("".join(self.words).split())
        if text and self.inside:
            self.found.append(text)
        self.words = []

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "h1", "article", "footer", "div", "nav", "ul", "li"):
            self.cut()
        self.inside += tag == "article"
        if tag == "br":
            self.words.append(" ")

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.cut()
        self.inside -= tag == "article"

    def handle_data(self, data):
        self.words.append(data)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_every_page_by_another_parser(folder):
    rows = duckdb.sql(f"select html from '/root/testdata/{folder}/pages.parquet'").fetchall()
    assert rows
    for (page,) in rows:
        parser = ArticleText()
        parser.feed(page or "")
        parser.close()
        parser.cut()
        assert html_text.main_text(page or "") == "\n\n".join(parser.found)
