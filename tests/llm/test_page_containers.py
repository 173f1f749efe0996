"""Containers of pages that mislead, and a second, plain reader of the tables' pages."""

import re
from html.parser import HTMLParser

import pytest

from conftest import SMALL
from vitrine.llm.html_blocks import blocks, extract, main_text, trained

LONG = " ".join(f"word{i} of the story" for i in range(20)) + "."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<article><p><a href=x>Linked line</a></p><p>{LONG}</p></article>", f"Linked line\n\n{LONG}"),
        (f"<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{LONG}</p></article>", f"Title\n\n{LONG}"),
        (f"<div id='content'><header>Home shop</header><p>{LONG}</p></div>", LONG),
        (f"<article><header><h1>Title</h1></header><p>{LONG}</p></article>", f"Title\n\n{LONG}"),
        (f"<div class='widget'><article><p>{LONG}</p></article></div>", LONG),
        (f"<div class='related-posts'><article><p>{LONG}</p></article></div><p>{LONG}</p>", LONG),
        (f"<section id=comments><article><p>{LONG}</p></article></section>", ""),
        (f"<div>{f'<h2>About it</h2><p>{LONG}</p>' * 2}<h3>More</h3><ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul></div>", "\n\n".join(["About it", LONG] * 2)),
    ],
)
def test_container_and_heading(page, want):
    assert main_text(page, trained()) == want


def test_links_around_blocks_count_as_linked():
    texts, features = blocks("<a href=x><div>all of this</div><div>and this</div></a><div>not this</div>")
    assert texts == ["all of this", "and this", "not this"] and features[:, 1].tolist() == [1.0, 1.0, 0.0]
    texts, features = blocks("<ul><li><a href=x>never closed</ul><p>free again</p>")
    assert features[:, 1].tolist() == [1.0, 0.0]


class Plain(HTMLParser):
    """All visible text that lies in an article or main element and in no furniture, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.texts, self.now = [], [], ""

    def cut(self):
        text = " ".join(self.now.split())
        inside = [t for t, _ in self.stack]
        bad = any(named for _, named in self.stack) or {"nav", "footer", "aside", "form", "script", "style", "noscript", "head"} & set(inside)
        if text and not bad and {"article", "main"} & set(inside):
            self.texts.append(text)
        self.now = ""

    def handle_starttag(self, tag, attributes):
        if tag in ("br", "img", "meta", "link", "input", "hr", "wbr"):
            self.now += " " if tag == "br" else ""
            return
        inline = tag in ("a", "b", "i", "em", "strong", "span", "u", "code", "small")
        if not inline:
            self.cut()
        if tag in ("p", "li") and self.stack and self.stack[-1][0] == tag:
            self.stack.pop()
        names = " ".join(v or "" for k, v in attributes if k in ("class", "id"))
        self.stack.append((tag, bool(re.search(r"comment|share|related|advert|newsletter|cookie|sidebar|promo|\bad\b", names)) and not inline))

    def handle_endtag(self, tag):
        if tag not in ("a", "b", "i", "em", "strong", "span", "u", "code", "small"):
            self.cut()
        if tag in [t for t, _ in self.stack]:
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not self.stack or self.stack[-1][0] not in ("script", "style"):
            self.now += data


def test_pages_with_an_article_tag_equal_a_plain_reader(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    found = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    compared = 0
    for page_id, html in pages.select("page_id", "html").collect():
        if not html or not re.search("<article[ >]|<main[ >]", html):
            continue
        reader = Plain()
        reader.feed(html)
        reader.close()
        reader.cut()
        assert found[page_id] == "\n\n".join(reader.texts), page_id
        compared += 1
    assert compared


def test_repeated_pages_are_pages_of_their_own(spark):
    pages = spark.createDataFrame([(1, "u", f"<p>{LONG}</p>", "t")] * 3, "page_id long, url string, html string, text string")
    assert [(r["page_id"], r["text"]) for r in extract(pages).collect()] == [(1, LONG)] * 3
