"""Pages that are long, cut anywhere, or written carelessly; comments of readers."""

import time

import pytest

from kinfold.llm.pages import read_page

MANY = 200_000


@pytest.mark.parametrize(
    "source",
    [
        "<article>" + "<a " * MANY,
        "<article>" + '<a "' * MANY,
        "<article>" + '<a ">" ' * MANY,
        "<div>" * MANY + "</section>" * MANY,
        "<svg>" + "<title>" * MANY,
        "<script>" * MANY,
        "<!--" * MANY,
        "<!" * MANY,
        "<article>" + "</p>" * MANY,
        "<" * MANY,
    ],
    ids=lambda s: s[:12],
)
def test_time_grows_with_the_length(source):
    start = time.process_time()
    read_page(source)
    assert time.process_time() - start < 6


def test_a_page_cut_anywhere_gives_a_beginning():
    source = '<body><nav class="x">menu</nav><article id="a"><h1>Title</h1><p class=\'q\'>One &amp; two</p><!-- no --><p>Three</p></article></body>'
    whole = read_page(source).article
    assert whole == ["Title", "One & two", "Three"]
    for end in range(len(source)):
        got = [x for x in (t.rstrip("</ ") for t in read_page(source[:end]).article) if x]  # a lone < is text
        assert got[:-1] == whole[: max(len(got) - 1, 0)]
        assert not got or whole[len(got) - 1].startswith(got[-1].split("&")[0].rstrip())


def test_careless_markup():
    assert read_page('<article><p class="x>hello</p><p>world</p></article>').article == ["hello", "world"]
    assert read_page('<article><p title="a > b">x</p></article>').article == ["x"]
    assert read_page("<article><p>1 < 2 and 3 > 2, a<b</p></article>").article[0].startswith("1 < 2 and 3 > 2, a")


def test_comments_of_readers_are_not_the_article():
    for page in (
        '<article><p>Text</p><article class="comment"><p>mine</p></article></article>',
        '<main><article><p>Text</p></article></main><article class="reply"><p>mine</p></article>',
        '<article class="comment"><p>mine</p></article><article><p>Text</p></article>',
        '<main><p>Text</p><article class="related teaser"><h2>Another</h2></article></main>',
        '<article><p>Text</p><section id="comments"><article><p>mine</p></article></section></article>',
    ):
        assert read_page(page).article == ["Text"]
    # A part of the text that is an article of its own stays.
    assert read_page('<main><article class="post"><p>One</p></article><article><p>Two</p></article></main>').article == ["One", "Two"]
