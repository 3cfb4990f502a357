"""Pages whose main text is known because they were put together here: with and without article, with several articles, with comments
of any length, sidebars, notices and menus around them."""

import random

import pytest

from courtside.llm.html_extract import main_text

WORDS = "the of a story that went on with people who saw it happen near old town river while nobody knew why".split()


def sentence(draw, least, most):
    return " ".join(draw.choice(WORDS) for _ in range(draw.randint(least, most))).capitalize() + "."


def paragraphs(draw, count):
    return [" ".join(sentence(draw, 8, 16) for _ in range(draw.randint(2, 4))) for _ in range(count)]


def marked(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def comments(draw, count, kind):
    each = [f"<div class='comment-body'><p>{sentence(draw, 6, 14)}</p><p>{sentence(draw, 8, 20)}</p></div>" for _ in range(count)]
    if kind == "list":
        return "<ol class='comment-list'>" + "".join(f"<li>{x}</li>" for x in each) + "</ol>"
    if kind == "articles":
        return "<section id='comments'>" + "".join(f"<article class='comment'>{x}</article>" for x in each) + "</section>"
    return f"<div id='{kind}'>" + "".join(each) + "</div>"


MENU = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
ASIDE = "<div class='sidebar'><h3>More</h3><ul><li><a href='/x'>One story</a></li><li><a href='/y'>Other story</a></li></ul></div>"
NOTICE = "<div class='cookie-notice'><p>We use cookies.</p><button>Fine</button></div>"
FOOTER = "<footer><p>Imprint and contact of this page</p></footer>"


@pytest.mark.parametrize("kind", ["comments", "disqus_thread", "reader-comments", "list", "articles"])
@pytest.mark.parametrize("frame", ["div", "section", "article", "main", "inside", "wrap"])
@pytest.mark.parametrize("seed", range(4))
def test_comments_never_count(kind, frame, seed):
    """However much readers wrote, and wherever it stands."""
    draw = random.Random(f"{kind}{frame}{seed}")
    texts = paragraphs(draw, draw.randint(2, 6))
    below = comments(draw, draw.choice([1, 4, 20, 60]), kind)
    page = {
        "div": f"<div id='content'>{marked(texts)}</div>{below}", "section": f"<section>{marked(texts)}</section><div>{below}</div>",
        "article": f"<article>{marked(texts)}</article>{below}", "main": f"<main>{marked(texts)}</main>{below}",
        "inside": f"<article>{marked(texts)}{below}</article>",
        "wrap": f"<div class='content-sidebar-wrap'><div class='entry'>{marked(texts)}</div>{below}</div>"}[frame]
    assert main_text(f"<html><body>{MENU}{page}{ASIDE}{NOTICE}{FOOTER}</body></html>") == "\n".join(texts)


def test_verdict_pages():
    """Three paragraphs against six comments, and two against nine."""
    draw = random.Random(1)
    for n, m in ((3, 6), (2, 9)):
        texts = paragraphs(draw, n)
        assert main_text(f"<body><div id=content>{marked(texts)}</div>{comments(draw, m, 'comments')}</body>") == "\n".join(texts)


@pytest.mark.parametrize("seed", range(6))
def test_several_articles(seed):
    draw = random.Random(seed)
    parts = [paragraphs(draw, 4) for _ in range(3)]
    page = "".join(f"<article>{marked(p)}</article>" for p in parts)
    assert main_text(f"<body>{MENU}<div>{page}</div>{ASIDE}{FOOTER}</body>") == "\n".join(t for p in parts for t in p)


@pytest.mark.parametrize("name", ["widget-text", "side-note", "related", "promo"])
def test_dense_blocks_of_an_article_stay(name):
    """A paragraph as dense as its siblings belongs to the article whatever its block is called; thin boxes do not."""
    draw = random.Random(3)
    texts = paragraphs(draw, 5)
    inside = marked(texts[:2]) + f"<div class='{name}'>{marked(texts[2:3])}</div>" + marked(texts[3:])
    thin = "<div class='share'><a href='/f'>Post</a> <a href='/t'>Send</a></div><div class='newsletter'><p>Join us</p></div>"
    assert main_text(f"<body><article>{inside}{thin}</article></body>") == "\n".join(texts)


def test_names_that_are_no_comments():
    texts = paragraphs(random.Random(4), 3)
    for name in ("post comments-open", "entry no-comments", "has-comments"):
        assert main_text(f"<body><div class='{name}'>{marked(texts)}</div><div>A tagline of the page</div></body>") == "\n".join(texts)
    # a page of nothing but comments has no other text to prefer
    assert main_text(f"<body><div id='comments'>{marked(texts)}</div></body>") == "\n".join(texts)
    assert main_text(f"<body><pre class='comment'>{texts[0]}</pre></body>") == texts[0]
