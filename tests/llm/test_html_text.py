"""Main text extraction: pages whose markup misleads, densities against plain recursion, deep nesting."""

import math
import random
import time

import pytest

pytest.importorskip("shelfscope.llm")

from shelfscope.llm import html_text  # noqa: E402

LONG = [f"A long paragraph of the story, which goes on for quite some time before it ends with the number {x}." for x in ("one", "two", "three", "four", "five")]
BODY = "".join(f"<p>{x}</p>" for x in LONG)
NAV = '<nav><a href="/a">Home</a><a href="/b">News</a></nav>'
FOOT = "<footer><p>All rights reserved by the people of the site.</p></footer>"


@pytest.mark.parametrize("tag", ["article", "div"])
@pytest.mark.parametrize("wrapper", ['form id="aspnetForm"', 'dialog open', 'div role="dialog"', 'form role="form" class="main"'])
def test_wrappers_of_the_page_are_no_forms(wrapper, tag):
    name = wrapper.split()[0]
    page = f"<body><{wrapper}>{NAV}<input value=x><{tag}><h1>The title</h1>{BODY}</{tag}>{FOOT}</{name}></body>"
    assert html_text.extract(page) == "\n".join(["The title"] + LONG)


@pytest.mark.parametrize("form", [
    "<form><p>Sign up for our letter, it is free.</p><input><button>Go</button></form>", "<aside><p>More from the author of the story.</p></aside>",
    '<div class="related-posts"><p>You may also like the other story.</p></div>', '<div class="social-share"><a href=x>Share it</a></div>',
    '<div id="comments"><p>First! What a very long comment this is, and it never ends, does it?</p></div>', '<div class="ad-slot-3"><p>Buy this thing now.</p></div>',
    '<div class="share"><a href=x>Share</a></div>', '<div class="promo-box"><p>Now for less.</p></div>', '<div class="share-price"><a href=x>Quotes</a></div>',
])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_furniture_inside_the_article_goes(form, tag):
    page = f"<body>{NAV}<{tag}><h1>The title</h1>{BODY}{form}</{tag}>{FOOT}</body>"
    assert html_text.extract(page) == "\n".join(["The title"] + LONG)


@pytest.mark.parametrize("block", [
    "<section id=related-work><p>{}</p></section>", "<p class=share-price>{}</p>", "<section class=social-policy><p>{}</p></section>",
    "<p class=menu-planning>{}</p>", "<div class=notice-period><p>{}</p></div>", "<p><math><mi>{}</mi></math></p>",
])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_words_of_a_name_do_not_cut_prose(block, tag):
    more = "Other work has looked at this before and found the very same thing in many places."
    page = f"<body>{NAV}<{tag}><h1>The title</h1>{BODY}{block.format(more)}</{tag}>{FOOT}</body>"
    assert html_text.extract(page) == "\n".join(["The title"] + LONG + [more])


@pytest.mark.parametrize("header", ["div class=header", "header", "div id=head"])
def test_headline_in_a_header_of_the_article_stays(header):
    name = header.split()[0]
    page = f"<body><header><h1>The Site</h1>{NAV}</header><div class=post><{header}><h1>The title</h1></{name}>{BODY}</div>{FOOT}</body>"
    assert html_text.extract(page) == "\n".join(["The title"] + LONG)


def _plain(tree):
    """Densities and sums by recursion over the kept nodes."""
    n = len(tree.tag)
    kids = {i: [j for j in range(1, n) if tree.parent[j] == i and not tree.cut[j]] for i in range(n)}

    def below(i):
        return [k for j in kids[i] for k in [j, *below(j)]]

    def linked(i):
        return i > 0 and (tree.tag[i] == "a" or linked(tree.parent[i]))

    def size(t):
        return len("".join(t.split()))

    def chars(i, links=False):
        own = {i, *below(i)}
        return sum(size(t) for j, t in tree.texts if j in own and not tree.cut[j] and (not links or linked(j)))

    share = chars(0, True) / chars(0) if chars(0) else 0

    def density(i):
        c, lc, t, lt = chars(i), chars(i, True), max(len(below(i)), 1), max(sum(tree.tag[j] == "a" for j in below(i)), 1)
        if not c:
            return 0.0
        base = math.log(c * lc / max(c - lc, 1) + share * c + math.e)
        ratio = c * t / (max(lc, 1) * lt)
        return c / t * (0.0 if ratio <= 1 else math.log(ratio) / math.log(base) if base > 1 else 1.0)

    each = [0.0 if tree.cut[i] else density(i) for i in range(n)]
    return each, [0.0 if tree.cut[i] else sum(each[j] for j in kids[i]) for i in range(n)]


def test_densities_against_recursion():
    rng = random.Random(4)
    for _ in range(60):
        parts, open_ = [], []
        for _ in range(rng.randrange(2, 60)):
            k = rng.random()
            if k < 0.4:
                open_.append(rng.choice(["div", "p", "a", "ul", "li", "span", "section", "table", "td", "script", "h2"]))
                parts.append(f"<{open_[-1]}>")
            elif k < 0.6 and open_:
                parts.append(f"</{open_.pop(rng.randrange(len(open_)))}>")
            else:
                parts.append("word " * rng.randrange(1, 30))
        tree = html_text._Tree()
        tree.feed("".join(parts))
        tree.close()
        density, total, _, _ = html_text.densities(tree)
        want, sums = _plain(tree)
        assert density == pytest.approx(want) and total == pytest.approx(sums)


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "<p>deep text</p>" + "</div>" * 100_000, "<p>deep text" + "<table>" + "<div>" * 60_000 + "</section>" * 60_000,
    "<b>deep text<div>" + "<span>" * 60_000 + "</b>" * 60_000, "<ul><li>deep text" + "<div><li>" * 50_000,
])
def test_time_grows_with_tags_not_with_depth(page):
    start = time.time()
    assert html_text.extract(page) == "deep text"
    assert time.time() - start < 20
