"""Operator 9: what is cut, held-out pages, and the cut itself against all labelings."""

import html
import itertools
import re

import numpy as np

from tracelake.llm import main_text, registry

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>My Site</h1><p>Best news, every day.</p></header>
<div id=menu><a href=x>Home</a> <a href=y>News</a></div><div class="post"><h2>A &amp; B</h2>
<p>First paragraph, which is long enough, has marks; and says a lot about the matter at hand.
<p>Second <b>one</b>&nbsp;is   here, and it also goes on for a while, as paragraphs do.<p>Short.<div class="ad">Buy this now.</div>
<ul><li>one point<li>another point</ul></div><aside><p>Other stories, and many other things that you may like.</p></aside>
<section class="comments"><p>I think this is a great article, thanks for it, really!</p></section>
<form>Name <input> <p>Sign up.</p></form><script>x="<p>a</p>"</script><div class="cookie-notice">We use cookies, as you know.</div><footer>&copy; 2024</footer>"""


def test_parts():
    assert main_text.content(main_text.blocks_of(PAGE), main_text.WEIGHTS).split("\n") == [
        "A & B", "First paragraph, which is long enough, has marks; and says a lot about the matter at hand.",
        "Second one is here, and it also goes on for a while, as paragraphs do.", "Short.", "one point", "another point"]


def test_pages_against_their_article_element(spark, sf):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in registry.queries()["op9_main_text"](spark, sf).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(filter(None, parts)) and r.n_chars == len(r.text)


def test_minimum_cut():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n = int(rng.integers(1, 8))
        source, sink = rng.integers(0, 20, n).tolist(), rng.integers(0, 20, n).tolist()
        ties = [(int(a), int(b), int(c)) for a, b, c in zip(rng.integers(0, n, 8), rng.integers(0, n, 8), rng.integers(0, 10, 8)) if a != b]
        cost = lambda side: sum(t if s else f for s, f, t in zip(side, source, sink)) + sum(c for a, b, c in ties if side[a] != side[b])
        assert cost(main_text.minimum_cut(source, sink, ties)) == min(cost(s) for s in itertools.product((False, True), repeat=n))


def test_fit_tells_texts_from_links():
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(3, 1, 400), np.repeat([0.0, 1.0], 200), rng.random(400), rng.random(400), rng.random(400), np.ones(400)])
    y = np.repeat([1.0, 0.0], 200)
    w = main_text.fit(x, y)
    assert ((x @ w > 0) == (y == 1)).mean() > 0.98


def texts(page):
    return [b[2] for b in main_text.blocks_of(page)]


def test_omitted_end_tags():
    for head in ("<head><title>T</title><body>", "<head><title>T</title>", "<head><meta charset=utf-8><noscript><link><body>", "<head><style>p{}</style></head><body>"):
        assert texts(f"<html>{head}<p>One.<p>Two <b>three</b>.</html>") == ["One.", "Two three."]
    assert texts("<html><head><title>T</title>Bare text<p>One.") == ["Bare text", "One."]
    for tag in ("button", "select", "svg", "noscript", "video"):
        assert texts(f"<article><p>One.</p><{tag}>hid<p>Two.</p><p>Three.</p></article><p>Four.") == ["One.", "Two.", "Three.", "Four."]
        assert texts(f"<article><p>One <{tag}>hid</{tag}> two.</p><{tag}><div>hid</div>hid</{tag}><p>Three.") == ["One two.", "Three."]
    assert texts("<div><button>A<p>One.</p><button><div>B</div></button><p>Two.</p></div>") == ["One.", "Two."]


def test_names_do_not_decide_alone():
    long = "This paragraph is long enough, has marks; and says a lot about the matter at hand, which goes on for quite a while, as paragraphs do. " * 3
    body = f"<h1>Head</h1><p>{long}</p><p>{long}</p><p>Short.</p>" + f"<p>{long}</p>" * 4
    links = "<div class=promo>" + "".join(f"<p><a href=x>link {i}</a></p>" for i in range(5)) + "</div>"
    whole = main_text.content(main_text.blocks_of(body), main_text.WEIGHTS)
    assert whole.count("\n") == 7
    for open_, close in (('<div class="layout with-sidebar">', "</div>"), ('<div id="content" class="no-sidebar">', "</div>"), ('<article class="legal-news">', "</article>"),
                         ('<div class="sidebar"><main>', "</main></div>"), ("<form><article>", "</article></form>")):
        assert main_text.content(main_text.blocks_of(links + open_ + body + close), main_text.WEIGHTS) == whole
    against = main_text.content(main_text.blocks_of(links + f'<div class="banner">{f"<p>{long}</p>" * 6}</div>'), main_text.WEIGHTS)
    assert against.count(long.strip()) == 6 and "link" not in against
    assert main_text.content(main_text.blocks_of(f"<div hidden><article>{body}</article></div>"), main_text.WEIGHTS) == ""
    names = {"sidebar": -1, "site-footer": -1, "cookie-notice": -1, "comment-body": -1, "related-posts": -1, "post-content": 1, "content-wrapper": 1, "with-sidebar": 0, "legal-news": 0}
    assert {n: main_text.named(n) for n in names} == names
