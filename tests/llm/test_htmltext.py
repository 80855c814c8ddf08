import html
import itertools
import re

import numpy as np
import pytest

from outflow.llm import htmltext as ht

PARAGRAPH = "Some words that go on for a while and say nothing at all, number {}."


def page(k):
    paragraphs = "".join(f"<p>{PARAGRAPH.format(i)} {k}</p>" if i % 3 else f"<p><b>{PARAGRAPH.format(i)} &amp; {k}<br>" for i in range(1 + k % 7))
    return f"<!DOCTYPE html><html><head><title>T</title><script>var t='</p>';</script></head><body><nav><ul><li><a href='/a'>Home</a></li></ul></nav><!-- x --><div class=\"ad\">Buy {k}</div><article><h1>Title {k}</h1>{paragraphs}</article><footer>&copy; me {k}</footer></body></html>"


@pytest.fixture(scope="module")
def model():
    return ht.fit_pages([page(k) for k in range(300)])


def expected(source):
    inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:h1|p)>", inner)]
    return "\n".join(x for x in blocks if x)


def test_articles(model):
    sources = [page(k) for k in range(300, 330)]
    assert ht.main_texts(sources, model) == [expected(x) for x in sources]


@pytest.mark.parametrize("opening", ["<main>", '<div id="content">', "<div>"])
def test_side_matter_goes(model, opening):
    close = "</main>" if opening == "<main>" else "</div>"
    source = (
        '<html><body><header><h1>Site</h1></header><div class="cookie-notice"><p>We use cookies, accept them all right now please.</p></div>'
        f'<div class="sidebar"><p>Side text that is long enough to look like content, really.</p></div>{opening}<h1>Title</h1><p>First &amp; <b>bold</b>  paragraph that is long enough.'
        '<p>Second one, with <a href=x>a link</a> inside it.<div class="ad"><p>Buy now something</p></div><p>Third one comes here.</p><form><p>Subscribe</p></form>'
        f'<section id="comments"><h3>Comments</h3><p>Reader says hello to everyone here.</p></section>{close}<footer>c</footer></body></html>'
    )
    assert ht.main_texts([source], model)[0] == "Title\nFirst & bold paragraph that is long enough.\nSecond one, with a link inside it.\nThird one comes here."


def test_nothing_returns_below_an_excluded_node(model):
    tree = ht.Page("<article><p>a</p><nav><article><p>b</p></article></nav></article>")
    score = np.array([2.0 if t in ("article", "p") else -9.0 for t in tree.tag])
    assert tree.text(tree.decode(score)) == "a"


@pytest.mark.parametrize(
    "source,want",
    [
        ("<body><article><p>Some real words that make the whole of this small article here.</p></article></body>", "Some real words that make the whole of this small article here."),
        ("Just words without any tag &amp; mark.", "Just words without any tag & mark."),
        ("<body><p>Only a paragraph.</p></body>", "Only a paragraph."),
        ("<html><head><title>t</title></head><body><article><h1>The Title Here</h1><p>First paragraph with a number of words in it.</p><p>Second one, that has some more.</p></article></body></html>", "The Title Here\nFirst paragraph with a number of words in it.\nSecond one, that has some more."),
        ("<body><article><h1>T words</h1><p>The main paragraph before a code block, quite long as main text goes.</p><pre>x = 1</pre><p>After it.</p></article></body>", "T words\nThe main paragraph before a code block, quite long as main text goes.\nx = 1\nAfter it."),
        ("<body><main><p>The main paragraph before a quotation, quite long as main text goes.</p><blockquote>Words of another.</blockquote></main></body>", "The main paragraph before a quotation, quite long as main text goes.\nWords of another."),
        ("<body><nav><ul><li><a href='/'>Home</a></ul></nav><footer>Copyright</footer></body>", ""),
        ("<body><article><p>Before it are words.</p><svg/><p>After the picture there are more words.</p><svg><text>no</text><p>And more after an open one.</p></article></body>", "Before it are words.\nAfter the picture there are more words.\nAnd more after an open one."),
        ("<body><nav>Home</nav><article><p>We know that <math><mi>a</mi>=<mi>b</mi></math> holds.</p><p>And so on it goes with words.</p></article><footer>c</footer></body>", "We know that a=b holds.\nAnd so on it goes with words."),
    ],
)
def test_pages_unlike_the_sample(model, source, want):
    assert ht.main_texts([source], model) == [want]


TEXT = "<p>The river rose slowly through the night and by morning the lower meadow was under water again.</p><p>Nobody in the village had seen it so high since the winter that the old bridge was carried away.</p>" * 2
NAV = '<nav><a href="/">Home</a> <a href="/a">About</a></nav>'
THREAD = '<section id="discussion"><h3>2 responses</h3><div class="comment"><p>Anna: what a lovely story.</p></div><div class="comment"><p>Ben: I remember that.</p></div></section>'


@pytest.mark.parametrize(
    "source",
    [
        f'<html><body class="has-sidebar with-header"><div class="post">{TEXT}</div></body></html>',
        f'<html><body class="search-enabled">{TEXT}</body></html>',
        f'<html><body class="home has-sidebar">{NAV}<article>{TEXT}</article></body></html>',
        f'<html class="no-banner"><body>{NAV}<main>{TEXT}</main></body></html>',
        f'<html><body><div id="page" class="site header-top">{NAV}<article>{TEXT}</article><footer>Copyright us</footer></div></body></html>',
        f'<html><body><div class="social-news story">{TEXT}</div></body></html>',
        f'<html><body><div class="layout sidebar-left"><article>{TEXT}</article></div><div class="comments">{THREAD * 4}</div></body></html>',
        f"<html><body><article>{TEXT}</article>{THREAD}</body></html>",
        f'<html><body><article>{TEXT}</article><div class="werbung"><p>Kaufen Sie jetzt ein neues Fahrrad zum halben Preis.</p></div></body></html>',
    ],
)
def test_layout_names_on_outer_elements_lose_nothing(model, source):
    assert ht.main_texts([source], model)[0] == "\n".join(re.findall("<p>(.*?)</p>", TEXT))


def test_text_marked_as_side_by_tokens_only_is_better_than_none(model):
    assert ht.main_texts([f'<html><body><div class="widget">{TEXT}</div></body></html>', f"<html><body>{NAV}</body></html>"], model) == ["\n".join(re.findall("<p>(.*?)</p>", TEXT)), ""]


def test_trees_equal_a_walk_through_them(model):
    pages = [ht.Page(page(k)) for k in range(5)]
    for tree_page, scores in zip(pages, model.score(pages), strict=True):
        for row, score in zip(tree_page.features(model.speaks), scores, strict=True):
            bins = [sum(edge < value for edge in edges) for edges, value in zip(model.trees.edges, row, strict=True)]
            total = 0.0
            for feature, cut, value in model.trees.trees:
                at = 1
                for _ in range(ht.DEPTH):
                    at = 2 * at + (1 if bins[feature[at]] > cut[at] else 0)
                total += value[at]
            assert abs(total - score) < 1e-9


def test_decoding_equals_trying_all():
    rng = np.random.default_rng(8)
    for _ in range(60):
        n = int(rng.integers(1, 8))
        tree = ht.Page("")
        tree.tag, tree.parent = ["x"] * n, [-1, *(int(rng.integers(0, k)) for k in range(1, n))]
        tree.blocks = [(int(rng.integers(0, n)), "w" * int(rng.integers(1, 40))) for _ in range(2 * n)]
        score = rng.normal(size=n) * 2
        own = [sum(len(t) for k, t in tree.blocks if k == i) for i in range(n)]
        below = own[:]
        for k in range(n - 1, 0, -1):
            below[tree.parent[k]] += below[k]
        best = None
        for states in itertools.product((0, 1, 2), repeat=n):  # before, in, after
            follows = {0: (0, 1), 1: (1, 2), 2: (2,)}
            if states[0] == 2 or any(states[k] not in follows[states[tree.parent[k]]] for k in range(1, n)):
                continue
            inside = sum(score[k] * (0.1 + np.log1p(own[k] if score[k] > 0 else below[k])) for k in range(n) if states[k] == 1)
            passed = sum(max(score[k], 0) * np.log1p(below[k]) for k in range(n) if states[k] == 0)
            best = max(best, inside - passed) if best is not None else inside - passed
        chosen = tree.decode(score)
        for k in range(1, n):  # one unbroken stretch on every path
            assert not (chosen[k] and not chosen[tree.parent[k]] and any(chosen[a] for a in _above(tree, k)))
        inside = sum(score[k] * (0.1 + np.log1p(own[k] if score[k] > 0 else below[k])) for k in range(n) if chosen[k])
        passed = sum(max(score[k], 0) * np.log1p(below[k]) for k in range(n) if not chosen[k] and not any(chosen[a] for a in _above(tree, k)))
        assert abs(inside - passed - best) < 1e-9


def _above(tree, k):
    while k:
        k = tree.parent[k]
        yield k


def test_many_closers_without_opener_are_cheap(model):
    import time

    began = time.time()
    ht.main_texts(["<div>" * 3000 + "</b></i></u>" * 30000 + "<p>x</p>"], model)
    assert time.time() - began < 20


def test_odd_rows(spark, model):
    broken = page(3)[: page(3).index("<article>") + 60] + "&am"
    rows = [(1, "u", None, "x"), (None, None, "", "x"), (2, "u", "<p", "x"), (2, "u", "<div>" * 3000 + "x", "x"), (3, "u", broken, "x"), (4, "u", "<b><i></p></div>&#0;&bogus; a<b", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = ht.extract(pages, model).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got][:3] == ["", "", ""] and got[4]["text"].startswith("Title 3\n")
    assert ht.extract(pages.limit(0), ht.train(pages.limit(0))).count() == 0
