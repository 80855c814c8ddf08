"""Main text of web pages by boosted trees over DOM nodes (operator 10).

Each block element is a node with features of its tag, attribute tokens, depth,
subtree density and siblings.  Tokens of class, id, role and itemprop are hashed;
what each bucket says for content is learnt from the sample.  Gradient-boosted
trees, fitted here in numpy on a bounded sample of pages whose own markup tells
content from the rest, score every node.  The sample also holds each page with
side matter grafted in, with its content's mark renamed or taken away, and with
nothing but a part of its content, so that density and position count too and
pages without any side matter are known.

Themes name their layout on outer elements (``has-sidebar``, ``header-top``), so
tokens that speak for side matter say nothing on html and body, on what holds
most of the page's text, and on what holds its largest article or main element.

Decoding picks the best set of nodes such that on every path from the root
content is one unbroken stretch: nothing below an excluded node comes back.  A
page whose nodes all score low is decoded by what scores best outside its menus,
headers, footers and the like: only a page without such text is empty.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Bound of the training sample, in pages.
SAMPLE_PAGES = 300
TREES, DEPTH, BINS, RATE, SEED = 60, 4, 32, 0.3, 5

#: Tokens are hashed into so many buckets; a bucket seen on fewer nodes says nothing.
BUCKETS, LEAST_SEEN = 4096, 8

#: Elements whose inside is not markup.
RAW = {"script", "style", "iframe", "textarea", "title"}
#: Drawings and formulas; a text block that begins inside ends them.
FOREIGN = {"svg", "math"}
INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr acronym label input math mi mn mo mrow msub msup mfrac msqrt mtext mstyle semantics".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = {"head", "select", "button", "datalist", "option", "noscript", "template", "svg"}
#: Elements whose tokens are about the page, and the share of its text that an element needs to be as one of them.
WHOLE, MOST = {"html", "body"}, 0.75
SIDE_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "address", "fieldset", *HIDDEN}
MAIN_TAGS = {"article", "main"}
TEXT_TAGS = set("p blockquote pre li td th dd dt figcaption".split())
HEADINGS = {f"h{k}" for k in range(1, 7)}
SIDE_TOKENS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist disqus cookie cookies consent copyright dialog footer form gdpr header "
    "login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related recommended reply replies respond share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar topbar widget widgets complementary contentinfo search alert discussion responses "
    "werbung anzeige reklame publicidad publicite kommentare commentaires comentarios".split()
)
MAIN_TOKENS = set("article body content entry main post story text articlebody".split())
#: An open element that one of these closes by beginning.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"p": set("div article section main body ul ol table td blockquote aside nav header footer form".split()), "li": {"ul", "ol", "menu"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}

_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*+)>|<[!?][^>]*+>|<[/!?]?[A-Za-z][^>]*\Z", re.S)
_NAMED = re.compile(r"(?:\b(?:class|id|role|itemprop))\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_TOKENS: dict[str, tuple[int, int, tuple[int, ...]]] = {}


def attribute_tokens(attributes: str) -> tuple[int, int, tuple[int, ...]]:
    """How many class, id or role tokens speak for side matter and for content, and the buckets of all."""
    known = _TOKENS.get(attributes)
    if known is None:
        words = {w for m in _NAMED.finditer(attributes) for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower())}
        known = len(words & SIDE_TOKENS), len(words & MAIN_TOKENS), tuple(sorted({zlib.crc32(w.encode()) % BUCKETS for w in words}))
        if len(_TOKENS) > 50_000:
            _TOKENS.clear()
        _TOKENS[attributes] = known
    return known


class Page:
    """Nodes of one page in document order, and its text blocks with their nodes."""

    def __init__(self, source: str):
        self.tag, self.parent, self.side, self.main = ["#root"], [-1], [0], [0]
        self.tokens: list[tuple[int, ...]] = [()]
        self.linked, self.inline = [0], [0]
        self.blocks: list[tuple[int, str]] = []  # (node, text) pieces of a block share a number
        self.block_of: list[int] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("#root", 0)]
        opened: dict[str, int] = {}  # how many elements of a name are open: closers without one are passed over
        links, block, at, n = 0, 0, 0, len(source)

        def close(k: int) -> None:
            for name, _ in stack[k:]:
                opened[name] -= 1
            del stack[k:]

        while at < n:
            m = _MARK.search(source, at)
            end = m.start() if m else n
            if end > at:
                text = source[at:end]
                node = stack[-1][1]
                self.blocks.append((node, text))
                self.block_of.append(block)
                if links:
                    self.linked[node] += len(text)
            if not m:
                return
            at = m.end()
            name = m[2] or m[5]
            if name is None:
                continue
            name, closing, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
            if name == "br":
                self.blocks.append((stack[-1][1], " "))
                self.block_of.append(block)
                continue
            if closing:
                if name == "a":
                    links = max(0, links - 1)
                if opened.get(name):
                    close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name))
                if name not in INLINE:
                    block += 1
                continue
            if name in RAW:
                shut = re.compile(rf"</{name}\b[^>]*>?", re.I).search(source, at)
                at = shut.end() if shut else n
                block += 1
                continue
            if name == "a":
                links += 1
            if (name in TEXT_TAGS or name in HEADINGS or name in SIDE_TAGS or name in MAIN_TAGS or name == "div") and (opened.get("svg") or opened.get("math")):
                close(next(k for k in range(1, len(stack)) if stack[k][0] in FOREIGN))
            if name in CLOSES and any(opened.get(x) for x in CLOSES[name]):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in CLOSES[name]:
                        close(k)
                        break
                    if stack[k][0] in SCOPE[name]:
                        break
            if name in VOID or (name in FOREIGN and attributes.rstrip().endswith("/")):
                if name not in INLINE:
                    block += 1
                continue
            side, main, tokens = attribute_tokens(attributes) if attributes and name not in WHOLE else (0, 0, ())
            parent = stack[-1][1]
            opened[name] = opened.get(name, 0) + 1
            if name in INLINE and not side:
                stack.append((name, parent))
                self.inline[parent] += 1
                continue
            if name not in INLINE:
                block += 1
                links = 0
            self.tag.append(name)
            self.parent.append(parent)
            self.side.append(side)
            self.main.append(main)
            self.tokens.append(tokens)
            self.linked.append(0)
            self.inline.append(0)
            stack.append((name, len(self.tag) - 1))

    def own_text(self) -> list[int]:
        """Characters of each node's own text."""
        own = [0] * len(self.tag)
        for node, text in self.blocks:
            own[node] += len(text) if text != " " else 0
        return own

    def below(self) -> list[int]:
        """Characters of the text of each node and all in it."""
        text = self.own_text()
        for k in range(len(text) - 1, 0, -1):
            text[self.parent[k]] += text[k]
        return text

    def wrappers(self) -> list[bool]:
        """Which nodes hold most of the page's text, or its largest article or main element outside side matter by tag."""
        text, n = self.below(), len(self.tag)
        wraps = [text[k] >= MOST * max(text[0], 1) for k in range(n)]
        shut = [False] * n
        for k in range(n):
            shut[k] = self.tag[k] in SIDE_TAGS or (k > 0 and shut[self.parent[k]])
        best = max((k for k in range(n) if self.tag[k] in MAIN_TAGS and not shut[k]), key=lambda k: text[k], default=0)
        while best > 0:
            wraps[best] = True
            best = self.parent[best]
        return wraps

    def features(self, speaks: np.ndarray) -> np.ndarray:
        """One row a node; ``speaks``: what each bucket of tokens says for content."""
        n = len(self.tag)
        own = self.own_text()
        parent = self.parent
        text, link, tags = own[:], self.linked[:], [1 + k for k in self.inline]
        kids, child_text = [0] * n, [0] * n
        for k in range(n - 1, 0, -1):
            p = parent[k]
            text[p] += text[k]
            link[p] += link[k]
            tags[p] += tags[k]
            kids[p] += 1
            child_text[p] += text[k]
        depth, order, seen, above, before = [0] * n, [0] * n, [0] * n, [(0, 0, 0.0, 0.0)] * n, [0] * n
        total, running = max(text[0], 1), 0
        wraps = self.wrappers()
        rows = []
        for k in range(n):
            p, tag = parent[k], self.tag[k]
            up = above[p] if k else (0, 0, 0.0, 0.0)
            said = [float(speaks[t]) for t in self.tokens[k]]
            low, high = min(said, default=0.0), max(said, default=0.0)
            if wraps[k]:
                low, high = max(low, 0.0), max(high, 0.0)
            mine = (int(tag in SIDE_TAGS), int(tag in MAIN_TAGS))
            above[k] = (up[0] | mine[0], up[1] | mine[1], min(up[2], low), max(up[3], high))
            if k:
                depth[k] = depth[p] + 1
                order[k] = seen[p]
                seen[p] += 1
            before[k] = running
            running += own[k]
            mates = kids[p] if k else 1
            rows.append(
                (
                    *mine, tag in HEADINGS, tag in TEXT_TAGS, low, high, *above[k], depth[k], own[k], text[k], link[k] / max(text[k], 1), text[k] / tags[k],
                    order[k] / max(mates, 1), mates, text[k] * max(mates, 1) / max(child_text[p] if k else text[k], 1), text[k] / total, before[k] / total, kids[k],
                )
            )
        return np.array(rows, dtype=np.float32)

    def marked(self) -> tuple[np.ndarray, np.ndarray]:
        """Which nodes lie in elements marked as content, and in side matter."""
        n, wraps = len(self.tag), self.wrappers()
        inside, side = [False] * n, [False] * n
        for k in range(n):
            p = self.parent[k]
            inside[k] = (k > 0 and inside[p]) or self.tag[k] in MAIN_TAGS
            side[k] = (k > 0 and side[p]) or self.tag[k] in SIDE_TAGS or (self.side[k] > 0 and self.tag[k] not in MAIN_TAGS and not wraps[k])
        return np.array(inside), np.array(side)

    def hints(self) -> np.ndarray | None:
        """What the page's own markup says of each node: content 1, other 0; None if it says nothing."""
        inside, side = self.marked()
        good = inside & ~side
        return good.astype(np.float32) if good.any() else None

    def choose(self, score: np.ndarray) -> np.ndarray:
        """The nodes to keep; some text outside side matter always stays."""
        chosen = self.decode(score)
        visible = np.zeros(len(self.tag), bool)
        visible[[node for node, text in self.blocks if text.strip()]] = True
        if (chosen & visible).any():
            return chosen
        _, side = self.marked()
        able = visible & ~side
        if not able.any():
            # Side matter by its tokens only is better than nothing.
            side = np.array([self.tag[k] in SIDE_TAGS for k in range(len(self.tag))])
            for k in range(1, len(side)):
                side[k] |= side[self.parent[k]]
            able = visible & ~side
        if not able.any():
            return chosen
        # Nothing scores as content: what comes near the best does.
        best = float(score[able].max())
        chosen = self.decode(np.where(side, np.minimum(score, -1.0), score - best + 1.0))
        return chosen if (chosen & visible).any() else able & (score == best)

    def decode(self, score: np.ndarray) -> np.ndarray:
        """Best choice of nodes whose state on each path runs before, in, after."""
        n = len(self.tag)
        own = [0] * n
        for node, text in self.blocks:
            own[node] += len(text)
        below = own[:]
        for k in range(n - 1, 0, -1):
            below[self.parent[k]] += below[k]
        # Keeping a node speaks for its own text, excluding it for all below it.
        weight = score * (0.1 + np.log1p(np.where(score > 0, own, below)))
        # Passing by a node that scores as content speaks against what is chosen inside it.
        inside, outside = weight.tolist(), (-np.maximum(score, 0) * np.log1p(below)).tolist()
        for k in range(n - 1, 0, -1):
            p = self.parent[k]
            inside[p] += max(inside[k], 0.0)
            outside[p] += max(inside[k], outside[k])
        state = [0] * n  # 0 before, 1 in, 2 after
        state[0] = 1 if inside[0] > outside[0] else 0
        for k in range(1, n):
            up = state[self.parent[k]]
            if up == 0:
                state[k] = 1 if inside[k] > outside[k] else 0
            elif up == 1:
                state[k] = 1 if inside[k] > 0 else 2
            else:
                state[k] = 2
        return np.array(state) == 1

    def text(self, chosen: np.ndarray) -> str:
        out, last, parts = [], -1, []

        def flush() -> None:
            line = " ".join(html.unescape("".join(parts)).split())
            if line:
                out.append(line)
            parts.clear()

        for (node, piece), block in zip(self.blocks, self.block_of, strict=True):
            if block != last:
                flush()
                last = block
            if chosen[node]:
                parts.append(piece)
        flush()
        return "\n".join(out)


class Trees:
    """Gradient-boosted trees for one yes-or-no target, on binned features."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = self.bin(x)
        score = np.zeros(len(y))
        self.trees = []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = self._grow(binned, p - y, p * (1 - p))
            score += tree[2][leaf]
            self.trees.append(tree)
        return self

    def bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1).astype(np.int64)

    @staticmethod
    def _grow(binned, grad, hess):
        n, m = binned.shape
        feature, cut, value = np.zeros(2 ** (DEPTH + 1), np.int64), np.full(2 ** (DEPTH + 1), BINS + 1), np.zeros(2 ** (DEPTH + 1))
        node = np.ones(n, np.int64)
        for level in range(DEPTH):
            for k in range(2**level, 2 ** (level + 1)):
                mine = np.flatnonzero(node == k)
                if len(mine) < 20 or abs(grad[mine]).max() < 1e-3:
                    continue
                g_all, h_all = grad[mine].sum(), hess[mine].sum()
                cells = (binned[mine] + np.arange(m) * (BINS + 1)).ravel()
                sums = [np.bincount(cells, np.repeat(w[mine], m), m * (BINS + 1)).reshape(m, BINS + 1).cumsum(axis=1)[:, :-1] for w in (grad, hess)]
                g, h = sums
                gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
                best = int(gain.argmax())
                if gain.flat[best] > 1e-3:
                    feature[k], cut[k] = divmod(best, BINS)
            node = 2 * node + (binned[np.arange(n), feature[node]] > cut[node])
        for k in range(2**DEPTH, 2 ** (DEPTH + 1)):
            mine = node == k
            value[k] = -RATE * grad[mine].sum() / (hess[mine].sum() + 1)
        return (feature, cut, value), node

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        binned, at = self.bin(x), np.arange(len(x))
        total = np.zeros(len(x))
        for feature, cut, value in self.trees:
            node = np.ones(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + (binned[at, feature[node]] > cut[node])
            total += value[node]
        return total


def _side_block(words: str, rng: np.random.Generator) -> str:
    """A block of side matter around given text, marked by its tag or by one of its tokens."""
    body = f"<p>{words}</p>" if rng.random() < 0.7 else f"<ul><li>{words}</li></ul>"
    if rng.random() < 0.4:
        head = f"h{rng.integers(1, 5)}"
        title = f"<{head}>{words[: int(rng.choice([10, 30]))]}</{head}>"
        body = title if rng.random() < 0.3 else title + body
    if rng.random() < 0.25:  # a thread: a heading of its own, and blocks with tokens of theirs
        each = "".join(f'<div class="{rng.choice(sorted(SIDE_TOKENS))}"><p>{words}</p></div>' for _ in range(rng.integers(1, 4)))
        body = f"<h3>{words[:10]}</h3>{each}"
    if rng.random() < 0.4:
        tag = str(rng.choice(["nav", "header", "footer", "aside", "form"]))
        return f"<{tag}>{body}</{tag}>"
    token = str(rng.choice(sorted(SIDE_TOKENS)))
    shape = str(rng.choice(['class="{}"', 'id="{}"', 'class="box {}-item"', 'class="{} wide"']))
    tag = str(rng.choice(["div", "section", "ul", "div"]))
    return f"<{tag} {shape.format(token)}>{body}</{tag}>"


_MAIN = re.compile(r"<(article|main)\b[^>]*>(.*?)(</\1>|\Z)", re.S | re.I)


def grafted(source: str, lines: list[str], rng: np.random.Generator) -> str:
    """The page with side matter grafted before, into and after its content.

    What is grafted reads like content (it is other pages' text), so that only
    its marks tell it apart; some paragraphs of the content get links, lists,
    quotations and preformatted text.
    """
    m = _MAIN.search(source)
    if not m or not lines:
        return source
    side = lambda most: "".join(_side_block(str(rng.choice(lines)), rng) for _ in range(rng.integers(0, most + 1)))
    parts = _varied(re.split(r"(?<=</p>)", m[2]), lines, rng, side)
    return source[: m.start()] + side(3) + f"<{m[1]}>" + "".join(parts) + side(1) + f"</{m[1]}>" + side(3) + source[m.end() :]


def _varied(parts: list[str], lines: list[str], rng: np.random.Generator, side) -> list[str]:
    for k in range(len(parts)):
        chance = rng.random()
        if chance < 0.12:
            parts[k] += side(1)
        elif chance < 0.24:
            parts[k] += f'<p>{rng.choice(lines)} <a href="/x">{str(rng.choice(lines))[:30]}</a> {str(rng.choice(lines))[:60]}</p>'
        elif chance < 0.32:
            parts[k] += f"<ul><li>{str(rng.choice(lines))[:80]}<li>{str(rng.choice(lines))[:50]}</ul>"
        elif chance < 0.4:
            parts[k] += f"<section><h2>{str(rng.choice(lines))[:40]}</h2><p>{rng.choice(lines)}</p></section>"
        elif chance < 0.5:
            tag = str(rng.choice(["pre", "blockquote"]))
            parts[k] += f"<{tag}>{str(rng.choice(lines))[: int(rng.integers(8, 200))]}</{tag}>"
    return parts


def bared(source: str, lines: list[str], rng: np.random.Generator) -> str:
    """A part of the page's content, from one block to all, and nothing else."""
    m = _MAIN.search(source)
    if not m or not lines:
        return source
    parts = [p for p in re.split(r"(?<=</p>)|(?<=</h1>)", m[2]) if p.strip()] or [m[2]]
    keep = int(rng.choice([1, 2, 3, len(parts)]))
    begin = int(rng.integers(0, 2)) if rng.random() < 0.5 else 0
    parts = _varied(parts[begin : begin + keep] or parts[:1], lines, rng, lambda _: "")
    head = "<head><title>x</title></head>" if rng.random() < 0.5 else ""
    return f"<html>{head}<body><article>{''.join(parts)}</article></body></html>"


class Model:
    """What buckets of tokens say, and the trees."""

    def __init__(self, pages: list[Page], targets: list[np.ndarray]):
        counts = np.zeros((2, BUCKETS))
        for page, y in zip(pages, targets, strict=True):
            for node, tokens in enumerate(page.tokens):
                for t in tokens:
                    counts[int(y[node]), t] += 1
        known = counts.sum(axis=0) >= LEAST_SEEN
        self.speaks = np.where(known, np.clip(np.log((counts[1] + 0.5) / (counts[0] + 0.5)), -4, 4), 0.0)
        self.trees = Trees().fit(np.concatenate([p.features(self.speaks) for p in pages]), np.concatenate(targets))

    def score(self, pages: list[Page]) -> list[np.ndarray]:
        """Log-odds of the nodes of each page."""
        flat = self.trees.score(np.concatenate([p.features(self.speaks) for p in pages])) if pages else np.zeros(0)
        return np.split(flat, np.cumsum([len(p.tag) for p in pages])[:-1]) if pages else []


def fit_pages(sources: list[str]) -> Model | None:
    """A model fitted on pages that mark their content; None if no page does.

    Each page counts as it is, with side matter grafted, and as a bare part of
    its content, all these also with the content's own mark renamed, and the bare
    part without the element that held it.
    """
    rng = np.random.default_rng(SEED)
    lines = [line for source in sources[:100] for line in re.findall(r"<p>([^<]{20,400})", source)] or ["some words of another page"]
    pages, targets = [], []
    for source in sources:
        bare = bared(source, lines, rng)
        for marked in (source, grafted(source, lines, rng), grafted(source, lines, rng), bare):
            page = Page(marked)
            y = page.hints()
            if y is None:
                continue
            pages.append(page)
            targets.append(y)
            name = str(rng.choice(["main", "div", "div", "section"]))
            mark = str(rng.choice(["", "", ' class="content"', ' id="main"', ' class="post-body"']))
            renamed = Page(re.sub(r"</(article|main)>", f"</{name}>", re.sub(r"<(article|main)\b[^>]*>", f"<{name}{mark}>", marked)))
            if len(renamed.tag) == len(y):
                pages.append(renamed)
                targets.append(y)
        gone = Page(re.sub(r"</?(?:article|main)\b[^>]*>", "", bare))
        page = Page(bare)
        y = page.hints()
        if y is not None:
            left = y[[tag not in MAIN_TAGS for tag in page.tag]]
            if len(left) == len(gone.tag):
                pages.append(gone)
                targets.append(left)
    return Model(pages, targets) if pages else None


def train(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Model | None:
    """A model fitted on at most ``sample`` pages, drawn in hash order of their ids."""
    ids = pages.where("page_id is not null and html is not null").select(F.col("page_id").cast("long").alias("page_id")).distinct()
    drawn = ids.orderBy(F.xxhash64("page_id"), "page_id").limit(sample).withColumnRenamed("page_id", "drawn")
    found = pages.select(F.col("page_id").cast("long").alias("page_id"), "html").join(F.broadcast(drawn), F.col("page_id") == F.col("drawn"), "left_semi")
    first = found.groupBy("page_id").agg(F.min("html").alias("html"))
    return fit_pages([r["html"] for r in sorted(first.collect())])


def main_texts(sources: list[str | None], model: Model | None) -> list[str]:
    """Main text of each page; without a model the pages' own markup decides."""
    pages = [Page(x or "") for x in sources]
    if model is None:
        marks = [p.hints() for p in pages]
        scores = [np.full(len(p.tag), -1.0) if y is None else y * 2 - 1 for p, y in zip(pages, marks, strict=True)]
    else:
        scores = model.score(pages)
    return [p.text(p.choose(s)) for p, s in zip(pages, scores, strict=True)]


def extract(pages: DataFrame, model: Model | None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    A null or empty page has empty text, and an empty table gives no rows; a page is read whole whatever its
    length or state (cut tags and references, open elements).  Rows stay as they
    are, repeated and null ids too; other columns are ignored.  No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                texts = main_texts(batch.column("html").to_pylist(), model)
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    cut = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return cut.mapInArrow(run, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))


def op10_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, train(pages))
