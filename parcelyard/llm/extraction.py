"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of its block elements, with a leaf for every stretch of text between
block boundaries. Each node is content or not. A node's own evidence (tag, names, text and
link density) gives unary potentials by logistic regression; potentials between parent and
child, by kind of child, say how likely a child is to share its parent's state. Messages
passed up from the leaves and down from the root (sum-product, exact on a tree) give each
leaf's marginal, and leaves that are rather content than not make up the text. Both kinds
of potentials start from counts and a regression and are then trained together for the
likelihood of whole labelled trees, whose gradient the same messages give.
``labelled_pages`` builds these pages in many layouts and markup habits.
"""

from __future__ import annotations

import html
import math
import random
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as S

from parcelyard.llm import text as T

# Fixed values, after the HTML standard: elements within a line, elements without an end,
# elements whose inside is never running text, and what a start tag closes by itself.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
    "nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
OPAQUE = frozenset("script style noscript template title textarea iframe object svg canvas select button".split())
# Opaque elements without markup inside: only their own end ends them.
RAW = frozenset("script style title textarea iframe".split())
# Opaque elements that the next one of their kind ends.
FLAT = frozenset("button select".split())
# Start tags that an opaque element without an end does not hold.
OUTSIDE = frozenset(
    "address article aside blockquote body dd details div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table td th tr ul".split()
)
CLOSES = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
}
CLOSES = {tag: (frozenset(a.split()), frozenset(b.split())) for tag, (a, b) in CLOSES.items()}
BLOCKS_IN_P = frozenset("div section article ul ol table h1 h2 h3 h4 h5 h6 p".split())

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
BROKEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
TAG_START = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*+)")
NAMES = re.compile(r"""\b(?:class|id|role)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)""", re.IGNORECASE)
NAME_PARTS = re.compile(r"[a-z]+")

# Words that name the parts of a page in class, id and role attributes.
PART_WORDS = frozenset(
    "ad ads advert advertisement alert article author banner body breadcrumb byline caption "
    "comment comments complementary consent content contentinfo cookie disqus entry feedback "
    "footer form gdpr header headline login main masthead menu meta modal nav navbar navigation "
    "newsletter notice pagination pager popup post promo related reply respond search share "
    "sidebar signup skip social sponsor sponsored story subscribe tags teaser text title toc "
    "toolbar topbar widget".split()
)


@dataclass(slots=True)
class Node:
    """A block element, or (without tag) a stretch of text."""

    tag: str
    names: frozenset[str]
    parent: int
    text: str = ""
    linked: int = 0
    chars: int = 0
    label: int = 0
    features: list = field(default_factory=list)


def _tags(page: str, at: int) -> Iterator[tuple[int, bool, str]]:
    """Place, whether closing, and name of the tags from ``at`` on, not those in comments or raw text."""
    while match := TAG_START.search(page, at):
        at = match.end()
        if match[2] is None:
            end = page.find("-->", at)
            if end < 0:
                return
            at = end + 3
            continue
        closing, tag = match[1] == "/", match[2].lower()
        yield match.start(), closing, tag
        if tag in RAW and not closing:
            end = _end_tag(tag).search(page, at)
            if not end:
                return
            at = end.end()


@lru_cache(maxsize=None)
def _end_tag(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\b[^>]*+>?", re.IGNORECASE)


def _closed(page: str) -> set[int]:
    """Ends of the names in start tags of opaque elements that end before what is around them."""
    found: set[int] = set()
    stack: list[list] = []
    opened: dict[str, int] = defaultdict(int)
    flat: dict[str, list] = {}
    for place, closing, name in _tags(page, 0):
        if name in INLINE or name in VOID or name in RAW:
            continue
        if closing:
            if opened[name]:
                while True:
                    last, start = stack.pop()
                    opened[last] -= 1
                    if last == name:
                        break
                if name in OPAQUE:
                    found.add(start)
            continue
        if name in OPAQUE and page[page.find(">", place) - 1] == "/":
            continue
        if name in FLAT:
            if opened[name]:
                flat[name][0] = ""
                opened[name] -= 1
                opened[""] += 1
        stack.append([name, place + 1 + len(name)])
        flat[name] = stack[-1]
        opened[name] += 1
    return found


def _left_open(page: str, at: int) -> int:
    """Where the inside of an opaque element without an end ends.

    That is at the end of an element around it, at a block, or with the page.
    """
    opened: dict[str, int] = defaultdict(int)
    for place, closing, name in _tags(page, at):
        if name in OUTSIDE or name in FLAT and not closing:
            return place
        if name in VOID:
            continue
        opened[name] += -1 if closing else 1
        if opened[name] < 0:
            return place
    return len(page)


def parse(page: str) -> list[Node]:
    """Nodes in page order, parents before children; node 0 is the root."""
    nodes = [Node("#root", frozenset(), -1)]
    stack = [0]
    pieces: list[str] = []
    linked, links = 0, 0
    closed: set[int] | None = None

    def end_block() -> None:
        nonlocal linked
        body = " ".join(html.unescape("".join(pieces)).split())
        if body:
            nodes.append(
                Node("", frozenset(), stack[-1], body, min(linked, len(body)), len(body))
            )
        pieces.clear()
        linked = 0

    def add(part: str) -> None:
        nonlocal linked
        pieces.append(part)
        if links:
            linked += len(part)

    at, size = 0, len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            add(page[at:])
            break
        if mark > at:
            add(page[at:mark])
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), mark):
            end = page.find(">", mark)
            at = size if end < 0 else end + 1
            continue
        match = TAG.match(page, mark) or BROKEN.match(page, mark)
        if not match:
            lead = 2 if page.startswith("</", mark) else 1
            after = page[mark + lead : mark + lead + 1]
            if after.isascii() and after.isalpha() or lead == 2 and not after:
                break  # cut off inside a tag
            end = page.find(">", mark) if lead == 2 else -1
            if end < 0:
                add(page[mark : mark + lead])
                at = mark + lead
            else:
                at = end + 1  # a comment
            continue
        at = match.end()
        closing, tag, rest = match[1], match[2].lower(), match[3]
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if closing else links + 1
            elif tag in VOID:
                add(" ")
            continue
        if tag in OPAQUE:
            if not closing and not rest.endswith("/"):
                if tag not in RAW and closed is None:
                    closed = _closed(page)
                if tag not in RAW and match.end(2) not in closed:
                    at = _left_open(page, at)
                else:
                    end = _end_tag(tag).search(page, at)
                    at = end.end() if end else size
            continue
        end_block()
        links = 0
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag in BLOCKS_IN_P and nodes[stack[-1]].tag == "p":
            stack.pop()
        if tag in CLOSES:
            ended, limit = CLOSES[tag]
            for depth in range(len(stack) - 1, 0, -1):
                above = nodes[stack[depth]].tag
                if above in limit:
                    break
                if above in ended:
                    del stack[depth:]
                    break
        names = frozenset(
            word
            for value in NAMES.findall(rest)
            for word in NAME_PARTS.findall(value.lower())
            if word in PART_WORDS
        )
        nodes.append(Node(tag, names, stack[-1]))
        if tag not in VOID and not rest.endswith("/"):
            stack.append(len(nodes) - 1)
    end_block()
    for node in reversed(nodes):
        if node.parent >= 0:
            nodes[node.parent].chars += node.chars
            nodes[node.parent].linked += node.linked
    return nodes


def _grade(value: float, limits: tuple[float, ...]) -> int:
    return bisect_right(limits, value)


def describe(nodes: list[Node]) -> None:
    """Evidence of each node, as names of the features it has."""
    whole = max(1, nodes[0].chars)
    before = 0
    for node in nodes:
        density = node.linked / node.chars if node.chars else 0.0
        own = [
            "any",
            f"tag {node.tag}",
            f"links {_grade(density, (0.05, 0.3, 0.6, 0.9))}",
            f"chars {_grade(node.chars, (1, 25, 60, 150, 400, 1500))}",
            *[f"name {name}" for name in node.names],
        ]
        if node.tag:
            own.append(f"share {_grade(node.chars / whole, (0.02, 0.1, 0.3, 0.6))}")
        else:
            above = nodes[node.parent]
            own += [
                f"in {above.tag}",
                f"in {above.tag} links {_grade(density, (0.3, 0.9))}",
                f"stops {_grade(node.text.count('. ') + node.text.endswith(('.', '!', '?')), (1, 2, 5))}",
                f"at {_grade(before / whole, (0.02, 0.2, 0.8, 0.98))}",
            ]
            if node.text[:1] in "©" or "rights reserved" in node.text.lower():
                own.append("notice")
            before += node.chars
        node.features = own


def kind(node: Node) -> str:
    """What the potential between a node and its parent depends on."""
    return node.tag or "text"


# --- potentials and messages -----------------------------------------------------------


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Weights(dict):
    """Weights by feature; 0 for one that training has not met."""

    def __missing__(self, name: str) -> float:
        return 0.0


def _messages(nodes: list[Node], model: dict):
    """Log-messages: what each node hears from below and from above, per state.

    ``up`` holds a node's evidence and its children's messages, ``sent`` what it passes to
    its parent, ``down`` what comes from its parent without its own part.
    """
    get, prior = model["weights"].__getitem__, model["prior"]
    edges = model["edges"]
    # Log-evidence for content against not, beyond the prior odds.
    up = [[0.0, sum(map(get, node.features)) - prior] for node in nodes]
    tables = [edges.get(node.tag or "text") or edges["other"] for node in nodes]
    sent = [(0.0, 0.0)] * len(nodes)
    for at in range(len(nodes) - 1, 0, -1):
        zero, one = up[at]
        (stay, rise), (fall, keep) = tables[at]
        sent[at] = message = (_add(stay + zero, rise + one), _add(fall + zero, keep + one))
        above = up[nodes[at].parent]
        above[0] += message[0]
        above[1] += message[1]
    down = [(0.0, prior)] * len(nodes)
    for at in range(1, len(nodes)):
        above, own = nodes[at].parent, sent[at]
        zero = down[above][0] + up[above][0] - own[0]
        one = down[above][1] + up[above][1] - own[1]
        (stay, rise), (fall, keep) = tables[at]
        down[at] = (_add(stay + zero, fall + one), _add(rise + zero, keep + one))
    return up, sent, down, tables


def _chance(odds: float) -> float:
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def marginals(nodes: list[Node], model: dict) -> list[float]:
    """Chance of each node to be content, by messages up the tree and down again."""
    up, _, down, _ = _messages(nodes, model)
    return [_chance(u[1] + d[1] - u[0] - d[0]) for u, d in zip(up, down)]


def _add(a: float, b: float) -> float:
    """Logarithm of the sum of two numbers given by their logarithms."""
    gap = a - b
    if gap > 30:
        return a
    if gap < -30:
        return b
    return b + math.log1p(math.exp(gap))


def fit(pages: list[list[Node]]) -> dict:
    """Unary weights by logistic regression, edge tables by smoothed counts."""
    names = sorted({f for nodes in pages for node in nodes for f in node.features})
    place = {name: i for i, name in enumerate(names)}
    rows = [[place[f] for f in node.features] for nodes in pages for node in nodes]
    marks = np.array([node.label for nodes in pages for node in nodes], float)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    flat = np.concatenate([np.array(r) for r in rows])
    weights = np.zeros(len(names))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, 301):
        error = _sigmoid(np.bincount(owner, weights[flat], len(rows))) - marks
        grad = np.bincount(flat, error[owner], len(names)) / len(rows) + 1e-4 * weights
        first += 0.1 * (grad - first)
        second += 0.01 * (grad * grad - second)
        weights -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    counts: dict[str, list] = defaultdict(lambda: [[0.5, 0.5], [0.5, 0.5]])
    for nodes in pages:
        for node in nodes[1:]:
            for name in (kind(node), "other"):
                counts[name][nodes[node.parent].label][node.label] += 1
    edges = {
        name: [[math.log(c / sum(row)) for c in row] for row in table]
        for name, table in counts.items()
    }
    rate = marks.mean()
    model = {
        "weights": Weights(zip(names, weights.tolist())),
        "edges": edges,
        "prior": math.log(rate / (1 - rate)),
    }
    _fit_trees(pages, model)
    return model


# Passes over the labelled trees, the size of a step, the pull of weights towards 0, and
# the share of a node's evidence that is hidden at random, so that no kind of it is all.
PASSES, STEP, DECAY, HIDDEN = 8, 0.1, 1e-4, 0.4


def _fit_trees(pages: list[list[Node]], model: dict) -> None:
    """Climb the likelihood of the trees' labels: observed less expected, tree by tree."""
    weights, edges = model["weights"], model["edges"]
    squares: dict = defaultdict(lambda: 1.0)
    draw = random.Random(3).random
    for _ in range(PASSES):
        for whole in pages:
            nodes = [
                replace(node, features=[f for f in node.features if draw() >= HIDDEN])
                for node in whole
            ]
            up, sent, down, tables = _messages(nodes, model)
            grads: dict = defaultdict(float)
            for at, node in enumerate(nodes):
                error = node.label - _chance(
                    up[at][1] + down[at][1] - up[at][0] - down[at][0]
                )
                if abs(error) > 1e-3:
                    for name in node.features:
                        grads[name] += error
                if at:
                    above = node.parent
                    outer = [down[above][s] + up[above][s] - sent[at][s] for s in (0, 1)]
                    logs = [
                        outer[s] + tables[at][s][t] + up[at][t] for s in (0, 1) for t in (0, 1)
                    ]
                    high = max(logs)
                    parts = [math.exp(v - high) for v in logs]
                    seen = 2 * nodes[above].label + node.label
                    name = kind(node) if kind(node) in edges else "other"
                    for cell in range(4):
                        grads[name, cell] += (cell == seen) - parts[cell] / sum(parts)
            for name, grad in grads.items():
                squares[name] += grad * grad
                step = STEP * grad / math.sqrt(squares[name])
                if isinstance(name, tuple):
                    edges[name[0]][name[1] // 2][name[1] % 2] += step
                else:
                    weights[name] += step - DECAY * weights[name]


def extract(page: str, model: dict) -> str:
    nodes = parse(page)
    describe(nodes)
    chances = marginals(nodes, model)
    return "\n\n".join(n.text for n, c in zip(nodes, chances) if not n.tag and c >= 0.5)


# --- labelled pages ----------------------------------------------------------------------

# What marks a block of a labelled page as content; no page has this character otherwise.
MARK = "␟"


class _Maker:
    """Writes pages in varied layouts; content blocks start with ``MARK``."""

    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)
        self.stop, self.short = ".", False

    def pick(self, *options):
        return self.rng.choice(options)

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def count(self, least: int, most: int) -> int:
        return self.rng.randint(least, most)

    def some(self, most: int) -> int:
        """A number from 1 up, often small, now and then as large as ``most``."""
        return max(1, min(most, int(most ** self.rng.random())))

    def words(self, least: int, most: int) -> str:
        parts = ("an", "ber", "co", "da", "en", "li", "mo", "ra", "sta", "ti", "ver", "ing", "ou", "é")
        return " ".join(
            "".join(self.rng.choices(parts, k=self.count(1, 3)))
            for _ in range(self.count(least, most))
        )

    def sentence(self, least: int = 4, most: int = 18) -> str:
        return self.words(least, most).capitalize() + self.stop

    def prose(self) -> str:
        if self.short:
            return self.sentence(1, 4)
        count = 1 if self.chance(0.3) else self.some(40)
        text = " ".join(self.sentence(1 if self.chance(0.2) else 4) for _ in range(count))
        if self.chance(0.3):
            text += f' <a href="/{self.words(1, 1)}">{self.words(1, 3)}</a> {self.sentence()}'
        return f"<b>{text}</b>" if self.chance(0.1) else text

    def box(self, names: tuple[str, ...], tags: tuple[str, ...], inside: str) -> str:
        tag, name = self.pick(*tags), self.pick(*names)
        how = self.pick("class", "class", "id")
        lead = self.pick("", "", "site-", "page-")
        return f'<{tag} {how}="{lead}{name}">{inside}</{tag}>'

    def link_list(self, least: int = 3, most: int = 9) -> str:
        links = [f'<a href="/{i}">{self.words(1, 3)}</a>' for i in range(self.count(least, most))]
        if self.chance(0.7):
            end = self.pick("</li>", "</li>", "")
            return "<ul>" + "".join(f"<li>{link}{end}" for link in links) + "</ul>"
        return self.pick(" | ", " ", " &middot; ").join(links)

    def content(self) -> str:
        blocks = []
        if self.chance(0.8):
            title = f"<h1>{MARK}{self.words(1, 9).capitalize()}{self.pick('', '.')}</h1>"
            wrapped = f"<header>{title}</header>" if self.chance(0.15) else title
            blocks.append(wrapped)
        end = self.pick("</p>", "</p>", "</p>", "")
        for _ in range(self.some(80)):
            sort = self.rng.random()
            if sort < 0.75:
                broken = self.pick("<b>", "<i>", "") if self.chance(0.1) else ""
                blocks.append(f"<p>{broken}{MARK}{self.prose()}{end}{'<br>' if self.chance(0.1) else ''}")
            elif sort < 0.83:
                blocks.append(f"<h2>{MARK}{self.words(1, 6).capitalize()}</h2>")
            elif sort < 0.9:
                items = "".join(f"<li>{MARK}{self.sentence()}</li>" for _ in range(self.count(2, 6)))
                blocks.append(f"<ul>{items}</ul>")
            elif sort < 0.94:
                blocks.append(f"<blockquote><p>{MARK}{self.prose()}</p></blockquote>")
            elif sort < 0.97:
                cells = "".join(f"<td>{MARK}{self.words(1, 4)}</td>" for _ in range(3))
                blocks.append(f"<table><tr>{cells}</tr></table>")
            else:
                blocks.append(f"<pre>{MARK}{self.words(4, 20)}</pre>")
            if self.chance(0.05):
                blocks.append(self.advert())
            if self.chance(0.04):
                blocks.append(self.box(("share", "social", "related"), ("div", "aside"), self.link_list(2, 5)))
        inside = "".join(blocks)
        return self.pick(
            f"<article>{inside}</article>",
            f"<article>{inside}</article>",
            f'<main><article class="post">{inside}</article></main>',
            f"<main>{inside}</main>",
            f'<div class="content">{inside}</div>',
            f'<div id="main"><div class="entry-content">{inside}</div></div>',
            f'<section class="story-body">{inside}</section>',
        )

    def advert(self) -> str:
        body = self.pick(self.sentence(), self.prose(), f"<p>{self.prose()}</p>", f'<a href="/x">{self.words(2, 6)}</a>')
        return self.box(("ad", "ads", "advert", "promo", "sponsored", "banner ad"), ("div", "div", "aside"), body)

    def before(self) -> str:
        menu = self.pick(
            f"<nav>{self.link_list()}</nav>",
            f"<nav>{self.link_list()}</nav>",
            self.box(("menu", "nav", "navbar", "navigation"), ("div", "ul"), self.link_list()),
        )
        name = f"<h1>{self.words(1, 3)}</h1>" if self.chance(0.3) else f"<p>{self.words(1, 4)}</p>"
        head = self.pick(
            f"<header>{name}{menu}</header>",
            self.box(("header", "masthead", "topbar"), ("div",), name + menu),
            menu,
            menu,
        )
        extra = ""
        if self.chance(0.4):
            extra += self.advert()
        if self.chance(0.3):
            text = f"<p>{self.sentence()}</p>" if self.chance(0.5) else self.sentence()
            extra += self.box(("cookie", "consent", "notice", "alert", "gdpr"), ("div", "section"), text)
        if self.chance(0.2):
            extra += self.box(("breadcrumb",), ("div", "nav"), self.link_list(2, 4))
        if self.chance(0.2):
            extra += f'<form action="/search"><label>{self.words(1, 2)}</label><input name="q"></form>'
        return head + extra

    def comments(self) -> str:
        notes = "".join(
            self.pick(
                f'<div class="comment"><p>{self.words(1, 2)}</p><p>{self.prose()}</p></div>',
                f"<li><p>{self.prose()}</p></li>",
                f"<p>{self.prose()}</p>",
            )
            for _ in range(self.some(30))
        )
        title = f"<h2>{self.words(1, 3)}</h2>" if self.chance(0.6) else ""
        return self.box(("comments", "comment-list", "disqus", "respond"), ("div", "section", "ol"), title + notes)

    def after(self) -> str:
        parts = []
        if self.chance(0.35):
            parts.append(self.comments())
        if self.chance(0.35):
            inside = self.pick(f"<h3>{self.words(1, 3)}</h3>{self.link_list()}", f"<p>{self.sentence()}</p>{self.link_list()}")
            tag = self.pick("aside", "aside", "div")
            parts.append(f'<{tag} class="{self.pick("sidebar", "widget", "related")}">{inside}</{tag}>')
        if self.chance(0.3):
            parts.append(f'<form class="{self.pick("newsletter", "subscribe", "signup", "login")}"><p>{self.sentence()}</p><input></form>')
        if self.chance(0.2):
            parts.append(self.advert())
        text = self.pick(
            f"&copy; {self.words(1, 3)}", f"&copy; {self.words(1, 2)} &middot; {self.sentence()}",
            f"<p>{self.sentence()} All rights reserved.</p>", self.link_list(),
        )
        parts.append(self.pick(f"<footer>{text}</footer>", f"<footer>{text}</footer>", self.box(("footer", "contentinfo"), ("div",), text)))
        return "".join(parts)

    def page(self) -> str:
        self.stop = self.pick(".", ".", ".", ".", "")
        self.short = self.chance(0.15)
        aside = ""
        if self.chance(0.2):
            aside = self.pick(f"<aside>{self.link_list()}</aside>", self.box(("sidebar",), ("div",), f"<p>{self.sentence()}</p>{self.link_list()}"))
        middle = aside + self.content() if self.chance(0.5) else self.content() + aside
        if self.chance(0.2):
            middle = f'<div class="{self.pick("container", "wrapper", "page")}">{middle}</div>'
        end = self.pick("</body></html>", "")
        return (
            f"<!DOCTYPE html><html><head><title>{self.words(1, 6)}</title><style>p{{}}</style></head><body>"
            f'<script>var a = "</p>";</script>{self.before()}{middle}{self.after()}{end}'
        )


def labelled_pages(count: int, seed: int) -> list[tuple[str, list[Node]]]:
    """Pages, and their described trees with every node labelled."""
    made = []
    maker = _Maker(seed)
    while len(made) < count:
        marked = maker.page()
        labels = [node.text.startswith(MARK) for node in parse(marked)]
        page = marked.replace(MARK, "")
        nodes = parse(page)
        describe(nodes)
        if len(nodes) != len(labels):
            continue
        for at in range(len(nodes) - 1, -1, -1):
            nodes[at].label |= int(labels[at])
            if nodes[at].label and nodes[at].parent >= 0:
                nodes[nodes[at].parent].label = 1
        made.append((page, nodes))
    return made


@lru_cache(maxsize=1)
def trained(count: int = 300) -> dict:
    """The model; the same in every run."""
    return fit([nodes for _, nodes in labelled_pages(count, seed=5)])


def _extract(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches):
        texts = [extract(page or "", model) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(text) for text in texts], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row.

    ``pages`` needs page_id, url and html; other columns are ignored. A null or empty page
    and one without content have an empty text. Repeated rows are each extracted; pages of
    any length are read whole. An empty table gives an empty result.
    """
    shape = S.StructType([pages.schema["page_id"], pages.schema["url"]])
    shape.add("text", S.StringType()).add("n_chars", S.LongType())
    return pages.select("page_id", "url", "html").mapInArrow(
        partial(_extract, model=trained()), shape
    )
