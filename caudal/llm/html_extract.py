"""Main text of HTML by a tree-structured graphical model.

A page's elements form a tree; each is content or not. A parent-child potential
says how likely a child is content given its parent, by the parent's kind; node
potentials say how likely an element's tag, class and id words, link density and
text length are in either state. Sum-product messages, upward and then downward,
give each element's marginal; text counts if the marginal of its element is over
one half. All potentials come from one logistic regression on labelled pages, which
`labelled_pages` writes: made-up articles in the usual surroundings.

Text: character references are decoded; white space inside a block becomes one
space; blocks are trimmed, empty ones left out, and the others joined in page
order by a line feed. A <br> ends a block. Scripts, styles, comments and other
markup never count.

Nulls and edge cases: null or empty html gives an empty text. Unclosed and stray
tags, unclosed comments and quotes, and any depth of nesting are taken as a
browser would, roughly; nothing recurses. A page whose elements are none content
gives an empty text. Repeated rows are extracted each. Extra columns are ignored.
"""

from __future__ import annotations

import html as _html
import math
import random
import re
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIP = frozenset("script style noscript template svg math iframe object select textarea canvas head title".split())
_RAW = frozenset("script style textarea title noscript iframe".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
#: A start tag of the key closes an open element of the values that is not beyond one of the stops.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody"), "tfoot": ("tbody",)}
_STOPS = frozenset("ul ol dl table html body article section div nav aside main".split())
_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_MARK = re.compile(r"""[>"']""")
_ATTR = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_TELLING = frozenset("nav header footer aside form article main".split())
#: Words of class, id and role that the model tells apart (fixed values).
_HINTS = frozenset("ad ads advert advertisement banner sponsor sponsored promo sidebar side menu nav navigation navbar footer header masthead comment comments reply cookie notice consent newsletter subscribe signup login form search related recommended share social breadcrumb pagination pager widget popup modal disclaimer copyright toolbar content article post entry story main body text".split())
#: Elements that hold text of their own only where a page has no other markup.
_ROOTS = frozenset("#page html body".split())
_KINDS = {"a": "link", "nav": "nav", "footer": "edge", "header": "edge", "aside": "edge", "form": "edge", "article": "article", "main": "main", "ul": "list", "ol": "list", "li": "item", "table": "table", "tr": "table", "td": "cell", "th": "cell", "p": "p", "div": "div", "section": "div", "html": "root", "#page": "root", "body": "body"}


class Node:
    __slots__ = ("tag", "parent", "hints", "under", "own", "text", "linked", "place", "inline")

    def __init__(self, tag: str, parent: int, hints: tuple[str, ...], under: frozenset[str] = frozenset()) -> None:
        """under: hints and telling tags of the elements around."""
        self.tag, self.parent, self.hints, self.under = tag, parent, hints, under
        self.own = self.text = self.linked = 0
        self.place: tuple = ()
        self.inline = ""  # the tag that a button within running text counts as


class _Tags:
    """The tags of a page one after another, in time that grows with its length alone, however broken they are."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.none: dict[str, int] = {}  # from where on a string does not occur any more
        self.open: set[int] = set()  # quotes after which no tag ends

    def find(self, what: str, at: int) -> int:
        if at >= self.none.get(what, len(self.page) + 1):
            return -1
        i = self.page.find(what, at)
        if i < 0:
            self.none[what] = at
        return i

    def end(self, at: int) -> int:
        """Where the tag ends whose name ends at `at`: at a > outside of quotes, or else at the first > at all; -1 without one."""
        i, passed = at, []
        while m := _MARK.search(self.page, i):
            if m[0] == ">":
                return m.start()
            if m.start() in self.open:
                break
            passed.append(m.start())
            close = self.find(m[0], m.end())
            if close < 0:
                break
            i = close + 1
        self.open.update(passed)
        return self.find(">", at)

    def next(self, at: int) -> tuple[int, int, str, str] | None:
        """(start, end, name, attributes) of the next tag from `at` on; the name has a slash before it if the tag closes, and is empty for comments and declarations."""
        while (i := self.find("<", at)) >= 0:
            if self.page.startswith("!--", i + 1):
                end = self.find("-->", i + 4)
                return i, end + 3 if end >= 0 else len(self.page), "", ""
            m = _NAME.match(self.page, i + 1)
            end = self.end(m.end()) if m else self.find(">", i) if self.page[i + 1 : i + 2] in ("!", "?") else -1
            if end >= 0:
                return i, end + 1, m[0].lower() if m else "", self.page[m.end() : end] if m else ""
            at = i + 1
        return None


class _Stack:
    """The open elements; for each tag, for blocks and for stops also where in the stack they are."""

    def __init__(self, nodes: list[Node]) -> None:
        self.nodes, self.ids, self.of = nodes, [0], defaultdict(list)

    def keys(self, tag: str):
        yield tag
        if tag in _BLOCK:
            yield "#block"
        if tag in _STOPS:
            yield "#stop"

    def push(self, node: int) -> None:
        for k in self.keys(self.nodes[node].tag):
            self.of[k].append(len(self.ids))
        self.ids.append(node)

    def pop(self) -> Node:
        n = self.nodes[self.ids.pop()]
        for k in self.keys(n.tag):
            self.of[k].pop()
        return n

    def last(self, key: str) -> int:
        """The depth of the innermost one, or 0."""
        at = self.of.get(key)
        return at[-1] if at else 0


def parse(page: str) -> tuple[list[Node], list[tuple[int, str | None]]]:
    """Elements, parents first, and what they hold in page order: (element, text), or (element, None) where a block ends."""
    nodes, events = [Node("#page", -1, ())], []
    stack, tags, at, skip = _Stack(nodes), _Tags(page), 0, 0

    def close(depth: int) -> None:
        nonlocal skip
        while len(stack.ids) > depth:
            n = stack.pop()
            if n.tag in _SKIP:
                skip -= 1
            elif n.tag in _BLOCK:
                events.append((stack.ids[-1], None))

    def say(text: str) -> None:
        if text and not skip:
            events.append((stack.ids[-1], text))

    while True:
        found = tags.next(at)
        if not found:
            say(page[at:])
            break
        start, end, tag, attrs = found
        say(page[at:start])
        at = end
        if not tag:
            continue
        if tag[0] == "/":
            tag = tag[1:]
            if depth := stack.last(tag):
                close(depth)
            elif tag in ("p", "br"):
                events.append((stack.ids[-1], None))
            continue
        if tag == "br":
            events.append((stack.ids[-1], None))
            continue
        if tag in _VOID:
            continue
        if tag in _BLOCK:
            if stack.last("p") > stack.last("#stop"):
                close(stack.last("p"))
        elif tag == "a" and stack.last("a") > stack.last("#block"):
            close(stack.last("a"))
        if tag in _CLOSES:
            inner = [stack.of[t][k] for t in _CLOSES[tag] if (k := bisect_right(stack.of[t], stack.last("#stop"))) < len(stack.of[t])]
            if inner:
                close(min(inner))
        hints = tuple(w for a in _ATTR.finditer(attrs) for w in _WORD.findall((a[1] or a[2] or a[3] or "").lower()) if w in _HINTS) if "=" in attrs else ()
        if tag in _BLOCK:
            events.append((stack.ids[-1], None))
        if attrs.endswith("/") and tag not in _BLOCK:
            continue
        around = nodes[stack.ids[-1]]
        under = around.under
        if around.hints or around.tag in _TELLING:
            under = under.union(around.hints, (around.tag,) if around.tag in _TELLING else ())
        nodes.append(Node(tag, stack.ids[-1], hints, under))
        stack.push(len(nodes) - 1)
        if tag in _SKIP:
            skip += 1
        if tag in _RAW:
            over = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = over.start() if over else len(page)
    for i, text in events:
        if text is not None:
            n = len(text.strip())
            nodes[i].own += n
            nodes[i].text += n
            if nodes[i].tag == "a":
                nodes[i].linked += n
    for i in range(len(nodes) - 1, 0, -1):
        n, up = nodes[i], nodes[nodes[i].parent]
        up.text += n.text
        up.linked += n.text if n.tag == "a" else n.linked
    _place(nodes)
    return nodes, events


#: Elements that are told apart by how they stand beside their siblings, and what names an article (fixed values).
_BOXES = frozenset("div section article aside td main table tbody tr".split())
_NAMED = frozenset("article main content post entry story".split())
#: Characters of a paragraph that a layout has and a table of figures has not.
_PROSE = 80


def _place(nodes: list[Node]) -> None:
    """How an element stands: whether a sibling of it, or of one around it, is named as the article; for boxes also the share of their parent's text, whether a sibling box has much more, how many siblings are of their kind, and for parts of tables whether they hold prose."""
    largest, alike, named, prose = [0] * len(nodes), defaultdict(int), [0] * len(nodes), [False] * len(nodes)
    aside = [False] * len(nodes)
    own_name = [n.tag in ("article", "main") or not _NAMED.isdisjoint(n.hints) for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        n = nodes[i]
        named[n.parent] += own_name[i]
        if n.tag in _BOXES and n.text:
            largest[n.parent] = max(largest[n.parent], n.text)
            alike[n.parent, n.tag] += 1
        if prose[i] or (n.tag in ("p", "h1") and n.text >= _PROSE):
            prose[i] = prose[n.parent] = True
    for i in range(1, len(nodes)):
        n = nodes[i]
        beside = aside[i] = aside[n.parent] or (named[n.parent] > 0 and not own_name[i])
        if n.tag == "button" and nodes[n.parent].own:
            n.inline = "span"
        if n.tag in _BOXES and n.text:
            same = alike[n.parent, n.tag]
            table = n.tag in ("table", "tbody", "tr", "td")
            n.place = (beside, "cell" if table else "box", min(3, 4 * n.text // max(1, nodes[n.parent].text)), min(3, same.bit_length() - 1), largest[n.parent] > 3 * n.text, prose[i] if table else None)
        elif beside:
            n.place = (True,)


def _size(n: int) -> int:
    return 0 if not n else min(5, 1 + int(math.log10(n) * 1.5))


def look(n: Node) -> tuple:
    """What features() rests on; elements that look alike share their potential."""
    return n.inline or n.tag, 4 * n.linked // max(1, n.text) if n.text else -1, _size(n.text), _size(n.own), n.hints, n.under, n.place


def features(n: Node) -> list[str]:
    return _features(*look(n))


def _features(tag: str, dense: int, size: int, own: int, hints: tuple[str, ...], under: frozenset[str], place: tuple = ()) -> list[str]:
    beside = ["beside the article"] if place and place[0] else []
    if len(place) > 1:
        _, what, share, alike, more, prose = place
        beside += [f"{what} share {share}", f"{what} alike {alike}", *((f"{what} beside more", f"{what} links {dense} beside more") if more else ()), *((f"{tag} prose {prose}",) if prose is not None else ())]
    return [*beside, "element", f"tag {tag}", f"links {dense}", f"size {size}", *((f"{tag} holds {own}",) if tag in _ROOTS else ()), *(f"hint {h}" for h in sorted(set(hints))), *(f"under {h}" for h in sorted(under))]


def kind(n: Node) -> str:
    return _KINDS.get(n.tag, "other")


@dataclass
class Model:
    node: dict = field(default_factory=dict)  # feature -> log potential of content
    edge: dict = field(default_factory=dict)  # kind of parent -> potential by its state and the child's

    def marginals(self, nodes: list[Node]) -> list[float]:
        """P(content) of each element, by sum-product messages up and down the tree."""
        known: dict[tuple, float] = {}
        odds = []
        for n in nodes:
            k = look(n)
            if k not in known:
                known[k] = math.exp(max(-30.0, min(30.0, sum(self.node.get(f, 0.0) for f in features(n)))))
            odds.append(known[k])
        edges = [self.edge.get(kind(n), self.edge["any"]) for n in nodes]
        up0, up1 = [1.0] * len(nodes), [1.0] * len(nodes)  # belief from below: products of messages, and the node's own potential
        to0, to1 = [1.0] * len(nodes), [1.0] * len(nodes)  # messages of a node to its parent
        for i in range(len(nodes) - 1, -1, -1):
            b0, b1 = up0[i], up1[i] * odds[i]
            s = b0 + b1
            up0[i], up1[i] = b0, b1 = b0 / s, b1 / s
            if i:
                p = nodes[i].parent
                (a00, a01), (a10, a11) = edges[p]
                m0, m1 = a00 * b0 + a01 * b1, a10 * b0 + a11 * b1
                to0[i], to1[i] = m0, m1
                x0, x1 = up0[p] * m0, up1[p] * m1
                s = x0 + x1
                up0[p], up1[p] = x0 / s, x1 / s
        out, d0, d1 = [0.0] * len(nodes), [1.0] * len(nodes), [1.0] * len(nodes)
        for i in range(len(nodes)):
            if i:
                p = nodes[i].parent
                (a00, a01), (a10, a11) = edges[p]
                q0, q1 = d0[p] * up0[p] / max(to0[i], 1e-300), d1[p] * up1[p] / max(to1[i], 1e-300)
                x0, x1 = q0 * a00 + q1 * a10, q0 * a01 + q1 * a11
                d0[i], d1[i] = x0 / (x0 + x1), x1 / (x0 + x1)
            b0, b1 = d0[i] * up0[i], d1[i] * up1[i]
            out[i] = b1 / (b0 + b1)
        return out


def train(pages: list[tuple[str, str]], *, shrink: float = 0.3, rounds: int = 12) -> Model:
    """From (html, a mark for each element in page order: 1 for content).

    The log odds of an element, given its parent's state, are the sum of its features' weights and of one for the
    parent's kind and state: one ridge-penalised logistic regression, by Newton's method over the distinct elements.
    The features' weights are node potentials; those of a kind, as probabilities of the child's state, are edge potentials.
    """
    at: dict = {}
    seen: dict[tuple, list[int]] = {}
    for page, marks in pages:
        nodes, _ = parse(page)
        for i, n in enumerate(nodes):
            k = (look(n), (kind(nodes[n.parent]), int(marks[n.parent])) if i else None)
            seen.setdefault(k, [0, 0])[marks[i] == "1"] += 1
    rows = [[at.setdefault(k, len(at)) for k in (*_features(*shape), *((above, ("any", above[1])) if above else ()))] for shape, above in seen]
    x = np.zeros((len(rows), len(at)))
    for i, row in enumerate(rows):
        np.add.at(x[i], row, 1)
    counts = np.array(list(seen.values()), float).reshape(-1, 2)
    n, w = counts.sum(1), np.zeros(len(at))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + shrink * np.eye(len(at))
        w += np.linalg.solve(h, x.T @ (counts[:, 1] - n * p) - shrink * w)
    m = Model(node={k: float(w[i]) for k, i in at.items() if isinstance(k, str)})
    weight = lambda k: float(w[at[k]]) if k in at else 0.0
    for k in {k[0] for k in at if not isinstance(k, str)}:
        on = [1 / (1 + math.exp(-weight(("any", s)) - (weight((k, s)) if k != "any" else 0.0))) for s in (0, 1)]
        m.edge[k] = tuple((1 - p, p) for p in on)
    return m


def labelled_pages(n: int = 1600, seed: int = 10) -> list[tuple[str, str]]:
    """Made-up pages, each with a mark for each element in page order: 1 for content."""
    rng = random.Random(seed)
    out = []

    def words(k: int) -> str:
        return " ".join("".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(max(1, k)))

    for _ in range(n):
        html, marks = [], ["0"]

        def el(tag: str, on: int, inner, attrs: str = "") -> None:
            html.append(f"<{tag}{' ' + attrs if attrs else ''}>")
            marks.append(str(on))
            inner() if callable(inner) else html.append(inner)
            html.append(f"</{tag}>")

        def links(tag: str, k: int, on: int = 0) -> None:
            el(tag, on, lambda: [el("li", on, lambda: el("a", on, words(rng.randint(1, 3)), 'href="/x"')) for _ in range(k)])

        def button() -> None:
            el("button", 0, words(rng.choice([1, 1, 2])), rng.choice(["", 'type="submit"']))

        def furniture() -> None:
            rng.choice([button, lambda: el("form", 0, lambda: (el("label", 0, words(2)), button())), lambda: el("nav", 0, lambda: [el("a", 0, words(1), 'href="/x"') for _ in range(rng.randint(1, 4))]), lambda: links("nav", rng.randint(1, 5)), lambda: el("form", 0, lambda: (el("label", 0, words(1)), el("p", 0, words(4)) if rng.random() < 0.3 else None)), lambda: el("div", 0, lambda: [el("a", 0, words(1), 'href="/x"') for _ in range(rng.randint(1, 4))], 'class="share"')])()

        def content() -> None:
            if rng.random() < 0.85:
                el(rng.choice(["h1", "h1", "h2"]), 1, words(rng.randint(1, 14)))
            for _ in range(rng.choice([0, 1, 1, 1, 2, 3, 5, 8, 12])):
                x = rng.random()
                if x < 0.72:
                    el("p", 1, lambda: (html.append(words(rng.choice([1, 1, 3, 12, 40, 120]))), [el(rng.choice(["b", "i", "em", "strong", "span", "a", "button"]), 1, words(rng.randint(1, 12))) for _ in range(rng.choice([0, 0, 1, 2]))]))
                elif x < 0.78:
                    el(rng.choice(["h2", "h3", "h4"]), 1, words(4))
                elif x < 0.84:
                    el(rng.choice(["ul", "ol"]), 1, lambda: [el("li", 1, words(rng.choice([1, 4, 12]))) for _ in range(rng.randint(1, 6))])
                elif x < 0.88:
                    el(rng.choice(["blockquote", "pre", "div", "figure", "section"]), 1, lambda: el("p", 1, words(20)) if rng.random() < 0.5 else html.append(words(15)))
                elif x < 0.895:
                    el("figure", 1, lambda: el("figcaption", 1, words(rng.choice([3, 8, 15]))))
                elif x < 0.91:
                    el("table", 1, lambda: [el("tr", 1, lambda: [el("td", 1, words(2)) for _ in range(3)]) for _ in range(2)])
                elif x < 0.925:
                    furniture()
                elif x < 0.95:
                    el(rng.choice(["div", "aside"]), 0, words(rng.choice([4, 12, 25])), f'class="{rng.choice(["ad", "ads", "advert", "promo", "related", "share", "newsletter", "notice", "sponsored", "social"])}"')
            if rng.random() < 0.3:
                for _ in range(rng.randint(1, 4)):
                    furniture()
            if rng.random() < 0.25:  # sources and further reading
                if rng.random() < 0.6:
                    el(rng.choice(["h2", "h3", "p"]), 1, words(rng.randint(1, 3)))
                el(rng.choice(["ul", "ol", "ul", "p", "div"]), 1, lambda: [rng.choice([lambda: el("li", 1, lambda: el("a", 1, words(rng.randint(1, 6)), 'href="/x"')), lambda: el("li", 1, lambda: (html.append(words(rng.randint(1, 6))), el("a", 1, words(rng.randint(1, 6)), 'href="/x"')))])() for _ in range(rng.randint(1, 7))])
            if rng.random() < 0.3:
                comments()

        def comments() -> None:
            el(rng.choice(["div", "section", "ul", "ol"]), 0, lambda: [el(rng.choice(["div", "div", "div", "p", "p", "p", "li", "li", "li", "article"]), 0, lambda: (el("p", 0, words(rng.choice([2, 10, 30]))), html.append(words(2))), rng.choice(['class="comment"', 'class="reply"', ""])) for _ in range(rng.randint(1, 4))], rng.choice(['class="comments"', 'id="comments"', 'class="comment list"']))

        def remarks() -> None:
            """Comments of readers that nothing names: boxes alike, each a name and a short text."""
            tag = rng.choice(["div", "div", "li"])
            one = lambda: el(tag, 0, lambda: (el(rng.choice(["b", "strong", "span", "p", "h4"]), 0, words(rng.randint(1, 2))), el(rng.choice(["p", "p", "div"]), 0, words(rng.choice([3, 8, 15, 30]))), button() if rng.random() < 0.3 else None), rng.choice(["", 'id="r1"', 'class="item"']))
            el("ol" if tag == "li" else rng.choice(["div", "section"]), 0, lambda: (el(rng.choice(["h3", "h2"]), 0, words(rng.randint(1, 3))) if rng.random() < 0.5 else None, [one() for _ in range(rng.randint(2, 6))]), rng.choice(['id="respond"', 'id="thread"', 'class="talk"', ""]))

        def rail() -> None:
            """A side column that nothing names: links, or short boxes."""
            el("div", 0, lambda: [rng.choice([lambda: links("ul", rng.randint(2, 7)), lambda: el("p", 0, lambda: el("a", 0, words(3), 'href="/x"')), lambda: (el("h3", 0, words(2)), el("p", 0, words(rng.choice([3, 8])))), lambda: el("div", 0, lambda: el("a", 0, words(2), 'href="/x"'))])() for _ in range(rng.randint(1, 4))], rng.choice(['id="rail"', 'id="left"', 'class="col"', ""]))

        def columns() -> None:
            """The article in the middle of plain columns, or of a table's cells."""
            if rng.random() < 0.4:
                body_of = lambda: (rail() if rng.random() < 0.6 else None, el("div", 1, content, rng.choice(['id="main-content"', 'class="content"', 'id="main"', 'id="article"'])), rail() if rng.random() < 0.6 else None)
                el("div", 0, body_of, rng.choice(["", 'id="page"', 'class="wrap"']))
            else:
                cell = lambda: el("td", 0, lambda: [rng.choice([lambda: el("a", 0, words(2), 'href="/x"'), lambda: el("p", 0, lambda: el("a", 0, words(2), 'href="/x"'))])() for _ in range(rng.randint(2, 8))])
                row = lambda: el("tr", 0, lambda: (cell() if rng.random() < 0.8 else None, el("td", 1, content), cell() if rng.random() < 0.3 else None))
                el("table", 0, row if rng.random() < 0.5 else lambda: el("tbody", 0, row))

        def box(tag: str, hint: str) -> None:
            el(tag, 0, lambda: rng.choice([lambda: html.append(words(rng.choice([2, 8, 20]))), lambda: links("ul", rng.randint(1, 7)), lambda: el("p", 0, words(rng.choice([3, 15]))), lambda: (el("h3", 0, words(2)), el("p", 0, words(12)))])(), f'class="{hint}"' if hint else "")

        def around(before: bool, enclosed: bool = False) -> None:
            if before:
                if rng.random() < 0.75:
                    el("nav", 0, lambda: links("ul", rng.randint(2, 9)))
                if rng.random() < 0.5:
                    el("header", 0, lambda: (el("h1" if rng.random() < 0.3 else "p", 0, words(3)), el("a", 0, words(1))), rng.choice(["", 'class="header"', 'id="masthead"']))
            for _ in range(rng.choice([0, 1, 2])):
                box(rng.choice(["div", "div", "aside", "section"]), rng.choice(["ad", "ads", "advert", "banner", "sidebar", "menu", "breadcrumb", "cookie notice", "promo", "widget", "popup", "consent", "related", "newsletter", "side", "disclaimer"]))
            if rng.random() < 0.2:
                el("form", 0, lambda: (el("label", 0, words(2)), el("p", 0, words(5))))
            if not before:
                if rng.random() < 0.3:
                    comments()
                elif enclosed and rng.random() < 0.25:
                    remarks()
                if rng.random() < 0.8:
                    el("footer", 0, lambda: (html.append(words(rng.choice([3, 12, 25]))), el("p", 0, words(6)) if rng.random() < 0.4 else None), rng.choice(["", 'class="footer"']))

        def body() -> None:
            around(True)
            tag, attrs = rng.choice([("article", ""), ("article", ""), ("article", ""), ("article", ""), ("article", 'class="post"'), ("div", 'class="content"'), ("div", 'id="article"'), ("div", 'class="entry content"'), ("main", ""), ("section", 'class="story"')])
            wrap = rng.random()
            if rng.random() < 0.35:
                columns()
            elif wrap < 0.2:
                el("main" if tag != "main" else "div", 0, lambda: el(tag, 1, content, attrs))
            elif wrap < 0.35:
                el("div", 0, lambda: (el(tag, 1, content, attrs), box("aside", "sidebar")), rng.choice(['class="container"', ""]))
            else:
                el(tag, 1, content, attrs)
            around(False, enclosed=True)

        def flat(tag: str, on: int) -> None:
            """An article that no element of its own encloses."""
            el(tag, on, lambda: (around(True) if rng.random() < 0.6 else None, content(), around(False) if rng.random() < 0.6 else None))

        def bare() -> None:
            for _ in range(rng.choice([1, 1, 2, 4])):
                html.append(words(rng.choice([3, 12, 40, 120])))
                html.append(rng.choice(["", "<br>", "<br><br>"]))
                if rng.random() < 0.3:
                    el(rng.choice(["b", "i", "a", "em", "p"]), 1, words(rng.randint(1, 12)))

        x = rng.random()
        if x < 0.12:  # a fragment
            rng.choice([body, lambda: el("article", 1, content)])()
        elif x < 0.18:  # text with hardly any markup
            marks[0] = "1"
            bare()
        elif x < 0.28:
            rng.choice([lambda: flat("div", 1), lambda: flat("body", 0), lambda: el("html", 0, lambda: (el("head", 0, lambda: el("title", 0, words(5))), flat("body", 0)))])()
        elif x < 0.34:
            shape = rng.random()
            el("html", 0, lambda: (el("head", 0, lambda: el("title", 0, words(5))) if rng.random() < 0.8 else None, el("body", 1, lambda: (around(True) if shape < 0.4 else None, bare(), around(False) if shape < 0.4 else None))))
        else:
            el("html", 0, lambda: (el("head", 0, lambda: el("title", 0, words(5))), el("body", 0, body)))
        out.append(("".join(html), "".join(marks)))
    return out


def extract(page: str | None, model: Model, least: float = 0.5) -> str:
    if not page:
        return ""
    nodes, events = parse(page)
    content = [p > least for p in model.marginals(nodes)]
    blocks, part = [], []
    for i, text in [*events, (0, None)]:
        if text is None:
            if part:
                block = " ".join(_html.unescape("".join(part)).split())
                if block:
                    blocks.append(block)
                part = []
        elif content[i]:
            part.append(text)
    return "\n".join(blocks)


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text and n_chars for each row of pages (page_id, url, html)."""
    model = train(labelled_pages()) if model is None else model

    def run(texts: list) -> list[pa.Array]:
        out = [extract(t, model) for t in texts]
        return [pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())]

    out, names = annotate(pages.select("page_id", "url", "html"), "html", run, [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return out.select("page_id", "url", F.col(names[0]).alias("text"), F.col(names[1]).alias("n_chars"))
