"""Main text of web pages by minimum cut: classifier costs against smoothness between neighbouring blocks.

A page is cut into blocks at block-level tags. Each block gets a score from its place (article or main; menus, headers, footers,
sidebars, notices, adverts, forms, comments, told by tag, role, class or id of it or an element around it), its share of linked
text, its length and its sentence marks. The score is its capacity to the source (content) or the sink (the rest). Neighbours
in reading order are joined by edges that weaken with the elements that lie between them, and so are successive blocks of one
element. A maximum flow gives the cheapest cut, and its source side is the main text; of several cheapest cuts the one with the
least text is taken.

Tags such as nav, footer and aside exclude all within them. Classes, ids and roles, and forms, only cost ``NAMED``, until an
article or main within them begins. One that holds two thirds of the page's text, and of what lies in articles and the like, is
a wrapper round the page ('layout-with-sidebar'): it costs less the more it holds, and good names within it count.

Character references are decoded; white space in a block becomes one blank; blocks are joined by line feeds. Scripts, styles,
comments and other markup are no text. An unclosed comment or script runs to the end of the page, as in a browser.

Defined results: null and empty html give an empty text, and so does a page whose cut leaves nothing. Every row gives one row,
repeated rows give equal ones, and a long page takes time nearly in proportion to its length. Other columns pass through; columns named
``text`` and ``n_chars`` are replaced.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html import unescape
from itertools import pairwise

from pyspark.sql import DataFrame

from claimlake.llm.common import arrow_extend

# A quote opens a value only behind "="; an unquoted value ends at a blank or ">". Possessive, so linear in the tag.
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9-]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9-]*+)([^>]*+)>")
_NO_TEXT = frozenset("script style noscript template svg iframe object textarea select button canvas title".split())
_NO_TEXT_ENDS = {name: re.compile(rf"</{name}\s*+>", re.I) for name in _NO_TEXT}
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr br label input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
GOOD = frozenset("article main".split())
BAD = frozenset("nav header footer aside dialog menu head".split())
FORMS = frozenset("form fieldset".split())
BAD_NAMES = frozenset(
    "nav navbar navigation menu menus header masthead topbar footer sidebar aside widget widgets ad ads advert adverts advertisement advertising "
    "sponsor sponsored promo promotion banner cookie cookies consent notice notices gdpr popup modal overlay form login signup subscribe newsletter "
    "comment comments disqus reply replies share sharing social related recommended breadcrumb breadcrumbs pagination pager toolbar copyright".split()
)
GOOD_NAMES = frozenset("article content main post entry story body text".split())
HARD, NAMED, SMOOTH, WRAPS, TINY = 1_000.0, 4.0, 1.5, 2 / 3, 1e-9


class _Element:
    __slots__ = ("chars", "cost", "depth", "good", "good_chars", "hard", "kind", "named", "owner", "tag", "within")

    def __init__(self, tag: str, attributes: str, owner: _Element | None):
        self.tag, self.owner = tag, owner
        self.depth = owner.depth + 1 if owner else 0
        names: set[str] = set()
        for m in _ATTRIBUTE.finditer(attributes) if "=" in attributes else ():
            names.update(_NAME.findall((m[2] or m[3] or m[4] or "").lower()))
        bad = tag in BAD
        if tag == "header" and owner and owner.within:
            bad = False  # an article's own header holds its heading
        self.hard = bad or bool(owner and owner.hard)
        self.named = tag not in ("body", "html", "main") and (tag in FORMS or bool(names & BAD_NAMES))
        self.kind = 2 if tag in GOOD else 1 if names & GOOD_NAMES and tag not in ("body", "html") else 0
        # within: 1 in an article by name or by tag, as far as can be told before the texts are known
        self.within = int(self.kind > 0 and not self.named) or (owner.within if owner and not self.named else 0)
        self.good, self.cost, self.chars, self.good_chars = 0, 0.0, 0, 0

    def settle(self, chars: int, good_chars: int) -> None:
        """``good`` (-1: within an element of another kind; 1 or 2: within an article, by name or by tag) and ``cost``."""
        owner = self.owner
        if self.hard:
            self.good = -1
            return
        inside, cost = (owner.good, owner.cost) if owner else (0, 0.0)
        kind = self.kind
        if self.named:
            wraps = self.chars >= WRAPS * chars and self.good_chars >= WRAPS * good_chars
            cost = max(cost, NAMED * (1 - self.chars / chars) if wraps and chars else NAMED)
            if not wraps:
                inside = kind = 0
        elif kind == 2:
            cost = 0.0
        elif cost >= NAMED:
            kind = 0  # a comment's text is no article
        self.good, self.cost = max(inside, kind), cost


def marks(html: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, whether it closes, attributes) of every piece of markup; comments and elements without text have no name.

    A "<" that begins no markup, or whose tag does not end, is text. Every character is looked at a few times only: an unclosed
    quote or tag is met once, then tags are taken to their next ">".
    """
    last, tag, at = html.rfind(">"), _TAG, 0
    while (at := html.find("<", at)) >= 0:
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            end = len(html) if end < 0 else end + 3
            yield at, end, "", False, ""
            at = end
            continue
        if at > last:
            at += 1
            continue
        if html.startswith(("<!", "<?"), at):
            end = html.index(">", at) + 1
            yield at, end, "", False, ""
            at = end
            continue
        found = tag.match(html, at)
        if found is None and tag is _TAG and html[at + 1 : at + 2].isalpha():
            tag = _PLAIN_TAG
            found = tag.match(html, at)
        if found is None:
            at += 1
            continue
        end, name = found.end(), found[2].lower()
        if name in _NO_TEXT and not found[1] and not (name == "svg" and found[3].endswith("/")):
            closing = _NO_TEXT_ENDS[name].search(html, end)
            end = closing.end() if closing else len(html)
            yield at, end, "", False, ""
        else:
            yield at, end, name, bool(found[1]), found[3]
        at = end


def blocks(html: str) -> list[tuple[str, int, str, _Element]]:
    """(text, characters in links, tag, element) of every block with text, in page order."""
    found: list[tuple[str, int, str, _Element]] = []
    stack = [_Element("", "", None)]
    made = stack[:]  # owners first
    parts: list[str] = []
    linked, in_link, tag = 0, 0, ""

    def close() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((unescape(raw) if "&" in raw else raw).split())
            if text:
                found.append((text, min(linked, len(text)), tag, stack[-1]))
            parts.clear()
        linked = 0

    at, opened = 0, Counter()
    for start, end, name, closes, attributes in marks(html):
        if start > at:
            piece = html[at:start]
            parts.append(piece)
            if in_link:
                linked += len(piece)
        at = end
        if not name:
            continue
        if name in INLINE:
            if name == "a":
                in_link = 0 if closes else 1
            elif name == "br":
                parts.append(" ")
            continue
        close()
        in_link = 0
        if closes:
            if opened[name]:
                while (left := stack.pop().tag) != name:
                    opened[left] -= 1
                opened[name] -= 1
            tag = stack[-1].tag
        else:
            if name in ("p", "h1", "h2", "h3", "h4", "h5", "h6") and stack[-1].tag == "p":
                stack.pop()
                opened["p"] -= 1
            tag = name
            if name not in VOID:
                stack.append(_Element(name, attributes, stack[-1]))
                opened[name] += 1
                made.append(stack[-1])
    if at < len(html):
        parts.append(html[at:])
    close()
    for text, _, _, element in found:
        if not element.hard:
            element.chars += len(text)
            element.good_chars += len(text) if element.within else 0
    for element in reversed(made[1:]):
        element.owner.chars += element.chars
        element.owner.good_chars += element.good_chars
    chars, good_chars = made[0].chars, made[0].good_chars
    for element in made:
        element.settle(chars, good_chars)
    return found


def score(text: str, linked: int, tag: str, element: _Element) -> float:
    """Above 0: rather content; its size is the cost of the other label."""
    if element.good < 0:
        return -HARD
    share = linked / len(text)
    words = text.count(" ") + 1
    value = (0.0, 2.0, 4.0)[element.good] - 4.0 * share
    value += min(2.0, words / 20) - element.cost
    if text[-1] in ".!?…\"”»:":
        value += 0.5
    if tag in ("p", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6"):
        value += 0.5
    if tag in ("li", "td", "th", "dt", "dd"):
        value -= 0.5
    if words < 4 and not element.good:
        value -= 1.0
    return value - 1.0


def _between(a: _Element, b: _Element) -> int:
    """Elements to climb from one to the other."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.owner
        else:
            b = b.owner
        steps += 1
    return steps


def minimum_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> set[int]:
    """Nodes on the source side of the smallest cheapest cut; edges carry their capacity both ways.

    A node whose terminal capacity outweighs all its edges is on that terminal's side in every cheapest cut. It is settled first,
    its edges become terminal capacity of its neighbours, and so on; most of a page ends there. The maximum flow through the rest
    is found in phases of shortest paths, each phase with one search and one pass over the edges.
    """
    n = len(source)
    room: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, capacity in edges:
        room[a][b] = room[a].get(b, 0.0) + capacity
        room[b][a] = room[b].get(a, 0.0) + capacity
    pull = [s - t for s, t in zip(source, sink, strict=True)]  # above 0: what the source has more to give than the sink takes
    weight = [sum(around.values()) for around in room]
    side: list[bool | None] = [None] * n
    due = list(range(n))
    while due:
        a = due.pop()
        if side[a] is not None or -pull[a] < weight[a] >= pull[a] - TINY:
            continue
        side[a] = pull[a] > weight[a] + TINY
        for b, capacity in room[a].items():
            del room[b][a]
            weight[b] -= capacity
            pull[b] += capacity if side[a] else -capacity
            due.append(b)
        room[a] = {}
    rest = [i for i in range(n) if side[i] is None]
    left = {i: pull[i] for i in rest if pull[i] > TINY}
    free = {i: -pull[i] for i in rest if pull[i] < -TINY}
    while True:
        level = dict.fromkeys(left, 0)
        queue, reached, goal = deque(left), [], False
        while queue:
            a = queue.popleft()
            if goal and level[a] > level[reached[0]]:
                break
            if a in free:
                goal = True
                reached.append(a)
            for b, capacity in room[a].items():
                if capacity > TINY and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if not goal:
            return {i for i in range(n) if side[i]} | set(level)
        _saturate(room, level, left, free)


def _saturate(room: list[dict[int, float]], level: dict[int, int], left: dict[int, float], free: dict[int, float]) -> None:
    """Send all flow that paths along rising levels can take; an edge found useless is not tried again."""
    ways = {}
    for start in list(left):
        path = [start]
        while path:
            a = path[-1]
            if a in free:
                flow = min(free[a], left[start], *(room[x][y] for x, y in pairwise(path)))
                for x, y in pairwise(path):
                    room[x][y] -= flow
                    room[y][x] += flow
                for terminal, node in ((left, start), (free, a)):
                    terminal[node] -= flow
                    if terminal[node] <= TINY:
                        del terminal[node]
                if start not in left:
                    break
                path = [start]
                continue
            way = ways.setdefault(a, list(room[a]))
            while way and not (room[a][way[-1]] > TINY and level.get(way[-1], -1) == level[a] + 1):
                way.pop()
            if way:
                path.append(way[-1])
            else:
                path.pop()
                if path:
                    ways[path[-1]].pop()


def main_text(html: str | None) -> str:
    found = blocks(html or "")
    if not found:
        return ""
    scores = [score(*block) for block in found]
    edges, latest = [], {}
    for i, (_, _, _, element) in enumerate(found):
        parent = element.owner
        if i:
            edges.append((i - 1, i, SMOOTH / (1 + _between(found[i - 1][3], element))))
        if parent is not None:
            if id(parent) in latest and latest[id(parent)] != i - 1:
                edges.append((latest[id(parent)], i, SMOOTH / 3))
            latest[id(parent)] = i
    kept = minimum_cut([max(s, 0.0) for s in scores], [max(-s, 0.0) for s in scores], edges)
    return "\n".join(found[i][0] for i in sorted(kept))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``, its code points."""

    def work(batch: dict) -> dict:
        texts = [main_text(h) for h in batch[html]]
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    return arrow_extend(pages, [html], work, "text string, n_chars long")
