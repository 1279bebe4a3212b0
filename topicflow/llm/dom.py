"""A lenient reading of HTML into a tree of blocks, and the features of its nodes."""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from dataclasses import dataclass, field

#: Elements that stand inside a block of text (fixed values, as the next five).
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
LANDMARKS = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT = frozenset("script style template noscript iframe svg math object canvas audio video select datalist".split())
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
#: What an element of this name ends when it starts inside it.
ENDS = {
    **dict.fromkeys(("li",), ("li",)), **dict.fromkeys(("dt", "dd"), ("dt", "dd")),
    **dict.fromkeys(("td", "th"), ("td", "th")), "tr": ("tr", "td", "th"), "option": ("option",),
}
_KEEPS_P = INLINE | VOID | {"li", "dt", "dd", "td", "th", "tr", "option", "body", "html"}
_HOLDERS = frozenset("ul ol dl table tbody thead tfoot select".split())

_HEAD = re.compile(r"<(?:(!--)|([!?])|(/?)([A-Za-z][^\s/>]*))")
_UNQUOTED = re.compile(r"[^>\"']*")
_HINTS = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Node:
    """An element that is no part of a line, or a run of text (``tag`` is ``#text``)."""

    tag: str
    tokens: tuple[str, ...]
    parent: int
    depth: int
    children: list[int] = field(default_factory=list)
    text: str = ""
    linked: int = 0
    controls: int = 0


class _Ends:
    """Ends of tags, asked from left to right. What is missing once is not searched again, so that all
    searches of a page together read it a few times at most."""

    def __init__(self, page: str):
        self.page, self.quoting, self.missing = page, True, set()

    def _find(self, what: str, at: int) -> int:
        if what in self.missing:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def of_tag(self, start: int) -> int:
        """Where the tag whose attributes begin at ``start`` ends (its ``>``), the page's end if nowhere.

        A quote that is not closed is a plain character. If all ``>`` to the page's end stand in quotes, quotes
        mean nothing from here on.
        """
        at = start
        while self.quoting:
            at = _UNQUOTED.match(self.page, at).end()
            if at == len(self.page):
                self.quoting = False
            elif self.page[at] == ">":
                return at
            else:
                at = max(at, self._find(self.page[at], at + 1)) + 1
        return self.plain(start)

    def plain(self, start: int, what: str = ">") -> int:
        found = self._find(what, start)
        return len(self.page) if found < 0 else found

    def of_content(self, name: str, start: int) -> int:
        """Where the end tag of an element begins whose content is no markup; -1 if nowhere."""
        if name in self.missing:
            return -1
        found = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(self.page, start)
        if found is None:
            self.missing.add(name)
        return found.start() if found else -1


def parse(page: str) -> list[Node]:
    """Nodes in page order, the root first. Runs of text are leaves; nothing fails on bad markup.

    Time is in proportion to the page whatever is unclosed or nested: ends of tags are searched by ``_Ends``, and
    open elements are found by name. A tag that the page's end cuts off is markup.
    """
    nodes = [Node("#root", (), -1, 0)]
    stack, names = [0], ["#root"]
    opened: dict[str, list[int]] = {}  # depths of the open elements of a name
    run: list[str] = []
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                parent = stack[-1]
                nodes.append(Node("#text", (), parent, nodes[parent].depth + 1, text=text, linked=linked))
                nodes[parent].children.append(len(nodes) - 1)
            run.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        run.append(text)
        if in_link:
            linked += len(text)

    def close(depth: int) -> None:
        flush()
        for name in names[depth:]:
            opened[name].pop()
        del stack[depth:], names[depth:]

    def deepest(some) -> int:
        return max((opened[n][-1] for n in some if opened.get(n)), default=0)

    ends, at, end = _Ends(page), 0, len(page)
    while at < end:
        start = ends.plain(at, "<")
        if start > at:
            say(page[at:start])
        if start == end:
            break
        tag = _HEAD.match(page, start)
        if tag is None:
            say("<")
            at = start + 1
            continue
        if tag[1] or tag[2]:
            at = ends.plain(start + 2, "-->") + 3 if tag[1] else ends.plain(start) + 1
            continue
        name, at = tag[4].lower(), ends.of_tag(tag.end()) + 1
        attributes = page[tag.end() : at - 1]
        if tag[3]:
            if name == "a":
                in_link = False
            elif name not in INLINE and opened.get(name):
                close(opened[name][-1])
            elif name not in INLINE:
                flush()
            continue
        if name in RAW or name in SILENT:
            if name == "textarea" or name == "select":
                nodes[stack[-1]].controls += 1
            if name in RAW or not attributes.endswith("/"):
                ended = ends.of_content(name, at)
                if ended >= 0:
                    at = ends.plain(ended) + 1
                elif name in RAW:
                    break
            continue
        if name in INLINE:
            if name == "br":
                say(" ")
            elif name == "a":
                in_link = True
            continue
        if name in VOID:
            if name == "input":
                nodes[stack[-1]].controls += 1
            elif name == "hr":
                flush()
            continue
        flush()
        in_link = False
        if name == "button":
            nodes[stack[-1]].controls += 1
        if name in ENDS:
            holder = deepest(_HOLDERS)
            inside = [opened[n][bisect_right(opened[n], holder)] for n in ENDS[name] if deepest((n,)) > holder]
            if inside:
                close(min(inside))
        if name not in _KEEPS_P and deepest(("p",)) > deepest(("td", "th", "li", "div")):
            close(opened["p"][-1])
        hints = [x for m in _HINTS.finditer(attributes) for x in m.groups() if x] if attributes else []
        tokens = tuple(dict.fromkeys(t.lower() for h in hints for t in _TOKEN.findall(h)))
        parent = stack[-1]
        nodes.append(Node(name, tokens, parent, nodes[parent].depth + 1))
        nodes[parent].children.append(len(nodes) - 1)
        opened.setdefault(name, []).append(len(names))
        stack.append(len(nodes) - 1)
        names.append(name)
    flush()
    return nodes


_STOPS = re.compile(r"[.,;:!?。、，]")

FEATURES = (
    "tag tokens_low tokens_high above_low above_high parent_tag depth leaf chars linked density stops words_a_leaf "
    "leaves siblings place same_tag share_of_siblings before after parent_linked parent_chars position share_of_page "
    "controls controls_above marks landmark"
).split()


def features(nodes: list[Node], tag_odds: dict[str, float], token_odds: dict[str, float]) -> list[list[float]]:
    """A row of ``FEATURES`` for each node: its tag and attribute tokens as odds learned from pages,
    its subtree's text, links and density, its siblings, and what stands above it."""
    n = len(nodes)
    chars, linked, stops, words, leaves, size, controls = ([0.0] * n for _ in range(7))
    for i in range(n - 1, -1, -1):
        x = nodes[i]
        size[i] += 1
        controls[i] += x.controls
        if x.text:
            chars[i], linked[i] = float(len(x.text)), float(min(x.linked, len(x.text)))
            stops[i], words[i], leaves[i] = float(len(_STOPS.findall(x.text))), float(x.text.count(" ") + 1), 1.0
        if x.parent >= 0:
            p = x.parent
            for total in (chars, linked, stops, words, leaves, size, controls):
                total[p] += total[i]
    whole = max(1.0, chars[0])
    low, high, form, inside = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    outside = -float(any(x.tag in LANDMARKS for x in nodes))  # of a page that has one
    out, passed = [], 0.0
    for i, x in enumerate(nodes):
        own = [token_odds[t] for t in x.tokens if t in token_odds]
        tag = tag_odds.get(x.tag, 0.0)
        own_low, own_high = (min(own), max(own)) if own else (0.0, 0.0)
        p = max(x.parent, 0)
        above_low, above_high = (low[p], high[p]) if x.parent >= 0 else (0.0, 0.0)
        low[i], high[i] = min(above_low, own_low, tag), max(above_high, own_high, tag)
        form[i] = max(form[p] if x.parent >= 0 else 0.0, float(x.tag == "form"), float(x.controls > 0))
        inside[i] = 1.0 if x.tag in LANDMARKS or (x.parent >= 0 and inside[p] > 0) else outside
        family = nodes[p].children if x.parent >= 0 else [i]
        out.append(
            [
                tag, own_low, own_high, above_low, above_high, tag_odds.get(nodes[p].tag, 0.0), float(x.depth),
                float(bool(x.text)), math.log1p(chars[i]), linked[i] / max(1.0, chars[i]), chars[i] / size[i],
                stops[i] / max(1.0, words[i]), words[i] / max(1.0, leaves[i]), leaves[i], float(len(family)), 0.0, 0.0,
                chars[i] / max(1.0, chars[p]), 0.0, 0.0, linked[p] / max(1.0, chars[p]), math.log1p(chars[p]),
                passed / whole, chars[i] / whole, controls[i], form[i],
                float(any(c in x.text for c in "©|»›·•")) if x.text else 0.0, inside[i],
            ]
        )
        passed += len(x.text)
    place, same, before, after = (FEATURES.index(k) for k in ("place", "same_tag", "before", "after"))
    for x in nodes:
        family = x.children
        if not family:
            continue
        counts: dict[str, int] = {}
        for c in family:
            counts[nodes[c].tag] = counts.get(nodes[c].tag, 0) + 1
        last = 0.0
        for k, c in enumerate(family):
            row = out[c]
            row[place], row[same], row[before] = k / len(family), counts[nodes[c].tag] / len(family), last
            last = math.log1p(chars[c])
            if k:
                out[family[k - 1]][after] = last
    return out


def decode(nodes: list[Node], keep: list[float], drop: list[float]) -> list[str]:
    """Blocks of the best consistent choice, in page order.

    ``keep`` and ``drop`` are log-probabilities of a node's holding main text or none. A node without main
    text has no descendant with any; among such choices the one of largest sum is taken, bottom up.
    """
    without, within = drop.copy(), keep.copy()
    for i in range(len(nodes) - 1, 0, -1):
        p = nodes[i].parent
        without[p] += without[i]
        within[p] += max(within[i], without[i])
    chosen = [True] * len(nodes)
    for i in range(1, len(nodes)):
        chosen[i] = chosen[nodes[i].parent] and within[i] >= without[i]
    return [x.text for i, x in enumerate(nodes) if x.text and chosen[i]]
