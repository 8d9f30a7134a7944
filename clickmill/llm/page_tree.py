"""HTML pages as trees of block elements and texts, and union-free expressions over them."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from zlib import crc32

#: Elements whose text belongs to the block around them.
INLINE = frozenset((
    "a abbr acronym b bdi bdo big blink center cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle mpadded msub msup msubsup munder mover munderover mtable mtr mtd "
    "semantics").split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style noscript template textarea title iframe noframes xmp svg annotation".split())
#: An element that ends when one of these begins, up to the container that holds both.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "tfoot": ({"tr", "td", "th", "tbody"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
#: Furniture by element and by words in class, id or role.
FURNITURE = frozenset((
    "nav footer aside form script style noscript template iframe button select textarea head title svg canvas "
    "object menu dialog input noframes annotation xmp").split())
FURNITURE_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer footer header menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted "
    "related reply replies search share sharing sidebar social sponsor sponsored subscribe toolbar widget masthead").split())
#: Words that may stand beside those in one name of a class, as in `comment-list`; `related-work` or `notice-period` tell nothing.
BESIDE = frozenset((
    "area article articles bar block bottom box button buttons container content form global group inner item items left link "
    "links list main outer page post posts primary right secondary section site slot stories top unit wrap wrapper").split())
CONTENT = frozenset("article main".split())
#: Elements that can be a region of a wrapper, and headings that no region of furniture holds.
BOXES = frozenset("details div fieldset figure ol section span ul".split())
TITLES = ("h1", "h2")
#: Pages of a host from which its wrapper tells furniture from content.
MANY = 4
#: Depth of the tree, and of open elements that are remembered.
DEEPEST = 60
OPEN = 240
#: Parts of one level of a wrapper; a level of more is free: it says nothing about what stands there.
MOST = 512
#: Cells of an alignment table; larger stretches are first cut at labels that occur once in both.
CELLS = 1 << 14

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_TAG_END = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_END_OR_QUOTE = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")


class Node:
    """An element: its label (element, then words of class, id and role), whether it is furniture, or only named like it
    inside content, where the wrapper decides, and its kids."""

    __slots__ = ("furniture", "kids", "label", "named", "said", "tag")

    def __init__(self, tag: str, label: str, furniture: bool, named: bool = False):
        self.tag, self.label, self.furniture, self.named, self.kids = tag, label, furniture, named, []
        self.said: tuple[int, int] | None = None


def _tells(value: str) -> bool:
    """Whether a class, id or role has a name that says furniture."""
    for name in value.split():
        words = _WORD.findall(name)
        if not FURNITURE_WORDS.isdisjoint(words) and all(w in FURNITURE_WORDS or w in BESIDE for w in words):
            return True
    return False


class _Tags:
    """Where tags end, in time linear in the page: at the first `>` outside quotes, or at the first `>` of all if a quote stays open."""

    def __init__(self, page: str):
        self.page, self.last, self.known = page, page.rfind(">"), None

    def end(self, at: int) -> int:
        """Place after the `>` of the tag whose name ends at `at`; at <= last."""
        if self.known is None:
            m = _TAG_END.match(self.page, at)
            if m:
                return m.end()
            self._scan()
        places, ends = self.known
        k = bisect_left(places, at)
        return ends[k] if k < len(places) and ends[k] else self.page.find(">", at) + 1

    def _scan(self) -> None:
        places = [m.start() for m in _END_OR_QUOTE.finditer(self.page)]
        ends, following = [0] * len(places), {}
        for k in range(len(places) - 1, -1, -1):
            sign = self.page[places[k]]
            if sign == ">":
                ends[k] = places[k] + 1
            else:
                close = following.get(sign)
                if close is not None and close + 1 < len(places):
                    ends[k] = ends[close + 1]
                following[sign] = k
        self.known = places, ends


def _element(tag: str, attributes: str, in_content: bool) -> Node:
    words, hidden, tells = [], False, False
    if attributes.strip(" /\n\t\r"):
        for name, *values in _ATTRIBUTE.findall(attributes):
            value, name = "".join(values).lower(), name.lower()
            if name in ("class", "id", "role"):
                words += _WORD.findall(value)
                tells = tells or _tells(value)
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                hidden = True
    label = ".".join([tag, *sorted(set(words)), *(["hidden"] if hidden else [])])
    bad = hidden or tag in FURNITURE or tag == "header" and not in_content
    named = tells and tag != "body" and not bad
    return Node("main" if "main" in words and "content" in words or words == ["main"] else tag, label, bad or named and (not in_content or tag in INLINE), named)


def parse(page: str) -> Node:
    """The tree of a page, in one pass.

    Elements nested deeper than DEEPEST belong to the one at that depth. A `<` that no `>` follows is text; a
    comment without an end takes the rest of the page.
    """
    root = Node("", "", False)
    stack: list[tuple[str, Node]] = [("", root)]
    at, size = 0, len(page)
    in_content = 0
    tags = _Tags(page)
    last = max(tags.last, page.rfind("<!"), page.rfind("<?"))
    texts: list[list] = []
    opened, beyond = Counter(), Counter()

    def say(text: str) -> None:
        if text:
            kids = stack[-1][1].kids
            link = any(tag == "a" for tag, _ in stack[-4:])
            if kids and kids[-1].__class__ is list:
                kids[-1][0].append(text)
                kids[-1][1] &= link or not text.strip()
            else:
                kids.append([[text], link])
                texts.append(kids[-1])

    def push(tag: str, node: Node) -> None:
        stack.append((tag, node))
        opened[tag] += 1

    def pop() -> None:
        nonlocal in_content
        tag, _ = stack.pop()
        opened[tag] -= 1
        in_content -= tag in CONTENT

    start = 0  # of text not said yet
    while at < size:
        here = page.find("<", at)
        if here < 0:
            break
        sign = page[here + 1:here + 2]
        m = None
        if sign == "!" or sign == "?":
            mark = "-->" if page.startswith("<!--", here) else ">"
            close = page.find(mark, here + (4 if mark == "-->" else 2))
            after = close + len(mark) if close >= 0 else size
        else:
            m = _NAME.match(page, here) if here < tags.last else None
            if m is None or m.end() > tags.last:
                at = here + 1
                if here > last:
                    break
                continue
            after = tags.end(m.end())
        if here > start:
            say(html.unescape(page[start:here]))
        start = at = after
        if m is None:
            continue
        tag = m[1].lower()
        if sign == "/":
            if beyond[tag]:
                beyond[tag] -= 1
            elif opened[tag]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        while len(stack) > k:
                            pop()
                        break
                    if tag in INLINE and stack[k][0] not in INLINE:
                        break
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b", re.I).search(page, at)
            at = page.find(">", close.end()) + 1 if close else 0
            start = at = at or size
            continue
        if tag == "br" or tag == "wbr":
            say(" " if tag == "br" else "")
            continue
        node = _element(tag, page[m.end():after - 1], bool(in_content))
        if tag in VOID:
            if tag == "hr":
                stack[-1][1].kids.append(Node("hr", "hr", False))
            continue
        if len(stack) >= OPEN:
            beyond[tag] += 1
            if tag not in INLINE:
                stack[-1][1].kids.append(Node("hr", "hr", False))
            continue
        if tag in INLINE and not node.furniture:
            push(tag, stack[-1][1])
            continue
        if tag not in INLINE:
            # A block ends an open paragraph; list items, cells and the like end their kind.
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    while len(stack) > k:
                        pop()
                    break
                if stack[k][0] not in INLINE:
                    break
            ended, within = CLOSES.get(tag, ((), ()))
            if ended:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in within:
                        break
                    if stack[k][0] in ended:
                        while len(stack) > k:
                            pop()
        deep = len(stack) > DEEPEST and not node.furniture
        parent = stack[-1][1]
        if deep:
            parent.kids.append(Node("hr", "hr", False))  # still ends the block before it
            node = parent
        elif parent.furniture:
            node.furniture = True
            parent.kids.append(node)
        else:
            parent.kids.append(node)
        push(tag, node)
        in_content += tag in CONTENT
    if start < size:
        say(html.unescape(page[start:]))
    for text in texts:
        text[0] = "".join(text[0])
    return root


# A wrapper is a list [label, kids]; a kid is [sign, wrapper] with sign 1, ?, + or *. A text slot has label # (or #a for
# link text) and, in place of kids, the checksum of its text while that is the same everywhere, else None. A repeated
# group of several kids has label ().

_REPEAT = {"1": "+", "?": "*", "+": "+", "*": "*"}
_OPTION = {"1": "?", "?": "?", "+": "*", "*": "*"}


def _both(a: str, b: str) -> str:
    repeated, optional = a in "+*" or b in "+*", a in "?*" or b in "?*"
    return ("*" if optional else "+") if repeated else ("?" if optional else "1")


def expression(node: Node) -> list:
    """Union-free expression of one page: runs of like siblings become repeated groups."""
    kids = []
    for kid in node.kids:
        if kid.__class__ is list:
            if kid[0].strip():
                kids.append(["1", ["#a" if kid[1] else "#", crc32(" ".join(kid[0].split()).encode())]])
        else:
            kids.append(["1", expression(kid)])
    return [node.label, _level(fold(kids))]


def _level(kids: list) -> list:
    return kids if len(kids) <= MOST else [["*", ["*", []]]]


def _free(kids: list) -> bool:
    return len(kids) == 1 and kids[0][1][0] == "*"


def fold(kids: list) -> list:
    """Adjacent kids, or groups of up to four, that are alike become one repeated."""
    for period in (1, 2, 3, 4):
        out: list = []
        i = 0
        while i < len(kids):
            here = kids[i:i + period]
            labels = [k[1][0] for k in here]
            j = i + period
            group = [[s, w] for s, w in here]
            while len(labels) == period and [k[1][0] for k in kids[j:j + period]] == labels:
                group = [[_both(a[0], b[0]), align(a[1], b[1])] for a, b in zip(group, kids[j:j + period])]
                j += period
            if j > i + period and (period == 1 or len(set(labels)) > 1):
                out.append([_REPEAT[group[0][0]], group[0][1]] if period == 1 else ["+", ["()", group]])
                i = j
            else:
                out.append(kids[i])
                i += 1
        kids = out
    return kids


def _key(kid: list) -> str:
    return kid[1][0] if kid[1][0] != "()" else "()" + ",".join(k[1][0] for k in kid[1][1])


def align(a: list, b: list) -> list:
    """Wrapper of both: what only one has becomes optional, unequal texts become a slot."""
    if a[0][:1] == "#":
        return [a[0], a[1] if a[1] == b[1] else None]
    x, y = a[1], b[1]
    if [_key(k) for k in x] == [_key(k) for k in y]:
        return [a[0], [[_both(p[0], q[0]), align(p[1], q[1])] for p, q in zip(x, y)]]
    if _free(x) or _free(y):
        return [a[0], x if _free(x) else y]
    kids: list = []
    i = j = 0
    for p, q in [*_pairs([_key(k) for k in x], [_key(k) for k in y]), (len(x), len(y))]:
        kids += [[_OPTION[s], part] for s, part in x[i:p]]
        kids += [[_OPTION[s], part] for s, part in y[j:q]]
        if p < len(x):
            kids.append([_both(x[p][0], y[q][0]), align(x[p][1], y[q][1])])
        i, j = p + 1, q + 1
    return [a[0], _level(fold(kids))]


def _pairs(x: list, y: list) -> list[tuple[int, int]]:
    """Places of a common subsequence: the longest while its table has at most CELLS cells, else cut at labels that occur once in both."""
    head = 0
    while head < len(x) and head < len(y) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    found = [(k, k) for k in range(head)]
    a, b = x[head:len(x) - tail], y[head:len(y) - tail]
    n, m = len(a), len(b)
    if n * m <= CELLS:
        best = [[0] * (m + 1) for _ in range(n + 1)]
        for i in range(n - 1, -1, -1):
            for j in range(m - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
        i = j = 0
        while i < n and j < m:
            if a[i] == b[j]:
                found.append((head + i, head + j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
    else:
        in_a, in_b = Counter(a), Counter(b)
        at = {label: j for j, label in enumerate(b) if in_b[label] == 1 and in_a[label] == 1}
        i = j = 0
        for p, q in [*_rising([(k, at[label]) for k, label in enumerate(a) if label in at]), (n, m)]:
            if (n, m) != (p - i, q - j):  # without a cut nothing is gained: both stretches stay apart
                found += [(head + i + u, head + j + v) for u, v in _pairs(a[i:p], b[j:q])]
            if p < n:
                found.append((head + p, head + q))
            i, j = p + 1, q + 1
    return found + [(len(x) - k, len(y) - k) for k in range(tail, 0, -1)]


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest subsequence whose second places rise too."""
    ends: list[int] = []
    last: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, q) in enumerate(pairs):
        at = bisect_left(ends, q)
        before[k] = last[at - 1] if at else -1
        ends[at:at + 1], last[at:at + 1] = [q], [k]
    out = []
    k = last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def matched(kids: list, wrapper: list | None) -> list:
    """For each kid (element or text) of a page's element its part of the wrapper and whether all pages have that; None without one."""
    parts = []
    for sign, part in wrapper[1] if wrapper else ():
        for s, p in part[1] if part[0] == "()" else [(sign, part)]:
            parts.append((p[0], p, sign in "1+" and s in "1+"))
    places: dict[str, list[int]] = defaultdict(list)
    for k, part in enumerate(parts):
        places[part[0]].append(k)
    out, at = [], 0
    for kid in kids:
        own = places.get(("#a" if kid[1] else "#") if kid.__class__ is list else kid.label)
        found = None
        if own:
            k = bisect_left(own, at)
            found = own[k if k < len(own) else 0]
            at = max(at, found)
        out.append((None, False) if found is None else parts[found][1:])
    return out


def fixed(part: list) -> set[int]:
    """Checksums of the texts of a wrapper's region that says the same on all pages and has no title; else none."""
    said: set[int] = set()
    for sign, kid in part[1]:
        if sign not in "1+" or kid[0].split(".")[0] in TITLES:
            return set()
        if kid[0][:1] == "#" or kid[1]:
            own = fixed(kid) if kid[0][:1] != "#" else set() if kid[1] is None else {kid[1]}
            if not own:
                return set()
            said |= own
    return said


def varied(part: list) -> bool:
    """Whether anything inside a part of a wrapper is optional, repeated or free."""
    return any(sign != "1" or kid[0][:1] != "#" and varied(kid) for sign, kid in part[1] or ())


def _titled(node: Node) -> bool:
    return node.tag == "h1" or any(kid.__class__ is not list and _titled(kid) for kid in node.kids)


def _checksums(node: Node) -> set[int]:
    said: set[int] = set()
    for kid in node.kids:
        if kid.__class__ is not list:
            said |= _checksums(kid)
        elif kid[0].strip():
            said.add(crc32(" ".join(kid[0].split()).encode()))
    return said


def _said(node: Node) -> tuple[int, int]:
    """Number of texts of a region without its furniture, and of those that are links."""
    if node.said is None:
        said = linked = 0
        for kid in node.kids:
            if kid.__class__ is list:
                if kid[0].strip():
                    said, linked = said + 1, linked + kid[1]
            elif not kid.furniture:
                own = _said(kid)
                said, linked = said + own[0], linked + own[1]
        node.said = said, linked
    return node.said


def _links(node: Node) -> int:
    """Number of texts of a region if all are links, else 0."""
    said, linked = _said(node)
    return said if said == linked else 0


def _goes(node: Node, part: list | None, always: bool, shared: bool) -> bool:
    """Whether a region inside the article that is named like furniture is furniture."""
    if _titled(node):
        return False
    return not shared or part is None or not always or varied(part) or bool(fixed(part))


def blocks(root: Node, wrapper: list | None, shared: bool) -> list[str]:
    """Texts of the article's blocks in page order.

    The article is what lies in an article or main element, or all of a page without one,
    less furniture. Inside it a region named like furniture stays if it holds the title (h1);
    else, if `shared`, the wrapper decides: it goes if it says the same on all pages, or is
    optional, repeated, or has parts that are, and stays if all pages have it once and plain,
    with words of their own. Without pages enough the name decides. Also out go, if `shared` (the wrapper stands for MANY pages)
    regions of the wrapper that say the same on all pages of the host, and outside an article
    regions of several links and nothing else. Regions that are half of the text or more are
    what the host's pages have in common, not furniture, and a page of furniture only keeps all.
    """
    found: list[tuple[int, int, str]] = []  # rank, kind of furniture (1 same everywhere, 2 links), text

    def walk(node: Node, part: list | None, content: bool, everywhere: bool, kind: int) -> None:
        content = content or node.tag in CONTENT
        for kid, (own, always) in zip(node.kids, matched(node.kids, part)):
            always = always and everywhere
            if kid.__class__ is list:
                text = " ".join(kid[0].split())
                if text:
                    found.append((0 if content else 1, kind, text))
            elif not kid.furniture and not (content and kid.named and _goes(kid, own, always, shared)):
                of = kind
                if not of and kid.tag in BOXES:
                    of = 1 if shared and always and (said := fixed(own)) and _checksums(kid) <= said else 2 if not content and _links(kid) > 1 else 0
                walk(kid, own, content, always, of)

    walk(root, wrapper, False, True, 0)
    best = min((rank for rank, _, _ in found), default=0)
    rest = [(kind, text) for rank, kind, text in found if rank == best]
    sizes = [sum(len(text) for kind, text in rest if kind == k) for k in (0, 1, 2)]
    gone = {k for k in (1, 2) if sizes[0] and (k == 2 or sizes[1] < sizes[0])}
    return [text for kind, text in rest if kind not in gone]
