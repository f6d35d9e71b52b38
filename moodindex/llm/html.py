"""Main text of web pages by wrapper inference.

A wrapper is a union-free regular expression over the block structure of a
host's pages: elements in order, some optional, some repeated (single elements or
short groups of them), and text slots where pages differ.  It is inferred by
alignment: the wrapper of one page is the page itself, with adjacent equal siblings folded into
repeats; two wrappers are aligned element by element (longest common
subsequence of labels), matching elements are merged, an element that one side lacks
becomes optional, neighbours that have become equal fold into a repeat, and
unequal texts become slots.  Merging is done pairwise in any order, so
each scan task folds its pages by host first, then a host's wrappers fold in
salted parts, and the parts of a host last: a hot host is never gathered, and
only one wrapper a host is held at a time.

A finished wrapper tells which texts are the same on different pages.  Extraction
aligns a page's elements with its host's wrapper and chooses the main region for this page by the slots,
so a host may have any number of templates: the smallest container that holds all slots with text that
isn't links, without the containers before and after them that hold none.  A page alone on its host has
no slots to tell; all of it counts that isn't cut.  Subtrees of
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments are cut
(by element, role or the names in class and id; by names not if the element holds most of
the page's text).  What the alignment can't place counts
as a slot, so no text is lost by it.

Defined results: a null or empty page has the text ''; a page without a
readable host is grouped with others of the same null host; markup that is not closed
is closed as browsers do for paragraphs and list items, a text end closes the rest; an
empty table gives an empty table; repeated rows each get their row.
"""

from __future__ import annotations

import json
import re
from collections import Counter, deque
from html import unescape
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodindex.llm.common import fresh

SALTS = 64
# Wrappers are broadcast up to this many bytes in all; beyond, pages and wrappers meet in a salted join.
BROADCAST_BYTES = 16 << 20
JOIN_SALTS = 16
MAX_PERIOD = 3
# Sequences of siblings whose table has no more cells than this are aligned by the table.
TABLE_CELLS = 250_000
# An article is fair with such a share of a page's text: then marks inside and beside it hold.
NEARLY = 0.9
# The mark of a container that class or id would cut, and the share of a page's text up to which it is cut.
MARKS = {"?": 0.5, "~": NEARLY}
MAX_HOSTS = 5000
# Elements whose wrappers a task holds before it passes them on, about (200 bytes each).
MAX_NODES = 500_000

# Names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes template".split())
UNSEEN = set("script style noscript template".split())  # no part of the text around them
INLINE = set("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark
    math q rp rt ruby s samp small span strike strong sub sup time tt u var wbr""".split())
CLOSES_P = set("""address article aside blockquote center details dialog dir div dl fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section
    summary table ul""".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
                "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"},
         "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
# Blocks of text; the region is never a part of one.
BLOCKS = set("p pre blockquote ul ol li table h1 h2 h3 h4 h5 h6 dl dt dd".split())
# Elements, roles and words of class or id whose text is not the article's.
CUT_TAGS = set("""head nav header footer aside form script style noscript iframe template button select
    textarea title svg canvas object audio video dialog menu""".split())
CUT_ROLES = set("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
CUT_WORDS = set("""ad ads adv advert advertisement advertising adbox banner promo promotion sponsor sponsored
    cookie cookies consent notice notices alert warning newsletter subscribe subscription signup login popup
    modal overlay sidebar sidenav aside menu nav navbar navigation breadcrumb breadcrumbs topbar masthead
    header footer share sharing social related recommended comment comments reply replies disqus discussion
    pagination pager widget toolbar""".split())

# A name of class or id counts if its other words say only which one or what kind of box:
# sidebar, sidebar-left and cookie_notice do, has-sidebar and related-work don't.
PLAIN_WORDS = set("""a site top bottom left right box bar list block container wrapper wrap section area inner
    outer content unit slot gpt div text link links button buttons icon icons item items main primary
    secondary global form""".split())
# These containers are never cut by class or id.
OWN_TAGS = set("html body main article".split())
# Other containers named so are not cut if they hold more than half of a page's text, those of readers' words
# and the like if they hold nearly all of it.
LONG_WORDS = set("related recommended comment comments reply replies disqus discussion".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
# One attribute after the other, so that no value is read as a name.
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_TELLING = re.compile("class|id|role|hidden", re.I)
_SPACE = re.compile(r"\s+")


def _cut_words(names: str) -> set[str]:
    """The words that cut, of the names in a class or id."""
    found: set[str] = set()
    for name in names.split():
        words = {w for w in re.split(r"[^a-z]+", name) if len(w) > 1}
        if words <= CUT_WORDS | PLAIN_WORDS:
            found |= words & CUT_WORDS
    return found


def _label(tag: str, attrs: str) -> str:
    """The element's name, of containers with the letters of their first class, and a
    mark if the attributes cut the element: "!", or by class and id "?" or "~" (a word of
    ``LONG_WORDS``), which holds if the page has enough other text."""
    if not attrs or not _TELLING.search(attrs):
        return tag
    own, mark = tag, ""
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "role" and value in CUT_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return tag + "!"
        if name in ("class", "id") and tag not in OWN_TAGS:
            words = _cut_words(value)
            if words:
                mark = "~" if mark == "~" or words & LONG_WORDS else "?"
        if name == "class" and value and tag in ("div", "section"):
            own = f"{tag}.{re.sub('[^a-z]', '', value.split()[0])}"
    return own + mark


class Element:
    __slots__ = ("label", "children")

    def __init__(self, label: str):
        self.label, self.children = label, []


def parse(page: str) -> Element:
    """The tree of block elements; the text between two of them is one string,
    with the number of its characters inside links: ``(text, linked)``."""
    root = Element("")
    stack, names = [root], [""]
    opened: Counter = Counter()  # how many elements of a name are open
    buf: list[str] = []
    linked = links = at = 0

    def end_text():
        nonlocal linked
        if buf:
            t = _SPACE.sub(" ", unescape("".join(buf))).strip()
            if t:
                stack[-1].children.append((t, min(linked, len(t))))
            buf.clear()
        linked = 0

    def close_to(k: int):
        nonlocal links
        end_text()
        opened.subtract(names[k:])
        del stack[k:], names[k:]

    n = len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            buf.append(page[at:])
            break
        if m.start() > at:
            buf.append(page[at:m.start()])
            if links:
                linked += m.start() - at
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in INLINE:
                continue
            if opened[tag]:
                k = len(names) - 1
                while names[k] != tag:
                    k -= 1
                close_to(k)
            elif tag == "p":
                end_text()
            continue
        if tag in INLINE:
            if tag == "br":
                buf.append(" ")
            elif tag == "a":
                links += 1
            tag_label = _label(tag, m[3]) if tag in ("a", "span", "label") else tag
            if tag_label == tag:
                continue
            e = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if tag_label[-1] != "!" and 2 * ((e.end() if e else n) - at) > n:
                continue  # most of the page
            end_text()  # an inline element that is cut stands for itself up to its end
            stack[-1].children.append(Element(tag + "!"))
            if tag == "a":
                links -= 1
            at = e.end() if e else n
            continue
        if tag in RAW:
            e = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if tag not in UNSEEN:
                end_text()
                stack[-1].children.append(Element(tag))
            at = e.end() if e else n
            continue
        if tag in CLOSES_P and opened["p"]:
            k = len(names) - 1
            while names[k] != "p":
                k -= 1
            close_to(k)
        elif tag in SELF_CLOSING and any(opened[x] for x in SELF_CLOSING[tag]):
            for k in range(len(names) - 1, 0, -1):
                if names[k] in SCOPE[tag]:
                    break
                if names[k] in SELF_CLOSING[tag]:
                    close_to(k)
                    break
        if re.fullmatch("h[1-6]", tag) and re.fullmatch("h[1-6]", names[-1]):
            close_to(len(names) - 1)
        end_text()
        e = Element(_label(tag, m[3]))
        stack[-1].children.append(e)
        if tag not in VOID and not m[3].rstrip().endswith("/"):
            stack.append(e)
            names.append(tag)
            opened[tag] += 1
    end_text()
    return root


# -- wrappers ----------------------------------------------------------------
# A node is [label, optional, repeated, children, text, first, last]: label "#" is a
# text (``text``: its hash, or None for a slot; the least and the greatest hash of the pages
# that have it, so equal ones mean that it was seen on one page only), "()" a repeated group.

def _hash(text: str) -> int:
    return crc32(text.encode("utf-8", "replace"))


def wrapper_of(e: Element) -> list:
    """The wrapper of one page."""
    page = 0
    order = [e]
    for x in order:  # grows
        for c in x.children:
            if isinstance(c, tuple):
                page = crc32(c[0].encode("utf-8", "replace"), page)
            else:
                order.append(c)
    later: deque = deque()
    made: dict[int, list] = {}
    for x in reversed(order):
        kids = [["#", 0, 0, [], _hash(c[0]), page, page] if isinstance(c, tuple) else made.pop(id(c)) for c in x.children]
        made[id(x)] = [x.label, 0, 0, fold(kids, later), None, 0, 0]
    _finish(later)
    return made[id(e)]


def shape(w: list):
    """What two wrappers must share to be merged place by place: all nodes in order."""
    out, todo = [], [w]
    while todo:
        x = todo.pop()
        out += (x[0], x[1], x[2], len(x[3]))
        todo += reversed(x[3])
    return tuple(out)


# Pages may be nested as deep as they like, so nothing here recurses: a merged node gets
# its children later, first come first served.  What they are merged from was merged
# earlier then, and one level of siblings is folded by labels alone.

def merge(a: list, b: list) -> list:
    """The wrapper of everything that either matches; their labels are equal."""
    later: deque = deque()
    w = _merge(a, b, later)
    _finish(later)
    return w


def _merge(a: list, b: list, later: deque) -> list:
    if a[0] == "()":  # its members are part of this level
        kids = align(a[3], b[3], later)
    else:
        kids = []
        if a[0] != "#":
            later.append((kids, a[3], b[3]))
    return [a[0], a[1] | b[1], a[2] | b[2], kids,
            a[4] if a[4] == b[4] else None, min(a[5], b[5]), max(a[6], b[6])]


def _finish(later: deque) -> None:
    while later:
        kids, a, b = later.popleft()
        if a or b:
            kids += align(a, b, later)


def fold(nodes: list[list], later: deque) -> list[list]:
    """Fold adjacent equal elements, and equal groups of them, into repeats."""
    for k in range(1, MAX_PERIOD + 1):
        out: list[list] = []
        i = 0
        while i < len(nodes):
            out.append(nodes[i])
            i += 1
            if len(out) >= 2 * k and [x[0] for x in out[-2 * k:-k]] == [x[0] for x in out[-k:]] \
                    and (k > 1 or out[-1][0] != "()"):
                if k == 1:
                    x = _merge(out[-2], out[-1], later)
                    x[1], x[2] = out[-2][1] & out[-1][1], 1
                    out[-2:] = [x]
                elif not any(x[0] == "()" for x in out[-k:]):
                    out[-2 * k:] = [["()", 0, 1, [_merge(x, y, later) for x, y in
                                                  zip(out[-2 * k:-k], out[-k:], strict=True)], None, 0, 0]]
            if len(out) > k and out[-k - 1][0] == "()" and len(out[-k - 1][3]) == k \
                    and [x[0] for x in out[-k - 1][3]] == [x[0] for x in out[-k:]]:
                g = out[-k - 1]
                out[-k - 1:] = [[*g[:3], [_merge(x, y, later) for x, y in zip(g[3], out[-k:], strict=True)], *g[4:]]]
        nodes = out
    return nodes


def dumps(w: list) -> str:
    """The wrapper as one flat JSON list, every node before its children."""
    out, todo = [], [w]
    while todo:
        x = todo.pop()
        out += (x[0], x[1], x[2], len(x[3]), *x[4:]) if x[0] == "#" else (x[0], x[1], x[2], len(x[3]))
        todo += reversed(x[3])
    return json.dumps(out, separators=(",", ":"))


def loads(text: str) -> list:
    flat, at = json.loads(text), 0
    top: list = []
    open_ = [(top, 1)]  # lists of children that wait for so many
    while open_:
        kids, n = open_.pop()
        if len(kids) == n:
            continue
        open_.append((kids, n))
        label, optional, repeated, many = flat[at:at + 4]
        at += 4
        x = [label, optional, repeated, [], None, 0, 0]
        if label == "#":
            x[4:] = flat[at:at + 3]
            at += 3
        kids.append(x)
        if many:
            open_.append((x[3], many))
    return top[0]


def _key(x: list):
    return (x[0], tuple(y[0] for y in x[3])) if x[0] == "()" else x[0]


def _prefix_lengths(a: list, b: list) -> np.ndarray:
    """Lengths of the longest common subsequences of ``a`` and each prefix of
    ``b``: a row of the table is one number, a bit for each place of ``b``."""
    where: dict = {}
    for j, x in enumerate(b):
        where.setdefault(x, []).append(j)
    masks = {}
    for x, at in where.items():
        bits = np.zeros(len(b), np.uint8)
        bits[at] = 1
        masks[x] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & masks.get(x, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    raw = np.frombuffer(row.to_bytes((len(b) + 7) // 8, "little"), np.uint8)
    steps = 1 - np.unpackbits(raw, bitorder="little")[:len(b)].astype(np.int64)
    return np.concatenate([[0], np.cumsum(steps)])


def _table_pairs(a: list, b: list) -> list[tuple[int, int]]:
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def pairs(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, in order.  Sequences whose table
    would be large are halved where the two halves' lengths add up to the
    most, so the memory grows with their length and not with its square."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        if m - i == 1 or (m - i) * (n - j) <= TABLE_CELLS:
            out += [(i + x, j + y) for x, y in _table_pairs(a[i:m], b[j:n])]
            continue
        mid = (i + m) // 2
        head = _prefix_lengths(a[i:mid], b[j:n])
        tail = _prefix_lengths(a[mid:m][::-1], b[j:n][::-1])
        cut = j + int(np.argmax(head + tail[::-1]))
        todo += [(i, mid, j, cut), (mid, m, cut, n)]
    return sorted(out)


def align(a: list[list], b: list[list], later: deque) -> list[list]:
    """Align two sequences of siblings; what one lacks becomes optional."""
    ka, kb = [_key(x) for x in a], [_key(x) for x in b]
    if ka == kb:
        return [_merge(x, y, later) for x, y in zip(a, b, strict=True)]
    out, i, j = [], 0, 0
    for m, n in [*pairs(ka, kb), (len(a), len(b))]:
        out += [[x[0], 1, *x[2:]] for x in a[i:m]]
        out += [[x[0], 1, *x[2:]] for x in b[j:n]]
        if m < len(a):
            out.append(_merge(a[m], b[n], later))
        i, j = m + 1, n + 1
    return fold(out, later)


def _cut(label: str) -> bool:
    return label.endswith("!") or label in CUT_TAGS


def choose(w: list) -> list:
    """The finished wrapper: only texts that are the same on different pages keep their hash."""
    todo = [w]
    while todo:
        x = todo.pop()
        if x[0] == "#":
            x[4] = x[4] if x[5] != x[6] else None
        todo += x[3]
    return w


def _runs(labels: list[str]) -> list[int]:
    """Where a run of equal labels begins."""
    return [i for i, x in enumerate(labels) if not i or labels[i - 1] != x]


def _places(kids: list, nodes: list[list]) -> list:
    """For each child of a page's element its place in the wrapper, or None.  Runs of equal
    children are aligned as in inference; what is left over by that (repeats of a
    group) takes the first place of its label."""
    flat = [y for x in nodes for y in (x[3] if x[0] == "()" else [x])]
    labels = ["#" if isinstance(c, tuple) else c.label for c in kids]
    starts = _runs(labels)
    a, b = [labels[i] for i in starts], [x[0] for x in flat]
    first: dict[str, list] = {}
    for x in flat:
        first.setdefault(x[0], x)
    got = [first.get(x) for x in a]
    for i, j in pairs(a, b):
        got[i] = flat[j]
    ends = [*starts[1:], len(labels)] if labels else []
    return [g for g, s, e in zip(got, starts, ends, strict=True) for _ in range(e - s)]


class _Page:
    """A page aligned with its host's wrapper: by element (its number) the text that isn't
    links, ``all`` of it and in ``slots``: where the host's pages differ, or no other page has the place."""

    def __init__(self, root: Element, w: list | None):
        self.elements, self.parent, hosts = [root], [-1], [w]
        self.kids: list[list] = []  # by element (all, slots, number of the child or -1, child)
        self.compared = False  # with another page
        for k, e in enumerate(self.elements):  # grows
            own: list[tuple] = []
            h = hosts[k]
            for c, at in zip(e.children, _places(e.children, h[3] if h else []), strict=True):
                if isinstance(c, tuple):
                    n = max(0, len(c[0]) - 2 * c[1]) if any(map(str.isalnum, c[0])) else 0
                    self.compared |= at is not None and at[5] != at[6]
                    same = at is not None and at[4] is not None and at[4] == _hash(c[0])
                    own.append((n, 0 if same else n, -1, c))
                elif not _cut(c.label):
                    own.append((0, 0, len(self.elements), c))
                    self.elements.append(c)
                    self.parent.append(k)
                    hosts.append(at)
            self.kids.append(own)
        self.all, self.slots = self.sums(0), self.sums(1)
        gone = {k for k, e in enumerate(self.elements) if e.label[-1:] in MARKS}
        if gone:
            v = self.weights()
            bare = self.sums(int(v is self.slots), gone)
            # with a fair article beside or around them the marks hold
            if not any(bare[0] and NEARLY * v[0] + sum(bare[k] for k in self.named(name, gone)) >= v[0] for name in ("article", "main")):
                gone = {k for k in gone if v[k] <= MARKS[self.elements[k].label[-1]] * v[0]}
            for own in self.kids:
                own[:] = [x for x in own if x[2] not in gone]
            # what is cut, with all in it, no longer counts for what is around it
            self.all, self.slots = self.sums(0, gone), self.sums(1, gone)

    def sums(self, of: int, gone: set[int] = frozenset()) -> list[int]:
        v = [sum(x[of] for x in own) for own in self.kids]
        for k in range(len(v) - 1, 0, -1):
            if k not in gone:
                v[self.parent[k]] += v[k]
        return v

    def weights(self) -> list[int]:
        # slots that are next to nothing (a date) are those of near copies of one page
        return self.slots if self.compared and 10 * self.slots[0] >= self.all[0] else self.all

    def named(self, name: str, without: set[int] = frozenset()) -> list[int]:
        """The outermost elements of the name, in order."""
        out, todo = [], [0]
        while todo:
            k = todo.pop()
            if self.elements[k].label == name:
                out.append(k)
            else:
                todo += [x[2] for x in reversed(self.kids[k]) if x[2] >= 0 and x[2] not in without]
        return out

    def text(self, k: int, without: set[int]) -> list[str]:
        out, todo = [], [self.kids[k][::-1]]
        while todo:
            if not todo[-1]:
                todo.pop()
                continue
            x = todo[-1].pop()
            if x[2] < 0:
                out.append(x[3][0])
            elif x[2] not in without:
                todo.append(self.kids[x[2]][::-1])
        return out

    def region(self) -> tuple[list[int], set[int]]:
        """The elements that hold the page's main text, and those in them that are left
        out.  ``article`` or ``main`` are taken only if no text is beside them."""
        v = self.weights()
        for name in ("article", "main"):
            found = self.named(name)
            if found and sum(v[k] for k in found) == v[0]:
                return found, set()
        if not self.compared:  # a page alone on its host: then all of the body counts
            return [0], set()
        at, without = self.by_weight(v)
        return [at], without

    def by_weight(self, v: list[int]) -> tuple[int, set[int]]:
        """The smallest container that holds all of ``v``, and the containers
        before and after its text that are left out as they hold none."""
        at = 0
        while True:
            titled, inner = False, None
            for x in self.kids[at]:
                label = self.elements[x[2]].label if x[2] >= 0 else "#"
                if label == "h1" and (v[x[2]] or self.all[x[2]]):
                    titled = True  # the title belongs to the text that follows
                if x[2] >= 0 and v[x[2]] and v[x[2]] == v[0]:
                    inner = None if titled or label in BLOCKS else x[2]
                    break
            if inner is None:
                break
            at = inner
        kids = [(x[2], v[x[2]] if x[2] >= 0 else x[int(v is self.slots)]) for x in self.kids[at]]
        full = [i for i, (_, n) in enumerate(kids) if n]
        if not full:
            return at, set()
        return at, {k for i, (k, _) in enumerate(kids) if k >= 0 and not full[0] <= i <= full[-1]
                    and (self.elements[k].label not in BLOCKS or self.elements[k].label in ("ul", "ol", "table"))}


def extract(page: str, w: list | None) -> str:
    """The blocks of a page that fall into its main region."""
    p = _Page(parse(page), w)
    found, without = p.region()
    return "\n".join(t for k in found for t in p.text(k, without))


# -- jobs --------------------------------------------------------------------

def _merge_all(ws):
    out = None
    for w in ws:
        out = w if out is None else merge(out, w)
    return out


def _fold_pages(batches):
    """A wrapper per host of the task's pages."""
    hosts: dict[str | None, dict] = {}
    held = 0

    def flush():
        rows = [(h, dumps(_merge_all(shapes.values()))) for h, shapes in hosts.items()]
        hosts.clear()
        return pa.record_batch([pa.array([h for h, _ in rows], pa.string()),
                                pa.array([w for _, w in rows], pa.string())], names=["host", "wrapper"])

    for b in batches:
        for host, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            shapes = hosts.setdefault(host, {})
            w = wrapper_of(parse(page))
            s = shape(w)
            held += 0 if s in shapes else 1 + (page or "").count("<")
            shapes[s] = merge(shapes[s], w) if s in shapes else w
            if len(shapes) > 50:
                w = _merge_all(shapes.values())
                shapes.clear()
                shapes[shape(w)] = w
            if len(hosts) > MAX_HOSTS or held > MAX_NODES:
                yield flush()
                held = 0
    if hosts:
        yield flush()


def _fold_wrappers(last: bool):
    def run(batches):
        key, now, out = (), None, []

        def done():
            w = choose(now) if last else now
            out.append((key[0], dumps(w)))

        def batch():
            rows = pa.record_batch([pa.array([h for h, _ in out], pa.string()),
                                    pa.array([w for _, w in out], pa.string())], names=["host", "wrapper"])
            out.clear()
            return rows

        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            for *k, w in zip(*cols, strict=True):
                w = loads(w)
                if now is not None and key == tuple(k):
                    now = merge(now, w)
                    continue
                if now is not None:
                    done()
                key, now = tuple(k), w
            if len(out) > 500:
                yield batch()
        if now is not None:
            done()
        if out:
            yield batch()
    return run


def host_of(url_col: str):
    h = F.lower(F.regexp_extract(F.col(url_col).cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return F.when(h != "", h)


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, wrapper`` (JSON), with the main region marked."""
    p = pages.select(host_of(url_col).alias("host"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    out = "host string, wrapper string"
    parts = p.mapInArrow(_fold_pages, out).withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    parts = (parts.repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper")
             .select("host", "salt", "wrapper").mapInArrow(_fold_wrappers(False), out))
    return (parts.repartition("host").sortWithinPartitions("host", "wrapper")
            .mapInArrow(_fold_wrappers(True), out))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text`` of every page."""
    wrappers = infer_wrappers(pages, url_col, html_col).checkpoint()
    total = wrappers.agg(F.sum(F.length("wrapper"))).first()[0] or 0
    host, wrap = fresh(pages, "_host"), fresh(pages, "_wrapper")
    d = pages.select(F.col(f"`{id_col}`"), F.col(f"`{url_col}`"), host_of(url_col).alias(host),
                     F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))
    w = wrappers.select(F.col("host").alias("_wh"), F.col("wrapper").alias(wrap))
    on = F.col(host).eqNullSafe(F.col("_wh"))
    if total <= BROADCAST_BYTES:
        d = d.join(F.broadcast(w), on, "left")
    else:
        d = d.withColumn("_ds", F.pmod(F.monotonically_increasing_id(), F.lit(JOIN_SALTS)))
        w = w.withColumn("_ws", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(JOIN_SALTS - 1).cast("long"))))
        d = d.join(w, on & (F.col("_ds") == F.col("_ws")), "left")

    @F.pandas_udf("string")
    def text(html, wrapper):
        import pandas as pd
        known: dict = {None: None}
        for x in wrapper.dropna().unique():
            known[x] = loads(x)
        return pd.Series([extract(h, known[x if isinstance(x, str) else None])
                          for h, x in zip(html, wrapper, strict=True)], dtype=object)

    return d.select(F.col(f"`{id_col}`"), F.col(f"`{url_col}`"), text("html", wrap).alias("text"))
