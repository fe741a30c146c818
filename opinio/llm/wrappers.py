"""Main text of web pages by union-free wrappers inferred per host.

``tree`` reads a page leniently into nested block elements and text runs;
inline markup is transparent, scripts, styles and comments are dropped, and
character references are decoded.

``infer`` builds a host's wrapper, a union-free regular expression over these
token streams: the first page's stream with immediate repetitions of up to
``PERIOD`` neighbours folded into repeated groups, then aligned with one page
after the other.  Tokens that match by element and class are merged inside;
tokens found on one side only become optional; a text that differs becomes a
slot; one that is the same on every page stays a constant.  ``pattern`` prints it.

``extract`` walks a page along its host's wrapper and keeps slots, inside an
article as elsewhere; constants are the template and are left out if they stand on
``LEAST`` different pages or more and on ``MOST`` of the pages that have the block around
them, the nearest one with a slot (shares are told from the ``MARKS`` least page hashes).  ``article`` or ``main`` are a hint where the main text is: what the
wrapper's slots hold there counts ``HINT`` times against what they hold in the
wrapper's part outside whose slots hold most of the text (``body``), and the larger is returned.
A page that has none of this text follows the tags alone: all runs of its
article (all constants, or unknown to the wrapper), else all slots, else all
text.  Menus, headers, footers, sidebars, notices, adverts, forms and reader
comments are left out by element, role and class (but for a header inside the article).
Some class words prove little: a block marked by one of ``MAYBE_WORDS`` stays if it holds the
page's article element, or more than half of the article's text outside links (of the
page's, where no element is an article).
Repeated elements are one token: a constant line among paragraphs that
differ from page to page is part of their slot and stays.

Each wrapper is inferred from all pages of the host, in steps that give the same
for any split of the input: tasks merge pages of equal structure (the layouts; whole pages
do not travel, and of a text over ``SHOWN`` characters only a digest); a host's layouts are dealt by
the hash of their structure into ``PARTS`` groups and those of a group aligned; last
the groups' wrappers are aligned.  Extraction covers every page
and the whole html.  Wrappers are joined to the pages by host.

Results for odd input: null or empty html gives an empty text; pages without
``://`` in the url form a host of their own; broken and cut markup is closed at
the end; texts of elements nested deeper than ``DEPTH`` belong to their ancestor, and
are left out if an element between marks them so;
repeated rows are each returned; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import cut, quoted, ship
from opinio.llm.link_trust import host

PARTS = 64
SHOWN = 200
# Nodes that a task holds before it passes its layouts on.
HELD = 200_000
PERIOD = 4
LEAST = 3
MARKS = 16
MOST = 0.8
HINT = 2
DEPTH = 120
# Pages in an output batch.
ROWS = 256

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
# What ends an open paragraph, list item, term, cell or row, up to the element in the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
# Elements, roles and words of class or id that mark what is no article.
ASIDE_TAGS = frozenset("head header nav footer aside form button select dialog menu".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
SURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager masthead topbar footer foot "
    "sidebar cookie cookies consent gdpr comment comments reply replies respond discussion disqus newsletter signup paywall".split()
)
MAYBE_WORDS = frozenset(
    "promo promotion promoted toc header side aside rail widget widgets related recommended recommendations teaser teasers "
    "notice notices notification alert popup modal overlay disclaimer "
    "share sharing social follow subscribe login search tags copyright".split()
)
HINTS = ("article", "main")
# How surely an element is no article: by element, role or a plain word, or by a word that articles have too.
SURE, MAYBE = 2, 1
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*+"|'[^']*+'|[^'">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_DIGITS = re.compile(r"\d+")
_WORD = re.compile(r"[a-z]+")
# "has-sidebar", "no-ads" and the like speak of something else.
_OTHER = re.compile(r"\b(?:no|has|with|without)[-_]+[\w-]+", re.I)


class Node:
    """A block element: what it is, whether it is no article (0, MAYBE, SURE), its children (nodes and ``Text``), and in a wrapper how it may occur."""

    __slots__ = ("sig", "tag", "aside", "kids", "plus", "optional")

    def __init__(self, sig: str, tag: str, aside: int, kids: list | None = None, plus: bool = False, optional: bool = False) -> None:
        self.sig, self.tag, self.aside, self.kids, self.plus, self.optional = sig, tag, aside, kids or [], plus, optional


class Text:
    """A text run; in a wrapper a constant, or a slot if ``value`` is None.

    ``runs`` are the digests of the runs of it on a page (several, if it repeats), None if pages
    differ in them (and once ``decide`` has found that it is no template); ``marks`` the ``MARKS`` least
    hashes of the different pages that have it.
    """

    __slots__ = ("value", "chars", "linked", "plus", "optional", "runs", "marks")
    sig, tag, aside = "#text", "#text", 0

    def __init__(self, value: str | None, chars: int, linked: int, plus: bool = False, optional: bool = False, runs: list | None = None, marks: list | None = None) -> None:
        self.value, self.chars, self.linked, self.plus, self.optional, self.runs, self.marks = value, chars, linked, plus, optional, runs, marks or []

    @property
    def constant(self) -> bool:
        return self.runs is not None


@lru_cache(maxsize=4096)
def _kind(tag: str, attributes: str) -> tuple[str, int]:
    """The signature of an element, and whether it marks what is no article."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    named = f"{found.get('class', '')} {found.get('id', '')}".strip()
    words = set(_WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", _OTHER.sub(" ", named)).lower()))
    role = found.get("role", "").strip().lower()
    hidden = "hidden" in found or re.search(r"display\s*:\s*none", found.get("style", "").lower()) is not None
    sure = tag in ASIDE_TAGS or role in ASIDE_ROLES or bool(words & SURE_WORDS) or hidden
    aside = SURE if sure else MAYBE if words & MAYBE_WORDS else 0
    if tag in ("body", "html", "article", "main"):
        aside = SURE if hidden and tag not in ("body", "html") else 0
    if role == "main" or found.get("itemprop", "") == "articleBody":
        tag = "main"
    return tag + "".join(f".{c}" for c in sorted(_DIGITS.sub("0", named).split())), aside


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=6).digest(), "big")


def tree(page: str) -> Node:
    """The page as nested blocks; texts have white space folded."""
    marks = [digest(page)]
    root = Node("#page", "#page", 0)
    # open elements: tag, the node that takes their texts, and whether an aside too deep for a node holds them
    stack: list[tuple[str, Node, bool]] = [("#page", root, False)]
    pieces: list[str] = []
    linked = depth_a = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text and not stack[-1][2]:
                stack[-1][1].kids.append(Text(text, len(text), linked, runs=[digest(text)], marks=marks))
            pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw)
            pieces.append(text)
            if depth_a:
                linked += len(text)

    at = 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        tag = name.lower()
        if tag in RAW and not closing:
            if not attributes.rstrip().endswith("/") or tag in ("script", "style", "title", "textarea"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            flush()
        elif tag == "br" or tag in VOID and tag != "wbr":
            flush()
        elif tag in INLINE or tag == "wbr":
            if tag == "a":
                depth_a = 0 if closing else 1
        elif closing:
            flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if tag == "p" and stack[i][0] not in TEXT_TAGS:
                    break
        else:
            flush()
            ended, until = ENDS.get(tag, (set(), set()))
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p" or stack[i][0] in ended:
                    del stack[i:]
                    if not ended:
                        break
                elif stack[i][0] in until or not ended:
                    break
            sig, aside = _kind(tag, attributes)
            kind = "main" if sig.split(".")[0] == "main" else tag
            _, node, lost = stack[-1]
            if len(stack) <= DEPTH:
                node = Node(sig, kind, aside)
                stack[-1][1].kids.append(node)
            else:
                lost = lost or aside == SURE and tag != "header"
            if not attributes.endswith("/") or tag not in ("div", "span"):
                stack.append((kind, node, lost))
        if tag not in INLINE:
            depth_a = 0
    flush()
    return root


def merge(a, b, one_page: bool = False):
    """The wrapper of what two tokens of one signature both match, on different pages or repeated on one."""
    plus, optional = a.plus or b.plus, a.optional or b.optional
    if isinstance(a, Text):
        if one_page:
            runs = a.runs + b.runs
        else:
            runs = a.runs if a.runs == b.runs else None
        return Text(a.value if a.value == b.value else None, a.chars + b.chars, a.linked + b.linked, plus, optional, runs, a.marks if a.marks == b.marks else sorted({*a.marks, *b.marks})[:MARKS])
    return Node(a.sig, a.tag, a.aside, align(a.kids, b.kids, one_page), plus, optional)


def fold(kids: list) -> list:
    """Children with immediate repetitions folded: one token, or a group of up to PERIOD, that repeats."""
    kids = [k if isinstance(k, Text) else Node(k.sig, k.tag, k.aside, fold(k.kids), k.plus, k.optional) for k in kids]
    for period in range(1, PERIOD + 1):
        out, i = [], 0
        while i < len(kids):
            unit = [k.sig for k in kids[i : i + period]]
            n = 1
            while len(unit) == period and [k.sig for k in kids[i + n * period : i + (n + 1) * period]] == unit:
                n += 1
            if n == 1 or period > 1 and len(set(unit)) == 1:
                out.append(kids[i])
                i += 1
                continue
            items = kids[i : i + period]
            for r in range(1, n):
                items = [merge(x, y, True) for x, y in zip(items, kids[i + r * period : i + (r + 1) * period])]
            if period == 1:
                items[0].plus = True
                out.append(items[0])
            else:
                out.append(Node("(" + ",".join(unit) + ")", "#group", 0, items, plus=True))
            i += n * period
        kids = out
    return kids


def align(a: list, b: list, one_page: bool = False) -> list:
    """Two folded streams as one: a longest common subsequence is merged, the rest is optional."""
    out, start = [], 0
    while start < min(len(a), len(b)) and a[start].sig == b[start].sig:
        out.append(merge(a[start], b[start], one_page))
        start += 1
    a, b = a[start:], b[start:]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = 1 + best[i + 1][j + 1] if a[i].sig == b[j].sig else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i].sig == b[j].sig:
            out.append(merge(a[i], b[j], one_page))
            i, j = i + 1, j + 1
        else:
            if j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
                one, i = a[i], i + 1
            else:
                one, j = b[j], j + 1
            one.optional = True
            out.append(one)
    return out


def infer(pages: list[str]) -> tuple[Node, int]:
    """The wrapper of pages, and of how many."""
    wrapper = Node("#page", "#page", 0)
    for n, page in enumerate(pages):
        seen = fold(tree(page).kids)
        wrapper.kids = align(wrapper.kids, seen) if n else seen
    decide(wrapper)
    return wrapper, len(pages)


def decide(root: Node) -> None:
    """Of the constants only those of the template stay so (their ``runs``), see above."""
    known: dict[int, tuple[list[int], bool]] = {}

    def read(node) -> tuple[list[int], bool]:
        """The least page hashes of a token, and whether a slot is below it."""
        if isinstance(node, Text):
            return node.marks, node.runs is None
        below = [read(k) for k in node.kids]
        known[id(node)] = out = sorted(set().union(*(m for m, _ in below)))[:MARKS], any(s for _, s in below)
        return out

    def among(part: list[int], whole: list[int]) -> float:
        """The share of the pages of ``whole`` that are of ``part``."""
        seen = [m for m in whole if len(part) < MARKS or m <= part[-1]]
        return sum(m in part for m in seen) / len(seen) if seen else 0.0

    def walk(node: Node, around: list[int]) -> None:
        marks, slots = known[id(node)]
        own = marks if slots and node.tag not in TEXT_TAGS and node.tag != "#group" else around
        for k in node.kids:
            if isinstance(k, Node):
                walk(k, own)
            elif k.runs is not None and (len(k.marks) < LEAST or among(k.marks, own) < MOST):
                k.runs = None

    read(root)
    walk(root, known[id(root)][0])


def pattern(node) -> str:
    """The wrapper as a regular expression: ``#`` a slot, ``( )+`` repeated, ``( )?`` optional."""
    if isinstance(node, Text):
        text = "#" if node.value is None else re.escape(node.value)
    else:
        inner = "".join(map(pattern, node.kids))
        text = inner if node.tag.startswith("#") else f"<{node.sig}>{inner}</{node.tag}>"
    if node.plus and node.optional:
        return f"({text})*"
    return f"({text})+" if node.plus else f"({text})?" if node.optional else text


def _pack(node) -> list:
    if isinstance(node, Text):
        return [0, node.value, node.chars, node.linked, node.plus, node.optional, node.runs, node.marks]
    return [1, node.sig, node.tag, node.aside, [_pack(k) for k in node.kids], node.plus, node.optional]


def _unpack(x: list):
    return Text(*x[1:]) if not x[0] else Node(x[1], x[2], x[3], [_unpack(k) for k in x[4]], x[5], x[6])


class Wrapper:
    """A host's wrapper, ready for extraction."""

    def __init__(self, root: Node, pages: int) -> None:
        self.root, self.pages = root, pages
        self.mass: dict[int, float] = {}
        self._weigh(root)
        self._weigh(root, self.mass[id(root)] / 2)
        self.body = self._densest(root)

    def _weigh(self, node, half: float = 0.0) -> float:
        """Slot text outside links, articles and mains below a node; what a class word marks counts if it is more than ``half``."""
        if isinstance(node, Text):
            own = 0 if node.constant else max(0, node.chars - 2 * node.linked)
        else:
            own = sum(self._weigh(k, half) for k in node.kids)
            own = 0.0 if node.aside == SURE or node.tag in HINTS or node.aside == MAYBE and own <= half else own
        self.mass[id(node)] = own
        return own

    def _densest(self, node: Node) -> Node:
        """The deepest block that still holds most of the slots' text."""
        while True:
            inner = [k for k in node.kids if isinstance(k, Node)]
            top = max(inner, key=lambda k: self.mass[id(k)], default=None)
            if top is None or top.tag in TEXT_TAGS or top.plus or self.mass[id(top)] < 0.7 * self.mass[id(node)] or not self.mass[id(top)]:
                return node
            node = top


def _has(node: Node, tag: str) -> bool:
    return any(isinstance(k, Node) and k.aside != SURE and (k.tag == tag or _has(k, tag)) for k in node.kids)


def _settle(root: Node, within: str | None) -> None:
    """On a page whose article element is ``within``: doubtful blocks become plain or asides."""

    def weigh(node) -> int:
        if isinstance(node, Text):
            return max(0, node.chars - 2 * node.linked)
        return 0 if node.aside == SURE else sum(map(weigh, node.kids))

    def walk(node: Node, whole: int) -> None:
        for k in node.kids:
            if isinstance(k, Node) and k.aside != SURE:
                if k.aside == MAYBE:
                    k.aside = 0 if within and _has(k, within) or 2 * weigh(k) > whole else SURE
                if not k.aside:
                    walk(k, weigh(k) if k.tag == within else whole)

    # beside an article no doubtful block is the main text
    walk(root, 1 << 62 if within else weigh(root))


def _weight(runs: list[Text]) -> int:
    return sum(max(0, t.chars - 2 * t.linked) for t in runs)


def extract(page: str | None, wrapper: Wrapper | None) -> str:
    """The main text of a page."""
    if not page:
        return ""
    root = tree(page)
    within = next((t for t in HINTS if _has(root, t)), None)
    _settle(root, within)
    # all runs and the slots inside the article, the slots inside the wrapper's body, all slots, all runs
    tagged, marked, body, slots, runs = [], [], [], [], []

    def walk(node: Node, along: Node | None, inside: bool, in_body: bool) -> None:
        ahead = along.kids if along is not None else []
        at = 0
        for kid in node.kids:
            if kid.aside and not (inside and kid.tag == "header"):
                continue
            # the wrapper's token for this one: the same again if repeated, else the next of its kind
            twin = None
            for i in [*range(at, len(ahead)), *range(0, at)]:
                group = ahead[i].kids if ahead[i].tag == "#group" else (ahead[i],)
                twin = next((g for g in group if g.sig == kid.sig), None)
                if twin is not None:
                    at = i if ahead[i].plus else i + 1
                    break
            if isinstance(kid, Text):
                slot = twin is None or not twin.constant or kid.runs[0] not in twin.runs
                for out, fits in ((tagged, inside), (marked, inside and slot), (body, in_body and not inside and slot), (slots, slot), (runs, True)):
                    if fits:
                        out.append(kid)
            else:
                walk(kid, twin, inside or kid.tag == within, in_body or twin is not None and twin is wrapper.body)

    walk(root, wrapper.root if wrapper else None, False, wrapper is not None and wrapper.body is wrapper.root)
    article = marked or tagged
    if article and (HINT if marked else 1) * _weight(article) < _weight(body):
        article = []
    return " ".join(t.value for t in article or body or slots or runs)


@lru_cache(maxsize=512)
def _read(packed: str) -> Wrapper:
    root, pages = json.loads(packed)
    return Wrapper(_unpack(root), pages)


def _shape(kids: list) -> str:
    """The structure of folded children, texts aside."""
    return "".join(f"{k.sig}{'+' * k.plus}{'?' * k.optional}" + ("," if isinstance(k, Text) else f"[{_shape(k.kids)}]") for k in kids)


def _shorten(node) -> int:
    """Long texts become digests; returns the number of nodes."""
    if isinstance(node, Text):
        if node.value is not None and len(node.value) > SHOWN:
            node.value = f"{node.value[:40]}...{digest(node.value):x}"
        return 1 + len(node.runs or ())
    return 1 + sum(map(_shorten, node.kids))


def _lean(node) -> list:
    """As ``_pack``, without what extraction has no use for."""
    if isinstance(node, Text):
        return [0, None, node.chars, node.linked, node.plus, node.optional, node.runs, []]
    return [1, node.sig, node.tag, node.aside, [_lean(k) for k in node.kids], node.plus, node.optional]


def _align_all(packed: list[str]) -> Node:
    root = Node("#page", "#page", 0)
    for n, x in enumerate(packed):
        kids = [_unpack(k) for k in json.loads(x)]
        root.kids = align(root.kids, kids) if n else kids
    return root


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, wrapper, pattern, pages)`` of every host; ``pages``: the number of different ones."""
    ship(pages.sparkSession)
    known = pages.select(host(quoted(url_col)).alias("host"), quoted(html_col).alias("html")).filter(F.length("html") > 0)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layouts: dict[tuple[str, int], list] = {}
        held = 0

        def out() -> pa.RecordBatch:
            rows = [(h, shape, json.dumps([_pack(k) for k in kids])) for (h, shape), kids in layouts.items()]
            cols = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.string(), pa.int64(), pa.string()))]
            return pa.RecordBatch.from_arrays(cols, names=["host", "shape", "layout"])

        for b in batches:
            for h, page in zip(b.column(0).to_pylist(), b.column(1)):
                kids = fold(tree(page.as_py()).kids)
                nodes = sum(map(_shorten, kids))
                key = h, digest(_shape(kids))
                if key in layouts:
                    layouts[key] = align(layouts[key], kids)
                else:
                    layouts[key] = kids
                    held += nodes
                if held > HELD:
                    yield out()
                    layouts, held = {}, 0
        if layouts:
            yield out()

    def part(key: tuple, rows: pa.Table) -> pa.Table:
        # those of one structure merge in any order, different ones align in the order of their hashes
        same: dict[int, list] = {}
        for shape, x in zip(rows["shape"].to_pylist(), rows["layout"].to_pylist()):
            kids = [_unpack(k) for k in json.loads(x)]
            same[shape] = align(same[shape], kids) if shape in same else kids
        wrapper: list = []
        for n, shape in enumerate(sorted(same)):
            wrapper = align(wrapper, same[shape]) if n else same[shape]
        return pa.table({"host": [key[0].as_py()], "part": pa.array([key[1].as_py()], pa.int64()), "layout": [json.dumps([_pack(k) for k in wrapper])]})

    def learn(key: tuple, rows: pa.Table) -> pa.Table:
        root = _align_all([x for _, x in sorted(zip(rows["part"].to_pylist(), rows["layout"].to_pylist()))])
        n = rows["pages"][0].as_py()
        decide(root)
        return pa.table({"host": [key[0].as_py()], "wrapper": [json.dumps([_lean(root), n])], "pattern": [pattern(root)], "pages": pa.array([n], pa.int32())})

    layouts = known.mapInArrow(gather, "host string, shape long, layout string")
    parts = layouts.withColumn("part", F.pmod("shape", F.lit(PARTS))).groupBy("host", "part").applyInArrow(part, "host string, part long, layout string")
    # copies of one page say nothing about the template
    counts = known.select("host", F.xxhash64("html").alias("tag")).distinct().groupBy("host").agg(F.count(F.lit(1)).cast("int").alias("pages"))
    counted = cut(parts, "wrapper-parts").join(cut(counts, "wrapper-pages"), "host")
    return counted.select("host", "part", "layout", "pages").groupBy("host").applyInArrow(learn, "host string, wrapper string, pattern string, pages int")


def main_text(pages: DataFrame, learned: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text)`` of every row, by the wrappers of :func:`wrappers`."""
    ship(pages.sparkSession)
    source = pages.select(quoted(id_col).alias("id"), quoted(url_col).alias("url"), quoted(html_col).alias("html"), host(quoted(url_col)).alias("host"))
    joined = source.join(learned.select("host", "wrapper"), "host", "left").select("id", "url", "html", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                texts = [extract(h.as_py(), _read(w) if (w := p.as_py()) else None) for h, p in zip(b.column(2), b.column(3))]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])

    return joined.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, url string, text string")


def op6(spark, sf_dir: str) -> DataFrame:
    """Every page's main text and its length."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = main_text(pages, cut(wrappers(pages), "wrappers"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
