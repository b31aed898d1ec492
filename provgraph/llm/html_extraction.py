"""Main text of web pages by wrapper induction: pages of a host are aligned as trees, the wrapper they share tells template from content."""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from provgraph.llm.common import Scratch

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
#: Elements that are part of the text around them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike strong sub sup time "
    "tt u var".split()
)
#: Never text of a page.
DROPPED = frozenset("head script style title textarea iframe noembed noframes xmp noscript template svg object audio video canvas map".split())
#: Elements that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr li main menu nav ol p pre section summary table ul".split()
)
#: A start tag ends an open element of these names, up to an element of the others.
ENDS = {
    "li": ("li", ("ul", "ol", "menu", "dir")), "dd": ("dd dt", ("dl",)), "dt": ("dd dt", ("dl",)), "option": ("option", ("select",)),
    "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
    "tbody": ("thead tbody tfoot tr td th", ("table",)), "thead": ("thead tbody tfoot tr td th", ("table",)),
    "tfoot": ("thead tbody tfoot tr td th", ("table",)),
}
#: Elements, roles and words of class and id of menus, notices, adverts, forms, sidebars, footers and reader comments.
CHROME_TAGS = frozenset("nav aside footer form button select fieldset dialog menu".split())
CHROME_ROLES = frozenset("navigation complementary contentinfo search form alert alertdialog dialog menu menubar toolbar".split())
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus "
    "footer gdpr login menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion "
    "recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar".split()
)
#: Of the page's head, but of an article its own title.
HEADER_TAGS, HEADER_WORDS = frozenset(["header"]), frozenset("header masthead topbar".split())
#: What the main text is marked with, the surest first.
REGIONS = (
    lambda n: n.tag == "article" or "article" in n.roles,
    lambda n: "articlebody" in n.roles,
    lambda n: n.tag == "main" or "main" in n.roles,
    lambda n: bool({"content", "article", "post", "entry", "story", "main"} & n.words),
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dd dt td th figcaption".split())

#: Elements deeper than this stay beside each other, as browsers have it at some depth.
DEPTH = 100
#: Shapes of a host's pages that its wrapper holds, the most frequent ones.
SHAPES = 8
#: A text is template where it is the same on this share of at least so many different pages of a host.
SAME_SHARE, SAME_PAGES = 0.9, 3

_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+)>|[!?/][^>]*(?:>|\Z)|[a-zA-Z][^>]*\Z)", re.S
)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Node:
    """An element, or a stretch of text (tag ``#``); ``label`` tells equal elements: its name, words of class and id, and roles."""

    tag: str
    label: str = "#"
    words: frozenset[str] = frozenset()
    roles: frozenset[str] = frozenset()
    children: list[Node] = field(default_factory=list)
    text: str = ""
    link_chars: int = 0


def _label(tag: str, attributes: str) -> str:
    words, roles = set(), set()
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            words.update(_WORD.findall(value))
        elif name in ("role", "itemprop"):
            roles.update(_WORD.findall(value))
        elif name == "hidden" or value == "true":
            roles.add("hidden")
    return " ".join((tag, *(f".{w}" for w in sorted(words)), *(f"@{r}" for r in sorted(roles))))


@lru_cache(1 << 16)
def _element(label: str) -> tuple[str, frozenset[str], frozenset[str]]:
    tag, *rest = label.split(" ")
    return tag, frozenset(r[1:] for r in rest if r[0] == "."), frozenset(r[1:] for r in rest if r[0] == "@")


def parse(page: str) -> Node:
    """The page's tree of blocks.  Inline elements belong to the text around them; left out end tags are supplied as browsers do."""
    root = Node("html", "html")
    stack, open_tags = [root], ["html"]
    run: list[str] = []
    links = 0

    def put_text() -> None:
        nonlocal links
        text = " ".join(html.unescape("".join(run)).split()) if run else ""
        if text:
            stack[-1].children.append(Node("#", text=text, link_chars=min(links, len(text))))
        run.clear()
        links = 0

    def close(n: int) -> None:
        put_text()
        del stack[n:], open_tags[n:]

    def last(names: Sequence[str], until: Sequence[str] = ()) -> int:
        """Where the innermost open element of these names stands; 0 if there is none inside ``until``."""
        for i in range(len(open_tags) - 1, 0, -1):
            if open_tags[i] in names:
                return i
            if open_tags[i] in until:
                return 0
        return 0

    anchors = 0
    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            piece = page[at:stop]
            run.append(piece)
            if anchors:
                links += len(piece.strip())
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        closing, tag = m[1], m[2].lower()
        if closing:
            if tag in INLINE:
                anchors = max(anchors - (tag == "a"), 0)
            elif tag == "br":
                run.append(" ")
            elif i := last((tag,), () if tag in ("body", "table") else ("table",)):
                close(i)
            continue
        if tag in INLINE:
            anchors = 1 if tag == "a" else anchors
            continue
        if tag in RAW or tag in DROPPED and tag != "head":
            if m[3].endswith("/") and tag == "svg":
                continue
            found = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            if found:
                at = found.end()
            elif tag in RAW:
                at = end
            run.append(" ")
            continue
        if tag in VOID:
            run.append(" ")
            continue
        if tag in ("html", "body"):
            if i := last(("head",)):
                close(i)
            if tag == "html" or "body" in open_tags:
                continue
        if tag in ENDS_P and (i := last(("p",), ("table", "td", "th", "article", "section", "div", "li"))):
            close(i)
        if tag in ENDS:
            names, until = ENDS[tag]
            while i := last(names.split(), until):
                close(i)
        if "head" in open_tags and tag != "head":
            close(last(("head",)))
        put_text()
        anchors = 0
        label = _label(tag, m[3])
        node = Node(tag, label, *_element(label)[1:])
        stack[-1].children.append(node)
        if len(stack) < DEPTH:
            stack.append(node)
            open_tags.append(tag)
    put_text()
    return root


def outline(root: Node) -> tuple[str, list[tuple[int, str, int]]]:
    """The page's shape, a line ``depth label`` for each node, and its texts in order: node of the shape, text, characters in links."""
    lines: list[str] = []
    texts: list[tuple[int, str, int]] = []
    # Children are described before it is known whether they repeat their neighbour, so nodes get their lines on a second walk.
    described: dict[int, str] = {}

    def describe(node: Node) -> str:
        parts, previous = [], None
        for c in node.children:
            d = describe(c)
            if d != previous:
                parts.append(d)
            previous = d
        described[id(node)] = d = hashlib.md5("\n".join([node.label, *parts]).encode()).hexdigest()
        return d

    def walk(node: Node, depth: int, at: int, write: bool) -> int:
        """Number the node's subtree from ``at`` on; a repeated neighbour takes the numbers of the first.  Returns the number after it."""
        if write:
            lines.append(f"{depth} {node.label}")
        if node.tag == "#":
            texts.append((at, node.text, node.link_chars))
        following = at + 1
        previous, begin = None, at + 1
        for c in node.children:
            d = described[id(c)]
            if d == previous:
                walk(c, depth + 1, begin, False)
            else:
                begin = following
                following = walk(c, depth + 1, begin, write)
            previous = d
        return following

    describe(root)
    walk(root, 0, 0, True)
    merged: list[tuple[int, str, int]] = []
    for node, text, links in texts:
        if merged and merged[-1][0] == node:
            before = merged[-1]
            merged[-1] = (node, f"{before[1]} {text}", before[2] + links)
        else:
            merged.append((node, text, links))
    return "\n".join(lines), merged


@dataclass(frozen=True, eq=False)
class Shape:
    """A tree without texts, in which neighbours of the same shape are one child."""

    label: str
    children: tuple[Shape, ...] = ()
    size: int = 1


_shapes: dict[tuple, Shape] = {}


def _shape(label: str, children: tuple[Shape, ...]) -> Shape:
    """The one object of the process for this shape, so that equal shapes are the same object."""
    key = (label, *children)
    if key not in _shapes:
        _shapes[key] = Shape(label, children, 1 + sum(c.size for c in children))
    return _shapes[key]


def shape_of(lines: str) -> Shape:
    """The shape that an outline describes."""
    if len(_shapes) > 1 << 18:
        _shapes.clear()
        tree_match.cache_clear()
        child_pairs.cache_clear()
    open_: list[tuple[str, list[Shape]]] = []
    for line in [*lines.split("\n"), "0 "]:
        depth, label = line.split(" ", 1)
        while len(open_) > int(depth) and (int(depth) or label == ""):
            name, children = open_.pop()
            done = _shape(name, tuple(children))
            if not open_:
                return done
            open_[-1][1].append(done)
        open_.append((label, []))
    raise ValueError("an outline has one root")


@lru_cache(1 << 18)
def tree_match(a: Shape, b: Shape) -> int:
    """Simple tree matching: nodes of the largest match of two trees that keeps parents and the order of children."""
    if a.label != b.label:
        return 0
    if a is b:
        return a.size
    return 1 + sum(tree_match(a.children[i], b.children[j]) for i, j in child_pairs(a, b))


@lru_cache(1 << 16)
def child_pairs(a: Shape, b: Shape) -> tuple[tuple[int, int], ...]:
    """Which children of two nodes the best match pairs, in order."""
    x, y = a.children, b.children
    head = 0
    while head < min(len(x), len(y)) and x[head] is y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] is y[-1 - tail]:
        tail += 1
    pairs = [(i, i) for i in range(head)]
    mid_x, mid_y = x[head : len(x) - tail], y[head : len(y) - tail]
    if mid_x and mid_y:
        kinds = list(dict.fromkeys(mid_y))
        place = {k: i for i, k in enumerate(kinds)}
        of = np.array([place[k] for k in mid_y])
        weights = {k: np.array([tree_match(k, o) for o in kinds])[of] for k in dict.fromkeys(mid_x)}
        # One row of the table at a time; of each row only the choices stay, a bit each.
        above = np.zeros(len(mid_y) + 1, np.int64)
        paired, skipped = [], []
        for k in mid_x:
            both = above[:-1] + weights[k]
            row = np.maximum.accumulate(np.concatenate([[0], np.maximum(above[1:], both)]))
            paired.append(np.packbits((row[1:] == both) & (weights[k] > 0)))
            skipped.append(np.packbits(row[1:] == above[1:]))
            above = row
        i, j, found = len(mid_x), len(mid_y), []
        bit = lambda rows: rows[i - 1][(j - 1) >> 3] >> (7 - ((j - 1) & 7)) & 1
        while i and j:
            if bit(paired):
                i, j = i - 1, j - 1
                found.append((head + i, head + j))
            elif bit(skipped):
                i -= 1
            else:
                j -= 1
        pairs += found[::-1]
    return (*pairs, *((len(x) - t, len(y) - t) for t in range(tail, 0, -1)))


def mapped(page: Shape, wrapper: Shape) -> list[int]:
    """For each node of the page's shape the wrapper's node that it is matched with, numbered from the root on in page order; for a node
    without one, -1 - the node of its nearest matched ancestor."""
    out = [-1] * page.size
    if page.label != wrapper.label:
        return out

    def go(p: Shape, at: int, w: Shape, w_at: int) -> None:
        out[at] = w_at
        starts, n = [], w_at + 1
        for c in w.children:
            starts.append(n)
            n += c.size
        partner = dict(child_pairs(p, w)) if p is not w else {i: i for i in range(len(p.children))}
        at += 1
        for i, c in enumerate(p.children):
            if i in partner:
                go(c, at, w.children[partner[i]], starts[partner[i]])
            else:
                out[at : at + c.size] = [-1 - w_at] * c.size
            at += c.size

    go(page, 0, wrapper, 0)
    return out


class Layout:
    """The nodes of an outline: parents, elements, and which are chrome by their own name, class, id or role."""

    def __init__(self, lines: str):
        self.parents: list[int] = []
        self.nodes: list[Node] = []
        path: list[int] = []
        for i, line in enumerate(lines.split("\n")):
            depth, label = line.split(" ", 1)
            del path[int(depth) :]
            self.parents.append(path[-1] if path else -1)
            self.nodes.append(Node(_element(label)[0], label, *_element(label)[1:]))
            path.append(i)
        self.chrome = [
            n.tag in CHROME_TAGS or n.tag == "head" or bool(n.words & CHROME_WORDS or n.roles & CHROME_ROLES or "hidden" in n.roles) for n in self.nodes
        ]

    def inside(self, marked: Sequence[bool], stop: frozenset[int] = frozenset()) -> list[bool]:
        """Nodes that are marked or below a marked one, where nodes of ``stop`` begin anew."""
        out: list[bool] = []
        for i, p in enumerate(self.parents):
            out.append(i not in stop and (marked[i] or p >= 0 and out[p]))
        return out

    def totals(self, own: Sequence[int]) -> list[int]:
        """Sums over each node's subtree."""
        out = list(own)
        for i in range(len(out) - 1, 0, -1):
            out[self.parents[i]] += out[i]
        return out

    def region(self, prose: Sequence[int]) -> tuple[int, list[int]]:
        """The nodes that hold the main text, by ``prose`` (characters of text beside links, by node), and the kind of mark that tells them;
        -1 where none does: then the region is the node down to which most prose leads."""
        chrome = self.inside(self.chrome)
        for hidden in (chrome, [False] * len(chrome)):
            # Marked regions inside chrome count only if there is no other, as below an advert that is not closed.
            total = self.totals([0 if h else p for h, p in zip(hidden, prose, strict=True)])
            for kind, is_region in enumerate(REGIONS[: 4 if hidden is chrome else 3]):
                found = [not h and is_region(n) and not (n.words & CHROME_WORDS) for n, h in zip(self.nodes, hidden, strict=True)]
                above = self.inside(found)
                tops = [i for i, f in enumerate(found) if f and not (self.parents[i] >= 0 and above[self.parents[i]])]
                if tops:
                    most = max(total[i] for i in tops)
                    tops = [i for i in tops if 2 * total[i] >= most]
                    if 10 * sum(total[i] for i in tops) >= 3 * total[0]:
                        return kind, tops
        total = self.totals([0 if h else p for h, p in zip(chrome, prose, strict=True)])
        at = 0
        while True:
            best = max((i for i, p in enumerate(self.parents) if p == at and self.nodes[i].tag not in PROSE | {"#"}), key=lambda i: total[i], default=None)
            if best is None or 10 * total[best] < 6 * total[at] or not total[best]:
                return -1, [at]
            at = best


def main_text(
    layout: Layout, texts: Sequence[tuple[int, str, int]], matched: Sequence[int], kind: int, region: Sequence[int], template: Sequence[int]
) -> str:
    """A page's texts that lie in its host's content region and are neither chrome nor template."""
    wanted, fixed = set(region), set(template)
    tops = frozenset(i for i, w in enumerate(matched) if w in wanted)
    if kind >= 0:
        # A region that the wrapper does not have at this place is known by the same mark.
        chrome = layout.inside(layout.chrome, tops)
        tops |= frozenset(i for i, n in enumerate(layout.nodes) if matched[i] < 0 and REGIONS[kind](n) and not chrome[i] and not n.words & CHROME_WORDS)
    if not tops:
        prose = [0] * len(layout.nodes)
        for i, t, links in texts:
            prose[i] += len(t) - links
        kind, own = layout.region(prose)
        tops = frozenset(own)
    inside = layout.inside([i in tops for i in range(len(layout.nodes))])
    header = [kind < 0 and (n.tag in HEADER_TAGS or bool(n.words & HEADER_WORDS)) for n in layout.nodes]
    dropped = layout.inside([c or h for c, h in zip(layout.chrome, header, strict=True)], tops)

    def keeps(i: int) -> bool:
        # Pages share passages: what stands in a paragraph of a marked region is its text, however many pages have it.
        prose = kind >= 0 and layout.nodes[layout.parents[i]].tag in PROSE
        return inside[i] and not dropped[i] and (prose or matched[i] not in fixed)

    return " ".join(t for i, t, _ in texts if keeps(i))


def _host(url: str | None) -> str:
    after = (url or "").split("://", 1)
    return re.split(r"[/?#]", after[1], maxsplit=1)[0].translate(_ASCII_LOWER) if len(after) == 2 else ""


_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
_PARSED = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("shape", pa.string()), ("outline", pa.string()), ("same", pa.string()),
    ("texts", pa.list_(pa.struct([("node", pa.int32()), ("text", pa.string()), ("links", pa.int32())]))),
    ("sums", pa.list_(pa.struct([("node", pa.int32()), ("hash", pa.binary()), ("chars", pa.int64()), ("links", pa.int64())]))),
])
_PARSED_SQL = (
    "page_id long, url string, host string, shape string, outline string, same string, texts array<struct<node:int,text:string,links:int>>, "
    "sums array<struct<node:int,hash:binary,chars:bigint,links:bigint>>"
)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's outline and texts; per node of the outline the hash and length of what the page has there."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            rows = []
            for page_id, url, raw in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns), strict=True):
                page = (raw or b"").decode("utf-8", "replace")
                lines, texts = outline(parse(page))
                at: dict[int, list] = {}
                for node, text, links in texts:
                    held = at.setdefault(node, [hashlib.md5(), 0, 0])
                    held[0].update(text.encode() + b"\n")
                    held[1] += len(text)
                    held[2] += links
                same = hashlib.md5(b"".join(h[0].digest() for h in at.values())).hexdigest()
                shape = hashlib.md5(lines.encode()).hexdigest()
                rows.append((
                    page_id, url, _host(url) or f" {shape}{same}", shape, lines, same, [dict(zip(("node", "text", "links"), t, strict=True)) for t in texts],
                    [{"node": n, "hash": h[0].digest()[:8], "chars": h[1], "links": h[2]} for n, h in at.items()],
                ))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_PARSED)], schema=_PARSED)


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each shape's best reference among its host's, by simple tree matching, and its nodes' places there."""
    for batch in batches:
        hosts, shapes, refs, maps = [], [], [], []
        for r in batch.to_pylist():
            page = shape_of(r["outline"])
            others = [(x["ref"], shape_of(x["outline"])) for x in sorted(r["refs"], key=lambda x: x["ref"])]
            ref, best = max(others, key=lambda o: (2 * tree_match(page, o[1]) / (page.size + o[1].size), -o[0]))
            hosts.append(r["host"])
            shapes.append(r["shape"])
            refs.append(ref)
            maps.append(mapped(page, best))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(shapes, pa.string()), pa.array(refs, pa.int32()), pa.array(maps, pa.list_(pa.int32()))],
            names=["host", "shape", "ref", "matched"],
        )


def induce(lines: str, stats: Sequence[dict]) -> tuple[int, list[int], list[int]]:
    """A wrapper's region and kind, and its template nodes, from what all pages have at its nodes: ``node``, ``pages``, ``top`` (pages with
    the most frequent text), ``chars`` and ``links``."""
    layout = Layout(lines)
    prose = [0] * len(layout.nodes)
    template = []
    for s in stats:
        if s["pages"] >= SAME_PAGES and s["top"] >= SAME_SHARE * s["pages"]:
            template.append(s["node"])
        else:
            prose[s["node"]] = max(s["chars"] - s["links"], 0)
    return *layout.region(prose), template


def _induced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(r["host"], r["ref"], *induce(r["outline"], r["stats"] or [])) for r in batch.to_pylist()]
        types = (pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["host", "ref", "kind", "region", "template"]
        )


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    layouts: dict[str, Layout] = {}
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            rows = batch.slice(start, 256).to_pylist()
            out = []
            for r in rows:
                if r["shape"] not in layouts:
                    if len(layouts) > 10_000:
                        layouts.clear()
                    layouts[r["shape"]] = Layout(r["outline"])
                texts = [(t["node"], t["text"], t["links"]) for t in r["texts"]]
                out.append(main_text(layouts[r["shape"]], texts, r["matched"], r["kind"], r["region"], r["template"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["page_id"] for r in rows], pa.int64()), pa.array([r["url"] for r in rows], pa.string()), pa.array(out, pa.string())],
                names=["page_id", "url", "text"],
            )


def extract_text(pages: DataFrame, *, shapes: int = SHAPES) -> DataFrame:
    """The main text of each page of ``pages`` (page_id, url, html): page_id, url, text and n_chars (code points).

    1. Pages are parsed into trees of blocks and their texts; equal neighbours count once in a tree's shape.
    2. The ``shapes`` most frequent shapes of a host are its wrapper.  Each shape of the host is aligned with the one it matches best, by
       simple tree matching; so each node of each page has a place in the wrapper, or a nearest one above it.
    3. At each place the texts of all different pages of the host are counted.  A text that stays the same on nine tenths of three pages or
       more is template; what varies is content.  The region that holds the main text is the wrapper's marked one (article, main, a class
       of content) or else the node down to which most varying text beside links leads.
    4. A page's text is what stands at the region's places or below, without template and without menus, forms, notices, adverts, comments
       and the like, which element, role, class or id tell.  In a marked region headings, paragraphs, cells and items stay even if pages share
       them.

    White space inside a block is one space; blocks are joined by one space.  Null and empty html give an empty text, as do pages without
    text.  Null urls and urls without a host stand alone: each is its own wrapper.  Repeated rows give a row each and count once in
    the wrapper.  Very long pages are read whole; elements nested deeper than 100 stay at that depth.  Bytes that are not UTF-8 become
    U+FFFD.  Columns beside page_id, url and html are not read; an empty table gives an empty result.  A host with a large share of all
    pages is counted in parts: nothing is gathered by host but its few most frequent shapes.
    """
    scratch = Scratch(pages.sparkSession, "extract")
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("binary").alias("html"))
    parsed = scratch.save(source.mapInArrow(_parsed, _PARSED_SQL))
    seen = scratch.save(parsed.groupBy("host", "shape").agg(F.first("outline").alias("outline"), F.count(F.lit(1)).alias("n")))
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), "shape")).cast("int")
    references = scratch.save(seen.withColumn("ref", rank).filter(F.col("ref") <= shapes).select("host", "ref", "outline"))
    of_host = references.groupBy("host").agg(F.collect_list(F.struct("ref", "outline")).alias("refs"))
    aligned = scratch.save(
        seen.select("host", "shape", "outline").join(of_host, "host").select("host", "shape", "outline", "refs")
        .mapInArrow(_align, "host string, shape string, ref int, matched array<int>")
    )
    places = (
        parsed.groupBy("host", "shape", "same").agg(F.first("sums").alias("sums")).join(aligned, ["host", "shape"])
        .select("host", "ref", "matched", F.inline("sums"))
        .withColumn("node", F.element_at("matched", F.col("node") + 1)).filter("node >= 0")
    )
    stats = (
        places.groupBy("host", "ref", "node", "hash").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
        .groupBy("host", "ref", "node").agg(F.sum("n").alias("pages"), F.max("n").alias("top"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
        # As many rows as the reference has nodes.
        .groupBy("host", "ref").agg(F.collect_list(F.struct("node", "pages", "top", "chars", "links")).alias("stats"))
    )
    wrappers = (
        references.join(stats, ["host", "ref"], "left").select("host", "ref", "outline", "stats")
        .mapInArrow(_induced, "host string, ref int, kind int, region array<int>, template array<int>")
    )
    rules = scratch.save(aligned.join(wrappers, ["host", "ref"]).select("host", "shape", "matched", "kind", "region", "template"))
    scratch.drop(seen, references, aligned)
    found = parsed.select("page_id", "url", "host", "shape", "outline", "texts").join(rules, ["host", "shape"])
    return found.mapInArrow(_extracted, "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))
