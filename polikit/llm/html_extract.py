"""Main text of web pages by wrapper induction.

Pages of a host share a layout. All different pages of a host are aligned, whole, with one of them, its
*anchor* (the shortest of ``REFERENCES`` chosen by hash), by simple tree matching (the largest order-keeping match
of two DOM trees whose matched nodes have matched parents and equal tags). Texts of the anchor that the aligned
nodes of all others repeat (from ``REFERENCES`` others on, of ``TEMPLATE_SHARE`` of them, so that a few broken pages
do not hide a layout) are constant; texts that differ, or that have no partner, fill the host's *slots*. Every page
votes for the container that holds most of its slot text; the path that most of them name is the host's *wrapper*.
How many different pages of the host have a block of text in that container is then
counted for all blocks of all its pages, and those on
nearly all are its *template*: two pages suffice, if most of their text differs (pages that
share most of it are copies of one another, and tell nothing about a layout).

A page is read through its host's wrapper: the text below the content node, in blocks,
without the nodes of the template and without what is no article by its element (menus, asides,
forms, scripts...) or by a whole class, id or role (``BOILERPLATE``, for parts that vary as an
article does, such as reader comments). Outside the container a word within such a name
suffices. Where the path leads to several nodes, that with the most text that is not
constant on the host is read. Where it leads nowhere (a broken page) or to little of the
page's text, or a host has one page, the container is found on the page itself by the same
descent.

Scale: what is gathered by host is the outline of an anchor (its tree, long texts as digests) and counters of its
texts; pages meet it one by one, in their own tasks. Subtrees of one shape are weighed once, equal
ones not at all, and long lists of children take rows of numpy with every so many rows kept, so the memory of an
alignment grows with the list, not with its square. A page's blocks are counted, by digest, in the container that it
votes for; only pages that voted otherwise than their host are read once more. Wrappers are counted and measured
before they are broadcast.

Null and empty pages have the text ''. A null url is the host ''. Pages without closing tags
and cut-off pages are read as far as they go. Repeated rows stay; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, broadcast_if_small, stage
from .language_id import host_of

REFERENCES = 8
BRANCHES = 48  # children of a node that a skeleton keeps at either end
NODES = 3_000  # of a skeleton
TEXT = 200  # characters of a text beyond which a skeleton has a digest of it
TEMPLATE_SHARE = 0.8  # of a host's different pages that have a node of its template
CELLS = 1 << 14  # of an alignment of two lists of children beyond which it is done by rows of numpy
SHAPES = 200_000  # shapes and weights that an alignment remembers
TEMPLATE_MASS = 1 / 3  # of a reference's content that may be constant
WRAPPERS_BROADCAST = 50_000
WRAPPER_BYTES = 32 << 20

# Names of elements, and words in class, id and role, that are not the article.
SKIPPED = frozenset("""head script style noscript template nav footer aside form button select option input textarea
    iframe svg canvas object embed audio video menu dialog""".split())
BOILERPLATE = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion
    cookie cookies consent gdpr notice notices popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs
    sidebar aside footer header masthead comment comments respond reply replies disqus share sharing social related
    recommended newsletter subscribe signup login search pagination pager toolbar widget contentinfo complementary""".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s
    samp small span strike strong sub sup time tt u var wbr img""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"))
CONTAINERS = frozenset("html body main article section div td tr tbody table center span".split())
CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li dd dt""".split())
CLOSES_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
               "th": ("td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
         "th": ("tr", "table"), "option": ("select",)}

_MARK = re.compile(
    r"""<(?:!--.*?(?:--!?>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|[!?/][^>]*+(?:>|\Z)|/?[a-zA-Z][^>]*+\Z)""",
    re.S)
_NAMES = re.compile(r"""(?i)(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")


class Node:
    __slots__ = ("tag", "names", "children", "text", "size")

    def __init__(self, tag: str, names: str = "", text: str | None = None, size: int | None = None):
        self.tag, self.names, self.text = tag, names, text
        self.size = len((text or "").strip()) if size is None else size
        self.children: list[Node] = []


def parse(page: str | None) -> Node:
    """The page's tree; text nodes have the tag ``#`` and their references decoded."""
    page = page or ""
    root = Node("#root")
    stack, at, end = [root], 0, len(page)

    def text(raw: str) -> None:
        if raw:
            stack[-1].children.append(Node("#", "", entities.unescape(raw)))

    def close(tags: tuple[str, ...], scope: tuple[str, ...] = ()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in scope:
                return

    while at < end:
        mark = _MARK.search(page, at)
        if mark is None:
            text(page[at:])
            break
        text(page[at:mark.start()])
        at = mark.end()
        tag = (mark[2] or mark[5] or "").lower()
        if not tag:
            continue
        if mark[1] or mark[4]:
            close((tag,))
            continue
        if tag in CLOSES_P:
            close(("p",), ("button", "table", "td", "th", "article", "section", "div", "body"))
        if tag in CLOSES_SAME:
            close(CLOSES_SAME[tag], SCOPE[tag])
        attributes = mark[3] or mark[6] or ""
        names = " ".join(m[2].strip("\"'") for m in _NAMES.finditer(attributes)) if "=" in attributes else ""
        node = Node(tag, names)
        stack[-1].children.append(node)
        if tag in RAW:
            over = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = over.end() if over else end
        elif tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
    return root


def skipped(node: Node, in_article: bool, whole: bool = False) -> bool:
    """Whether a node is known not to be the article. ``whole``: by a whole name, not by a word in one."""
    if node.tag in SKIPPED or node.tag == "title" or node.tag == "header" and not in_article:
        return True
    if not node.names or node.tag in ("html", "body", "article", "main"):
        return False
    if whole:
        return not BOILERPLATE.isdisjoint(node.names.lower().split())
    words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", node.names).lower())
    return not BOILERPLATE.isdisjoint(words)


Block = tuple[str, str]  # tags from the container down, and text
_SEEN = pa.list_(pa.struct([("id", pa.binary()), ("nth", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("size", pa.int32())]))


def placed_blocks(top: Node) -> list[Block]:
    """The blocks below ``top``, in order: white space is one space, none is empty."""
    whole = top.tag not in ("#root", "html", "body")
    out: list[Block] = []
    now: list[str] = []

    def end(path: str) -> None:
        words = "".join(now).split()
        now.clear()
        if words:
            out.append((path, " ".join(words)))

    # a stack, not recursion: pages may nest deeply; a path is kept to its last tags
    todo: list[tuple[Node | None, bool, str]] = [(top, top.tag == "article", "")]
    while todo:
        node, inside, path = todo.pop()
        if node is None:
            end(path)
        elif node.tag == "#":
            now.append(node.text or "")
        elif node is not top and skipped(node, inside, whole):
            if node.tag not in INLINE:
                end(path)
        else:
            inside = inside or node.tag == "article"
            if node.tag not in INLINE:
                end(path)
                path = f"{path}/{node.tag}"[-60:] if node is not top else path
                todo.append((None, inside, path))
            todo.extend((c, inside, path) for c in reversed(node.children))
    end("")
    return out


def block_id(block: Block) -> bytes:
    """128 bits of a block's path and text."""
    return hashlib.blake2b("\0".join(block).encode("utf-8", "replace"), digest_size=16).digest()


def blocks(top: Node, template: list[list] = ()) -> list[str]:
    """Texts of the blocks below ``top`` without the template's nodes: of each, the one block of its path and
    text (no path: of its ``block_id``) that stands nearest to its place, counted from the end that it stood nearer to."""
    found = placed_blocks(top)
    places: dict = {}
    if template:
        for i, block in enumerate(found):
            places.setdefault(block, []).append(i)
        places |= {block_id(block).hex().upper(): own for block, own in places.items()}
    gone = set()
    for path, text, from_start, from_end in template:
        same = [i for i in places.get(text if path is None else (path, text), ()) if i not in gone]
        if same:
            gone.add(min(same, key=lambda i: abs(len(found) - i - from_end) if from_end <= from_start else abs(i - from_start)))
    return [text for i, (_, text) in enumerate(found) if i not in gone]


def _masses(top: Node, counts) -> dict[int, int]:
    """By id of node: characters of the text below it that ``counts`` (a test of text nodes). A word in a name
    rules out a node only if no article or heading is in it."""
    mass: dict[int, int] = {}
    holds: set[int] = set()
    order: list[tuple[Node, bool]] = [(top, False)]
    while order:
        node, ready = order.pop()
        if node.tag == "#":
            mass[id(node)] = node.size if counts(node) else 0
        elif ready:
            mass[id(node)] = sum(mass[id(c)] for c in node.children)
            if node.tag in ("article", "main", "h1") or any(id(c) in holds for c in node.children):
                holds.add(id(node))
            if node is not top and skipped(node, False, id(node) in holds):
                mass[id(node)] = 0
                holds.discard(id(node))
        else:
            order.append((node, True))
            order.extend((c, False) for c in node.children)
    return mass


def content_path(top: Node, counts=lambda node: True, mass: dict[int, int] | None = None) -> list[Node]:
    """From the root down to the container that holds most of the text that counts (``mass``: its masses, if known)."""
    mass = _masses(top, counts) if mass is None else mass
    path = [top]
    while True:
        node = path[-1]
        named = [c for c in node.children if c.tag in ("article", "main") and mass[id(c)] > 0]
        inside = [c for c in node.children if c.tag in CONTAINERS and mass[id(c)] > 0]
        best = max(named or inside, key=lambda c: mass[id(c)], default=None)
        if best is None or node.tag == "article" or any(c.tag in ("h1", "h2") for c in node.children):
            return path
        if not named and mass[id(best)] < 0.6 * mass[id(node)]:
            return path
        path.append(best)


class Shapes:
    """Numbers of tree shapes (equal for trees that differ in texts only), and the sizes of their largest matches."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.kids: list[tuple[int, ...]] = []
        self.tags: list[str] = []
        self.sizes: list[int] = []
        self.weights: dict[tuple[int, int], int] = {}

    def full(self) -> bool:
        return len(self.numbers) + len(self.weights) > SHAPES

    def of(self, top: Node) -> dict[int, int]:
        """By id of node: the number of its shape."""
        found: dict[int, int] = {}
        order = [top]
        for node in order:
            order.extend(node.children)
        for node in reversed(order):
            kids = tuple([found[id(c)] for c in node.children])
            number = self.numbers.get((node.tag, kids))
            if number is None:
                number = self.numbers[(node.tag, kids)] = len(self.tags)
                self.tags.append(node.tag)
                self.kids.append(kids)
                self.sizes.append(1 + sum([self.sizes[k] for k in kids]))
            found[id(node)] = number
        return found

    def _known(self, x: int, y: int) -> int | None:
        if x == y:
            return self.sizes[x]
        if self.tags[x] != self.tags[y]:
            return 0
        if not self.kids[x] or not self.kids[y]:
            return 1
        return self.weights.get((x, y))

    def weigh(self, x: int, y: int) -> int:
        """Matched nodes of two shapes at most."""
        todo = [(x, y)]
        while todo:
            p, q = todo[-1]
            if self._known(p, q) is not None:
                todo.pop()
                continue
            # equal shapes at either end match one another in some largest match
            ps, qs = self.kids[p], self.kids[q]
            i, j, k = len(ps), len(qs), 0
            while i and j and ps[i - 1] == qs[j - 1]:
                i, j = i - 1, j - 1
            while k < i and k < j and ps[k] == qs[k]:
                k += 1
            ps, qs, rest = ps[k:i], qs[k:j], sum([self.sizes[c] for c in ps[:k] + ps[i:]])
            open_ = [(c, d) for c in set(ps) for d in set(qs) if self._known(c, d) is None]
            if open_:
                todo += open_
            else:
                self.weights[(p, q)] = 1 + rest + _last(self, ps, qs)
                todo.pop()
        return self._known(x, y)

    def matrix(self, xs: tuple[int, ...], ys: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights of the different shapes of two lists, and the place of each element among them."""
        (a, at), (b, of) = np.unique(xs, return_inverse=True), np.unique(ys, return_inverse=True)
        return np.array([[self._known(x, y) for y in b.tolist()] for x in a.tolist()], np.int64), at, of


def _next(row: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The row below of an alignment's table."""
    best = np.empty_like(row)
    best[0] = 0
    np.maximum(row[1:], row[:-1] + weights, out=best[1:])
    return np.maximum.accumulate(best, out=best)


def _table(shapes: Shapes, xs: tuple[int, ...], ys: tuple[int, ...]) -> list[list[int]]:
    m = [[0] * (len(ys) + 1)]
    for x in xs:
        above, row, left = m[-1], [0], 0
        for j, y in enumerate(ys):
            up, both = above[j + 1], above[j] + shapes._known(x, y)
            left = left if left >= up else up
            left = left if left >= both else both
            row.append(left)
        m.append(row)
    return m


def _last(shapes: Shapes, xs: tuple[int, ...], ys: tuple[int, ...]) -> int:
    """The weight of the best alignment of two lists of shapes."""
    if not xs or not ys:
        return 0
    if len(xs) * len(ys) <= CELLS:
        return _table(shapes, xs, ys)[-1][-1]
    w, at, of = shapes.matrix(xs, ys)
    row = np.zeros(len(ys) + 1, np.int64)
    for i in at:
        row = _next(row, w[i][of])
    return int(row[-1])


def _aligned(shapes: Shapes, xs: tuple[int, ...], ys: tuple[int, ...]) -> list[tuple[int, int]]:
    """Places of the best alignment of two lists of shapes, from their ends; of equally good ones, the last pairs."""
    out, i, j = [], len(xs), len(ys)
    while i and j and xs[i - 1] == ys[j - 1]:
        i, j = i - 1, j - 1
        out.append((i, j))
    if not i or not j:
        return out
    for x in set(xs[:i]):
        for y in set(ys[:j]):
            shapes.weigh(x, y)
    small = i * j <= CELLS
    if small:
        m, low = _table(shapes, xs[:i], ys[:j]), 0
    else:
        w, at, of = shapes.matrix(xs[:i], ys[:j])
        step, row, kept = isqrt(i) + 1, np.zeros(j + 1, np.int64), []
        for k in range(i):
            if k % step == 0:
                kept.append(row)
            row = _next(row, w[at[k]][of])
        m, low = [], i + 1  # the rows from ``low`` on
    while i and j:
        if not small and i - 1 < low:
            low = (i - 1) // step * step
            m = [kept[low // step]]
            for k in range(low, i):
                m.append(_next(m[-1], w[at[k]][of]))
        here, above = m[i - low], m[i - 1 - low]
        both = shapes._known(xs[i - 1], ys[j - 1])
        if both and here[j] == above[j - 1] + both:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif here[j] == above[j]:
            i -= 1
        else:
            j -= 1
    return out


def tree_match(a: Node, b: Node, shapes: Shapes | None = None) -> list[tuple[Node, Node]]:
    """Aligned pairs of two trees by simple tree matching (``shapes``: what earlier ones have found)."""
    if a.tag != b.tag:
        return []
    shapes = shapes or Shapes()
    of_a, of_b = shapes.of(a), shapes.of(b)
    pairs, todo = [], [(a, b)]
    while todo:
        p, q = todo.pop()
        pairs.append((p, q))
        if not p.children or not q.children:
            continue
        if of_a[id(p)] == of_b[id(q)]:
            todo.extend(zip(p.children, q.children, strict=True))
        else:
            todo.extend((p.children[i], q.children[j]) for i, j in _aligned(
                shapes, shapes.kids[of_a[id(p)]], shapes.kids[of_b[id(q)]]))
    return pairs


def _step(node: Node) -> str:
    return f"{node.tag} {node.names}".strip()


def _words(node: Node) -> str:
    return " ".join((node.text or "").split())


def _mark(node: Node) -> str:
    """A node's words; of many, their beginning and a digest of them all."""
    text = _words(node)
    return text if len(text) <= TEXT else f"{text[:40]}\0{hashlib.sha256(text.encode('utf-8', 'replace')).hexdigest()}"


def outline(page: str | None) -> str:
    """A page's whole tree as JSON, of any depth: each node before its children, texts as marks."""
    top = parse(page)
    made, todo = [], [top]
    while todo:
        node = todo.pop()
        made.append([node.tag, node.names, None if node.text is None else _mark(node), node.size, len(node.children)])
        todo.extend(reversed(node.children))
    return json.dumps(made, ensure_ascii=False)


def _outlined(made: str) -> Node:
    top, todo = None, []
    for tag, names, text, size, n in json.loads(made):
        node = Node(tag, names, text, size)
        if top is None:
            top = node
        else:
            parent, left = todo[-1]
            parent.children.append(node)
            todo[-1][1] = left - 1
            if left == 1:
                todo.pop()
        if n:
            todo.append([node, n])
    return top


def _texts(top: Node) -> list[Node]:
    """The text nodes of a tree, in the order of the page."""
    out, todo = [], [top]
    while todo:
        node = todo.pop()
        if node.tag == "#":
            out.append(node)
        todo.extend(reversed(node.children))
    return out


def anchor_of(outlines: list[str]) -> str | None:
    """Of pages of a host, that with the shortest text, which the others are aligned with."""
    made = {" ".join(blocks(_outlined(o))): o for o in sorted(outlines)}
    made.pop("", None)
    return made[min(made, key=lambda k: (len(k), k))] if made else None


def repeated(anchor: Node, page: Node, shapes: Shapes | None = None) -> list[int]:
    """Places, among the texts of ``anchor``, of those whose aligned node of ``page`` reads the same."""
    same = {id(p) for p, q in tree_match(anchor, page, shapes) if p.tag == "#" and _words(p) == _mark(q)}
    return [i for i, node in enumerate(_texts(anchor)) if id(node) in same]


def enough_of(others: int) -> int:
    """How many of so many other pages must repeat a constant text."""
    return others if others < REFERENCES else -int(-TEMPLATE_SHARE * others // 1)


def skeleton(page: str | None) -> str:
    """A page's tree as JSON, bounded: of many children those at both ends, of long texts a digest."""
    top = parse(page)
    left = NODES
    out: list = []
    todo: list[tuple[Node, list]] = [(top, out)]
    while todo and left > 0:  # level by level, so what is near the root is kept
        after = []
        for node, into in todo:
            left -= 1
            if left < 0:
                break
            text = None if node.text is None else _mark(node)
            children: list = []
            into.append([node.tag, node.names[:TEXT], text, node.size, children])
            many = node.children
            kept = many if len(many) <= 2 * BRANCHES else many[:BRANCHES] + many[-BRANCHES:]
            after += [(c, children) for c in kept]
        todo = after
    return json.dumps(out[0], ensure_ascii=False)


def _tree(made: str) -> Node:
    data = json.loads(made)
    top = Node(*data[:4])
    todo = [(data, top)]
    while todo:
        (*_, children), node = todo.pop()
        for own in children:
            child = Node(*own[:4])
            node.children.append(child)
            todo.append((own, child))
    return top


def induce(skeletons: list[str]) -> dict:
    """What ``wrappers`` finds, of few pages and in one place, from their skeletons: {"path": steps, "candidates": constant
    nodes in the container as (path, text, places from its start and end), "constant": texts anywhere on the page
    that all of them share}."""
    trees = {" ".join(blocks(t)): t for t in map(_tree, sorted(skeletons))}  # of copies, one
    trees.pop("", None)
    if len(trees) < 2:
        return {"path": [], "candidates": [], "constant": []}
    first, *others = [trees[k] for k in sorted(trees, key=lambda k: (len(k), k))]
    partners: dict[int, list[str]] = {}
    for other in others:
        for p, q in tree_match(first, other):
            if p.tag == "#":
                partners.setdefault(id(p), []).append(_words(q))

    def constant(node: Node, of: int = len(others)) -> bool:
        own = partners.get(id(node), [])
        return len(own) >= of and own.count(_words(node)) >= of

    everywhere, todo = set(), [first]
    while todo:
        node = todo.pop()
        todo.extend(node.children)
        if node.tag == "#" and _words(node) and constant(node):
            everywhere.add(_words(node))
    paths = Counter()
    paths[tuple(map(_step, content_path(first, lambda n: not constant(n))[1:]))] += 1
    for other in others:
        paths[tuple(map(_step, content_path(other, lambda n: _words(n) not in everywhere)[1:]))] += 1
    path = max(paths, key=lambda p: (paths[p], p))
    # nodes that most references share are candidates; all pages of the host decide
    most = max(1, int(TEMPLATE_SHARE * len(others)))
    top = content_path(first, lambda n: not constant(n))[-1]
    shared, todo = set(), [top]
    while todo:
        node = todo.pop()
        todo.extend(node.children)
        if node.tag == "#" and _words(node) and "\0" not in _words(node) and constant(node, most):
            shared.add(_words(node))
    placed = placed_blocks(top)
    candidates = [[where, text, i, len(placed) - i] for i, (where, text) in enumerate(placed) if text in shared]
    mass = _masses(top, lambda n: True)[id(top)]
    if sum(len(c[1]) for c in candidates) > TEMPLATE_MASS * mass:
        candidates = []
    return {"path": list(path), "candidates": candidates, "constant": sorted(everywhere)}


def led_to(top: Node, wrapper: dict) -> tuple[Node, list[str]]:
    """The node of a page that a wrapper's path leads to, or the page's own container, and the path. A wrapper without
    a path is taken to have that of the page's own container."""
    constant = frozenset(wrapper["constant"])
    mass = _masses(top, lambda n: _mark(n) not in constant)
    way = content_path(top, mass=mass)
    path = list(map(_step, way[1:])) if wrapper["path"] is None else wrapper["path"]
    fitting = [top]
    for step in path:
        fitting = [c for n in fitting for c in n.children if _step(c) == step]
    node = max(fitting, key=lambda n: mass.get(id(n), 0), default=None)
    own = way[-1]
    return own if node is None or mass.get(id(node), 0) < 0.6 * mass[id(own)] else node, path


def container(top: Node, wrapper: dict) -> Node:
    """The node of a page that a wrapper's path leads to, or the page's own container."""
    return led_to(top, wrapper)[0]


def extract(page: str | None, wrapper: dict | None) -> str:
    """The main text of a page."""
    top = parse(page)
    if not wrapper or not wrapper["path"]:
        return " ".join(blocks(content_path(top)[-1]))
    return " ".join(blocks(container(top, wrapper), wrapper.get("template", ())))


def _json_wrappers(batch: pa.RecordBatch, column: int, known: dict[str, dict]) -> list[dict | None]:
    """The wrappers of a batch's rows; ``known`` keeps those that were parsed."""
    out = []
    for made in batch.column(column).to_pylist():
        if made is not None and made not in known:
            if len(known) > 1000:
                known.clear()
            known[made] = json.loads(made)
        out.append(known.get(made))
    return out


def _counted(top: Node) -> list[dict]:
    """The blocks below ``top`` for counting by digest: which of its equals each is, and its places from both ends."""
    own = placed_blocks(top)
    before: Counter = Counter()
    seen = []
    for i, block in enumerate(own):
        seen.append({"id": block_id(block), "nth": before[block], "start": i, "end": len(own) - i, "size": len(block[1])})
        before[block] += 1
    return seen


def _small(found: DataFrame) -> DataFrame:
    """A broadcast hint for a side of few rows and bytes (host, text)."""
    n, size = found.agg(F.count("*"), F.coalesce(F.sum(F.length(found.columns[1])), F.lit(0))).first()
    return F.broadcast(found) if n <= WRAPPERS_BROADCAST and size <= WRAPPER_BYTES else found


def _beside(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (host, key, html) of the hosts that ``found`` (host, text) has, with its text."""
    name = found.columns[1]
    return rows.join(_small(found.withColumnRenamed("host", "host_")), F.col("host") == F.col("host_")).select(
        "host", "key", "html", name)


def _anchors(rows: DataFrame, references: int) -> DataFrame:
    """(host, anchor as an outline) of every host with at least two different pages."""
    # ranks over distinct pages of the host; the limit is applied in each task before the shuffle
    different = rows.select("host", "key").distinct()
    several = F.count("*").over(Window.partitionBy("host"))
    chosen = stage(different.withColumn("rank", F.row_number().over(Window.partitionBy("host").orderBy("key"))).filter(
        f"rank <= {references}").withColumn("several", several).filter("several > 1").select("host", "key"), "references")
    picked = rows.join(broadcast_if_small(chosen), ["host", "key"])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, page in enumerate(batch.column(2)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1),
                                                  pa.array([outline(page.as_py())], pa.string())], ["host", "key", "drawn"])

    drawn = picked.select("host", "key", "html").mapInArrow(draw, "host string, key long, drawn string")
    drawn = drawn.groupBy("host", "key").agg(F.first("drawn").alias("drawn"))
    by_host = drawn.groupBy("host").agg(F.collect_list("drawn").alias("pages"))  # at most ``references``

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [anchor_of(p.as_py()) for p in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["host", "anchor"])

    return stage(by_host.mapInArrow(choose, "host string, anchor string").filter("anchor IS NOT NULL"), "anchors")


def _constants(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """(host, constant: JSON of the marks of the texts that the host's other pages repeat where the anchor has them), of
    every host with two pages of different text. Every page is aligned with its host's anchor."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Node] = {}
        shapes = Shapes()
        for batch in batches:
            kept, texts, same = [], [], []
            for i, (page, made) in enumerate(zip(batch.column(1), batch.column(2).to_pylist(), strict=True)):
                if made not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[made] = _outlined(made)
                if shapes.full():
                    shapes = Shapes()
                top = parse(page.as_py())
                text = " ".join(blocks(top))
                if text:
                    kept.append(i)
                    texts.append(block_id(("", text)))
                    same.append([-1, *repeated(known[made], top, shapes)])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), pa.array(texts, pa.binary()),
                                              pa.array(same, pa.list_(pa.int32()))], ["host", "copy", "same"])

    aligned = _beside(rows, anchors).select("host", "html", "anchor").mapInArrow(align, "host string, copy binary, same array<int>")
    different = aligned.groupBy("host", "copy").agg(F.min("same").alias("same"))  # of copies, one
    tally = different.select("host", F.explode("same").alias("at")).groupBy("host", "at").agg(F.count("*").alias("n"))
    tally = tally.groupBy("host").agg(F.collect_list(F.struct("at", "n")).alias("tally"))  # as many as the anchor has texts

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for made, counted in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                n = {t["at"]: t["n"] for t in counted}
                others = n[-1] - 1  # all but the anchor
                marks = {_words(node) for i, node in enumerate(_texts(_outlined(made))) if n.get(i, 0) - 1 >= enough_of(others)}
                found.append(json.dumps(sorted(marks - {""}), ensure_ascii=False) if others else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["host", "constant"])

    return stage(anchors.join(tally, "host").mapInArrow(settle, "host string, constant string").filter(
        "constant IS NOT NULL"), "constants")


_SEEN_TYPE = "array<struct<id: binary, nth: int, start: int, end: int, size: int>>"


def _seen(found: DataFrame) -> DataFrame:
    """(host, key, path, seen) of ``found`` (host, key, html, wrapper): the blocks in each page's container, by the wrapper's
    path or, if it has none, by that to the page's own container."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in batches:
            paths, held = [], []
            for page, wrapper in zip(batch.column(2), _json_wrappers(batch, 3, known), strict=True):
                wrapper = wrapper if isinstance(wrapper, dict) else {"path": None, "constant": wrapper}
                node, path = led_to(parse(page.as_py()), wrapper)
                paths.append(path)
                held.append(_counted(node))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(paths, pa.list_(pa.string())),
                                              pa.array(held, _SEEN)], ["host", "key", "path", "seen"])

    pages = found.mapInArrow(run, f"host string, key long, path array<string>, seen {_SEEN_TYPE}")
    return pages.groupBy("host", "key").agg(F.first("path").alias("path"), F.first("seen").alias("seen"))  # different pages


def _template(pages: DataFrame) -> DataFrame:
    """(host, kept) of ``pages`` (host, key, seen): the blocks that ``TEMPLATE_SHARE`` of a host's different pages have in their
    container. A host whose pages share more than ``TEMPLATE_MASS`` of their content has no template."""
    mass = F.aggregate("seen", F.lit(0).cast("long"), lambda total, block: total + block["size"])
    total = pages.groupBy("host").agg(F.count("*").alias("n"), F.sum(mass).alias("mass"))
    counts = pages.select("host", F.inline("seen")).groupBy("host", "id", "nth").agg(
        F.count("*").alias("m"), F.min("start").alias("start"), F.min("end").alias("end"), F.first("size").alias("size"))
    enough = counts.filter("m >= 2").join(total, "host").filter(F.col("m") >= TEMPLATE_SHARE * F.col("n"))
    block = F.struct("start", "end", "nth", F.hex("id").alias("id"))
    # at most as many as a page has, over the share
    kept = enough.groupBy("host").agg(F.sort_array(F.collect_list(block)).alias("kept"), F.sum("size").alias("shared"),
                                      F.first(F.col("mass") / F.col("n")).alias("of"))
    return kept.filter(F.col("shared") <= TEMPLATE_MASS * F.col("of")).select("host", "kept")


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", references: int = REFERENCES) -> DataFrame:
    """(host, wrapper as JSON) of every host with at least two different pages, from all of them. ``references``: pages
    of which the shortest is the one that the others are aligned with."""
    bounded_batches(pages.sparkSession)
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).filter(
        F.col("html").isNotNull()).select("host", F.xxhash64("html").alias("key"), "html")
    constants = _constants(rows, _anchors(rows, references))
    own = stage(_seen(_beside(rows, constants)), "supports")
    votes = own.groupBy("host", "path").agg(F.count("*").alias("n"))
    path = votes.groupBy("host").agg(F.max(F.struct("n", "path"))["path"].alias("path"))
    wrapper = F.concat(F.lit('{"path": '), F.to_json("path"), F.lit(', "constant": '), "constant", F.lit("}"))
    voted = stage(constants.join(path, "host").select("host", wrapper.alias("wrapper"), F.to_json("path").alias("voted")), "paths")
    found = voted.filter("voted <> '[]'")
    beside = own.join(_small(found.select("host", "voted")), "host").withColumn("path", F.to_json("path"))
    other = stage(beside.filter("path <> voted").select("host", "key"), "others")
    counted = beside.filter("path = voted").select("host", "key", "seen")
    if n := other.count():
        again = rows.join(broadcast_if_small(other, n), ["host", "key"]).select("host", "key", "html")
        counted = counted.unionByName(_seen(_beside(again, found.select("host", "wrapper"))).select("host", "key", "seen"))
        counted = stage(counted, "supports")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                template = [[None, b["id"], b["start"], b["end"]] for b in own or []]
                made.append(json.dumps({**json.loads(text), "template": template}, ensure_ascii=False))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["host", "wrapper"])

    return stage(voted.join(_template(counted), "host", "left").select("host", "wrapper", "kept").mapInArrow(
        settle, "host string, wrapper string"), "wrappers")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text ('' if none) and n_chars of every page."""
    found = wrappers(pages, url_col, html_col).withColumnRenamed("host", "host_")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        host_of(F.col(url_col)).alias("host"))
    beside = rows.join(_small(found), F.col("host") == F.col("host_"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in batches:
            texts = [extract(page.as_py(), wrapper)
                     for page, wrapper in zip(batch.column(2), _json_wrappers(batch, 3, known), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    out = T.StructType([T.StructField("id", pages.schema[id_col].dataType), T.StructField("url", T.StringType()),
                        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return beside.select("id", "url", "html", "wrapper").mapInArrow(run, out).withColumnsRenamed(
        {"id": id_col, "url": url_col})
