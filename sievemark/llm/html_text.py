"""Main text of web pages by wrapper induction over pages of the same host.

Each page becomes a tree of its block elements in which an element's children of one
kind are folded into one node. A host's pages are grouped by layout, the paths of their
elements outside articles and runs of text: each that three pages have, however many; pages of rarer
ones join the likest. In each layout one page (of the commonest
paths the one with the smallest hash) is the model; every other page's tree is aligned
with the model's by simple tree matching. A text that so many of the host's different pages have in the same node
of a layout is template and goes; varying slots are content. Near copies of the model page count
as one page with it, so an article that stands on many pages makes no template. Where most of the varying text lies
within article or main elements, these bound the content, whose own texts all stay but links that all pages have; else slots that hold links
mainly are menus; a page without these takes its own article or main. Layouts with fewer than three different pages, or without varying
text, have no wrapper: there a page's own article or main elements are its text, or
its body where it has none. Elements whose name, class, id or role marks them as
navigation, page header or footer, sidebar, notice, advert, form, script, style or
reader comment are left out everywhere. Marks are whole names and compounds that end in
one (site-footer, comments-area); states (no-sidebar), ids of headings and paragraphs,
and compounds on what holds the page's heading and most of its text mark nothing.

Character references are decoded, white space within a block becomes one space, and
blocks are joined by a newline in page order.

Edge cases: a null or empty page has empty text; text without any element is one
block; unclosed and stray tags are tolerated; a page whose url has no host is aligned
with the others without host. Reading a page takes time linear in its length, however
its tags nest or its quotes stay open. Extra columns pass through unless they bear an
output's name. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html as references
import re
from bisect import bisect_right
from collections import defaultdict
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.plans.tables import cut, fitted

from .common import remembered, ship
from .url_filter import url_host

#: Elements that end a block, that are never content, and whose inside is not markup.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
NEVER = frozenset("aside audio button canvas datalist dialog embed footer form head iframe input map menu nav noembed noframes noscript object option script search select style svg template textarea title video".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag closes open elements of these names, up to one of those that hold them.
CLOSES = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
#: Words of a class, id or role that mark what is not content.
MARKS = frozenset(
    "ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs byline-ads comment commentlist comments complementary consent contentinfo cookie cookies disqus footer form gdpr "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promotion recommended related replies reply respond search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription teaser toc toolbar widget widgets".split()
)
HEADERS = frozenset(["header", "topbar"])
#: Words that may follow a mark in a compound ("comments-area"), and words before it that turn it into a state ("no-sidebar").
PLACES = frozenset("area articles bar block body bottom box button buttons col column container content copyright group holder icons inner item items left link links list main media news outer panel posts primary right row secondary section slot small stories this top unit wide wrap wrapper".split())
STATES = frozenset("has hide is no non not with without".split())
#: Elements whose ids are anchors of their text, as headings get automatically.
ANCHORED = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th pre blockquote table figure".split())
#: A tag whose quoted values may hold ">", and one that ends at the next ">".
QUOTED = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
#: Tags of a page whose quotes never close that are looked for to the page's end; further tags are read as plain ones.
MOST_OPEN_QUOTES = 16
NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"']+)""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
#: Text is a host's template if so large a share of its pages has it in the same place, of so many pages at least.
SHARE, LEAST_PAGES = 0.9, 3
#: Near copies share so many of their articles' runs of words; without articles, of those of their differing blocks, or of all.
RUN, SAME, ALL_SAME = 3, 0.5, 0.9
#: Elements below which a page's layout does not look, and the depth to which it does.
FLOWING = frozenset("address article blockquote caption dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr legend li main ol p pre summary table ul".split())
LAYOUT_DEPTH = 6
#: Pages belong to a layout that shares so many of their paths.
LAYOUT_SAME = 0.5
#: Sets of paths that one task looks up among a host's layouts, and rows that go back at once.
SLICE, ROWS = 100_000, 1000
#: Elements nested deeper belong to their ancestor at this depth when trees are aligned.
DEEPEST = 50
#: Model pages of all hosts are broadcast up to so many characters in all.
BROADCAST_CHARS = 16_000_000


class Node:
    __slots__ = ("tag", "label", "marked", "loosely", "heading", "children", "parent")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        names = NAMED.findall(attributes) if attributes else []
        self.tag, self.parent = tag, parent
        #: The element's kind in its page: its name with its first class or id, without numbers.
        self.label = f"{tag}.{re.sub(r'[^a-zA-Z]+', '', names[0][1].split()[0])}" if names and names[0][1].split() else tag
        #: 2 if hidden or a whole name marks it, 1 if only a compound does, which its text can overrule.
        mark = 2 if attributes and HIDDEN.search(attributes) else _marked(tag, names, MARKS)
        self.marked, self.loosely = mark > 0, mark == 1
        #: Marked as a header, which is the page's unless it stands in an article.
        self.heading = not self.marked and _marked(tag, names, HEADERS) > 0
        self.children: list[Node | str] = []


def _marked(tag: str, names: list[tuple[str, str]], marks: frozenset[str]) -> int:
    """2 if a whole class, id or role is among ``marks``, 1 if a compound ends in one, as site-footer or comments-area, 0 else."""
    found = 0
    for kind, value in names:
        if tag == "main" or kind.lower() == "id" and tag in ANCHORED:
            continue
        for token in value.strip("\"'").split():
            parts = [w for w in re.split(r"(?:\d+x\d+|[^a-z])+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()) if w]
            if len(parts) == 1 and parts[0] in marks:
                return 2
            while len(parts) > 1 and parts[-1] in PLACES:
                parts.pop()
            if parts and parts[-1] in marks and not STATES.intersection(parts[:-1]):
                found = 1
    return found


def _overrule(root: Node) -> None:
    """A compound name does not mark an element that holds a heading of first rank, main or article and most of the page's text."""
    todo: list[Node] = [root]
    order: list[Node] = []
    while todo:
        node = todo.pop()
        if node.tag in NEVER or node.marked and not node.loosely:
            continue
        order.append(node)
        todo += [c for c in node.children if not isinstance(c, str)]
    if not any(n.loosely for n in order):
        return
    size: dict[int, int] = {}
    heads: set[int] = set()
    for node in reversed(order):
        size[id(node)] = sum(len(c.strip()) if isinstance(c, str) else size.get(id(c), 0) for c in node.children)
        if node.tag in ("h1", "main", "article") and not node.marked or any(not isinstance(c, str) and id(c) in heads for c in node.children):
            heads.add(id(node))
    for node in order:
        if node.loosely and (node.tag == "article" or id(node) in heads) and 2 * size[id(node)] > size[id(root)]:
            node.marked = False


class Open:
    """The open elements, outermost first, and where those of a name and the blocks stand among them."""

    def __init__(self, root: Node):
        self.nodes, self.named, self.blocks = [root], defaultdict(list), []

    def push(self, node: Node) -> None:
        self.named[node.tag].append(len(self.nodes))
        if node.tag in BLOCK:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def close(self, at: int) -> None:
        """Close the element at that place and all within."""
        while len(self.nodes) > at:
            tag = self.nodes.pop().tag
            self.named[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def outermost(self, names: frozenset[str], within: frozenset[str]) -> int | None:
        """The place of the outermost element with one of the names inside the innermost of ``within``."""
        bound = max((self.named[t][-1] for t in within if self.named.get(t)), default=0)
        found = [at[i] for t in names if (at := self.named.get(t)) and (i := bisect_right(at, bound)) < len(at)]
        return min(found, default=None)


def _ends_itself(attributes: str) -> bool:
    """Whether a tag ends in a slash that is not part of an unquoted value."""
    last = attributes.rsplit(None, 1)[-1] if attributes.endswith("/") else ""
    return bool(last) and ("=" not in last or last[-2:-1] in "\"'")


def parse(page: str) -> Node:
    """A tree of all elements and texts, in time linear in the page; never fails."""
    root = Node("", "", None)
    there = Open(root)
    nodes, named, find = there.nodes, there.named, page.find
    at, last, unclosed, i = 0, page.rfind(">"), 0, page.find("<")
    while i >= 0:
        m, kind = None, page[i + 1 : i + 2]
        if kind == "!" and page.startswith("<!--", i):
            end = find("-->", i + 4)
            end = end + 3 if end >= 0 else len(page)
        elif kind in ("!", "?"):
            end = find(">", i + 2)
            end = end + 1 if end >= 0 else len(page)
        else:
            if i < last:
                m = QUOTED.match(page, i) if unclosed < MOST_OPEN_QUOTES else None
                if m is None and (m := PLAIN.match(page, i)):
                    unclosed += 1
            if m is None:
                i = find("<", i + 1)
                continue
            end = m.end()
        if i > at:
            nodes[-1].children.append(page[at:i])
        at = end
        if m is not None:
            closing, name, attributes = m.groups()
            name = name.lower()
            if closing:
                if named.get(name):
                    there.close(named[name][-1])
            else:
                if name in BLOCK and there.blocks and nodes[there.blocks[-1]].tag == "p":
                    there.close(there.blocks[-1])
                if name in CLOSES and (outer := there.outermost(*CLOSES[name])) is not None:
                    there.close(outer)
                child = Node(name, attributes, nodes[-1])
                nodes[-1].children.append(child)
                if name in RAW:
                    stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                    if name not in NEVER:
                        child.children.append(page[at : stop.start() if stop else len(page)])
                    at = stop.end() if stop else len(page)
                elif name not in EMPTY and (name in BLOCK or not _ends_itself(attributes)):
                    there.push(child)
        i = find("<", at)
    if at < len(page):
        nodes[-1].children.append(page[at:])
    _overrule(root)
    return root


def _clean(raw: str) -> str:
    return " ".join(references.unescape(raw).split())


def _skipped(node: Node, in_article: bool) -> bool:
    if node.tag in NEVER:
        return True
    if node.tag == "header" or node.heading and node.tag not in ("html", "body"):
        return not in_article
    return node.marked and node.tag not in ("html", "body")


def content_nodes(root: Node) -> list[Node]:
    """The outermost article or main elements that nothing marks as something else."""
    found: list[tuple[Node, bool]] = []
    todo = [(root, False)]
    while todo:
        node, doubtful = todo.pop()
        if node.tag in NEVER:
            continue
        doubtful = doubtful or node.marked and node.tag not in ("html", "body")
        if node.tag in ("article", "main"):
            inner = [n for n in content_nodes_in(node)] if node.tag == "main" else []
            found += [(n, doubtful or n.marked) for n in inner] or [(node, doubtful)]
            continue
        todo += [(c, doubtful) for c in reversed(node.children) if not isinstance(c, str)]
    return [n for n, doubtful in found if not doubtful]


def content_nodes_in(main: Node) -> list[Node]:
    """The article elements directly below a main element, if they hold it all."""
    out = []
    todo = [c for c in reversed(main.children) if not isinstance(c, str)]
    while todo:
        node = todo.pop()
        if _skipped(node, True):
            continue
        if node.tag == "article":
            out.append(node)
        elif node.tag in BLOCK:
            if any(isinstance(c, str) and c.strip() for c in node.children) or node.tag in ("p", "h1", "h2", "ul", "ol", "table"):
                return []
            todo += [c for c in reversed(node.children) if not isinstance(c, str)]
    return out


def blocks(top: Node, in_article: bool, path: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], str, int]]:
    """(path, text, characters that are links) of each block below ``top`` that is not left out."""
    out: list[tuple[tuple[str, ...], str, int]] = []
    raw: list[str] = []
    linked = 0

    def flush(where: tuple[str, ...]) -> None:
        nonlocal linked
        text = _clean("".join(raw))
        if text:
            out.append((where, text, linked))
        raw.clear()
        linked = 0

    # Frames: node, its path, children left, whether it is in an article, whether it is in a link.
    stack = [(top, path, iter(top.children), in_article, False)]
    while stack:
        node, where, children, article, link = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            if node.tag in BLOCK or not stack:
                flush(where)
            continue
        if isinstance(child, str):
            raw.append(child)
            linked += len(child.strip()) if link else 0
            continue
        if child.tag == "br":
            raw.append(" ")
        if _skipped(child, article):
            if child.tag in BLOCK:
                flush(where)
            continue
        if child.tag in BLOCK:
            flush(where)
        inner = (*where, child.label) if child.tag in BLOCK and len(where) < DEEPEST else where
        stack.append((child, inner, iter(child.children), article or child.tag in ("article", "main"), link or child.tag == "a"))
    return out


class Folded:
    """A node of the folded tree: an element's children of one kind are one node, in the order of the first of each."""

    __slots__ = ("tag", "texts", "links", "named")

    def __init__(self, tag: str):
        self.tag = tag
        self.texts: list[str] = []
        #: Characters of each text that are links.
        self.links: list[int] = []
        self.named: dict[str, Folded] = {}

    @property
    def children(self) -> list[Folded]:
        return list(self.named.values())


def folded(found: list[tuple[tuple[str, ...], str, int]]) -> Folded:
    root = Folded("")
    for path, text, links in found:
        node = root
        for tag in path:
            node = node.named.get(tag) or node.named.setdefault(tag, Folded(tag))
        node.texts.append(text)
        node.links.append(links)
    return root


def align(a: Folded, b: Folded) -> tuple[int, list[tuple[Folded, Folded]]]:
    """Simple tree matching: the number of matched nodes, and the matched pairs in order.

    Children have different kinds, so the best order-preserving matching of two lists of
    children is the heaviest run of their common kinds that ascends in both; it is found
    with running maxima in time n log n.
    """
    if a.tag != b.tag:
        return 0, []
    place = {tag: j for j, tag in enumerate(b.named, 1)}
    common = [(place[tag], *align(child, b.named[tag])) for tag, child in a.named.items() if tag in place]
    best: list[tuple[int, int]] = [(0, -1)] * (len(place) + 1)  # a tree of maxima: weight and its last pair
    before = []
    for k, (j, weight, _) in enumerate(common):
        held, i = (0, -1), j - 1
        while i:
            held, i = max(held, best[i], key=lambda x: x[0]), i & (i - 1)
        before.append(held[1])
        i = j
        while i < len(best):
            if held[0] + weight > best[i][0]:
                best[i] = (held[0] + weight, k)
            i += i & -i
    total, k = (0, -1)
    i = len(place)
    while i:
        if best[i][0] > total:
            total, k = best[i]
        i &= i - 1
    chosen = []
    while k >= 0:
        chosen.append(common[k][2])
        k = before[k]
    return total + 1, [(a, b), *(pair for pairs in reversed(chosen) for pair in pairs)]


def _numbered(root: Folded) -> dict[int, tuple[int, str]]:
    """For each node (by identity) its number in page order and its path."""
    out: dict[int, tuple[int, str]] = {}

    def visit(node: Folded, path: str) -> None:
        out[id(node)] = (len(out), path)
        for c in node.children:
            visit(c, f"{path}/{c.tag}")

    visit(root, "")
    return out


def page_blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    return blocks(parse(page), False)


#: What a worker remembers of model pages and layouts: plain tables, as tasks carry them along.
MODELS: dict = {}
MODEL_BLOCKS: dict = {}
MODEL_RUNS: dict = {}


def _model(page: str) -> tuple[Folded, dict[int, tuple[int, str]]]:
    def make():
        tree = folded(_model_blocks(page))
        return tree, _numbered(tree)

    return remembered(MODELS, page, make, 64)


def layout_key(found: list[tuple[tuple[str, ...], str, int]]) -> str:
    """The paths of a page's elements, down to articles and runs of text, one in a line."""
    paths = set()
    for path, _, _ in found:
        parts = []
        for x in path[:LAYOUT_DEPTH]:
            flows = x.split(".", 1)[0] in FLOWING
            if not flows or x.split(".", 1)[0] in ("article", "main"):
                parts.append(x)
            if flows:
                break
        paths.add("/".join(parts))
    return "\n".join(sorted(paths))


class Layouts:
    """Sets of paths by number; the likest of a set is found without comparing it with all.

    Postings by path and size of set are read from the rarest path on, as far as a set that
    has none of the paths before can still be as like as the best one found. A path that
    one set alone has takes a single number.
    """

    def __init__(self):
        self.sets: list[tuple[str, ...]] = []
        self.holding: dict[str, int | dict[int, list[int]]] = {}

    def add(self, key: str) -> None:
        paths = tuple(key.split("\n"))
        number = len(self.sets)
        self.sets.append(paths)
        for path in paths:
            held = self.holding.setdefault(path, number)
            if held == number:
                continue
            if isinstance(held, int):
                held = self.holding[path] = {len(self.sets[held]): [held]}
            held.setdefault(len(paths), []).append(number)

    def likest(self, key: str, least: float = 0.0) -> int | None:
        """The first of the sets that share most with a key's paths, at least that share of both together; None if there is none."""
        own = set(key.split("\n"))
        found = []
        for path in own:
            held = self.holding.get(path)
            if held is not None:
                held = {len(self.sets[held]): [held]} if isinstance(held, int) else held
                found.append((sum(map(len, held.values())), path, held))
        found.sort(key=lambda x: x[:2])
        n, share, best = len(own), least, None
        for i, (_, _, held) in enumerate(found):
            left = len(found) - i
            if left / n < share:
                break
            for size in sorted(held):
                common = min(left, size)
                bound = common / (n + size - common)
                if bound < share:
                    continue
                for number in held[size]:
                    if best is not None and (bound < share or bound == share and number > best):
                        break
                    both = len(own.intersection(self.sets[number]))
                    now = both / (n + size - both)
                    if now > share or now == share and (best is None or number < best):
                        share, best = now, number
        return best


class Grouped:
    """A host's keys grouped by layout, to be given by descending pages, then key; what is held grows with the layouts, not the keys."""

    def __init__(self):
        self.leaders, self.pages, self.firsts = Layouts(), [], []

    def add(self, key: str, pages: int, first: tuple) -> None:
        near = self.leaders.likest(key, LAYOUT_SAME)
        if near is not None:
            self.pages[near] += pages
        else:
            self.leaders.add(key)
            self.pages.append(pages)
            self.firsts.append(first)

    def chosen(self) -> list[tuple[str, tuple]]:
        """(key, first) of each layout in order: the commonest and all others of enough pages for a wrapper."""
        most = max(self.pages)
        common = [i for i, n in enumerate(self.pages) if n >= min(most, LEAST_PAGES)]
        ranked = sorted((-self.pages[i], "\n".join(self.leaders.sets[i]), i) for i in common)
        return [(key, self.firsts[i]) for _, key, i in (ranked if most >= LEAST_PAGES else ranked[:1])]


def choose_layouts(counted: list[tuple[str, int]]) -> list[str]:
    """Keys of a host's layouts, from its keys and their pages; layouts of too few pages for a wrapper join the others."""
    grouped = Grouped()
    for key, pages in sorted(counted, key=lambda x: (-x[1], x[0])):
        grouped.add(key, pages, ())
    return [key for key, _ in grouped.chosen()]


def _digest(path: str, text: str) -> str:
    return hashlib.blake2b(f"{path}\n{text}".encode("utf-8", "replace"), digest_size=12).hexdigest()


def _signature(found: list[tuple[tuple[str, ...], str, int]]) -> bytes:
    return hashlib.blake2b("\n".join(text for _, text, _ in found).encode("utf-8", "replace"), digest_size=16).digest()


def _article(found: list[tuple[tuple[str, ...], str, int]]) -> list[str]:
    """The texts that stand in article or main elements."""
    return [text for path, text, _ in found if any(x.split(".", 1)[0] in ("article", "main") for x in path)]


def _runs(texts: list[str]) -> set[tuple[str, ...]]:
    words = [w for t in texts for w in t.split()]
    return set(zip(*[words[i:] for i in range(RUN)], strict=False)) if len(words) >= RUN else {tuple(words)}


def _alike(a: set[tuple[str, ...]], b: set[tuple[str, ...]]) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def _model_blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    return remembered(MODEL_BLOCKS, page, lambda: page_blocks(page), 64)


def near_copy(model: list[tuple[tuple[str, ...], str, int]], found: list[tuple[tuple[str, ...], str, int]]) -> bool:
    """Whether a page tells what the model page tells, but for small changes."""
    a, b = _article(model), _article(found)
    least = SAME
    if not a or not b:
        a, b = [text for _, text, _ in model], [text for _, text, _ in found]
        least = ALL_SAME
    if a == b:
        return True
    if not a or not b:
        return False
    alike = _alike(remembered(MODEL_RUNS, "\n".join(a), lambda: _runs(a), 64), _runs(b))
    if alike >= least:
        return True
    known, own = set(a), set(b)
    left, right = [t for t in a if t not in own], [t for t in b if t not in known]
    if len(left) == len(a) and len(right) == len(b):  # no block in common: that is what was compared
        return alike >= SAME
    return bool(left and right) and _alike(_runs(left), _runs(right)) >= SAME


#: Of one aligned node (text -1) the characters of texts that the model's node lacks, links among them; of a text of the model's node that the page has it.
SEEN = pa.struct([("node", pa.int32()), ("text", pa.int32()), ("varying", pa.int64()), ("links", pa.int64())])
STATS = "host string, layout int, signature binary, seen array<struct<node:int,text:int,varying:bigint,links:bigint>>"


def _seen(model: str, found: list[tuple[tuple[str, ...], str, int]]) -> list[dict]:
    """What one page shows of its host's model page."""
    tree, numbers = _model(model)
    out = []
    for own, its in align(tree, folded(found))[1]:
        node, has, known = numbers[id(own)][0], set(its.texts), set(own.texts)
        new = [(len(t), n) for t, n in zip(its.texts, its.links, strict=True) if t not in known]
        out.append({"node": node, "text": -1, "varying": sum(n for n, _ in new), "links": sum(n for _, n in new)})
        out += [{"node": node, "text": i, "varying": 0, "links": 0} for i, t in enumerate(own.texts) if t in has]
    return out


def _in_rows(rows, schema: pa.Schema):
    """Record batches of ``rows``, tuples in the order of ``schema``."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held.clear()
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def _identified(pages: DataFrame) -> DataFrame:
    return pages.withColumns({"hash": F.xxhash64("html"), "chars": F.length("html")})


def _related(counted: DataFrame) -> DataFrame:
    """``counted`` without sets of paths that cannot matter to the choice of layouts.

    A set of which more than half the paths stand in no other set of its host shares half
    with none: it is a layout by itself, and of too few pages it matters only where it is
    the commonest of its host.
    """
    size = F.size(F.split("key", "\n"))
    known = counted.withColumn("id", F.struct(F.xxhash64("host", "key"), F.xxhash64("key", "host")))
    paths = known.select("id", "host", F.explode(F.split("key", "\n")).alias("path")).select("id", F.xxhash64("host", "path").alias("path"))
    alone = paths.groupBy("path").agg(F.count(F.lit(1)).alias("sets"), F.min("id").alias("id")).filter("sets = 1").groupBy("id").agg(F.count(F.lit(1)).alias("alone"))
    marked = cut(known.join(alone, "id", "left").withColumn("single", (2 * F.coalesce("alone", F.lit(0)) > size) & (F.col("pages") < LEAST_PAGES)).drop("id", "alone"))
    first = marked.filter("single").groupBy("host").agg(F.min(F.struct((-F.col("pages")).alias("less"), "key", "hash", "chars")).alias("x"))
    return marked.filter("not single").drop("single").union(first.select("host", "x.key", -F.col("x.less"), "x.hash", "x.chars"))


def layout_models(pages: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """From rows (host, html): rows (host, layout, model), each host's layouts and the page that stands for each, and the pages' layouts.

    The latter are rows (host, hash, chars, layout) of pages that are not of their host's
    layout 0, or None if all are. A host's distinct sets of paths pass through one task,
    sorted, and leave only the layouts there; of more than a slice only those that other
    sets can be like. Which layout is the likest of a set is looked up in slices.
    """
    ship(__name__)
    keyed_schema = pa.schema([("host", pa.string()), ("key", pa.string()), ("hash", pa.int64()), ("chars", pa.int32())])
    leader_schema = pa.schema([("host", pa.string()), ("layout", pa.int32()), ("key", pa.string()), ("hash", pa.int64()), ("chars", pa.int32())])
    assigned_schema = pa.schema([("host", pa.string()), ("key", pa.string()), ("layout", pa.int32())])

    def keys(batches):
        for b in batches:
            made = [layout_key(page_blocks(page)) for page in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(made, pa.string()), b.column("hash"), b.column("chars")], schema=keyed_schema)

    def choose(batches):
        def rows():
            host, grouped = None, None
            for b in batches:
                for h, key, n, hashed, chars in zip(*[b.column(x).to_pylist() for x in ("host", "key", "pages", "hash", "chars")], strict=True):
                    if grouped is None or h != host:
                        yield from chosen(host, grouped)
                        host, grouped = h, Grouped()
                    grouped.add(key, n, (hashed, chars))
            yield from chosen(host, grouped)

        def chosen(host, grouped):
            for i, (key, first) in enumerate(grouped.chosen() if grouped else []):
                yield host, i, key, *first

        return _in_rows(rows(), leader_schema)

    def assign(batches):
        def rows():
            at, layouts = None, Layouts()
            for b in batches:
                for h, part, layout, key in zip(*[b.column(x).to_pylist() for x in ("host", "slice", "layout", "key")], strict=True):
                    if at != (h, part):
                        at, layouts = (h, part), Layouts()
                    if layout is not None:
                        layouts.add(key)
                    elif likest := layouts.likest(key) or 0:
                        yield h, key, likest

        return _in_rows(rows(), assigned_schema)

    p = _identified(pages)
    keyed = cut(p.select("host", "html", "hash", "chars").mapInArrow(keys, "host string, key string, hash bigint, chars int"))
    counted = cut(keyed.groupBy("host", "key").agg(F.count(F.lit(1)).alias("pages"), F.min(F.struct("hash", "chars")).alias("first")).select("host", "key", "pages", "first.hash", "first.chars"))
    slices = counted.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("slices"))
    many = (slices.agg(F.max("slices")).first()[0] or 0) > 1
    listed = (_related(counted) if many else counted).repartition("host").sortWithinPartitions("host", F.desc("pages"), "key")
    leaders = cut(listed.mapInArrow(choose, "host string, layout int, key string, hash bigint, chars int"))
    models = cut(p.join(fitted(leaders.drop("key"), 128), ["host", "hash", "chars"]).groupBy("host", "layout").agg(F.min("html").alias("model")))
    more = leaders.filter("layout > 0").select("host").distinct()
    if more.isEmpty():
        return models, None
    slices = cut(slices.join(more, "host"))
    own = counted.join(slices, "host").select("host", F.pmod(F.xxhash64("key"), "slices").cast("int").alias("slice"), F.lit(None).cast("int").alias("layout"), "key")
    its = leaders.join(slices, "host").select("host", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "layout", "key")
    sought = own.union(its).repartition("host", "slice").sortWithinPartitions("host", "slice", F.asc_nulls_last("layout"))
    assigned = cut(sought.mapInArrow(assign, "host string, key string, layout int"))
    placed = cut(keyed.join(assigned, ["host", "key"]).groupBy("host", "hash", "chars").agg(F.min("layout").alias("layout")))
    return models, fitted(placed, 128)


def _placed(pages: DataFrame, layouts: DataFrame | None) -> DataFrame:
    """``pages`` (host, html, ...) with their layout."""
    if layouts is None:
        return pages.withColumn("layout", F.lit(0))
    return _identified(pages).join(layouts, ["host", "hash", "chars"], "left").withColumn("layout", F.coalesce("layout", F.lit(0))).drop("hash", "chars")


def statistics(pages: DataFrame) -> DataFrame:
    """Rows (host, layout, seen): for each node and text of a layout's model page the pages that have it and their varying characters.

    ``pages`` has rows (host, layout, html, model). Pages that show the same text count once,
    and so do near copies of the model page: copies make no text constant. Only the model's
    texts can be constant, so other pages' near copies need no comparison.
    """
    ship(__name__)
    schema = pa.schema([("host", pa.string()), ("layout", pa.int32()), ("signature", pa.binary()), ("seen", pa.list_(SEEN))])

    def run(batches):
        for b in batches:
            rows = []
            # One layout after another, so that a batch reads each model page once.
            for h, i, like, page in sorted(zip(*[b.column(x).to_pylist() for x in ("host", "layout", "model", "html")], strict=True), key=lambda x: x[:2]):
                found = page_blocks(page)
                own = _model_blocks(like)
                found = own if near_copy(own, found) else found
                rows.append({"host": h, "layout": i, "signature": _signature(found), "seen": _seen(like, found)})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    once = pages.select("host", "layout", "html", "model").mapInArrow(run, STATS).groupBy("host", "layout", "signature").agg(F.first("seen").alias("seen"))
    sums = once.select("host", "layout", F.explode("seen").alias("s")).groupBy("host", "layout", "s.node", "s.text").agg(F.count(F.lit(1)).alias("pages"), F.sum("s.varying").alias("varying"), F.sum("s.links").alias("links"))
    # A layout's list is as long as its model page has nodes and texts.
    return sums.groupBy("host", "layout").agg(F.collect_list(F.struct("node", "text", "pages", "varying", "links")).alias("seen"))


class Wrapper(NamedTuple):
    """A layout's wrapper: its article region (null if none), its menus' paths and digests of the template's texts."""

    region: str | None = None
    menus: frozenset[str] = frozenset()
    constants: frozenset[str] = frozenset()
    #: Whether the layout showed enough different pages to tell template from slots.
    known: bool = False


def induce(model: str, seen: list[dict]) -> Wrapper:
    """The wrapper of a layout: constant texts are template, varying slots are content.

    If most of the varying text lies within article or main elements, the outermost of
    those bounds the content; else all slots are content but those that hold links
    mainly. Without enough different pages there is no wrapper.
    """
    tree, numbers = _model(model)
    paths, texts = dict(numbers.values()), {}
    todo = [tree]
    while todo:
        node = todo.pop()
        texts[numbers[id(node)][0]] = node.texts
        todo += node.children
    pages = max((s["pages"] for s in seen), default=0)
    held, varying, links = defaultdict(int), defaultdict(int), defaultdict(int)
    for s in seen:
        path = paths[s["node"]]
        varying[path] += s["varying"]
        links[path] += s["links"]
        parts = path.split("/")
        for i in range(1, len(parts) + 1):
            held["/".join(parts[:i])] += max(0, s["varying"] - s["links"])
    everything = held[""]
    if pages < LEAST_PAGES or not everything:
        return Wrapper()
    constants = frozenset(_digest(paths[s["node"]], texts[s["node"]][s["text"]]) for s in seen if s["text"] >= 0 and s["pages"] >= SHARE * pages)
    regions = [p for p, n in held.items() if p.rsplit("/", 1)[-1].split(".")[0] in ("article", "main") and 2 * n > everything]
    return Wrapper(min(regions, key=lambda p: (p.count("/"), p), default=None), frozenset(p for p, n in links.items() if 2 * n > varying[p]), constants, True)


def wrappers(models: DataFrame, stats: DataFrame) -> DataFrame:
    """Rows (host, layout, region, menus, constants, known) from ``models`` (host, layout, model) and ``stats``."""
    ship(__name__)
    schema = pa.schema([("host", pa.string()), ("layout", pa.int32()), ("region", pa.string()), ("menus", pa.list_(pa.string())), ("constants", pa.list_(pa.string())), ("known", pa.bool_())])

    def run(batches):
        for b in batches:
            rows = []
            for h, layout, model, seen in zip(*[b.column(x).to_pylist() for x in ("host", "layout", "model", "seen")], strict=True):
                w = induce(model, seen or [])
                rows.append({"host": h, "layout": layout, "region": w.region, "menus": sorted(w.menus), "constants": sorted(w.constants), "known": w.known})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    joined = models.join(stats, ["host", "layout"], "left").select("host", "layout", "model", "seen")
    return joined.mapInArrow(run, "host string, layout int, region string, menus array<string>, constants array<string>, known boolean")


def extract_page(page: str, wrapper: Wrapper = Wrapper()) -> str:
    """The page's text, given its layout's wrapper."""
    root = parse(page)
    if not wrapper.known:
        nodes = content_nodes(root)
        return "\n".join(text for n in nodes or [root] for _, text, _ in blocks(n, bool(nodes)))
    shown = [("".join(f"/{x}" for x in path), text, 2 * links > len(text)) for path, text, links in blocks(root, False)]
    inside = [x for x in shown if f"{x[0]}/".startswith(f"{wrapper.region}/")] if wrapper.region else []
    if wrapper.region and not inside:
        inside = [x for x in shown if re.search(r"/(?:article|main)[./]", f"{x[0]}/")]
    if inside:  # within the article only links that stand on all pages are template
        return "\n".join(text for path, text, link in inside if not (link and _digest(path, text) in wrapper.constants))
    return "\n".join(text for path, text, _ in shown if path not in wrapper.menus and _digest(path, text) not in wrapper.constants)


def _attach(pages: DataFrame, layouts: DataFrame, chars: int) -> DataFrame:
    """What ``layouts``, a written table, has of each page's layout; above the size for broadcasting both sides are plain shuffles, so Spark can split a large one."""
    return pages.join(F.broadcast(layouts) if chars <= BROADCAST_CHARS else layouts, ["host", "layout"], "left")


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` without the html, with columns text and n_chars."""
    ship(__name__)
    kept = [f for f in pages.schema.fields if f.name not in (html, "text", "n_chars")]
    # The other columns travel in one, so none of their names can clash.
    p = pages.select(F.struct(*[F.col(f.name) for f in kept]).alias("row"), F.col(html).alias("html"), url_host(F.col(url)).alias("host"))
    filled = p.filter("html is not null").select("host", "html")
    models, layouts = layout_models(filled)
    size = models.agg(F.sum(F.length("model")).alias("n")).first()["n"] or 0
    w = cut(wrappers(models, statistics(_attach(_placed(filled, layouts), models, size))))
    size = w.agg(F.sum(F.length(F.to_json(F.struct(*w.columns)))).alias("n")).first()["n"] or 0
    joined = _attach(_placed(p, layouts), w, size)
    schema = T.StructType([T.StructField("row", T.StructType(kept)), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for b in batches:
            texts = []
            for page, region, menus, constants, known in zip(*[b.column(x).to_pylist() for x in ("html", "region", "menus", "constants", "known")], strict=True):
                texts.append(extract_page(page, Wrapper(region, frozenset(menus), frozenset(constants), True) if known else Wrapper()) if page else "")
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.fieldNames())

    return joined.select("row", "html", "region", "menus", "constants", "known").mapInArrow(run, schema).select("row.*", "text", "n_chars")
