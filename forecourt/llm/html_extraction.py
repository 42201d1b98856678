"""Operator 9: main text of web pages by wrapper induction.

*Trees.*  A page becomes the tree of its block elements; inline markup only adds to the text of its block.
Siblings of one kind in a row (paragraphs, list items) are one repeated node of several items.

*Induction.*  Pages of a host are aligned by simple tree matching: the best order-preserving pairing of
children, by the number of nodes that pair, recursively.  Folding pages into each other gives the host's
wrapper: a tree whose nodes know on how many pages they stand and which texts they had there (a bounded
frequent-items summary, by item).  An item whose text stands there on most pages is template, any other a
slot; two pages cannot tell one from the other by majority, so three are needed.
Pages of a host with one tree (tags, names and texts) are copies and count once, else a much copied page would
make its article a template: tasks leave out their own copies, a shuffle by host and tree hash the others.
Each task then folds its pages of a host, the partial wrappers of a host are folded by groups of tasks and then
one after another as they stream by, so a host with a third of all pages is a few small trees by then, and no group is held.
The table of two lists of children with over ``TABLE`` pairs is worked through by rows, of which every so many are kept
for the way back: the pairs are those of the whole table.  Weights are known by distinct subtrees, not by pairs of nodes.
If all of a marked article is template all the same (near copies that differ elsewhere), the wrapper tells
nothing about it and the article stays.

*Extraction.*  Pages meet their host's wrapper in a join on the host (Spark splits the hot ones), are
aligned with it, and keep what stands in slots.  What HTML itself declares to be outside the article by tag
or role (menus, headers, footers, asides, forms, scripts, styles) is never content, and neither is what a
whole class or id names as boilerplate (adverts, comments, notices), whether it varies or not.  If a page marks main or
article elements, the one with the most text decides: all of its tag are searched, and nothing else; names
do not count for the elements round it.  If a page that marks none has no text left, names count only where the wrapper
is silent (a node of no or too few other pages): there the slots are better evidence.

Nesting has no limit: no walk is recursive, wrappers are stored flat.

Tags may be left open or unclosed; comments, scripts and styles are skipped as HTML does.  A block's white
space becomes one space, blocks are joined by one space in page order.

Cases: null html gives an empty text; null urls and those without host share the empty host; repeated
pages and ids stay (each has its row, copies count as one page for the wrapper); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.common import staged
from forecourt.llm.url_filter import host_of

#: A text is template if it is on this part of its node's pages, of which there are at least so many.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.8, 3
#: Texts that a node's summary counts for each of the items it has on a page, so that a count is at most 1/64
#: of the node's pages too low: a text on 82% of them is found for sure.
SUMMARY = 64
#: Pairs of children up to which the table that aligns two lists is held whole; the pairs found do not depend on it.
TABLE = 1 << 16
#: Groups of tasks whose wrappers of one host are folded before the last fold.
SALTS = 16
#: Pages whose copies a task leaves out before the shuffle leaves out the others.
SEEN_AT_ONCE = 100_000

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption option".split()
)
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th"), "body": ("head",),
}
KEEP_OPEN = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",), "tbody": ("table",), "tfoot": ("table",)}
NEVER = frozenset("head nav footer aside form script style noscript template menu dialog button select textarea iframe svg canvas object title".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer "
    "header masthead cookie cookies consent notice notices alert popup modal newsletter subscribe social share sharing comment comments disqus "
    "related widget widgets toolbar login signup".split()
)
TAG = re.compile(r"<(?:!--.*?(?:-->|$)|[!?][^>]*(?:>|$)|(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*|[^>]*)(?:>|$))", re.S)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

#: A node of a page: [label, outside the article, items], items being texts and nodes in order.
Node = list
#: What says that a node is outside: a class or id, or HTML itself (tag or role).
NAMED, HTML = 1, 2


def _label(tag: str, attributes: str) -> tuple[str, int]:
    outside, names = HTML if tag in NEVER else 0, ""
    if attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            value = next((v for v in values if v), "").lower()
            words = value.split()
            if name.lower() == "role":
                outside = outside if ROLES.isdisjoint(words) else HTML
            else:
                if tag not in ("html", "body", "main", "article") and not NAMES.isdisjoint(words):
                    outside = outside or NAMED
                names += "." + re.sub(r"\d+", "0", value)
    return tag + names, outside


def tree(page: str) -> Node:
    """The page as a tree of block elements, with texts decoded but white space as it is."""
    root: Node = ["", False, []]
    stack: list[tuple[str, Node]] = [("", root)]
    opened: Counter[str] = Counter()
    at, end = 0, len(page)

    def close(k: int) -> None:
        opened.subtract(t for t, _ in stack[k:])
        del stack[k:]

    while at < end:
        m = TAG.search(page, at)
        text = page[at:m.start() if m else end]
        if text:
            stack[-1][1][2].append(entities.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        name = m[2]
        if not name:
            continue
        tag = name.lower()
        if m[1]:
            if tag == "br":
                stack[-1][1][2].append(" ")
            elif opened[tag] > 0:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag))
            continue
        if tag in RAW:
            stop = re.compile(f"</{tag}(?=[\\s/>]|$)", re.I).search(page, at)
            at = stop.start() if stop else end
            shut = page.find(">", at)
            at = shut + 1 if shut >= 0 else end
            continue
        if tag in VOID:
            stack[-1][1][2].append(" ")
            continue
        if tag not in BLOCKS and tag not in NEVER:
            continue
        if tag in BLOCKS:
            closes, keep = CLOSES.get(tag, ()), KEEP_OPEN.get(tag, ())
            for k in range(len(stack) - 1, 0, -1):
                open_ = stack[k][0]
                if open_ in keep or not (opened["p"] > 0 or any(opened[t] > 0 for t in closes)):
                    break
                if open_ == "p" or open_ in closes:
                    close(k)
                elif open_ not in closes and closes == ():
                    break
        if m[3].rstrip().endswith("/") and tag not in BLOCKS:
            continue
        label, outside = _label(tag, m[3])
        node: Node = [label, outside, []]
        stack[-1][1][2].append(node)
        stack.append((tag, node))
        opened[tag] += 1
    return root


def _elements(root: Node) -> list[Node]:
    """All nodes of a page, each before those below it."""
    out, todo = [], [root]
    while todo:
        out.append(todo.pop())
        todo += [x for x in reversed(out[-1][2]) if not isinstance(x, str)]
    return out


def _page_key(root: Node) -> str:
    """Equal for pages of one tree."""
    flat = [[n[0], n[1], [x if isinstance(x, str) else 0 for x in n[2]]] for n in _elements(root)]
    return xxhash.xxh3_128_hexdigest(json.dumps(flat))


# A wrapper's node: [label, pages, {text hash: pages}, children, most items on a page].


def _own_text(node: Node) -> str:
    return " ".join(" ".join(x for x in node[2] if isinstance(x, str)).split())


def _summarise(counts: dict[str, int], items: int) -> dict[str, int]:
    """Frequent items: all counts less the largest that does not fit."""
    if len(counts) <= SUMMARY * items:
        return counts
    off = sorted(counts.values(), reverse=True)[SUMMARY * items]
    return {k: v - off for k, v in counts.items() if v > off}


def _digest(text: str) -> str:
    return xxhash.xxh64_hexdigest(text)


def skeletons(root: Node) -> dict[int, list]:
    """By node (its id): the runs of its children as wrappers of one page."""
    out: dict[int, list] = {}
    for node in reversed(_elements(root)):
        mine = []
        for run in runs(node):
            texts = {_digest(text): 1 for text in map(_own_text, run) if text}
            children: list = []
            for x in run:
                children = _merged(children, out[id(x)], 1) if children else out[id(x)]
            mine.append([run[0][0], 1, texts, children, len(run)])
        out[id(node)] = mine
    return out


def runs(node: Node) -> list[list[Node]]:
    """Its child elements, those of one label in a row together."""
    out: list[list[Node]] = []
    for x in node[2]:
        if not isinstance(x, str):
            if out and out[-1][0][0] == x[0]:
                out[-1].append(x)
            else:
                out.append([x])
    return out


class Weights:
    """Nodes paired by two subtrees, by their shapes: labels and order of all below, which is all that pairing looks at."""

    def __init__(self) -> None:
        self.of: dict[int, int] = {}  # by id of a node, which must still be held
        self.shapes: dict[tuple, int] = {}
        self.known: dict[tuple[int, int], int] = {}

    def shape(self, node: list) -> int:
        if (have := self.of.get(id(node))) is not None:
            return have
        todo = [node]
        while todo:
            x = todo[-1]
            if id(x) not in self.of:
                if below := [y for y in x[3] if id(y) not in self.of]:
                    todo += below
                    continue
                key = (x[0], tuple(self.of[id(y)] for y in x[3]))
                self.of[id(x)] = self.shapes.setdefault(key, len(self.shapes))
            todo.pop()
        return self.of[id(node)]

    def __call__(self, x: list, y: list) -> int:
        return self.known[self.shape(x), self.shape(y)] if x[3] and y[3] else 1


def _alike(a: list, b: list) -> bool:
    """Equal labels in order: no pairing is better than all in order."""
    return len(a) == len(b) and all(x[0] == y[0] for x, y in zip(a, b, strict=True))


def _unweighed(a: list, b: list, weights: Weights) -> list[tuple]:
    """Pairs of nodes with something below both, one for each pair of shapes, whose weight an alignment of the two lists needs."""
    if not a or not b:
        return []
    if _alike(a, b):
        pairs = {(weights.shape(x), weights.shape(y)): (x, y) for x, y in zip(a, b, strict=True) if x[3] and y[3]}
    else:
        at_a, at_b = ({weights.shape(x): x for x in side if x[3]} for side in (a, b))
        pairs = {(p, q): (x, y) for p, x in at_a.items() for q, y in at_b.items() if x[0] == y[0] and (p, q) not in weights.known}
    return [xy for pq, xy in pairs.items() if pq not in weights.known]


def _anchored(a: list, b: list, weights: Weights | None = None) -> list[tuple[int, int]]:
    """The best pairing of two long lists, as by the whole table, of which rows at intervals are kept: the way back starts anew from each."""
    weights = weights or Weights()
    at: dict[str, list[int]] = {}
    for j, y in enumerate(b):
        at.setdefault(y[0], []).append(j)
    columns = {}
    for label, js in at.items():  # its columns, which shape each has, and a node of each shape
        shapes = {weights.shape(b[j]): b[j] for j in js}
        number = {p: k for k, p in enumerate(shapes)}
        columns[label] = np.array(js), np.array([number[weights.shape(b[j])] for j in js]), list(shapes.values())

    def after(x: list, row: np.ndarray) -> np.ndarray:
        if x[0] not in columns:
            return row
        js, which, nodes = columns[x[0]]
        out = row.copy()
        out[js + 1] = np.maximum(row[js + 1], row[js] + np.array([weights(x, y) for y in nodes])[which])
        return np.maximum.accumulate(out)

    step = isqrt(len(a)) + 1
    row, kept = np.zeros(len(b) + 1, np.int64), []
    for i, x in enumerate(a):
        if i % step == 0:
            kept.append(row)
        row = after(x, row)
    i, j, pairs = len(a), len(b), []
    for first in range((len(kept) - 1) * step, -1, -step):
        rows = [kept.pop()]
        for x in a[first:i]:
            rows.append(after(x, rows[-1]))
        while j and i > first:
            now, above = rows[i - first], rows[i - first - 1]
            if a[i - 1][0] == b[j - 1][0] and now[j] == above[j - 1] + weights(a[i - 1], b[j - 1]):
                i, j = i - 1, j - 1
                pairs.append((i, j))
            elif now[j] == above[j]:
                i -= 1
            else:
                j -= 1
        i = min(i, first)
    return pairs[::-1]


def _aligned(a: list, b: list, weight: Weights) -> tuple[int, list[tuple[int, int]]]:
    """The best pairing of two lists, given the weights of pairs of nodes."""
    if not a or not b:
        return 0, []
    if _alike(a, b):
        return sum(weight(x, y) for x, y in zip(a, b, strict=True)), [(i, i) for i in range(len(a))]
    both = {x[0] for x in a} & {x[0] for x in b}  # others cannot pair
    at_a, at_b = ([i for i, x in enumerate(side) if x[0] in both] for side in (a, b))
    a, b = [a[i] for i in at_a], [b[j] for j in at_b]
    if len(a) * len(b) > TABLE:
        pairs = _anchored(a, b, weight)
        return sum(weight(a[i], b[j]) for i, j in pairs), [(at_a[i], at_b[j]) for i, j in pairs]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            most = max(best[i - 1][j], best[i][j - 1])
            best[i][j] = max(most, best[i - 1][j - 1] + weight(x, y)) if x[0] == y[0] else most
    i, j, pairs = len(a), len(b), []
    while i and j:
        x, y = a[i - 1], b[j - 1]
        if x[0] == y[0] and best[i][j] == best[i - 1][j - 1] + weight(x, y):
            i, j = i - 1, j - 1
            pairs.append((at_a[i], at_b[j]))
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[-1][-1], pairs[::-1]


def matching(a: list, b: list, weights: Weights | None = None) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two lists of children: nodes paired in all, and the pairs at the top.

    weights: those found before (the nodes must still be held), added to here.
    """
    weights = weights or Weights()
    todo = _unweighed(a, b, weights)
    while todo:
        x, y = todo[-1]
        pair = weights.shape(x), weights.shape(y)
        if pair not in weights.known:
            if below := _unweighed(x[3], y[3], weights):
                todo += below
                continue
            weights.known[pair] = 1 + _aligned(x[3], y[3], weights)[0]
        todo.pop()
    return _aligned(a, b, weights)


def _merged(a: list, b: list, same_page: int = 0) -> list:
    """Two aligned lists of wrapper children as one.  same_page: both are of one page."""
    whole: list = []
    weights = Weights()
    todo = [(a, b, whole)]
    while todo:
        a, b, out = todo.pop()
        i, j = 0, 0
        for p, q in [*matching(a, b, weights)[1], (len(a), len(b))]:
            out += a[i:p] + b[j:q]
            if p < len(a):
                x, y = a[p], b[q]
                texts, items = dict(x[2]), x[4] + y[4] if same_page else max(x[4], y[4])
                for k, n in y[2].items():
                    texts[k] = max(n, texts.get(k, 0)) if same_page else texts.get(k, 0) + n
                children = [] if x[3] and y[3] else x[3] or y[3]
                out.append([x[0], max(x[1], y[1]) if same_page else x[1] + y[1], _summarise(texts, items), children, items])
                if x[3] and y[3]:
                    todo.append((x[3], y[3], children))
            i, j = p + 1, q + 1
    return whole


def _decided(nodes: list) -> list:
    """What extraction needs of a whole wrapper: nodes on enough pages, and their template texts."""
    whole: list = []
    todo = [(nodes, whole)]
    while todo:
        nodes, out = todo.pop()
        for x in nodes:
            if x[1] >= TEMPLATE_PAGES:
                out.append([x[0], x[1], {k: n for k, n in x[2].items() if n >= TEMPLATE_SHARE * x[1]}, [], x[4]])
                todo.append((x[3], out[-1][3]))
    return whole


def flat(nodes: list) -> str:
    """A wrapper as JSON: its nodes in page order, each with the number of its children in their place."""
    out, todo = [], nodes[::-1]
    while todo:
        x = todo.pop()
        out.append([x[0], x[1], x[2], len(x[3]), x[4]])
        todo += x[3][::-1]
    return json.dumps(out)


def grown(text: str) -> list:
    """The wrapper of a ``flat`` one."""
    whole: list = []
    below: list[tuple[list, int]] = []
    for label, pages, texts, n, items in json.loads(text):
        while below and len(below[-1][0]) == below[-1][1]:
            below.pop()
        (below[-1][0] if below else whole).append([label, pages, texts, [], items])
        below.append(((below[-1][0] if below else whole)[-1][3], n))
    return whole


def _tag(node: Node) -> str:
    return node[0].split(".")[0]


def _article(root: Node) -> list[Node]:
    """The nodes from the root down to the main or article element with the most text; none: no element is marked."""
    around: dict[int, Node] = {}
    seen, todo = [], [root]
    while todo:  # nothing below what HTML puts outside
        node = todo.pop()
        if node[1] == HTML and _tag(node) != "form":
            continue
        seen.append(node)
        for x in reversed(node[2]):
            if not isinstance(x, str):
                around[id(x)] = node
                todo.append(x)
    length: dict[int, int] = {}
    for node in reversed(seen):
        length[id(node)] = sum(len(x.strip()) if isinstance(x, str) else length.get(id(x), 0) for x in node[2])
    marked = [n for n in seen if _tag(n) in ("main", "article")]
    path = [max(marked, key=lambda n: length[id(n)])] if marked else []
    while path and id(path[-1]) in around:
        path.append(around[id(path[-1])])
    return path[::-1]


def _slots(root: Node, path: list[Node], wrapper: list, mine: dict[int, list], names: bool) -> str:
    """The text of the slots.  names: they count also where the wrapper knows the node."""
    wanted, holds = _tag(path[-1]) if path else None, {id(x) for x in path}
    weights = Weights()
    blocks: list[str] = []
    open_: list[tuple] = []

    def enter(node: Node, known: list | None, inside: bool) -> None:
        """Opens a node, with the wrapper's node that it pairs with, unless it stands outside."""
        by_name = node[1] == NAMED and (names or known is None)
        if id(node) not in holds and (node[1] == HTML or by_name or (_tag(node) == "header" and not inside)):
            return
        here = inside or wanted is None or _tag(node) == wanted
        template = known is not None and _digest(_own_text(node)) in known[2]
        followed = {}
        if known is not None and known[3]:
            parts = runs(node)
            followed = {id(n): known[3][j] for i, j in matching(mine[id(node)], known[3], weights)[1] for n in parts[i]}
        open_.append((iter([*node[2], None]), [], here, here and not template, followed))

    enter(root, ["", 0, {}, wrapper, 1], False)
    while open_:
        items, text, here, kept, followed = open_[-1]
        depth = len(open_)
        for x in items:
            if isinstance(x, str):
                text.append(x)
                continue
            if text and kept:
                blocks.append(" ".join("".join(text).split()))
            text.clear()
            if x is not None:
                enter(x, followed.get(id(x)), here)
                if len(open_) > depth:
                    break
        else:
            open_.pop()
    return " ".join(filter(None, blocks))


def extract(root: Node, wrapper: list) -> str:
    """The text of a page's slots, given its host's wrapper (the children of the root, ``_decided``)."""
    path = _article(root)
    mine = skeletons(root) if wrapper else {}
    out = _slots(root, path, wrapper, mine, True)
    if out or not wrapper:
        return out
    return _slots(root, path, [], {}, True) if path else _slots(root, path, wrapper, mine, False)


def wrappers(pages: DataFrame) -> DataFrame:
    """``(host, wrapper)``, the wrapper as JSON, for ``pages(host, html)``."""

    def induced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, str]] = set()
        for batch in batches:
            out = []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if (page := page.as_py()) is None:
                    continue
                root = tree(page)
                key = _page_key(root)
                if (host, key) not in seen:
                    seen.add((host, key))
                    out.append((host, key, flat(skeletons(root)[id(root)])))
            if len(seen) > SEEN_AT_ONCE:
                seen.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], ["host", "key", "wrapper"])

    def folded(batches: Iterator[pa.RecordBatch], last: bool = False) -> Iterator[pa.RecordBatch]:
        """Rows sorted by host and key: the wrappers of a host as one, those of one key once."""
        host, key, whole = None, None, None
        text = lambda w: flat(_decided(w) if last else w)
        for batch in batches:
            out = []
            for h, k, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if whole is not None and h != host:
                    out.append((host, text(whole)))
                    whole = None
                if whole is None:
                    whole = grown(part)
                elif k is None or k != key:
                    whole = _merged(whole, grown(part))
                host, key = h, k
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], ["host", "wrapper"])
        if whole is not None:
            yield pa.RecordBatch.from_arrays([pa.array([host]), pa.array([text(whole)])], ["host", "wrapper"])

    schema = "host string, wrapper string"
    distinct = pages.select("host", "html").mapInArrow(induced, "host string, key string, wrapper string").repartition("host", "key").sortWithinPartitions("host", "key")
    columns = ("host", F.lit(None).cast("string").alias("key"), "wrapper")
    salted = distinct.mapInArrow(folded, schema).select(*columns, F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt"))
    grouped = salted.repartition("host", "salt").sortWithinPartitions("host").select("host", "key", "wrapper")
    parts = grouped.mapInArrow(folded, schema).select(*columns).repartition("host").sortWithinPartitions("host")
    return staged(parts.mapInArrow(lambda batches: folded(batches, True), schema), "wrappers")


def main_text(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The columns ``keep`` of every page with ``text``, empty where there is none."""
    at = pages.select(*(F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    known = wrappers(at).withColumnRenamed("host", "w_host")
    met = at.join(known, F.col("host") == F.col("w_host"), "left").drop("host", "w_host")
    schema = ", ".join([f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep] + ["text string"])
    n = len(keep)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, wrapper = None, []
        for batch in batches:
            texts = []
            for page, own in zip(batch.column(n), batch.column(n + 1), strict=True):
                if (own := own.as_py()) != last:
                    last, wrapper = own, grown(own) if own else []
                page = page.as_py()
                texts.append(extract(tree(page), wrapper) if page else "")
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string())], [*keep, "text"])

    return met.mapInArrow(extracted, schema)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn("n_chars", F.length("text").cast("long"))
