"""Main text of web pages by wrapper induction.

The trees of a page and of a few reference pages of its host are aligned by
simple tree matching: children are matched in order so that the number of
matched nodes is largest. A slot of the page whose text is the same in all
references belongs to the host's template; one whose text varies holds content. Elements
that mark themselves as boilerplate (navigation, footers, asides, forms, scripts,
and class or id names such as ``ad`` or ``comments``) are left out whether they vary or
not. Where a page has an ``article`` or ``main`` element, only its slots count.

Neighbouring siblings of the same kind, such as the paragraphs of an article, are one
slot, so a long page is aligned in few steps; containers such as ``div`` are matched one by one
where both pages have as many. Lists of any length get the best match.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetree.llm.host_rank import host_of

# Parts that a host's pages are dealt into, so that a large host is not one task.
SALTS = 32
# Elements nested deeper are kept as children of the deepest level.
MAX_DEPTH = 150
# Tables of more cells are made by whole rows, of which few are held at a time; what they hold is the same.
_LIST_CELLS = 4_096

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea)(?=[\s/>])[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(?:svg|math)(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?<=/)>"
    r"|<(noscript|template|iframe|svg|math|select|title)(?=[\s/>])[^>]*+>(?:.*?</\2\s*+>)?+"
    r"|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
# An opening tag that ends an open element of these kinds, unless one of the others lies between.
_ENDS = {
    "p": (frozenset(["p"]), frozenset("article aside blockquote body div li main section table td th".split())),
    "li": (frozenset(["li"]), frozenset(["ol", "ul", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
} | {
    tag: (frozenset(["p"]), frozenset("article aside blockquote body div li main section table td th".split()))
    for tag in "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol pre section table ul".split()
}
# Neighbours of these kinds are slots of their own where page and reference have as many.
_CONTAINERS = frozenset("article div dl fieldset main ol section table tbody td tr ul".split())
_LEFT_OUT = frozenset("aside button canvas dialog footer form head input label menu nav object".split())
_BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices "
    "alert sidebar aside widget menu nav navbar navigation breadcrumb breadcrumbs header masthead footer comment comments disqus "
    "respond replies share sharing social related recommended newsletter subscribe subscription signup login form search popup "
    "modal overlay toolbar pagination pager complementary contentinfo".split()
)


class Node:
    """An element with its kind (tag and class, id and role names); children are elements and strings."""

    __slots__ = ("tag", "kind", "children", "left_out", "held")

    def __init__(self, tag: str, names: str, inside_main: bool):
        self.tag = tag
        self.kind = f"{tag} {names}" if names else tag
        self.children: list[Node | str] = []
        self.held: str | None = None
        words = set(re.split(r"[^a-z0-9]+", names.lower())) if names else ()
        self.left_out = tag in _LEFT_OUT or (tag == "header" and not inside_main) or (tag not in ("body", "html", "article", "main") and not _BOILERPLATE.isdisjoint(words))

    def text(self) -> str:
        """The text of the subtree, for comparison."""
        if self.held is None:
            self.held = "\x00".join(c if isinstance(c, str) else c.text() for c in self.children)
        return self.held


def parse(page: str) -> Node:
    """The tree of a page. Markup that is broken anyhow leaves its text where it stands."""
    root = Node("#root", "", False)
    stack, done, main = [root], 0, 0
    for token in _TOKEN.finditer(page):
        if token.start() > done:
            stack[-1].children.append(page[done : token.start()])
        done = token.end()
        tag = token[4]
        if tag is None:
            continue
        tag = tag.lower()
        if token[3]:
            for at in range(len(stack) - 1, 0, -1):
                if stack[at].tag == tag:
                    main -= sum(n.tag in ("article", "main") for n in stack[at:])
                    del stack[at:]
                    break
            continue
        ended, walls = _ENDS.get(tag, ((), ()))
        for at in range(len(stack) - 1, 0, -1):
            if stack[at].tag in ended:
                del stack[at:]
                break
            if stack[at].tag in walls:
                break
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(token[5])) if token[5] else ""
        node = Node(tag, names, main > 0)
        stack[-1].children.append(node)
        if tag not in _VOID and not token[5].endswith("/") and len(stack) < MAX_DEPTH:
            stack.append(node)
            main += tag in ("article", "main")
    if done < len(page):
        stack[-1].children.append(page[done:])
    return root


Run = list  # neighbouring children of one kind


def _runs(node: Node) -> list[Run]:
    out: list[Run] = []
    last = None
    for child in node.children:
        if isinstance(child, str):
            if child.isspace():
                continue
            kind = "#text"
        elif child.left_out:
            continue
        else:
            kind = child.kind
        if kind == last:
            out[-1].append(child)
        else:
            out.append([child])
        last = kind
    return out


def _kind(run: Run) -> str:
    return "#text" if isinstance(run[0], str) else run[0].kind


def _text(run: Run) -> str:
    return "\x00".join(c if isinstance(c, str) else c.text() for c in run)


class Alignment:
    """Simple tree matching of a page and a reference."""

    def __init__(self) -> None:
        self.sizes: dict[tuple[int, int], int] = {}
        self.same: set[int] = set()  # children (by id) whose slot has the same text in both
        self.runs: dict[int, list[Run]] = {}
        self.shapes: dict[tuple, int] = {}
        self.shape_of: dict[int, int] = {}
        self.shape_sizes: dict[tuple[int, int], int] = {}

    def _of(self, node: Node) -> list[Run]:
        if id(node) not in self.runs:
            self.runs[id(node)] = _runs(node)
        return self.runs[id(node)]

    def _weight(self, a: Run, b: Run) -> int:
        if _kind(a) != _kind(b):
            return 0
        if len(a) > 1 or len(b) > 1 or isinstance(a[0], str):
            return 1
        return 1 + self.size(a[0], b[0])

    def _table(self, a: list[Run], b: list[Run]) -> list[list[int]]:
        table = [[0] * (len(b) + 1)]
        for x in a:
            above, row = table[-1], [0]
            for j, y in enumerate(b):
                best = max(above[j + 1], row[j])
                weight = self._weight(x, y)
                row.append(max(best, above[j] + weight) if weight else best)
            table.append(row)
        return table

    def size(self, a: Node, b: Node) -> int:
        """Matched pairs below two nodes of the same kind."""
        key = (id(a), id(b))
        if key not in self.sizes:
            x, y = self._of(a), self._of(b)
            if len(x) * len(y) <= _LIST_CELLS:
                self.sizes[key] = self._table(x, y)[-1][-1]
            else:
                row = np.zeros(len(y) + 1, np.int32)
                for row in self._rows(x, y, row):
                    pass
                self.sizes[key] = int(row[-1])
        return self.sizes[key]

    def _shape(self, run: Run) -> tuple[str, int]:
        """A run's kind and, if it is one element, a number for what the sizes of matches below it depend on; else -1."""
        if len(run) > 1 or isinstance(run[0], str):
            return _kind(run), -1
        if id(run[0]) not in self.shape_of:
            below = tuple(self._shape(r) for r in self._of(run[0]))
            self.shape_of[id(run[0])] = self.shapes.setdefault(below, len(self.shapes))
        return _kind(run), self.shape_of[id(run[0])]

    def _rows(self, a: list[Run], b: list[Run], row: np.ndarray) -> Iterator[np.ndarray]:
        """The rows of ``_table`` that follow ``row``, one for each of ``a``."""
        places: dict[str, dict[int, list[int]]] = {}
        for j, y in enumerate(b):
            kind, shape = self._shape(y)
            places.setdefault(kind, {}).setdefault(shape, []).append(j)
        arrays = {kind: [(shape, np.array(at)) for shape, at in shapes.items()] for kind, shapes in places.items()}
        for x in a:
            kind, shape = self._shape(x)
            reached = row[1:].copy()
            for other, at in arrays.get(kind, ()):
                weight = 1
                if shape >= 0 and other >= 0:
                    if (shape, other) not in self.shape_sizes:
                        self.shape_sizes[shape, other] = self.size(x[0], b[at[0]][0])
                    weight += self.shape_sizes[shape, other]
                reached[at] = np.maximum(reached[at], row[at] + np.int32(weight))
            row = np.concatenate([row[:1], np.maximum.accumulate(reached)])
            yield row

    def _pairs_by_rows(self, a: list[Run], b: list[Run]) -> list[tuple[Run, Run]]:
        """As ``_pairs``, from a table of which one row in many is held and the others are made again."""
        step = isqrt(len(a)) + 1
        held = [np.zeros(len(b) + 1, np.int32)]
        for i, row in enumerate(self._rows(a, b, held[0]), 1):
            if i % step == 0:
                held.append(row)
        out, i, j = [], len(a), len(b)
        while i and j:
            low = (i - 1) // step * step
            first = held[low // step]
            table = [first, *self._rows(a[low:i], b, first)]
            while i > low and j:
                above, row = table[i - low - 1], table[i - low]
                if row[j] == above[j]:
                    i -= 1
                elif row[j] == row[j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    out.append((a[i], b[j]))
        return out

    def _pairs(self, a: list[Run], b: list[Run]) -> list[tuple[Run, Run]]:
        if len(a) * len(b) > _LIST_CELLS:
            return self._pairs_by_rows(a, b)
        out = []
        table, i, j = self._table(a, b), len(a), len(b)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((a[i], b[j]))
        return out

    def align(self, a: Node, b: Node) -> None:
        for x, y in self._pairs(self._of(a), self._of(b)):
            if _text(x) == _text(y):
                self.same.update(map(id, x))
            elif len(x) == len(y) and not isinstance(x[0], str) and (len(x) == 1 or x[0].tag in _CONTAINERS):
                for own, other in zip(x, y):
                    if own.text() == other.text():
                        self.same.add(id(own))
                    else:
                        self.align(own, other)


def _blocks(node: Node, template: set[int], out: list[str], open_text: list[str]) -> None:
    """Append the blocks below ``node``; ``open_text`` holds the block that is not ended yet."""
    for child in node.children:
        if id(child) in template:
            continue
        if isinstance(child, str):
            open_text.append(child)
        elif child.tag == "br":
            open_text.append(" ")
        elif not child.left_out:
            block = child.tag in _BLOCKS
            if block:
                _end(out, open_text)
            _blocks(child, template, out, open_text)
            if block:
                _end(out, open_text)


def _end(out: list[str], open_text: list[str]) -> None:
    text = " ".join(entities.unescape("".join(open_text)).split())
    open_text.clear()
    if text:
        out.append(text)


def _outermost_main(root: Node) -> list[Node]:
    found: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        if node.left_out:
            continue
        if node.tag in ("article", "main"):
            found.append(node)
            continue
        todo.extend(c for c in reversed(node.children) if not isinstance(c, str))
    return found


def extract(page: str | None, references: list[tuple[str, Node]]) -> str:
    """The main text of a page, given parsed pages of the same host with their sources.

    Blocks are joined by an empty line. References with the page's own source tell
    nothing, nor do those in which every slot of the content is the same (copies of the article).
    """
    if not page:
        return ""
    root = parse(page)
    roots = _outermost_main(root) or [root]
    whole = _any_text(roots, set())
    template: set[int] | None = None
    for source, reference in references:
        if source == page:
            continue
        aligned = Alignment()
        aligned.align(root, reference)
        if whole and not _any_text(roots, aligned.same):
            continue
        template = aligned.same if template is None else template & aligned.same
    return "\n\n".join(_collect(roots, template or set()))


def _collect(roots: list[Node], template: set[int]) -> list[str]:
    out: list[str] = []
    for root in roots:
        if id(root) in template:
            continue
        open_text: list[str] = []
        _blocks(root, template, out, open_text)
        _end(out, open_text)
    return out


def _any_text(nodes: Iterable[Node | str], template: set[int]) -> bool:
    """Whether anything but white space is left of the nodes without the template."""
    for node in nodes:
        if id(node) in template:
            continue
        if isinstance(node, str):
            if not node.isspace():
                return True
        elif not node.left_out and _any_text(node.children, template):
            return True
    return False


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages`` (page_id, url, html).

    References of a host are up to three of its pages: those whose source has the smallest and the
    largest hash, and the smallest under another hash function. Pages without a host have references among each other. A
    null or empty html, or one without content, gives an empty text. A page whose host has no
    other page keeps all slots that are not marked as boilerplate. Repeated rows come out repeatedly.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    places = [F.when(F.col("html") != "", F.xxhash64("html", F.lit(k))) for k in (0, 1)]
    # The first and the last page differ wherever a host has two.
    picks = [F.min_by("html", places[0]).alias("r0"), F.max_by("html", places[0]).alias("r1"), F.min_by("html", places[1]).alias("r2")]
    references = rows.groupBy("host").agg(*picks).select("host", F.array_compact(F.array_distinct(F.array("r0", "r1", "r2"))).alias("refs"))
    salted = references.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "html"), F.lit(SALTS)).cast("int"))
    joined = dealt.join(salted, ["host", "salt"]).select("page_id", "url", "html", "refs")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Node] = {}

        def tree(source: str) -> Node:
            if source not in known:
                if len(known) >= 64:
                    known.clear()
                known[source] = parse(source)
            return known[source]

        for batch in batches:
            texts = []
            for row in range(batch.num_rows):
                page = batch.column(2)[row].as_py()
                texts.append(extract(page, [(r, tree(r)) for r in batch.column(3)[row].as_py() if r]))
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    kind = dict(pages.dtypes)["page_id"]
    return joined.mapInArrow(work, f"page_id {kind}, url string, text string, n_chars long")
