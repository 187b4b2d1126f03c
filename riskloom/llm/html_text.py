"""Main text of web pages by wrapper induction over the pages of a host.

Every page becomes a tree of elements in which runs of equal siblings are one node (a list of paragraphs is one
node with many texts), so that trees stay small. The most frequent tree of a host is its reference; all trees of
the host are aligned with it by simple tree matching (the largest order-preserving matching of children, level by
level). A reference node whose text is the same on every page of the host that has it, while the pages differ
elsewhere, is template, inside a marked article as well; a node whose text varies is a slot for content. Pages with
a marked article count as different when its texts differ, so that copies of one article do not look like template.
What marks itself as something else than the article (navigation, headers of a site, footers, asides, forms, adverts,
notices, comments) is no content in either case. On a page that marks its article, the article's nodes are content
unless they are template, and nodes beside it are content where the wrapper has found them to be slots.

Texts of nodes are only hashed and counted over the host; pages stay where they are. Reference trees and template
nodes are small tables with one row per host.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import kept_in_worker, text_batches
from riskloom.session import materialize

#: Pages of a host, different from each other, that must agree on a node's text before it is template.
TEMPLATE_PAGES = 5
#: Cells up to which the table of a matching is held whole.
SMALL_TABLE = 4096
#: Element names and roles of the markup language.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
BLOCKS = set(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul caption".split()
)
CLOSES_P = BLOCKS - set("html body td th tr tbody thead tfoot caption option optgroup legend".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FENCES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
OUTSIDE = set("head nav aside footer form button select dialog menu audio video canvas search".split()) | RAW
OUTSIDE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())
#: Parts of class names and ids that say what an element is for, and words that say it only has or lacks such a thing.
OUTSIDE_PARTS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer cookie cookies consent notice notices gdpr popup modal newsletter subscribe "
    "subscription signup login share sharing social related recommended pagination pager widget toolbar masthead topbar".split()
)
COMMENT_PARTS = set("comment comments disqus respond replies".split())
ONLY_HAS = set("has with no without article content main".split())
ARTICLE_TOKENS = set(
    "article story article-body articlebody article-content article-text post-content post-body post-text entry-content "
    "main-content story-body page-content content-body".split()
)
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=/>\"']+)")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


@dataclass
class Node:
    name: str
    mark: str = ""
    outside: int = 0  # 1: by its name parts, 2: by what it is
    article: bool = False
    children: list = field(default_factory=list)  # nodes and strings


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        found.setdefault((m[1] or m[5]).lower(), unescape(next((g for g in m.group(2, 3, 4) if g is not None), "")))
    return found


def _element(name: str, attributes: str) -> Node:
    node = Node(name, outside=2 if name in OUTSIDE else 0, article=name in ("article", "main"))
    if not attributes.strip(" /"):
        return node
    found = _attributes(attributes)
    tokens = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
    node.mark = re.sub(r"\d+", "", " ".join(tokens))
    role = found.get("role", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", ""))
    if role in OUTSIDE_ROLES or hidden:
        node.outside = 2
    if role in ("main", "article") or found.get("itemprop") == "articleBody" or name in ("div", "section", "td") and ARTICLE_TOKENS & set(tokens):
        node.article = True
    if name not in ("html", "body"):
        for token in tokens:
            parts = set(re.split(r"[-_\d]+", token))
            if parts & COMMENT_PARTS and not parts & {"no", "has", "with", "without"}:
                node.outside = 2
            elif parts & OUTSIDE_PARTS and not parts & ONLY_HAS and name not in ("article", "main"):
                node.outside = max(node.outside, 1)
    node.article &= node.outside == 0
    return node


def _close(stack: list[Node], names: set[str], fences: set[str]) -> None:
    """Ends the innermost open element of ``names``, unless a fence stands between."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].name in names:
            del stack[depth:]
            return
        if stack[depth].name in fences:
            return


def parse(html: str) -> Node:
    """Tree of a page; unclosed and misplaced tags are mended as browsers mend the common cases."""
    root = Node("#")
    stack = [root]
    at, end = 0, len(html)
    while at < end:
        m = TOKEN.search(html, at)
        if m is None:
            rest = html[at:]
            cut = re.search(r"<[/!?a-zA-Z][^<]*$", rest)  # a tag that the end of the page cuts off
            stack[-1].children.append(unescape(rest[: cut.start()] if cut else rest))
            break
        if m.start() > at:
            stack[-1].children.append(unescape(html[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            _close(stack, {name}, set() if name in BLOCKS else {"article", "main", "body", "table"})
            continue
        if name in CLOSES_P:
            _close(stack, {"p"}, (BLOCKS - {"p"}) | {"button", "object"})
        if name in SIBLINGS:
            _close(stack, SIBLINGS[name], FENCES[name])
        node = _element(name, m[3])
        stack[-1].children.append(node)
        if name in RAW:
            closing = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(html, at)
            at = closing.end() if closing else at if name in ("noscript", "template", "svg", "math") else end
        elif name not in VOID:
            stack.append(node)
    return root


@dataclass
class Block:
    """Text of one block, the node of the page's tree it belongs to, and what encloses it."""

    node: int
    outside: bool
    article: bool
    linked: bool
    text: str


class Page:
    """Tree of a page with runs of equal siblings as one node, and its blocks in page order."""

    def __init__(self, html: str):
        self.nodes: list[tuple[int, str]] = [(-1, "#")]  # parent, label
        self.numbers: dict[tuple[int, str, int], int] = {}
        self.blocks: list[Block] = []
        self.text: list[str] = []
        self.plain = self.any_link = False
        self._walk(parse(html))
        self.has_article = any(b.article and not b.outside for b in self.blocks)

    def _walk(self, root: Node) -> None:
        where = (0, 0, False)  # node, outside, article
        work: list[tuple] = [("enter", root, *where, False)]  # an own stack: nesting may be deeper than Python's
        while work:
            step = work.pop()
            if step[0] == "say":
                self.text.append(step[1])
                if not step[1].isspace():
                    self.any_link |= step[2]
                    self.plain |= not step[2]
            elif step[0] == "leave":
                self._flush(where)
                where = step[1]
            else:
                _, node, index, outside, article, link = step
                if node.name in BLOCKS or node.name == "#" or outside != where[1]:
                    self._flush(where)
                    work.append(("leave", where))
                    where = (index, outside, article)
                work.extend(reversed(self._steps(node, index, outside, article, link)))
        self._flush(where)

    def _steps(self, node: Node, index: int, outside: int, article: bool, link: bool) -> list[tuple]:
        steps: list[tuple] = []
        last, run = None, -1
        for child in node.children:
            if isinstance(child, str):
                steps.append(("say", child, link))
            elif child.name in VOID:
                steps.append(("enter", child, index, outside, article, link) if child.name == "hr" else ("say", " ", link))
            else:
                own = index
                if child.name in BLOCKS or child.outside:
                    label = f"{child.name}.{child.mark}"
                    if label != last:
                        run, last = run + 1, label
                    own = self._number(index, label, run)
                # a site's header stands outside of articles; an article in a box named otherwise is still one
                kept_out = max(outside, child.outside, 2 if child.name == "header" and not article else 0)
                if child.article and outside < 2:
                    kept_out = 0
                steps.append(("enter", child, own, kept_out, article or child.article, link or child.name == "a"))
        return steps

    def _number(self, parent: int, label: str, run: int) -> int:
        key = (parent, label, run)
        if key not in self.numbers:
            self.numbers[key] = len(self.nodes)
            self.nodes.append((parent, label))
        return self.numbers[key]

    def _flush(self, where: tuple[int, int, bool]) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.blocks.append(Block(where[0], where[1] > 0, where[2], self.any_link and not self.plain, text))
        self.text, self.plain, self.any_link = [], False, False

    def tree(self) -> str:
        return json.dumps(self.nodes, ensure_ascii=False, separators=(",", ":"))

    def node_hashes(self) -> list[int | None]:
        """Hash of all texts of each node; nothing for nodes without text of their own."""
        texts: list[list[str]] = [[] for _ in self.nodes]
        for b in self.blocks:
            texts[b.node].append(b.text)
        return [text_hash("\n".join(t)) if t else None for t in texts]

    def page_hash(self, hashes: list[int | None]) -> int:
        """What makes a page differ from others: the texts of its marked article, or else all texts."""
        inside = {b.node for b in self.blocks if b.article and not b.outside}
        return text_hash(json.dumps([h for node, h in enumerate(hashes) if node in inside] if inside else hashes))

    def main_text(self, template: set[int], slots: set[int] = frozenset()) -> str:
        """Blocks of the marked article and of the known slots, or without a mark all blocks; none that is template or marked as something else."""
        open_to = [b for b in self.blocks if not b.outside and b.node not in template]
        if self.has_article:
            kept = [b for b in open_to if b.article or b.node in slots and not b.linked]
        else:
            kept = [b for b in open_to if not b.linked]
        return "\n".join(b.text for b in kept)


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _matching(left: list[int], right: list[int], weight: Callable[[int, int], int], trace: bool) -> tuple[int, list[tuple[int, int]]]:
    """Weight of the best matching of two lists that keeps their order and, if asked for, its pairs of places.

    Small lists go through a plain table. Of long ones only a row of weights is held at a time, with two bits a cell for
    the way back; equal shapes share their weights, so a row is one lookup.
    """
    if len(left) * len(right) <= SMALL_TABLE:
        best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weight(x, y))
        total, skips_left, skips_right = best[-1][-1], None, None
    else:
        kinds, where = np.unique(right, return_inverse=True)
        by_kind = {x: np.array([weight(x, y) for y in kinds.tolist()], np.int64) for x in set(left)}
        row, skips_left, skips_right = np.zeros(len(right) + 1, np.int64), [], []
        for x in left:
            new = np.zeros_like(row)
            new[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + by_kind[x][where]))
            if trace:
                skips_left.append(np.packbits(new[1:] == row[1:]))
                skips_right.append(np.packbits(new[1:] == new[:-1]))
            row = new
        total = int(row[-1])
    pairs, i, j = [], len(left), len(right)
    while trace and i and j:
        if skips_left is None:
            up, back = best[i][j] == best[i - 1][j], best[i][j] == best[i][j - 1]
        else:
            byte, bit = (j - 1) >> 3, 7 - ((j - 1) & 7)
            up, back = skips_left[i - 1][byte] >> bit & 1, skips_right[i - 1][byte] >> bit & 1
        if up:
            i -= 1
        elif back:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return total, pairs


def align(tree: str, reference: str) -> list[int]:
    """For each node of ``tree`` the matching node of ``reference``, or -1: simple tree matching from the roots.

    Subtrees of equal shape are one shape, and a pair of shapes is weighed once, so long lists of like siblings cost
    little; children are matched one by one only for pairs of nodes that are matched themselves.
    """
    first, second = json.loads(tree), json.loads(reference)
    if first == second:
        return list(range(len(first)))
    numbers: dict[tuple, int] = {}
    labels: list = []  # by shape
    parts: list[list[int]] = []
    below, shapes = [], []
    for nodes in (first, second):
        children: list[list[int]] = [[] for _ in nodes]
        for number, (parent, _) in enumerate(nodes):
            if parent >= 0:
                children[parent].append(number)
        own = [0] * len(nodes)
        for number in range(len(nodes) - 1, -1, -1):  # children come after their parents
            inner = [own[c] for c in children[number]]
            key = (str(nodes[number][1]), tuple(inner))
            if key not in numbers:
                numbers[key] = len(labels)
                labels.append(nodes[number][1])
                parts.append(inner)
            own[number] = numbers[key]
        below.append(children)
        shapes.append(own)
    sizes: dict[tuple[int, int], int] = {}

    def weight(x: int, y: int) -> int:
        return sizes[x, y] if labels[x] == labels[y] else 0

    waiting = [(shapes[0][0], shapes[1][0])]
    while waiting:
        x, y = waiting[-1]
        if (x, y) in sizes:
            waiting.pop()
            continue
        inner = [(p, q) for p in dict.fromkeys(parts[x]) for q in dict.fromkeys(parts[y]) if labels[p] == labels[q]]
        missing = [pair for pair in inner if pair not in sizes]
        if missing:
            waiting += missing
        else:
            sizes[x, y] = _matching(parts[x], parts[y], weight, False)[0] + 1
            waiting.pop()
    found = [-1] * len(first)
    work = [(0, 0)]
    while work:
        a, b = work.pop()
        found[a] = b
        left, right = below[0][a], below[1][b]
        _, pairs = _matching([shapes[0][c] for c in left], [shapes[1][c] for c in right], weight, True)
        work += [(left[i], right[j]) for i, j in pairs]
    return found


def _pages(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), HOST, 1))
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), host.alias("host"), F.col("html").cast("string"))


def wrappers(pages: DataFrame) -> DataFrame:
    """One row per host: its reference tree and the nodes of it that are template, and those that are slots.

    Trees and nodes are counted over all pages of all hosts; a host's pages never come together in one task.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            rows = []
            for html in batch["html"].to_pylist():
                page = Page(html or "")
                tree, hashes = page.tree(), page.node_hashes()
                rows.append((text_hash(tree), tree, hashes, page.page_hash(hashes)))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            types = [pa.int64(), pa.string(), pa.list_(pa.int64()), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["host"], *arrays], ["host", "tree_id", "tree", "hashes", "page_hash"])

    schema = "host string, tree_id long, tree string, hashes array<long>, page_hash long"
    seen = materialize(_pages(pages).where("host <> ''").select("host", "html").mapInArrow(read, schema), "page-trees")
    trees = seen.groupBy("host", "tree_id").agg(F.count("*").alias("n"), F.first("tree").alias("tree"))
    trees = materialize(trees, "trees")
    frequent = F.max(F.struct("n", "tree_id", "tree")).alias("best")
    references = materialize(trees.groupBy("host").agg(frequent).select("host", F.col("best.tree").alias("reference")), "references")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            found = [align(t, r) for t, r in zip(batch["tree"].to_pylist(), batch["reference"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["host"], batch["tree_id"], pa.array(found, pa.list_(pa.int64()))], ["host", "tree_id", "places"])

    places = trees.join(references, "host").select("host", "tree_id", "tree", "reference").mapInArrow(match, "host string, tree_id long, places array<long>")
    places = places.select("host", "tree_id", F.posexplode("places").alias("node", "place")).where("place >= 0")
    texts = seen.select("host", "tree_id", "page_hash", F.posexplode("hashes").alias("node", "text")).where("text IS NOT NULL")
    texts = texts.groupBy("host", "tree_id", "node").agg(
        F.min("text").alias("low"), F.max("text").alias("high"), F.approx_count_distinct("page_hash").alias("pages")
    )
    template = texts.join(places, ["host", "tree_id", "node"]).groupBy("host", "place").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("pages").alias("pages")
    )
    # at most as many places as the reference tree has nodes
    sides = [F.sort_array(F.collect_list(F.when(F.expr(is_one), F.col("place")))).alias(name) for name, is_one in (("template", "low = high"), ("slots", "low < high"))]
    template = template.where(f"pages >= {TEMPLATE_PAGES}").groupBy("host").agg(*sides)
    return materialize(references.join(template, "host", "left"), "wrappers")


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per page row: page_id, url, text (main text, empty if there is none) and n_chars.

    Null html counts as empty. Pages without a readable host have no wrapper: only marks on the page decide. A host
    with fewer than TEMPLATE_PAGES different pages has no template either. Null page ids and urls are kept, repeated
    rows give repeated results, other columns are ignored.
    """
    rows = _pages(pages).join(wrappers(pages), "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept_in_worker("aligned trees", dict)
        for batch in text_batches(batches):
            texts = []
            for html, reference, template, slots in zip(*(batch[c].to_pylist() for c in ("html", "reference", "template", "slots")), strict=True):
                page = Page(html or "")
                constant: set[int] = set()
                varying: set[int] = set()
                if template or slots:
                    key = page.tree(), reference
                    if key not in known:
                        if len(known) >= 1000:
                            known.clear()
                        known[key] = align(*key)
                    fixed, free = set(template), set(slots)
                    constant = {node for node, place in enumerate(known[key]) if place in fixed}
                    varying = {node for node, place in enumerate(known[key]) if place in free}
                texts.append(page.main_text(constant, varying))
            arrays = [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])

    return rows.select("page_id", "url", "html", "reference", "template", "slots").mapInArrow(run, "page_id long, url string, text string, n_chars long")
