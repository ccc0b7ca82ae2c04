"""Main text of web pages by wrapper induction.

Every page is parsed once to a tree of blocks: elements that break lines, and the runs
of text between them. Pages of a host with the same set of container paths are one
layout. Each layout with two different pages has a reference tree, the page that holds
most of the texts common to nearly all its pages; every different page is aligned with
it by simple tree matching (the heaviest order-preserving match of children, top down).
Whole-layout counts say on how many pages a reference node came back with the same
text. A node constant on ``NEARLY`` all pages is template, a node that varies or has no
partner is content, and the deepest container with ``MOST`` of what varies is the
content region. Counts combine per task and by key; only the reference is kept per
layout, so no host is gathered in one place. Pages whose layout is theirs alone use the
wrapper of their host's largest layout.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments are left out by tag and by name outside of ``article`` and ``main``; within,
only whole comment lists, adverts, notices, share bars and the like, never a heading or
a paragraph. A page without its wrapper's region uses its own article, main or body.

Edge cases: null and empty pages give an empty text; a null url or one without a host
has no wrapper; broken markup is read as browsers do as far as blocks are concerned;
pages of equal text count once, and a page that would keep less than ``KEPT`` of its
text is taken for a near copy of its reference and loses nothing; rows may repeat; texts
of any length are whole. Below ``DEPTH`` nested blocks only text runs are nodes. Child lists
of any length are aligned exactly: of large tables of sums only some rows are held and the
others made again (``HELD``), and weights that were forgotten (``KNOWN``) are found again, so
neither bound decides a result.
"""

from __future__ import annotations

import bisect
import hashlib
import html as entities
import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.session import settle

NEARLY = 0.9  # of a layout's different pages, for a template node (two pages at least)
MOST = 0.6  # of the varying text, for the region
KEPT = 0.05  # of a page's text that a template must leave
DEPTH = 60
CELLS = math.inf  # an option, off: child lists of more pairs are aligned by children equal and unique in both
HELD = 4_000_000  # sums of one child list that are held at once; beyond, rows of them by the root of their number
KNOWN = 500_000  # weights of pairs that are remembered at once
FLUSH = 100_000  # counts a task holds before it passes them on
CONTAINERS = {"article", "main", "section", "div", "body", "td"}

# Names of elements by what they are for.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
SKIP = {"head", "nav", "header", "footer", "aside", "form", "menu", "button", "select", "svg", "dialog", "object", "canvas", "audio", "video", "map"} | RAW
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SHUTS_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary", "figcaption"}
BOXES = {"article", "main", "section", "div", "body", "td", "table", "aside", "nav", "header", "footer", "form", "ul", "ol", "html"}
BOILER = re.compile(
    r"(?:^|[-_\s])(?:ads?|adv|advert\w*|adsense|banner|sponsor\w*|promo\w*|sidebar\w*|side|menu\w*|nav|navbar|navigation|breadcrumbs?|cookie\w*|consent|notice\w*|gdpr|popup|modal|overlay|comments?|commentlist|replies|disqus|respond|share\w*|sharing|social\w*|related|recommend\w*|newsletter\w*|subscribe\w*|signup|login|footer|masthead|topbar|toolbar|pagination|pager|widget\w*|skip|alert)(?:$|[-_\s])",
    re.I,
)
#: Names that leave out whole elements within an article too; the name is the element's, not a part of a longer one.
INSIDE = re.compile(
    r"(?:^|\s)(?:ads?|advert\w*|adsense|sponsor(?:ed)?|promo|comments?|comment-?list|replies|disqus\w*|respond|share(?:-?(?:bar|buttons|links))?|sharing|social(?:-?(?:bar|links))?|newsletter(?:-?signup)?|subscribe|cookie-?(?:notice|banner|consent)|notice|consent|gdpr|menu|nav|navbar|navigation|breadcrumbs?|sidebar|pagination|pager)(?:$|\s)",
    re.I,
)
HEADINGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form", "alertdialog"}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Node:
    tag: str
    mark: str = ""  # class and id
    skip: bool = False
    text: str = ""
    inside: bool = False  # of an article or main
    children: list[Node] = field(default_factory=list)


def _attrs(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)}


def parse(page: str) -> Node:
    """Tree of elements and text nodes; end tags that are missing are supplied."""
    root = Node("#root")
    stack, at = [root], 0

    def text(upto: int) -> None:
        if upto > at:
            top = stack[-1]
            top.children.append(Node("#text", text=entities.unescape(page[at:upto]), skip=top.skip))

    while m := _TOKEN.search(page, at):
        text(m.start())
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag not in BOXES and stack[k].tag in BOXES and tag in BLOCK:
                    break
            continue
        shut = CLOSES.get(tag, set()) | ({"p"} if tag in SHUTS_P else set())
        if shut:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in shut:
                    del stack[k:]
                    break
                if stack[k].tag in BOXES:
                    break
        top = stack[-1]
        inside = top.inside or tag in ("article", "main")
        node = Node(tag, skip=top.skip or (tag in SKIP and not (inside and tag == "header")), inside=inside)
        if m[3] and not m[3].isspace():
            a = _attrs(m[3])
            node.mark = " ".join(x for x in (a.get("class", ""), a.get("id", "")) if x)
            named = tag not in ("html", "body", "article", "main") and node.mark and (tag not in HEADINGS and INSIDE.search(node.mark) if inside else BOILER.search(node.mark))
            if named or a.get("role", "").lower() in ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true" or ("style" in a and _HIDDEN.search(a["style"])):
                node.skip = True
        top.children.append(node)
        if tag in VOID or m[3].rstrip().endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append(node)
    text(len(page))
    return root


def _clean(text: str) -> str:
    return " ".join(text.split())


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


@dataclass
class Tree:
    """Blocks in page order: each node's parent, its label (tag and names; ``#text`` for a run of text) and its text.

    ``mark`` is the hash of a run's text, 0 for elements, and ``chars`` its length; a tree
    to align with needs no text. The first node is the root.
    """

    up: list[int]
    label: list[str]
    mark: list[int]
    chars: list[int]
    text: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.tag = [x.split(" ", 1)[0] for x in self.label]
        self.kids: list[list[int]] = [[] for _ in self.up]
        for k in range(1, len(self.up)):
            self.kids[self.up[k]].append(k)
        # A node's hash stands for its whole subtree; a simple node has no children but one run of text.
        self.sub, self.size = list(self.mark), [1] * len(self.up)
        for k in range(len(self.up) - 1, -1, -1):
            if self.tag[k] != "#text":
                self.sub[k] = hash((self.label[k], *[self.sub[c] for c in self.kids[k]]))
                self.size[k] += sum(self.size[c] for c in self.kids[k])
        self.simple = np.array([not kids or (len(kids) == 1 and self.tag[kids[0]] == "#text") for kids in self.kids])
        self.only = np.array([self.mark[kids[0]] if kids and flat else m for kids, flat, m in zip(self.kids, self.simple, self.mark, strict=True)], np.int64)
        self.code, self.name = (np.array([zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in xs], np.int64) for xs in (self.tag, self.label))

    def runs(self) -> list[int]:
        return [k for k, t in enumerate(self.tag) if t == "#text"]

    def path(self, k: int) -> str:
        out = []
        while k > 0:
            out.append(self.tag[k])
            k = self.up[k]
        return "".join(f"/{t}" for t in reversed(out) if t != "html")


def outline(page: str) -> Tree:
    """Tree of blocks of what is not skipped."""
    up, label, text = [-1], ["#root"], [""]
    at, depth, held = [0], 0, []

    def flush():
        if held:
            run = _clean("".join(held))
            if run:
                up.append(at[-1])
                label.append("#text")
                text.append(run)
            held.clear()

    todo: list[Node | None] = [parse(page)]
    while todo:
        n = todo.pop()
        if n is None:
            flush()
            depth -= 1
            if depth < DEPTH:
                at.pop()
            continue
        if n.tag in BLOCK:
            flush()
        if n.skip:
            continue
        if n.tag == "#text":
            held.append(n.text)
        elif n.tag == "br":
            held.append(" ")
        else:
            if n.tag in BLOCK:
                if depth < DEPTH:
                    up.append(at[-1])
                    label.append(f"{n.tag} {n.mark}".rstrip())
                    text.append("")
                    at.append(len(up) - 1)
                depth += 1
                todo.append(None)
            todo.extend(reversed(n.children))
    flush()
    return Tree(up, label, [_hash(t) if t else 0 for t in text], [len(t) for t in text], text)


def layout(tree: Tree) -> int:
    """Hash of the set of container paths."""
    return _hash("\n".join(sorted({tree.path(k) for k, t in enumerate(tree.tag) if t in CONTAINERS})))


def _equal_in_order(a: list[tuple], b: list[tuple]) -> list[tuple[int, int]]:
    """Longest run of pairs in order among keys that occur once in both lists."""
    once = [{k: p for p, k in enumerate(x) if n[k] == 1} for x in (a, b) for n in (Counter(x),)]
    pairs = sorted((p, once[1][k]) for k, p in once[0].items() if k in once[1])
    ends, last, before = [], [], [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect.bisect_left(ends, j)
        ends[at:at + 1], last[at:at + 1] = [j], [k]
        before[k] = last[at - 1] if at else -1
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def match(ref: Tree, tree: Tree) -> list[int]:
    """Simple tree matching: the reference node that each node of ``tree`` is aligned with, -1 without one.

    Nodes match by tag below matched parents, in order. A pair weighs 2 and the weight of
    its children's match, 1 more for equal names, or equal text if they are runs of text.
    """
    known: dict[tuple[int, int], int] = {}  # by the hashes of two subtrees

    def side(b: int) -> tuple:
        right = tree.kids[b]
        return right, tree.code[right], tree.name[right], tree.only[right], tree.simple[right]

    def add(x: int, right: tuple, before: np.ndarray) -> np.ndarray:
        """Best sums of the pairs of the first children up to ``x`` and all first children of the other node, from those before ``x``."""
        kids, code, name, only, flat = right
        like = code == ref.code[x]
        same = only == ref.only[x]
        if ref.tag[x] == "#text":
            w = like * (2 + same)
        else:
            w = like * (2 + (name == ref.name[x]) + (only != 0) * (ref.only[x] != 0) * (2 + same))
            for j in np.flatnonzero(like if not ref.simple[x] else like & ~flat).tolist():
                w[j] = weight(x, kids[j])
        out = np.zeros(len(before), np.int32)
        out[1:] = np.maximum.accumulate(np.maximum(before[1:], before[:-1] + w))
        return out

    def weight(a: int, b: int) -> int:
        key = ref.sub[a], tree.sub[b]
        if key[0] == key[1]:
            return 3 * ref.size[a]
        if key not in known:
            w = 2 + int(ref.label[a] == tree.label[b])
            if ref.kids[a] and tree.kids[b] and len(ref.kids[a]) * len(tree.kids[b]) <= CELLS:
                right = side(b)
                sums = np.zeros(len(right[0]) + 1, np.int32)
                for x in ref.kids[a]:
                    sums = add(x, right, sums)
                w += int(sums[-1])
            if len(known) >= KNOWN:
                known.clear()
            known[key] = w
        return known[key]

    def heaviest(a: int, b: int) -> list[tuple[int, int]]:
        """Places of the matched children, last ones first."""
        left, right = ref.kids[a], side(b)
        i, j = len(left), len(right[0])
        step = i if i * j <= HELD else math.isqrt(i)
        row = np.zeros(j + 1, np.int32)
        rows = {0: row}  # every so many
        for k in range((i - 1) // step * step):
            row = add(left[k], right, row)
            if (k + 1) % step == 0:
                rows[k + 1] = row
        found, first, block = [], -1, []
        while i and j:
            if first != (i - 1) // step * step:
                first = (i - 1) // step * step
                block = [rows[first]]
                for x in left[first:i]:
                    block.append(add(x, right, block[-1]))
            above, own = block[i - 1 - first], block[i - first]
            if own[j] == above[j]:
                i -= 1
            elif own[j] == own[j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((i, j))
        return found

    to = [-1] * len(tree.up)
    to[0] = 0
    todo = [(0, 0)]
    while todo:
        a, b = todo.pop()
        left, right = ref.kids[a], tree.kids[b]
        if not left or not right:
            continue
        if len(left) * len(right) > CELLS:
            found = _equal_in_order([(ref.tag[x], ref.sub[x]) for x in left], [(tree.tag[x], tree.sub[x]) for x in right])
        else:
            found = heaviest(a, b)
        for i, j in found:
            to[right[j]] = left[i]
            todo.append((left[i], right[j]))
    return to


def _deepest(tree: Tree, own: dict[int, int]) -> int:
    """Deepest container that holds ``MOST`` of the weights of nodes; -1 without any."""
    total = [own.get(k, 0) for k in range(len(tree.up))]
    depth = [0] * len(total)
    for k in range(len(total) - 1, 0, -1):
        total[tree.up[k]] += total[k]
    for k in range(1, len(total)):
        depth[k] = depth[tree.up[k]] + 1
    fit = [k for k, t in enumerate(tree.tag) if t in CONTAINERS and total[k] > 0 and total[k] >= MOST * total[0]]
    return max(fit, key=lambda k: (depth[k], total[k], -k), default=-1)


@dataclass
class Wrapper:
    """Reference tree of a layout, its template nodes and its content region (-1: none)."""

    tree: Tree
    constant: frozenset[int]
    region: int


def seen(ref: Tree, tree: Tree) -> dict[int, tuple[int, int]]:
    """Per reference node: 1 if the page shows its text there, and the length of the page's text there or, unmatched, below."""
    to, out = match(ref, tree), {}
    for k in tree.runs():
        at, equal = to[k], 0
        if at >= 0:
            equal = int(ref.mark[at] == tree.mark[k])
        up = k
        while at < 0:
            up = tree.up[up]
            at = to[up]
        n = out.get(at, (0, 0))
        out[at] = (n[0] + equal, n[1] + tree.chars[k])
    return out


def conclude(ref: Tree, pages: int, counts: dict[int, tuple[int, int]]) -> Wrapper:
    """Wrapper from a layout's number of different pages and its summed counts per reference node."""
    constant = frozenset(k for k, (n, _) in counts.items() if n >= max(2, NEARLY * pages))
    varying = {k: size - (counts[k][0] * ref.chars[k] if k in constant else 0) for k, (_, size) in counts.items()}
    return Wrapper(ref, constant, _deepest(ref, varying))


def kept(tree: Tree, wrapper: Wrapper | None = None) -> list[int]:
    """Runs of text of the page's content, in page order."""
    runs, to, template = tree.runs(), [], set()
    if wrapper is not None:
        to = match(wrapper.tree, tree)
        template = {k for k in runs if to[k] in wrapper.constant and wrapper.tree.mark[to[k]] == tree.mark[k]}
        size = sum(tree.chars[k] for k in runs)
        if sum(tree.chars[k] for k in runs if k not in template) < KEPT * size:
            template = set()

    def under(tops) -> list[int]:
        among = set(tops)
        for k in range(1, len(tree.up)):
            if tree.up[k] in among:
                among.add(k)
        return [k for k in runs if k in among and k not in template]

    if wrapper is not None and wrapper.region >= 0 and wrapper.region in to:
        found = under([to.index(wrapper.region)])
        if 2 * sum(tree.chars[k] for k in found) >= sum(tree.chars[k] for k in runs if k not in template):
            return found
    for tag in ("article", "main", "body"):
        if tops := [k for k, t in enumerate(tree.tag) if t == tag]:
            return under(tops)
    return under([0])


def main_text(page: str | None, wrapper: Wrapper | None = None) -> str:
    """Blocks of the content region in page order, joined by an empty line."""
    tree = outline(page or "")
    return "\n\n".join(tree.text[k] for k in kept(tree, wrapper))


FIELDS = ("_up", "_label", "_mark", "_chars")  # of a tree without its text
TREE = "_up array<int>, _label array<string>, _mark array<long>, _chars array<int>"


def _columns(batch, *names: str):
    return zip(*(batch.column(c).to_pylist() for c in names), strict=True)


def _read(batches):
    """Pages to trees, with the hashes of layout and text."""
    for batch in batches:
        out = []
        for page in batch.column("_html"):
            tree = outline(page.as_py() or "")
            out.append((layout(tree), _hash("\n".join(t for t in tree.text if t)), tree.up, tree.label, tree.mark, tree.chars, tree.text))
        types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string())]
        found = [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)] if out else [pa.array([], t) for t in types]
        names = ["_layout", "_print", *FIELDS, "_text"]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), batch.column("_host"), *found], names=["page_id", "url", "_host", *names])


def _count(batches):
    """Sums of ``seen`` per layout and reference node."""
    counts: dict[tuple, list[int]] = {}

    def out():
        rows = [(*key, *n) for key, n in counts.items()]
        types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["_host", "_layout", "_node", "_equal", "_size"])

    for batch in batches:
        refs: dict[tuple, Tree] = {}
        for host, where, ref, *tree in _columns(batch, "_host", "_layout", "_ref", *FIELDS):
            if (host, where) not in refs:
                refs[host, where] = Tree(*[ref[f] for f in FIELDS])
            for node, n in seen(refs[host, where], Tree(*tree)).items():
                at = counts.setdefault((host, where, node), [0, 0])
                at[0], at[1] = at[0] + n[0], at[1] + n[1]
        if len(counts) >= FLUSH:
            yield out()
            counts.clear()
    if counts:
        yield out()


def _apply(batches):
    """Texts of pages by their wrappers."""
    for batch in batches:
        wrappers: dict[tuple, Wrapper] = {}
        out = []
        for host, where, w, text, *tree in _columns(batch, "_host", "_layout", "_wrapper", "_text", *FIELDS):
            wrapper = None
            if w is not None:
                if (host, where) not in wrappers:
                    counts = {c["_node"]: (c["_equal"], c["_size"]) for c in w["_counts"]}
                    wrappers[host, where] = conclude(Tree(*[w["_ref"][f] for f in FIELDS]), w["_pages"], counts)
                wrapper = wrappers[host, where]
            out.append("\n\n".join(text[k] for k in kept(Tree(*tree), wrapper)))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url and text."""
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("_html"))
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    base = base.withColumn("_host", F.when(F.length(host) > 0, host))
    trees = settle(base.mapInArrow(_read, f"page_id long, url string, _host string, _layout long, _print long, {TREE}, _text array<string>"))

    # Pages of equal text count once. Texts themselves are not shuffled here.
    key = ["_host", "_layout"]
    known = trees.where("_host IS NOT NULL AND exists(_mark, m -> m != 0)")
    different = settle(known.groupBy(*key, "_print").agg(F.min(F.struct(*FIELDS)).alias("_ref")))
    layouts = settle(different.groupBy(*key).agg(F.count("*").alias("_pages")).where("_pages > 1"))
    marks = F.explode(F.array_distinct(F.filter("_ref._mark", lambda m: m != 0))).alias("_mark")
    common = different.select(*key, marks).groupBy(*key, "_mark").agg(F.count("*").alias("_n")).where("_n > 1")
    common = common.join(layouts, key).where(F.col("_n") >= NEARLY * F.col("_pages")).groupBy(*key).agg(F.collect_set("_mark").alias("_common"))
    # The reference holds most of the common texts and is the smallest such page. Written first, a hot layout's join can be split.
    shared = F.coalesce(F.size(F.array_intersect("_ref._mark", "_common")), F.lit(0))
    ranked = different.join(settle(common), key, "left").select(*key, F.struct((-shared).alias("a"), F.size("_ref._up").alias("b"), F.col("_print").alias("c")).alias("_rank"))
    first = settle(ranked).groupBy(*key).agg(F.min("_rank")["c"].alias("_print"))
    refs = settle(different.join(first, [*key, "_print"]).join(layouts, key).select(*key, "_ref", "_pages"))

    counts = different.select(*key, "_ref.*").join(refs, key).select(*key, "_ref", *FIELDS).mapInArrow(_count, "_host string, _layout long, _node int, _equal long, _size long")
    counts = counts.groupBy(*key, "_node").agg(F.sum("_equal").alias("_equal"), F.sum("_size").alias("_size"))
    counts = counts.groupBy(*key).agg(F.collect_list(F.struct("_node", "_equal", "_size")).alias("_counts"))  # at most the reference's nodes
    wrappers = settle(refs.join(counts, key).select(*key, F.struct("_ref", "_pages", "_counts").alias("_wrapper")))

    # A layout without a wrapper takes the one of its host's largest layout.
    largest = refs.groupBy("_host").agg(F.max_by("_layout", F.struct("_pages", "_layout")).alias("_main"))
    own = wrappers.select(*key, F.col("_layout").alias("_own"))
    uses = known.select(*key).distinct().join(own, key, "left").join(largest, "_host")
    uses = uses.select(*key, F.coalesce("_own", "_main").alias("_use"))
    chosen = wrappers.withColumnRenamed("_layout", "_use")
    uses = settle(uses.join(chosen, ["_host", "_use"]).select(*key, "_wrapper"))
    return trees.join(uses, key, "left").select("page_id", "url", *key, "_wrapper", *FIELDS, "_text").mapInArrow(_apply, "page_id long, url string, text string")


def digest(found: DataFrame) -> DataFrame:
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
