"""Main text of web pages by wrapper induction.

Pages of one host are aligned with a reference page of the host by simple tree matching; what
the reference lacks is known by its place in the page. Nodes whose text stays the same over the
host's pages are template; slots whose text varies are content. Roles that no reader takes for the article (menus, adverts, forms, comments ...)
are known by element, or by a whole class or id, and go. All other text stays, inside an article
element or not.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrisk.llm import textkit
from portrisk.session import freeze

TEMPLATE_SHARE, TEMPLATE_PAGES = 0.7, 3
# fixed values: element names of HTML by their role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head script style noscript template iframe object svg math canvas audio video".split())
BOILERPLATE = frozenset("nav footer aside form button select textarea dialog menu".split())
RAW = frozenset("script style textarea title".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br".split()
)
CLOSES_P = BLOCKS - {"br", "body", "html"}
# a class or an id names a role if each of its parts does or helps to: "related-posts", not "has-sidebar" or "category-legal"
_ROLE = (
    "ads?|adverts?|advertisements?|advertising|sponsor(?:s|ed)?|promos?|banners?|navs?|navbar|navigation|menus?|sidebars?|footers?|masthead|topbar|breadcrumbs?|"
    "comments?|respond|replies|disqus|cookies?|consent|notices?|gdpr|popups?|modals?|overlay|newsletters?|subscribe|subscription|signup|login|share|sharing|"
    "social|related|recommended|recommendations?|widgets?|pagination|pager|toolbar|skip|skiplink|copyright|legal|disclaimers?"
)
_HELPS = (
    "site|global|top|bottom|primary|secondary|mobile|links?|lists?|items?|box|boxes|bar|block|area|wrap|wrapper|container|inner|outer|section|group|buttons?|icons?|"
    "posts|articles|stories|form|title|header|heading|text|body|unit|slot|policy|toggle|to|us|by|media|thread"
)
NOT_ARTICLE = re.compile(rf"(?:(?:{_HELPS})[-_]+)*(?:{_ROLE})(?:[-_]+(?:{_ROLE}|{_HELPS}))*|side-bar|site-header", re.I)
ARTICLE = re.compile(r"(?:h?entry|post|article|story|content|main|page)(?:[-_]+(?:content|body|text|main|article|wrap|wrapper|container|inner))*", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())


class Node:
    __slots__ = ("tag", "label", "children", "text", "dropped", "named")

    def __init__(self, tag: str, label: str, dropped: bool, named: bool = False) -> None:
        self.tag, self.label, self.dropped = tag, label, dropped
        self.named = named  # by its class or id alone it is no article
        self.children: list[Node] = []
        self.text: list = []  # strings and child nodes in page order


# a comment, a declaration, an end tag, or a start tag with its attributes (also with odd quotes); any other "<" is text
_MARKUP = re.compile(
    r"<(?:!--(?:.*?-->|.*)|[!?][^>]*>|/([A-Za-z][^\s/>]*)[^>]*>|([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|([A-Za-z][^\s/>]*)[^>]*>)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TELLING = re.compile(r"class|id|role|hidden", re.I)
_CONTROL = re.compile("[\x00-\x03]")
_ENDS: dict[str, re.Pattern] = {}


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(a or b or c))
    return found


def _no_article(names: str) -> bool:
    tokens = names.split()
    return any(NOT_ARTICLE.fullmatch(t) for t in tokens) and not any(ARTICLE.fullmatch(t) for t in tokens)


def _spare_articles(root: Node) -> None:
    """A class or id does not count against an element that holds a main element, the longest article, or an article when all are in such elements."""
    nodes, above = [root], [-1]
    for at, node in enumerate(nodes):  # grows meanwhile; what is dropped by element holds no article
        for child in node.children:
            if not child.dropped:
                nodes.append(child)
                above.append(at)
    sizes = [sum(len(x) for x in n.text if isinstance(x, str)) for n in nodes]
    inside = [n.named for n in nodes]
    for at in range(1, len(nodes)):
        inside[at] |= inside[above[at]]
    for at in range(len(nodes) - 1, 0, -1):
        sizes[above[at]] += sizes[at]
    articles = [at for at, n in enumerate(nodes) if n.tag == "article"]
    longest = max(articles, key=lambda at: sizes[at], default=-1)
    hidden = all(inside[at] for at in range(len(nodes)) if nodes[at].tag in ("article", "main"))
    spared = [n.tag == "main" or n.tag == "article" and (hidden or at == longest) for at, n in enumerate(nodes)]
    for at in range(len(nodes) - 1, 0, -1):
        spared[above[at]] |= spared[at]
    for node, spare in zip(nodes, spared, strict=True):
        node.named &= not spare


class _Builder:
    """A DOM of sorts: unclosed paragraphs and list items end where the next one or their parent ends."""

    def __init__(self) -> None:
        self.root = Node("html", "html", False)
        self.open = [self.root]
        self.count: Counter[str] = Counter()  # open elements of each tag
        self.named = self.articles = False  # whether there is any

    def start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body"):
            return
        if tag in CLOSES_P:
            self._end_open("p", BLOCKS - {"p"})
        if tag == "li":
            self._end_open("li", {"ul", "ol", "menu"})
        elif tag in ("dt", "dd"):
            self._end_open("dt", {"dl"})
            self._end_open("dd", {"dl"})
        elif tag in ("tr", "td", "th"):
            for cell in ("td", "th"):
                self._end_open(cell, {"table", "tr"} if tag != "tr" else {"table"})
            if tag == "tr":
                self._end_open("tr", {"table"})
        names, named, drop = "", False, tag in UNSEEN or tag in BOILERPLATE or tag == "header" and not (self.count["article"] or self.count["main"])
        if attributes and _TELLING.search(attributes):
            known = _attributes(attributes)
            names = _CONTROL.sub("", f"{known.get('class', '')} {known.get('id', '')}").strip()
            drop = drop or known.get("role", "").lower() in ROLES or "hidden" in known or known.get("aria-hidden") == "true"
            named = bool(names) and tag not in ("article", "main") and _no_article(names)
        self.named |= named
        self.articles |= tag in ("article", "main")
        node = Node(tag, f"{tag}.{names}" if names and not re.search(r"\d", names) else tag, drop, named)
        parent = self.open[-1]
        parent.children.append(node)
        parent.text.append(node)
        if tag not in VOID and not attributes.endswith("/"):
            self.open.append(node)
            self.count[tag] += 1

    def _close(self, at: int) -> None:
        self.count.subtract(n.tag for n in self.open[at:])
        del self.open[at:]

    def end(self, tag: str) -> None:
        if not self.count[tag]:
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                self._close(at)
                return
            if tag not in BLOCKS and self.open[at].tag in ("article", "main", "table"):
                return  # a stray inline end does not close the article

    def _end_open(self, tag: str, within) -> None:
        if not self.count[tag]:
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                self._close(at)
                return
            if self.open[at].tag in within:
                return


def parse(html: str) -> Node:
    """Read a page in one pass; what stands in scripts, styles and the like is one raw text."""
    tree, at = _Builder(), 0
    while (found := _MARKUP.search(html, at)) is not None:
        if found.start() > at:
            tree.open[-1].text.append(_decoded(html[at : found.start()]))
        at = found.end()
        if found[1]:
            tree.end(found[1].lower())
        elif found[2] or found[4]:
            tag = (found[2] or found[4]).lower()
            tree.start(tag, found[3] or "")
            if tag in RAW and tree.open[-1].tag == tag:
                if tag not in _ENDS:
                    _ENDS[tag] = re.compile(rf"</{tag}[^>]*>", re.I)
                stop = _ENDS[tag].search(html, at)
                end = stop.start() if stop else len(html)
                tree.open[-1].text.append(html[at:end])
                tree.end(tag)
                at = stop.end() if stop else end
    if at < len(html):
        tree.open[-1].text.append(_decoded(html[at:]))
    if tree.named and tree.articles:
        _spare_articles(tree.root)
    return tree.root


def _decoded(text: str) -> str:
    return unescape(text) if "&" in text else text


def folded(node: Node, order: dict[int, list[Node]] | None = None) -> list:
    """The aligned form: [label, children, text hash]; neighbours of one label count as one node.

    order: gets the page nodes each folded node stands for.
    """
    nodes, below = [node], []
    for node in nodes:  # grows meanwhile
        inner = [c for c in node.children if c.tag in BLOCKS and c.tag != "br" or c.tag in UNSEEN]
        below.append((len(nodes), len(nodes) + len(inner)))
        nodes += inner
    made: list = [None] * len(nodes)
    for at in range(len(nodes) - 1, -1, -1):  # children come after their parents
        children: list = []
        for k in range(*below[at]):
            child = made[k]
            if children and children[-1][0] == child[0]:
                same = children[-1]
                if child[2] or same[2]:
                    same[2] = zlib.crc32(str(child[2]).encode(), same[2])
                same[1] = same[1] or child[1]
                if order is not None:
                    order[id(same)].append(nodes[k])
                continue
            children.append(child)
        own = "".join(" ".join(_strings(nodes[at])).split())
        made[at] = [nodes[at].label, children, zlib.crc32(own.encode("utf-8", "replace"))]
        if order is not None:
            order[id(made[at])] = [nodes[at]]
    return made[0]


def _strings(node: Node) -> Iterator[str]:
    open_ = [iter(node.text)]
    while open_:
        for part in open_[-1]:
            if isinstance(part, str):
                yield part
            elif part.tag not in BLOCKS and part.tag not in UNSEEN:
                open_.append(iter(part.text))
                break
        else:
            open_.pop()


def match(a: list, b: list, memo: dict | None = None) -> int:
    """Simple tree matching: nodes of the largest order-keeping match of two trees, roots matched."""
    if a[0] != b[0]:
        return 0
    if not a[1] or not b[1]:
        return 1
    memo = {} if memo is None else memo
    todo, begun = [(a, b)], set()
    while todo:
        x, y = todo[-1]
        key = id(x), id(y)
        if key in memo:
            todo.pop()
        elif key not in begun:  # children first
            begun.add(key)
            todo += [(u, v) for u in x[1] if u[1] for v in y[1] if v[1] and u[0] == v[0] and (id(u), id(v)) not in memo]
        else:
            todo.pop()
            memo[key] = _table(x[1], y[1], memo)[-1][-1] + 1
    return memo[id(a), id(b)]


def _table(a: list[list], b: list[list], memo: dict) -> list[list[int]]:
    """Matched nodes below the first i of a and the first j of b."""
    table = [[0] * (len(b) + 1)]
    for x in a:
        before, row = table[-1], [0]
        for j, y in enumerate(b):
            both = 0 if x[0] != y[0] else memo[id(x), id(y)] if x[1] and y[1] else 1
            row.append(max(row[-1], before[j + 1], before[j] + both))
        table.append(row)
    return table


def aligned(ref: list, page: list, memo: dict | None = None) -> Iterator[tuple[list, list]]:
    """(the reference's node, the page's node) of every matched pair."""
    memo = {} if memo is None else memo
    match(ref, page, memo)
    todo = [(ref, page)]
    while todo:
        ref, page = todo.pop()
        yield ref, page
        a, b = ref[1], page[1]
        if not a or not b:
            continue
        table = _table(a, b, memo)
        i, j = len(a), len(b)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                todo.append((a[i], b[j]))


def _hash(*parts) -> int:
    return int.from_bytes(hashlib.blake2b("\x01".join(map(str, parts)).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _seen(tree: list) -> list[list]:
    return [c for c in tree[1] if c[0].partition(".")[0] not in UNSEEN]


def layout(tree: list) -> int:
    """Pages with the same kinds of parts, below wrappers of the whole page, are of one layout."""
    while len(parts := _seen(tree)) == 1 and parts[0][1]:
        tree = parts[0]
    return _hash(*sorted({c[0] for c in parts}))


def keys(ref: list | None, page: list) -> Iterator[tuple[int, list]]:
    """(key, leaf) of what the page's leaves with text are: the reference's matched node, the place in any page, and the place in the page's layout."""
    if ref is not None:
        for theirs, own in aligned(ref, page):
            if own[2] and not own[1] and theirs is not ref:
                yield theirs[3], own
    kind = layout(page)
    todo = [(page, 0)]
    while todo:
        node, place = todo.pop()
        before: dict[str, int] = {}
        for child in _seen(node):
            before[child[0]] = nth = before.get(child[0], 0) + 1
            at = _hash(place, child[0], nth)
            if child[1]:
                todo.append((child, at))
            elif child[2]:
                yield at, child
                yield _hash(kind, at), child


def _blocks(root: Node, template: set[int], by_name: bool = True) -> list[str]:
    """The text of each block that is no boilerplate, in page order; by_name: classes and ids count."""
    found: list[str] = []
    parts: list[str] = []

    def close() -> None:
        text = " ".join("".join(parts).split())
        if text:
            found.append(text)
        parts.clear()

    open_ = [(iter(root.text), False)]
    while open_:
        for part in open_[-1][0]:
            if isinstance(part, str):
                parts.append(part)
                continue
            block = part.tag in BLOCKS
            if block:
                close()
            if not (part.dropped or by_name and part.named or id(part) in template):
                open_.append((iter(part.text), block))
                break
        else:
            if open_.pop()[1]:
                close()
    close()
    return found


def main_text(html: str | None, fixed: set[tuple[int, int]] | None = None, ref: list | None = None) -> str:
    """The page's text without template and boilerplate: blocks in page order, one space between them.

    fixed: (key, text hash) of what is template.
    """
    if not html:
        return ""
    root = parse(html)
    template: set[int] = set()
    if fixed:
        order: dict[int, list[Node]] = {}
        for key, leaf in keys(ref, folded(root, order)):
            if (key, leaf[2]) in fixed:
                template.update(id(n) for n in order[id(leaf)])
    # a page that is all template is read without it, and one with nothing else than named roles with these
    for skip, by_name in ((template, True), (set(), True), (template, False), (set(), False)):
        if blocks := _blocks(root, skip, by_name):
            return " ".join(blocks)
    return ""


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


_NUMBERS = re.compile("\x01[^\x02]*\x02")


def _pack(tree: list) -> str:
    out: list[str] = []
    todo: list = [tree]
    while todo:
        node = todo.pop()
        if node is None:
            out.append("\x03")
            continue
        out.append(f"{node[0]}\x01{node[2]}\x02")
        todo.append(None)
        todo += reversed(node[1])
    return "".join(out)


def _unpack(text: str) -> list:
    """The tree, its nodes numbered."""
    root: list = ["", [], 0, 0]
    stack, at, number = [root], 0, 0
    while at < len(text):
        if text[at] == "\x03":
            stack.pop()
            at += 1
            continue
        label, end = text.index("\x01", at), text.index("\x02", at)
        node = [text[at:label], [], int(text[label + 1 : end]), number]
        number += 1
        stack[-1][1].append(node)
        stack.append(node)
        at = end + 1
    return root[1][0]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of `pages` (page_id, url, html).

    Every page of a host is aligned with the host's reference, a page of the commonest tree shape
    (the largest of these) among pages with anything to align. What a node says is counted over
    all pages of the host, by the reference's node it matches, by its place in the page, and by its
    place among pages of its layout; so neither what the reference lacks nor a second layout goes
    uncounted. A text is template there when it is on TEMPLATE_SHARE of the pages that have the
    node, and on TEMPLATE_PAGES different pages at least (copies of one page count once); only
    nodes without further blocks are, and only where they say that text. Only references and counts
    meet by host; pages stay where they are read but for one join with their host's small wrapper.

    A null or empty page, and one of boilerplate elements only, has empty text; classes and ids
    do not count on a page with no other text; pages without a host share one; repeated rows are
    extracted each on their own; no rows give no rows.
    """
    rows = pages.select("page_id", "url", "html").withColumn("host", host(F.col("url")))
    shape_schema = "host string, digest long, tree string, shape long, nodes long"

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (tree := folded(parse(html or "")))[1]:  # others have nothing to align
                    packed = _pack(tree)
                    out.append((name, zlib.crc32(html.encode("utf-8", "replace")), packed, _hash(_NUMBERS.sub("", packed)), packed.count("\x03")))
            if out:
                yield textkit.batch(shape_schema, *(list(x) for x in zip(*out, strict=True)))

    trees = freeze(rows.select("host", "html").mapInArrow(shapes, shape_schema))
    different = trees.groupBy("host", "shape", "nodes", "digest").agg(F.min("tree").alias("tree"))
    common = different.groupBy("host", "shape", "nodes").agg(F.count("*").alias("n"), F.min("tree").alias("tree"))
    refs = freeze(common.groupBy("host").agg(F.max_by("tree", F.struct("n", "nodes", "shape")).alias("ref")))
    count_schema = "host string, key long, said long, digest long"

    def said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for batch in batches:
            out = []
            for name, digest, tree, ref in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ref not in known:
                    known.clear()
                    known[ref] = _unpack(ref)
                out += [(name, key, leaf[2], digest) for key, leaf in keys(known[ref], _unpack(tree))]
            if out:
                yield textkit.batch(count_schema, *(list(x) for x in zip(*out, strict=True)))

    paired = trees.join(refs, "host").select("host", "digest", "tree", "ref")
    # a page's copies are one page
    told = paired.mapInArrow(said, count_schema).distinct().groupBy("host", "key", "said").agg(F.count("*").alias("pages"))
    shares = told.groupBy("host", "key").agg(F.max(F.struct("pages", "said")).alias("most"), F.sum("pages").alias("all_pages"))
    fixed = shares.where((F.col("most.pages") >= TEMPLATE_PAGES) & (F.col("most.pages") >= TEMPLATE_SHARE * F.col("all_pages")))
    named = fixed.groupBy("host").agg(F.collect_set(F.struct("key", "most.said")).alias("fixed"))
    wrappers = freeze(refs.join(named, "host").select("host", "ref", "fixed"))
    schema = "page_id long, url string, text string, n_chars long"

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in batches:
            ids, urls, htmls = (c.to_pylist() for c in batch.columns[:3])
            out = []
            for html, ref, pairs in zip(htmls, *batch.columns[3:], strict=True):
                if (name := ref.as_py()) is None:
                    out.append(main_text(html))
                    continue
                if name not in known:
                    known.clear()
                    known[name] = _unpack(name), {(x["key"], x["said"]) for x in pairs.as_py()}
                ref, fixed = known[name]
                out.append(main_text(html, fixed, ref))
            yield textkit.batch(schema, ids, urls, out, [len(x) for x in out])

    return rows.join(wrappers, "host", "left").select("page_id", "url", "html", "ref", "fixed").mapInArrow(texts, schema)
