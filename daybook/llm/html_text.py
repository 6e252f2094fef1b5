"""HTML extraction (7): a site style tree.

The DOMs of the pages of one host are merged: nodes with the same path of tags
and classes are one node of the host's tree. A node's presentation is the
sequence of its children; its content is the text below it. Over the distinct
pages of the host that have the node, both have an entropy, divided by the log
of the number of pages: 0 where every page shows the same, 1 where all differ.
A node's importance is the larger of the two, ``H``, drawn towards 1 as long as
there is little evidence: ``(H m + k) / (m + k)`` over ``m`` pages, with
``k = STRENGTH / (max(8, bytes) (1 - share)^2)``. So a long text that repeats
tells more than a short one, and the larger the ``share`` of the pages' text
that is at stake, the more pages have to agree: near copies of one page do not
lose what they say. This holds for hosts of any number of pages; on a single
page every importance is 1. Marked branches (menus, headers, footers, forms,
...) have importance 0, marked articles 1; branches below the threshold are
removed from each page, and where a page has a marked article, what stands
outside it is removed as well.

Each page is parsed once: its nodes and its text blocks are stored, and the
branches that the host's tree removes are dropped from the stored blocks.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.tables import broadcast_if_small, stored
from daybook.llm.words import row_slices

#: Importance under which a branch is removed, and the weight of the doubt in it.
THRESHOLD = 0.25
STRENGTH = 20.0

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var".split()
)
_RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe"}
_REMOVED_TAGS = frozenset(
    "head script style noscript template nav aside form button select option textarea input iframe object embed svg canvas audio video dialog menu map applet noembed noframes title".split()
)
_REMOVED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
_REMOVED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot banner banners promo promos promotion sponsor sponsored sponsors nav navbar navigation navi "
    "menu menus submenu breadcrumb breadcrumbs footer footers sidebar sidebars aside rail widget widgets cookie cookies consent gdpr notice notices notification notifications alert "
    "popup popups modal overlay lightbox newsletter subscribe subscription signup signin login register share sharing social related recommended recommendations "
    "comment comments commentlist disqus respond reply replies discussion reactions pagination pager toolbar skip skiplink search searchbox masthead topbar".split()
)
_HEADER_NAMES = frozenset(("header", "headers"))
_ARTICLE_NAMES = frozenset(
    "articlebody articletext articlecontent postbody postcontent posttext entrycontent entrytext storybody storytext maincontent pagecontent blogpost".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li".split()
)
_CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "thead": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}, "option": {"select"}}
_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*'|["'])*)(?:>|\Z)|[^<]+|<""", re.S)
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


class Node:
    __slots__ = ("tag", "sig", "prior", "items", "links")

    def __init__(self, tag: str, sig: str, prior: int | None):
        self.tag, self.sig, self.prior = tag, sig, prior
        self.items: list = []  # text pieces and nodes, in page order
        self.links = 0  # characters of direct text that stand in a link


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): html.unescape((v or "").strip("\"'")) for k, v in _ATTR.findall(raw)} if raw.strip(" /\n\t") else {}


def _names(attrs: dict[str, str]) -> list[str]:
    text = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", f"{attrs.get('class', '')} {attrs.get('id', '')}")
    return [x.lower() for x in text.split()]


def node_prior(tag: str, attrs: dict[str, str], inside_article: bool) -> int | None:
    """0 for marked chrome, 1 for a marked article, None where nothing is said."""
    if tag in ("html", "body"):
        return None
    if tag in _REMOVED_TAGS or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return 0
    role = attrs.get("role", "").lower()
    if role in _REMOVED_ROLES:
        return 0
    names = _names(attrs)
    parts = {p for x in names for p in re.split(r"[-_:\d]+", x)}
    if parts & _REMOVED_NAMES:
        return 0
    if tag == "footer" or not inside_article and (tag == "header" or parts & _HEADER_NAMES):
        return 0
    if tag in ("article", "main") or role in ("main", "article") or any(re.sub(r"[-_]", "", x) in _ARTICLE_NAMES for x in names):
        return 1
    return None


def parse(page: str | None) -> Node:
    """A tolerant DOM of the blocks of a page; formatting tags leave no node, unless they are marked as chrome."""
    root = Node("#", "#", None)
    stack, articles, link = [root], 0, 0
    open_: dict[str, list[int]] = {}  # where the open elements of a tag are in the stack
    page = page or ""
    at, end = 0, len(page)

    def pop_to(k: int) -> None:
        nonlocal articles
        for node in stack[k:]:
            articles -= node.prior == 1
            open_[node.tag].pop()
        del stack[k:]

    def add(text: str) -> None:
        stack[-1].items.append(text)
        if link:
            stack[-1].links += len(text.strip())

    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        text = m.group(0)
        if m.group(2) is None:
            if text[0] != "<" or text == "<":
                add(html.unescape(text))
            elif text.startswith("<![CDATA["):
                add(text[9:-3] if text.endswith("]]>") else text[9:])
            continue
        tag = m.group(2).lower()
        if m.group(1):
            if tag == "a":
                link = 0
            if open_.get(tag):
                pop_to(open_[tag][-1])
            elif tag in ("br", "p") and tag not in _INLINE:
                add(" ")
            continue
        attrs = _attributes(m.group(3))
        if tag in _RAW and not m.group(3).endswith("/"):
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag in _VOID:
            if tag in ("br", "hr"):
                add(" ")
            continue
        prior = node_prior(tag, attrs, articles > 0)
        if tag in _INLINE and prior is None:
            link = 1 if tag == "a" else link
            continue
        if tag in _CLOSES_P or tag == "table":
            k = len(stack) - 1
            if stack[k].tag == "p":
                pop_to(k)
        if tag in _CLOSED_BY:
            scope = max((open_[t][-1] for t in _SCOPE[tag] if open_.get(t)), default=0)
            closed = [held[bisect_right(held, scope)] for t in _CLOSED_BY[tag] if (held := open_.get(t)) and held[-1] > scope]
            if closed:
                pop_to(min(closed))
        if m.group(3).rstrip().endswith("/") and tag not in _CLOSES_P:
            continue
        names = _names(attrs)
        sig = tag + ("." + re.sub(r"\d+", "0", names[0]) if names else "")
        node = Node(tag, sig, prior)
        stack[-1].items.append(node)
        open_.setdefault(tag, []).append(len(stack))
        stack.append(node)
        articles += prior == 1
    return root


def _bottom_up(root: Node) -> list[Node]:
    """All nodes, those below before those above; an explicit stack, since pages may nest deeply."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [x for x in node.items if not isinstance(x, str)]
    return out[::-1]


def _menus(root: Node) -> set[int]:
    """``id`` of the lists whose text nearly all stands in links."""
    sums: dict[int, tuple[int, int]] = {}
    menus = set()
    for node in _bottom_up(root):
        links, chars = node.links, 0
        for item in node.items:
            if isinstance(item, str):
                chars += len(item.strip())
            else:
                more = sums.pop(id(item))
                links, chars = links + more[0], chars + more[1]
        sums[id(node)] = links, chars
        if node.tag in ("ul", "ol") and chars > 0 and links > 0.8 * chars:
            menus.add(id(node))
    return menus


def _digest(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


#: Texts are compared by their bytes as a number modulo this prime, which adds up over the nodes below.
_PRIME = (1 << 128) - 159


def node_features(page: str | None) -> list[tuple[int, int, int, int]]:
    """``(path, presentation, content)`` digests of the unmarked nodes of a page, merged by path, and the bytes of their text."""
    return _features(parse(page))[0]


def _features(root: Node) -> tuple[list[tuple[int, int, int, int]], int]:
    """The node features below ``root``, and the bytes of all unmarked text."""
    nodes: list[tuple[Node, int]] = []  # as they open
    todo = [(root, 0)]
    while todo:
        node, path = todo.pop()
        nodes.append((node, path))
        todo += [(x, _digest(str(path), x.sig)) for x in reversed(node.items) if not isinstance(x, str) and x.prior != 0]
    texts: dict[int, tuple[int, int]] = {}  # of a node: its text modulo the prime, and its length
    ended: list[tuple[int, str, str, int]] = []
    for node, path in reversed(nodes):
        number, size, styles = 0, 0, []
        for item in node.items:
            if isinstance(item, str):
                if not (item := " ".join(item.split())):
                    continue
                data = (item + " ").encode("utf-8", "surrogatepass")
                more, length = int.from_bytes(data, "big") % _PRIME, len(data)
                styles.append("#text")
            elif item.prior != 0:
                more, length = texts.pop(id(item))
                styles.append(item.sig)
            else:
                continue
            number, size = (number * pow(256, length, _PRIME) + more) % _PRIME, size + length
        texts[id(node)] = number, size
        if node.tag not in ("#", "html", "body") and node.prior is None:
            style = ">".join(s for i, s in enumerate(styles) if i == 0 or s != styles[i - 1] or s == "#text")
            ended.append((path, style, f"{size}:{number}", size))
    found: dict[int, list[list]] = {}
    for path, *values in reversed(ended):
        for held, value in zip(found.setdefault(path, [[], [], []]), values, strict=True):
            held.append(value)
    return [(path, _digest(*s), _digest(*t), sum(n)) for path, (s, t, n) in found.items()], texts[id(root)][1]


def main_text(page: str | None, removed: frozenset[int] | set[int] = frozenset()) -> str:
    """Text of the blocks that stay, joined by line breaks."""
    return kept_text(*page_blocks(parse(page)), removed)


def page_blocks(root: Node) -> tuple[list[int], list[int | None], list[int], list[str]]:
    """The text blocks of a page that no mark removes, in page order, and the nodes around them.

    ``(parent of each node, its path, node of each block, text of each block)``; parents come before their
    children, the root is node 0, and the path of a node that the tree cannot remove is None.
    """
    menus = _menus(root)
    todo, has_article = [root], False
    while todo:
        node = todo.pop()
        has_article |= node.prior == 1
        todo += [x for x in node.items if not isinstance(x, str) and x.prior != 0]
    parents, paths, owners, blocks = [0], [None], [], []
    held: list[str] = []

    def flush(number: int) -> None:
        if text := " ".join("".join(held).split()):
            owners.append(number)
            blocks.append(text)
        held.clear()

    # (node, its number and path, whether its own text counts, next item): an explicit stack, since pages may nest deeply
    work: list[list] = [[root, 0, 0, not has_article, 0]]
    while work:
        node, number, path, inside, i = work[-1]
        if i == len(node.items):
            flush(number)
            work.pop()
            continue
        work[-1][4] += 1
        item = node.items[i]
        if isinstance(item, str):
            if inside:
                held.append(item)
            continue
        if item.prior == 0 and item.tag in _INLINE:
            continue
        flush(number)
        if item.prior == 0 or not (inside and has_article) and id(item) in menus:
            continue
        below = _digest(str(path), item.sig)
        parents.append(number)
        paths.append(None if item.prior == 1 else below)
        work.append([item, len(parents) - 1, below, inside or item.prior == 1, 0])
    return parents, paths, owners, blocks


def kept_text(parents: list[int], paths: list[int | None], owners: list[int], blocks: list[str], removed) -> str:
    """The blocks outside the branches whose paths are ``removed``, joined by line breaks."""
    if not removed:
        return "\n".join(blocks)
    gone = [False] * len(parents)
    for i in range(1, len(parents)):
        gone[i] = gone[parents[i]] or paths[i] in removed
    return "\n".join(x for k, x in zip(owners, blocks, strict=True) if not gone[k])


_PARSED_NAMES = ("page", "total", "features", "parents", "paths", "owners", "blocks")
_PARSED = "page long, total long, features array<struct<path: long, style: long, content: long, size: long>>, parents array<int>, paths array<long>, owners array<int>, blocks array<string>"


def parsed_pages(pages: DataFrame, url_col: str = "url", html_col: str = "html", *more: str) -> DataFrame:
    """``(host, *more, page, total, features, parents, paths, owners, blocks)`` per row: what one parse gives.

    ``page`` is a digest of the node features: rows that agree in them are one page of the tree.
    """
    rows = pages.select(host_of(F.col(url_col)).alias("host"), *more, F.col(html_col).alias("html"))
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]

    def parse_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feature = pa.struct([(x, pa.int64()) for x in ("path", "style", "content", "size")])
        types = [pa.int64(), pa.int64(), pa.list_(feature), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string())]
        for batch in batches:
            for part in row_slices(batch, batch.num_columns - 1):
                out = []
                for html_ in part.column(part.num_columns - 1).to_pylist():
                    root = parse(html_)
                    features, total = _features(root)
                    out.append((_digest(*map(str, sum(features, ()))), total, [dict(zip(("path", "style", "content", "size"), x, strict=True)) for x in features], *page_blocks(root)))
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                names = [*(x.split()[0] for x in kept), *_PARSED_NAMES]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], names=names)

    return rows.mapInArrow(parse_all, ", ".join((*kept, _PARSED)))


def tree_of(nodes: DataFrame) -> DataFrame:
    """:func:`style_tree` of ``(host, page, total, path, style, content, size)``, one row per distinct page and path."""

    def entropy(column: str) -> DataFrame:
        # Counts first: whatever many pages share is one row before it meets its host.
        counts = nodes.groupBy("host", "path", column).agg(F.count("*").alias("c"), F.max("size").alias("size"), F.sum("size").alias("bytes"), F.sum("total").alias("all"))
        sums = counts.groupBy("host", "path").agg(
            F.sum("c").alias("pages"), F.sum(F.col("c") * F.log2("c")).alias("s"), F.max("size").alias("size"), (F.sum("bytes") / F.sum("all")).alias("share")
        )
        bits = F.log2("pages") - F.col("s") / F.col("pages")
        return sums.select("host", "path", "pages", "size", "share", F.when(F.col("pages") > 1, bits / F.log2("pages")).otherwise(1.0).alias(column))

    both = entropy("style").drop("pages", "size", "share").join(entropy("content"), ["host", "path"])
    both = both.withColumn("importance", F.greatest("style", "content"))
    doubt = evidence(F.col("size"), F.col("share"))
    judged = (F.col("importance") * F.col("pages") + doubt) / (F.col("pages") + doubt)
    return both.select("host", "path", "pages", "size", "share", "importance", judged.alias("judged"))


def evidence(size, share):
    """The weight ``k`` of the doubt: less for long texts, more where much of a page is at stake."""
    left = F.greatest(F.lit(1.0) - F.coalesce(share, F.lit(0.0)), F.lit(1e-3))
    return F.lit(STRENGTH) / (F.greatest(F.lit(8), size) * left * left)


def page_nodes(parsed: DataFrame) -> DataFrame:
    """``(host, page, total, path, style, content, size)`` of the distinct pages: copies of a page are one."""
    nodes = parsed.select("host", "page", "total", F.explode("features").alias("f"))
    return nodes.select("host", "page", "total", "f.*").distinct()


def style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, path, pages, size, share, importance, judged)`` of every unmarked node of every host's tree.

    ``importance`` is the larger entropy, ``judged`` the same drawn towards 1 by the doubt. ``size``: the bytes of its longest text; ``share``: its part of all unmarked text of the pages that have it.
    """
    return tree_of(stored(page_nodes(parsed_pages(pages, url_col, html_col)), "nodes"))


def host_of(url) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", threshold: float = THRESHOLD,
) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages``.

    A null or empty html has the empty text; a url without a host belongs to the host ''; equal rows all come back.
    The removed paths of a host meet its pages as rows, so what a row holds is bounded by the page itself.
    """
    types = pages.schema
    named = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    parsed = stored(parsed_pages(named, "url", "html", "page_id", "url"), "parsed")
    nodes = stored(page_nodes(parsed), "nodes")
    low = stored(tree_of(nodes).where(F.col("judged") < threshold).select("host", "path"), "low")
    removed = nodes.join(broadcast_if_small(low, size=F.length("host") + 24), ["host", "path"]).groupBy("host", "page").agg(F.collect_list("path").alias("removed"))
    removed = stored(removed, "removed")
    rows = parsed.join(broadcast_if_small(removed, size=F.length("host") + 8 * F.size("removed") + 48), ["host", "page"], "left")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                out = [kept_text(*x, set(gone or ())) for *x, gone in zip(*(part.column(k).to_pylist() for k in range(2, 7)), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = rows.select("page_id", "url", "parents", "paths", "owners", "blocks", "removed")
    return rows.mapInArrow(texts, f"page_id {types[id_col].dataType.simpleString()}, url {types[url_col].dataType.simpleString()}, text string, n_chars long")
