"""Main text of web pages by wrapper induction.

The block elements of a page form a tree in which siblings of one label are folded into one repeating
node. Every host gets a reference tree, the commonest one among its pages, and the trees of all its
pages are aligned with it by simple tree matching. Text that stands in the same node on most pages is
template, text that varies is content. An ``article`` or ``main`` element decides only on text that the
template leaves open. Elements whose tag, role or class names them as navigation, advert, form and the
like are never content; a class does so only if all its parts are such names or say nothing, and ids,
which are often made from headings, only outside articles and not on headings and paragraphs.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.plans.staging import staged

#: Text is template if it stands in a node on this share of the pages that have the node, and the
#: host has at least so many such pages of different text.
TEMPLATE_SHARE = 0.8
LEAST_PAGES = 5
#: Deeper elements belong to their ancestor at this depth; wider nodes tell children by tag alone.
MAX_DEPTH = 64
MAX_LABELS = 64

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "xmp", "noembed", "noframes"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol "
    "optgroup option p pre search section select summary svg table tbody td tfoot th thead tr ul".split()
)
_CLOSES_P = _BLOCKS - set("button label option optgroup select svg caption legend tbody td tfoot th thead tr".split())
# What a start tag ends if it is open, and the elements that this does not reach beyond.
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
_P_LIMIT = {"td", "th", "table", "button", "caption", "html", "body"}
_NEVER = set("aside button dialog footer form head menu nav option search select svg".split())
_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
_NAMES = set(
    "ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disclaimer discussion disqus footer gdpr hidden masthead menu modal nav navbar navigation "
    "newsletter notice notices pager pagination popup promo promoted promotion recommended related replies reply "
    "respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar tooltip widget widgets".split()
)
# Parts of a class name that say nothing about what an element holds.
_NEUTRAL = set(
    "area articles bar block bottom box button buttons center column container content footer global group header "
    "icons inner item items left link links list main mobile module outer page panel post posts primary region right "
    "row secondary section site slot sticky stories the top wrap wrapper".split()
)
_HEADER = {"header", "topbar"}
#: Elements that are text themselves. Inside an article no class rules them out, and an id never does.
_TEXTUAL = set("blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
_ARTICLE = {"article", "main"}


class Node:
    """A block element with one child per label."""

    __slots__ = ("label", "children", "number")

    def __init__(self, label: str):
        self.label = label
        self.children: dict[str, Node] = {}
        self.number = -1

    def child(self, tag: str, label: str) -> Node:
        label = label if len(self.children) < MAX_LABELS else tag
        if label not in self.children:
            self.children[label] = Node(label)
        return self.children[label]


def _named(word: str, names: set[str]) -> bool:
    """Whether ``word`` (as ``share-buttons``) is made of ``names`` and parts that say nothing."""
    parts = [p for p in re.split(r"[-_]+", word) if p and not re.fullmatch(r"[0-9]+(x[0-9]+)?", p)]
    return any(p in names for p in parts) and all(p in names or p in _NEUTRAL for p in parts)


def _attributes(source: str, tag: str, inside: bool) -> tuple[str, bool]:
    """Label suffix of an element, and whether its attributes rule it out as content."""
    classes: list[str] = []
    ids: list[str] = []
    out = False
    for name, a, b, c in _ATTRIBUTE.findall(source):
        name, value = name.lower(), (a or b or c).lower()
        if name == "class":
            classes += value.split()
        elif name == "id":
            ids += value.split()
        elif name == "role":
            out = out or value.strip() in _ROLES
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            out = True
        elif name == "style":
            out = out or "display:none" in value.replace(" ", "")
    label = classes or ids
    suffix = "." + re.sub(r"[^\w-]", "", label[0]) if label else ""
    textual = tag in _TEXTUAL
    judged = ([] if textual and inside else classes) + ([] if textual or inside else ids)
    out = out or any(_named(word, _NAMES) for word in judged)
    parts = {part for word in judged if _named(word, _HEADER) for part in re.split(r"[-_]", word)}
    if parts and not parts & {"content", "post"}:
        suffix += "^"  # a page header unless it stands in an article
    return suffix, out


def parse(source: str) -> tuple[Node, list[tuple[Node, str, bool]]]:
    """Block tree of a page, and its text blocks in page order: node, text, whether inside an article.

    End tags may be missing or stray, as in ordinary pages. Text that can never be content is not
    among the blocks.
    """
    root = Node("")
    blocks: list[tuple[Node, str, bool]] = []
    # Open elements: tag, node, inside something that is never content, inside an article.
    stack: list[tuple[str, Node, bool, bool]] = [("", root, False, False)]
    text: list[str] = []

    def flush() -> None:
        if text:
            joined = "".join(text)
            if "&" in joined:
                joined = entities.unescape(joined)
            clean = " ".join(joined.split())
            if clean:
                _, node, out, inside = stack[-1]
                if not out:
                    blocks.append((node, clean, inside))
            text.clear()

    def close(tags: set[str], limit: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in limit:
                return

    at = 0
    find = _TAG.search
    while match := find(source, at):
        if match.start() > at:
            text.append(source[at : match.start()])
        at = match.end()
        tag = match.group(2) or match.group(5)
        if tag is None:  # a comment or declaration
            continue
        tag = tag.lower()
        if match.group(1) or match.group(4):
            if tag in _BLOCKS:
                flush()
                close({tag}, _P_LIMIT - {tag} if tag == "p" else set())
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
            at = end.end() if end else len(source)
            text.append(" ")
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag not in _BLOCKS:
            continue
        flush()
        if tag in _VOID:
            continue
        if tag in _CLOSES_P:
            close({"p"}, _P_LIMIT)
        if tag in _IMPLIED:
            close(*_IMPLIED[tag])
        attributes = match.group(3) or match.group(6) or ""
        _, parent, parent_out, inside = stack[-1]
        stated = "=" in attributes or "hidden" in attributes
        suffix, out = _attributes(attributes, tag, inside) if stated else ("", False)
        out = out and tag not in ("html", "body")
        header = tag == "header" or suffix.endswith("^")
        out = parent_out or out or tag in _NEVER or (header and not inside)
        node = parent.child(tag, tag + suffix.rstrip("^")) if len(stack) <= MAX_DEPTH else parent
        stack.append((tag, node, out, inside or (tag in _ARTICLE and not out)))
    text.append(source[at:])
    flush()
    return root, blocks


def shape_of(root: Node) -> str:
    """The tree as text, ``label(child child)``; numbers the nodes in the same order."""
    counter = 0

    def write(node: Node) -> str:
        nonlocal counter
        node.number = counter
        counter += 1
        inner = " ".join(write(c) for c in node.children.values())
        return f"{node.label}({inner})" if inner else node.label

    return write(root)


@lru_cache(maxsize=512)
def read_shape(shape: str) -> Node:
    root = Node("")
    stack = [root]
    last = root
    for token in re.findall(r"[()]|[^() ]+", shape):
        if token == "(":
            stack.append(last)
        elif token == ")":
            stack.pop()
        else:
            last = stack[-1].child(token, token)
    inner = Node("")
    inner.children = root.children
    shape_of(inner)
    return inner


@lru_cache(maxsize=4096)
def align(shape: str, reference: str) -> dict[int, int]:
    """Node numbers of ``shape`` to those of ``reference`` by simple tree matching.

    The largest match of two trees with equal roots is one more than the best order-preserving match
    of their child lists, where a pair of children counts its own largest match.
    """

    def match(a: Node, b: Node) -> list[tuple[int, int]]:
        left, right = list(a.children.values()), list(b.children.values())
        width = len(right) + 1
        best: list[list[tuple[int, int]]] = [[] for _ in range(width)]
        for one in left:
            above, best = best, [[]]
            for j, other in enumerate(right, 1):
                option = max(above[j], best[j - 1], key=len)
                if one.label == other.label:
                    found = above[j - 1] + match(one, other)
                    option = found if len(found) > len(option) else option
                best.append(option)
        return [(a.number, b.number), *best[-1]]

    return dict(match(read_shape(shape), read_shape(reference)))


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def located(source: str, reference: str | None) -> tuple[list[str], list[int], list[bool]]:
    """Text blocks of a page, the node of the reference tree that each stands in, or -1, and whether in an article."""
    root, blocks = parse(source)
    shape = shape_of(root)
    to = align(shape, reference) if reference is not None else {}
    places = [to.get(node.number, -1) for node, _, _ in blocks]
    return [text for _, text, _ in blocks], places, [inside for _, _, inside in blocks]


def content(
    texts: list[str], places: list[int], inside: list[bool], template: set[tuple[int, int]], judged: set[int]
) -> list[str]:
    """The blocks that are content: all that are not template, but for a tie that an article breaks.

    The template decides on blocks in the nodes that it has ``judged``. Blocks in other nodes are left
    out if they stand outside an article and the article text of the page is at least as long as they are.
    """
    found = [
        (text, place in judged, within)
        for text, place, within in zip(texts, places, inside, strict=True)
        if not template or place < 0 or (place, text_hash(text)) not in template
    ]
    article = sum(len(text) for text, _, within in found if within)
    rest = sum(len(text) for text, known, within in found if not known and not within)
    return [text for text, known, within in found if known or within or rest > article]


def host(url: Column) -> Column:
    """Host of a URL in lower case, without user and port; null if there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def references(pages: DataFrame) -> DataFrame:
    """``host, shape``: the commonest tree among the pages of each host."""

    def run(batches):
        for batch in batches:
            shapes = [shape_of(parse(h.as_py() or "")[0]) for h in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shapes, pa.string())], names=["host", "shape"])

    known = pages.where("host is not null").select("host", "html")
    counted = known.mapInArrow(run, "host string, shape string").groupBy("host", "shape").count()
    commonest = counted.groupBy("host").agg(F.max(F.struct("count", "shape")).alias("top"))
    return commonest.select("host", F.col("top.shape").alias("shape"))


def wrappers(pages: DataFrame, shapes: DataFrame) -> DataFrame:
    """``host, shape, nodes, texts, judged``: reference tree and its template, as nodes and text hashes.

    ``judged`` are the nodes that enough pages have for the template to tell. Pages of equal text count
    as one, so that an article copied over and over is not template.
    """

    def run(batches):
        for batch in batches:
            contents, entries = [], []
            for source, shape in zip(batch.column(1), batch.column(2), strict=True):
                texts, nodes, _ = located(source.as_py() or "", shape.as_py())
                hashes = [text_hash(t) for t in texts]
                contents.append(xxhash.xxh3_64_intdigest(str(hashes)) - (1 << 63))
                placed = {(n, h) for n, h in zip(nodes, hashes, strict=True) if n >= 0}
                placed |= {(n, None) for n, _ in placed}
                entries.append([{"node": n, "text": h} for n, h in placed])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(contents, pa.int64()),
                    pa.array(entries, pa.list_(pa.struct([("node", pa.int32()), ("text", pa.int64())]))),
                ],
                names=["host", "content", "entries"],
            )

    joined = pages.join(shapes, "host").select("host", "html", "shape")
    schema = "host string, content bigint, entries array<struct<node: int, text: bigint>>"
    entries = joined.mapInArrow(run, schema).select("host", "content", F.explode("entries").alias("e"))
    different = entries.select("host", "content", "e.node", "e.text").dropDuplicates()
    counts = staged(different.groupBy("host", "node", "text").count().where(F.col("count") >= LEAST_PAGES))
    # A host's counts of one node: the row without text counts the pages that have the node.
    totals = counts.where("text is null").select("host", "node", F.col("count").alias("pages"))
    template = (
        counts.where("text is not null")
        .join(totals, ["host", "node"])
        .where(F.col("count") >= TEMPLATE_SHARE * F.col("pages"))
    )
    listed = template.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("node", "text"))).alias("t"))
    judged = totals.groupBy("host").agg(F.sort_array(F.collect_list("node")).alias("judged"))
    return shapes.join(listed, "host", "left").join(judged, "host", "left").select(
        "host", "shape", F.col("t.node").alias("nodes"), F.col("t.text").alias("texts"), "judged"
    )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text, n_chars`` of every row: its main text, blocks joined by an empty line.

    Wrappers are small next to the pages. They are written to the shared folder and joined by host,
    and Spark broadcasts them if the table is under its threshold; otherwise it shuffles by host and
    splits hosts that are too large.

    Null html counts as empty and gives an empty text. A null or odd URL has no host, so no wrapper;
    the other rules hold. Repeated rows are extracted one by one. An empty table gives an empty
    result. ``article`` and ``main`` elements only break ties, see ``content``.
    """
    kept = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        host(F.col(f"`{url_col}`")).alias("host"),
        F.col(f"`{html_col}`").alias("html"),
    )
    induced = staged(wrappers(kept, staged(references(kept))))
    joined = kept.join(induced, "host", "left").select("page_id", "url", "html", "shape", "nodes", "texts", "judged")
    schema = T.StructType(
        [*joined.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches):
        for batch in batches:
            found = []
            for source, shape, nodes, texts, judged in zip(*batch.columns[2:], strict=True):
                template = set(zip(nodes.as_py() or (), texts.as_py() or (), strict=True))
                blocks = content(*located(source.as_py() or "", shape.as_py()), template, set(judged.as_py() or ()))
                found.append("\n\n".join(blocks))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                names=schema.names,
            )

    return joined.mapInArrow(run, schema).select(
        F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars"
    )
