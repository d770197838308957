"""Operator 10, main text of pages by removal of site templates.

A page is read into a tree. Elements that are never the article (navigation, headers and
footers of the page, asides, forms, scripts, styles, adverts, notices, comments: by tag,
role, and words of class and id) are cut off. Every other element that holds text is
hashed with all below it, and Spark counts for each host on how many different pages a
subtree occurs. Containers that recur on many pages of their host are its template and are
deleted; in pages without ``article`` or ``main`` so are paragraphs.

Blocks without blocks in them (paragraphs, items, headings), in articles too, are template
on evidence of the corpus, whatever their share of the host, as texts also quote each other:

* a template has its place: in ``SAME_PLACE`` of its pages the block is the same one from
  the beginning or the end. At random that has a chance of 1 in the number of blocks for
  each page; all pages but one together must give ``PLACE_BITS`` bits against chance;
* it belongs to its host: it stands on no other one, or on half of the host's pages, or so
  much more often than on other hosts' pages that chance (a Poisson number, by Chernoff's
  bound) gives ``HOST_BITS`` bits against it;
* only pages count most of whose text does not recur on their host: versions of one
  article share their paragraphs and their places, too. Where most of every article is
  template, its blocks are therefore kept.

Pages with equal trees count once, so copies of a page never make its text a template.
A host's counts are formed before the shuffle, a row for each subtree and task.

What is left of the article (or of the body, in pages without one) is given out block by
block: character references decoded, white space as one space, blocks joined by ``\\n``.

Defined results: null and empty pages have an empty text; tags that are not closed end
where their parent does or where the next such block begins; text of a page that is
nothing but template is empty; repeated rows get equal results; null urls are a host of
their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm.common import saved, slices, whole
from goldpan.llm.hosts import with_host_and_path

MIN_PAGES = 5
MIN_SHARE = 0.2
SAME_PLACE = 0.8
PLACE_BITS = 10.0
HOST_BITS = 20.0
MOST_PAGES = 0.5
_MAX_ROWS = 4096

# fixed values: element names of HTML by what they mean here
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW = frozenset("script style textarea title noscript template iframe svg math".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
    "nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CUT_TAGS = frozenset(
    "nav footer aside form button select option input label fieldset menu dialog head "
    "script style noscript template iframe svg math textarea title object embed canvas audio "
    "video map".split()
)
_CUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu "
    "menubar toolbar tablist".split()
)
_CUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo "
    "promotion promoted nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead "
    "topbar footer foot sidebar aside rail widget widgets related recommended recommendations "
    "share sharing social comment comments disqus respond reply replies cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "toolbar pagination pager copyright legal skip toc".split()
)
_MAIN_WORDS = frozenset("article main content post entry story".split())
_CLOSES = {
    "p": frozenset(["p"]),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
_SCOPES = frozenset("ul ol dl table article main section div body html td th blockquote".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)/?>",
    re.S,
)
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in _RAW}
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_WORDS = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "cut", "main", "children", "hash")

    def __init__(self, tag: str, cut: bool, main: bool):
        self.tag, self.cut, self.main, self.children = tag, cut, main, []


def _meaning(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is cut off, and whether it is named as the main part."""
    cut, main = tag in _CUT_TAGS, tag in ("article", "main")
    if attributes and tag not in ("html", "body"):
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name in ("hidden", "aria-hidden"):
                cut |= value != "false"
            elif name == "role":
                cut |= value in _CUT_ROLES
                main |= value == "main"
            elif not main:
                words = set(_WORDS.findall(value))
                cut |= bool(words & _CUT_WORDS) and not words & _MAIN_WORDS
                cut |= bool(words & {"comment", "comments", "sidebar", "related"})
    return cut, main


def parse(page: str) -> Node:
    """The tree of a page. Unknown and unclosed markup never raises."""
    root = Node("#root", False, False)
    stack, at, end = [root], 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        start = found.start() if found else end
        if start > at:
            stack[-1].children.append(page[at:start])
        if not found:
            break
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag in _RAW:
            close = _RAW_END[tag].search(page, at)
            at = close.end() if close else end
            continue
        if tag in _BLOCKS:
            _close(stack, "p" if tag not in _CLOSES else tag)
            if tag != "p" and tag in _CLOSES:
                _close(stack, "p")
        cut, main = _meaning(tag, found[3])
        # a page's own header is cut, a header inside the article holds its title
        if tag == "header":
            cut |= not any(node.main for node in stack)
        node = Node(tag, cut, main)
        stack[-1].children.append(node)
        if tag not in _VOID:
            stack.append(node)
    return root


def _close(stack: list[Node], tag: str) -> None:
    """Ends an open element that a new ``tag`` implies the end of, within its scope."""
    ends = _CLOSES.get(tag, frozenset([tag]))
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in ends:
            del stack[depth:]
            return
        if stack[depth].tag in _SCOPES:
            return


def _walk(root: Node):
    """Every node with the node above it, parents first; no recursion, trees may be deep."""
    todo = [(root, None)]
    while todo:
        node, above = todo.pop()
        yield node, above
        todo += [(c, node) for c in reversed(node.children) if isinstance(c, Node)]


def hash_tree(root: Node) -> None:
    """Gives every node the hash of its tag and of all below it, 0 without text."""
    for node, _ in reversed(list(_walk(root))):
        parts, texts = [node.tag], False
        for child in node.children:
            if isinstance(child, Node):
                parts.append(f"<{child.hash}>")
                texts |= child.hash != 0
            elif text := _SPACE.sub(" ", child).strip():
                parts.append(text)
                texts = True
        node.hash = xxhash.xxh3_64_intdigest("\0".join(parts)) or 1 if texts else 0


def _main_parts(root: Node) -> list[Node]:
    """The outermost article or main elements that are not cut, or the whole page."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.cut:
            continue
        if node.main:
            found.append(node)
            continue
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return found or [root]


def _chars(root: Node) -> int:
    texts = (c for node, _ in _walk(root) for c in node.children if isinstance(c, str))
    return sum(len(_SPACE.sub(" ", text).strip()) for text in texts)


def described(root: Node) -> dict[int, tuple[bool, int, int, int]]:
    """Subtrees that may be template, of a hashed tree, by hash: whether a container's share
    of the host is enough, place from the beginning and the end, and characters.

    Places are those among blocks without blocks in them, -1 for other subtrees. Of equal
    subtrees the first counts.
    """
    parts = _main_parts(root)
    inside = parts != [root]
    found, order = {}, []
    todo = [(p, True) for p in reversed(parts)]
    while todo:
        node, top = todo.pop()
        if node.cut:
            continue
        if node.hash and not top and node.tag in _BLOCKS:
            bottom = not any(isinstance(c, Node) and c.tag in _BLOCKS for c in node.children)
            container = not (inside and bottom) or node.tag in ("div", "section", "ul", "ol", "table")
            if bottom:
                order.append(node)
            if node.hash not in found:
                place = len(order) - 1 if bottom else -1
                found[node.hash] = (container, place, _chars(node) if bottom else 0)
        todo += [(c, False) for c in reversed(node.children) if isinstance(c, Node)]
    n = len(order)
    return {
        key: (container, place, n - 1 - place if place >= 0 else -1, chars)
        for key, (container, place, chars) in found.items()
    }


def candidates(root: Node) -> set[int]:
    """Hashes of subtrees that may be template, of a hashed tree."""
    return set(described(root))


def main_text(root: Node, template: frozenset[int] = frozenset()) -> str:
    """Blocks of the main parts without cut elements and template subtrees."""
    blocks: list[str] = []
    inline: list[str] = []

    def end_block() -> None:
        if inline:
            text = _SPACE.sub(" ", html.unescape("".join(inline))).strip()
            if text:
                blocks.append(text)
            inline.clear()

    allowed = candidates(root) & template if template else frozenset()
    todo: list = list(reversed(_main_parts(root)))
    while todo:
        item = todo.pop()
        if item is None:
            end_block()
        elif isinstance(item, str):
            inline.append(item)
        elif item.tag == "br":
            inline.append(" ")
        elif not item.cut and not (allowed and item.hash in allowed):
            if item.tag in _BLOCKS or item.tag == "#root":
                end_block()
                todo.append(None)
            todo += reversed(item.children)
    end_block()
    return "\n".join(blocks)


# --- jobs -----------------------------------------------------------------------


def _parts(batches):
    for batch in slices(batches, "html"):
        for first in range(0, batch.num_rows, _MAX_ROWS):
            yield batch.slice(first, _MAX_ROWS)


_SUBTREES = "array<struct<subtree:long,container:boolean,start:int,end:int,chars:int>>"


def template_hashes(
    spark: SparkSession, pages: DataFrame, min_pages: int = MIN_PAGES, share: float = MIN_SHARE
) -> DataFrame:
    """``host, subtree``: subtrees on at least ``min_pages`` different pages of their host,
    and containers on at least ``share`` of them or blocks with evidence of their place."""
    fields = [("subtree", pa.int64()), ("container", pa.bool_())]
    fields += [(name, pa.int32()) for name in ("start", "end", "chars")]
    kind = pa.list_(pa.struct(fields))

    def hashed(batches):
        for batch in _parts(batches):
            hosts, bodies, found = [], [], []
            for host, page in zip(batch["host"].to_pylist(), whole(batch, "html").to_pylist()):
                root = parse(page)
                hash_tree(root)
                main = "".join(f"<{part.hash}>" for part in _main_parts(root))
                hosts.append(host)
                bodies.append(_signed(xxhash.xxh3_64_intdigest(main)))
                found.append(
                    [
                        dict(subtree=_signed(key), container=c, start=a, end=b, chars=n)
                        for key, (c, a, b, n) in sorted(described(root).items())
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hosts, pa.string()),
                    pa.array(bodies, pa.int64()),
                    pa.array(found, kind),
                ],
                ["host", "body", "subtrees"],
            )

    read = pages.select("host", "html").mapInArrow(
        hashed, f"host string, body long, subtrees {_SUBTREES}"
    )
    # one row for each different page: copies have the same body and the same subtrees
    different = read.groupBy("host", "body").agg(F.any_value("subtrees").alias("subtrees"))
    different = saved(spark, different, "subtrees")
    sizes = different.groupBy("host").agg(F.count("*").alias("pages"))
    each = different.select(
        "host",
        "body",
        F.aggregate("subtrees", F.lit(0), lambda n, s: n + s["chars"]).alias("total"),
        F.explode("subtrees").alias("s"),
    ).select("host", "body", "total", "s.*")
    counts = each.groupBy("host", "subtree").agg(
        F.count("*").alias("n"), F.count_if("container").alias("containers"), F.max("start").alias("start")
    )
    counts = saved(spark, counts.filter(F.col("n") >= min_pages), "recurring")
    containers = counts.filter(F.col("containers") >= min_pages).join(sizes, "host")
    containers = containers.filter(F.col("containers") >= share * F.col("pages"))
    blocks = _blocks_in_place(spark, each.filter("start >= 0"), counts.filter("start >= 0"), sizes, min_pages)
    return containers.select("host", "subtree").unionByName(blocks).distinct()


def _blocks_in_place(
    spark: SparkSession, each: DataFrame, counts: DataFrame, sizes: DataFrame, min_pages: int
) -> DataFrame:
    """``host, subtree`` of recurring blocks that have their place and belong to their host."""
    recurring = counts.select("host", "subtree", F.col("n").alias("on_host"))
    hits = saved(spark, each.join(recurring, ["host", "subtree"]), "blocks")
    own = hits.groupBy("host", "body").agg(F.sum("chars").alias("shared"), F.first("total").alias("all"))
    own = own.filter(2 * F.col("shared") <= F.col("all")).select("host", "body")
    placed = hits.join(own, ["host", "body"]).withColumn(
        "bits", F.log2(F.col("start") + F.col("end") + 1)
    )
    # places from the beginning are 0, 1, ..., those from the end -1, -2, ...
    slots = placed.select(
        "host", "subtree", "on_host", "bits", F.explode(F.array("start", -1 - F.col("end"))).alias("slot")
    )
    slots = slots.groupBy("host", "subtree", "slot").agg(
        F.count("*").alias("n"), (F.sum("bits") - F.max("bits")).alias("bits"), F.first("on_host").alias("on_host")
    )
    # each occurrence has two slots
    best = slots.groupBy("host", "subtree").agg(
        F.max(F.struct("n", "bits")).alias("best"), (F.sum("n") / 2).alias("all"), F.first("on_host").alias("on_host")
    )
    best = best.filter(
        (F.col("best.n") >= min_pages)
        & (F.col("best.n") >= SAME_PLACE * F.col("all"))
        & (F.col("best.bits") >= PLACE_BITS)
    ).select("host", "subtree", "on_host")
    best = saved(spark, best, "places").join(sizes, "host")
    # summed before it is dealt out: a passage of very many pages is one row of each task
    everywhere = each.groupBy("subtree").agg(F.count("*").alias("everywhere"))
    overall = sizes.agg(F.sum("pages").alias("all_pages"))
    scored = best.join(everywhere, "subtree").crossJoin(overall)
    others = F.greatest(F.col("all_pages") - F.col("pages"), F.lit(1))
    expected = F.col("pages") * (F.col("everywhere") - F.col("on_host")) / others
    n = F.col("on_host")
    bits = (n * F.log(n / F.nullif(expected, F.lit(0.0))) - n + expected) / F.log(F.lit(2.0))
    local = (expected == 0) | ((n > expected) & (bits >= HOST_BITS))
    most = F.col("on_host") >= MOST_PAGES * F.col("pages")
    return scored.filter(local | most).select("host", "subtree")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def extract_text(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    located = with_host_and_path(pages.select("page_id", "url", "html")).drop("path")
    templates = template_hashes(spark, located, **options)
    # containers: at most 1 / share of each depth; blocks: pages / min_pages at each place
    listed = templates.groupBy("host").agg(F.collect_list("subtree").alias("template"))
    listed = saved(spark, listed, "templates")
    joined = located.join(listed, "host", "left").select("page_id", "url", "template", "html")
    kinds = [pages.schema[name].dataType.simpleString() for name in ("page_id", "url")]

    def extract(batches):
        for batch in _parts(batches):
            texts = []
            for page, template in zip(
                whole(batch, "html").to_pylist(), batch["template"].to_pylist()
            ):
                root = parse(page)
                if template:
                    hash_tree(root)
                    texts.append(main_text(root, frozenset(h % (1 << 64) for h in template)))
                else:
                    texts.append(main_text(root))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["page_id"],
                    batch["url"],
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    schema = f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long"
    return joined.mapInArrow(extract, schema)
