"""HTML extraction with a site style tree.

The DOMs of a host are merged by the path of tags and classes from the root.
Over the host's different pages, a node whose children and whose content are
always alike carries little; one that differs from page to page is the host's
reason to be.  The entropy of both, shrunk towards that of the same node on
all hosts and weighted by the role its tags and classes state, is its
importance; branches of low importance are cut from every page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlode.llm.common import fits, small_batches, spread_join
from textlode.llm.url_reputation import host_of
from textlode.sources.store import settle

# Share of the content's entropy against that of the children's sequence.
CONTENT = 0.9
# Pages that the same node on all hosts counts for.
PRIOR = 10.0
# Importance below which a branch is cut.
LEAST = 0.6
# Weights of nodes whose names state a role beside the article, or may: the latter are outvoted by high entropy.
STATED, HINTED = 0.55, 0.75
# Weight of an article in an article whose names say that it is a remark or the like, however long it is.
REMARK = 0.5
# Weights of nodes inside an article or main element, which low entropy outvotes, and of those outside one that the page has.
INSIDE, OUTSIDE = 2.0, 0.5
# Weight of article and main elements, what holds them, and the headings in them: kept however alike the pages are.
KEPT = 10.0

# Elements by kind.
RAW = frozenset({"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noframes"})
HIDDEN = RAW | {"head", "template", "svg", "math", "object", "select", "button", "canvas", "audio", "video", "datalist"}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var".split()
)
ROLES = frozenset("nav footer aside header form menu dialog".split())
MAIN = frozenset({"article", "main"})
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})
# Words of classes and ids that name something beside the article, and words that may.
ROLE_WORDS = frozenset(
    "ad ads advert advertisement advertising breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer"
    " nav navbar navigation newsletter pagination sidebar sponsor sponsored".split()
)
HINTS = frozenset(
    "banner disclaimer header menu modal notice popup promo promoted related replies reply respond share sharing signup"
    " social subscribe toolbar widget".split()
)
# Words that lead a compound name of something beside the article, ambiguous ones at its end, and those that tell a state.
LEADS = frozenset("ad ads advert advertisement comment comments cookie cookies share sharing nav newsletter sidebar".split())
LOOSE = frozenset({"header", "menu", "social", "related"})
STATES = frozenset("has with without no is on off open closed enabled disabled fixed active sticky left right top bottom".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*(?:>|\Z)", re.DOTALL
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")


class Node(NamedTuple):
    path: int
    tag: str
    hint: float
    in_article: bool
    hidden: bool
    cut: bool
    number: int


class Block(NamedTuple):
    nodes: tuple[Node, ...]
    text: str


class Page(NamedTuple):
    """Blocks of text in page order, per path the node and its children's tags, and by node number whether it is main."""

    blocks: list[Block]
    nodes: dict[int, Node]
    children: dict[int, list[str]]
    main: list[bool]
    has_main: bool

    def inside(self, block: Block) -> bool:
        return bool(block.nodes) and self.main[block.nodes[-1].number]


def _names_role(words: list[str]) -> float:
    """Weight by the words of one class, id or role: the whole name, the noun it ends in, or the word it begins with."""
    if len(words) > 1 and not STATES.isdisjoint(words):
        return 1.0
    said = [w for w in words[:1] if len(words) == 1 or w in LEADS] + [w for w in words[-1:] if w not in LOOSE]
    return STATED if not ROLE_WORDS.isdisjoint(said) else HINTED if not HINTS.isdisjoint(said) else 1.0


def _signature(tag: str, attributes: str) -> tuple[str, float]:
    """Tag with the words of its classes, and the weight of what these name: 1 unless it is beside the article."""
    names = [t for m in _NAMES.finditer(attributes) for t in (m[1] or m[2] or m[3] or "").lower().split()]
    words = [_WORD.findall(t) for t in names]
    hint = min((_names_role(w) for w in words if w), default=1.0)
    return " ".join([tag, *[w for own in words for w in own][:6]]), hint


def _ended(html: str) -> set[int]:
    """Places of the menus, headers and the like whose end tag is there."""
    ended, open_ = set(), {}
    for m in _TAG.finditer(html):
        tag = m[2] and m[2].lower()
        if tag in ROLES:
            own = open_.setdefault(tag, [])
            if not m[1]:
                own.append(m.start())
            elif own:
                ended.add(own.pop())
    return ended


def _main_nodes(nodes: list[tuple[str, float]], parents: list[int], sizes: list[int]) -> tuple[list[bool], bool]:
    """By number, whether a node is or lies in a main article; and whether the page has any.

    An article beside the text (its own names or a branch around it say so) is
    none, unless what says so holds most of the page's text together with an
    article whose own names do not.  The articles count if they hold at least half of what is not beside.
    """
    held, holds = list(sizes), [tag in MAIN and hint == 1 for tag, hint in nodes]
    for n in range(len(nodes) - 1, 0, -1):
        held[parents[n]] += held[n]
        holds[parents[n]] |= holds[n]
    beside, main = [False] * len(nodes), [False] * len(nodes)
    rest, own, some = held[0], 0, False
    for n in range(1, len(nodes)):
        (tag, hint), up = nodes[n], parents[n]
        named = hint < 1 and tag not in ("html", "body") and not (holds[n] and 2 * held[n] > held[0])
        beside[n] = beside[up] or named
        main[n] = main[up] or tag in MAIN and not beside[n]
        if main[n] and not main[up]:
            own, some = own + held[n], True
        elif beside[n] and not beside[up] and not main[up]:
            rest -= held[n]
    if some and 2 * own >= rest:
        return main, True
    return [False] * len(nodes), False


def parse_page(html: str, noise: frozenset[int] = frozenset()) -> Page:
    """A tolerant reading of the markup: only elements that hold blocks become nodes.

    Unclosed elements end with their parent; an article or main element also
    ends a menu, header or the like that has no end tag.  Nodes in `noise` are cut.
    """
    root = Node(0, "", 1.0, False, False, False, 0)
    stack, blocks, nodes, children = [root], [], {}, {}
    held: list[str] = []
    at, known, ended = 0, {}, None
    kinds, parents, sizes = [("", 1.0)], [0], [0]
    places: dict[int, int] = {}

    def emit() -> None:
        if held:
            if not stack[-1].hidden:
                text = " ".join(unescape("".join(held)).split())
                if text:
                    blocks.append(Block(tuple(stack[1:]), text))
                    sizes[stack[-1].number] += len(text)
            held.clear()

    while True:
        m = _TAG.search(html, at)
        if m is None:
            held.append(html[at:])
            break
        if m.start() > at:
            held.append(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in INLINE:
            continue
        if tag == "br":
            held.append(" ")
            continue
        emit()
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag in VOID:
            continue
        while len(stack) > 1 and stack[-1].tag in CLOSES.get(tag, ()):
            stack.pop()
        if tag != "p" and tag not in CLOSES and stack[-1].tag == "p":
            stack.pop()
        if tag in MAIN and stack[-1].tag in ROLES:
            if ended is None:
                ended = _ended(html)
            while len(stack) > 1 and stack[-1].tag in ROLES and places[stack[-1].number] not in ended:
                stack.pop()
        top = stack[-1]
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(html, at)
            at = end.end() if end else len(html)
            continue
        spelled = known.get((tag, m[3]))
        if spelled is None:
            spelled = known[tag, m[3]] = _signature(tag, m[3])
        signature, hint = spelled
        # An article's own header holds its title.
        if tag in ROLES and not (tag == "header" and top.in_article):
            hint = min(hint, HINTED if tag == "header" else STATED)
        if tag == "article" and hint < 1 and any(n.tag == "article" for n in stack):
            hint = REMARK
        path = xxhash.xxh64_intdigest(signature, seed=top.path & (1 << 63) - 1) >> 1
        node = Node(
            path,
            tag,
            hint,
            top.in_article or tag in MAIN,
            top.hidden or tag in HIDDEN,
            top.cut or path in noise,
            len(kinds),
        )
        kinds.append((tag, hint))
        parents.append(top.number)
        sizes.append(0)
        if tag in ROLES:
            places[node.number] = m.start()
        nodes.setdefault(path, node)
        children.setdefault(top.path, []).append(signature)
        if not m[3].rstrip().endswith("/"):
            stack.append(node)
    emit()
    return Page(blocks, nodes, children, *_main_nodes(kinds, parents, sizes))


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text) >> 1


def page_nodes(html: str) -> tuple[int, list[tuple[int, int, int, int, float, float, float]]]:
    """Name of the page's whole text; per node (page, path, content, style, weight, hint, most).

    Content and style are names of its content and of its children's tags.  The
    page is named by its whole text, or for nodes inside its article by the
    article's: copies of an article beside other adverts count once.  `most` is
    1 if the node holds more than half of that text.
    """
    page = parse_page(html)
    content: dict[int, list[str]] = {}
    for block in page.blocks:
        for node in block.nodes:
            content.setdefault(node.path, []).append(block.text)
    holders = {n.path for b in page.blocks if page.inside(b) for n in b.nodes if not page.main[n.number]}
    # A path may lie in an article at one place of a page and beside it at another.
    within = {n.path for b in page.blocks if page.inside(b) for n in b.nodes if page.main[n.number]}
    texts = {
        False: [b.text for b in page.blocks],
        True: [b.text for b in page.blocks if page.inside(b)],
    }
    names = {inside: _digest("\n".join(own)) for inside, own in texts.items()}
    sizes = {inside: sum(map(len, own)) for inside, own in texts.items()}
    rows = []
    for path, node in page.nodes.items():
        if node.hidden or node.tag in ("html", "body"):
            continue
        weight, in_main = 1.0, path in within or page.main[node.number]
        if path in holders or in_main and node.hint == 1.0 and (node.tag in MAIN or node.tag in HEADINGS):
            weight = KEPT
        elif in_main:
            weight = INSIDE
        elif page.has_main:
            weight = OUTSIDE
        own = content.get(path, ())
        most = float(node.hint != REMARK and 2 * sum(map(len, own)) > sizes[in_main])
        style = _digest(" ".join(page.children.get(path, ())))
        rows.append((names[in_main], path, _digest("\n".join(own)), style, weight, node.hint, most))
    return names[False], rows


def page_text(html: str, noise: frozenset[int]) -> str:
    """Blocks outside cut branches, one to a line."""
    page = parse_page(html, noise)
    return "\n".join(
        b.text for b in page.blocks if not (b.nodes and b.nodes[-1].cut) and (page.inside(b) or not page.has_main)
    )


def style_nodes(pages: DataFrame) -> DataFrame:
    """`(host, page, path, content, style, weight, hint, most)` from `pages(host, html)`, equal pages of a host once."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        for batch in batches:
            rows = []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                whole, nodes = page_nodes(html.as_py())
                if (host, whole) not in met:
                    met.add((host, whole))
                    rows += [(host, *node) for node in nodes]
            if rows:
                kinds = [pa.string(), *[pa.int64()] * 4, *[pa.float64()] * 3]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["host", "page", "path", "content", "style", "weight", "hint", "most"])

    found = pages.select("host", "html").mapInArrow(
        run, "host string, page long, path long, content long, style long, weight double, hint double, most double"
    )
    return found.distinct()


def _entropy(nodes: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Entropy of `value` per key over its pages, between 0 (all alike) and 1 (all different; also for one page)."""
    c = F.col("c")
    counts = nodes.groupBy(*keys, value).agg(F.sum("c").alias("c"))
    sums = counts.groupBy(*keys).agg(F.sum(c).alias("m"), F.sum(c * F.log(c)).alias("s"))
    m = F.col("m")
    bits = F.when(m > 1, (F.log(m) - F.col("s") / m) / F.log(m)).otherwise(1.0)
    return sums.select(*keys, bits.alias(name), F.col("m").alias(f"{name}_m"))


def node_importance(nodes: DataFrame) -> DataFrame:
    """`(host, path, importance)` of every merged node."""
    counted = settle(
        nodes.groupBy("host", "path", "content", "style").agg(
            F.count("*").alias("c"), F.max("weight").alias("weight"), F.max("hint").alias("hint"), F.sum("most").alias("most")
        )
    )

    def mixed(keys: list[str], name: str) -> DataFrame:
        own = _entropy(counted, keys, "content", "h").join(_entropy(counted, keys, "style", "g"), keys)
        return own.select(*keys, (F.col("h") * CONTENT + F.col("g") * (1 - CONTENT)).alias(name), F.col("h_m").alias(f"{name}_m"))

    # What holds most of the text on most of its pages is not scored by its names.
    hint = F.when(F.sum("most") * 2 > F.sum("c"), 1.0).otherwise(F.max("hint"))
    weights = counted.groupBy("host", "path").agg(F.max("weight").alias("weight"), hint.alias("hint"))
    own, everywhere = mixed(["host", "path"], "own"), mixed(["path"], "all")
    m, pages = F.col("own_m"), F.col("all_m")
    mixture = (F.col("own") * m + F.col("all") * PRIOR) / (m + PRIOR)
    # A node that its names speak against needs pages to speak for it: without any, its entropy is taken for half.
    shown = 0.5 + (mixture - 0.5) * pages / (pages + PRIOR)
    return (
        own.join(weights, ["host", "path"])
        .join(everywhere, "path")
        .select(
            "host",
            "path",
            F.when(F.col("weight") >= KEPT, 1.0)
            .when(F.col("hint") < 1, shown * F.col("hint"))
            .otherwise(mixture * F.col("weight"))
            .alias("importance"),
        )
    )


def extract_main_text(
    pages: DataFrame, least: float = LEAST, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """`(page_id, url, text, n_chars)`, one row per row of `pages`.

    Blocks are joined by line breaks; white space inside a block becomes one
    space, character references are decoded.  If a page has an article or
    main element that holds most of the text, only text inside counts; branches of low importance are cut
    there as well, its headings stay.  Null and empty pages, and pages
    without main text, have an empty text.  Null ids and urls are kept; pages
    without a host share one tree.
    """
    import pyarrow as pa

    small_batches(pages.sparkSession)
    source = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        host_of(F.col(url_col)).alias("host"),
        F.coalesce(html_col, F.lit("")).alias("html"),
    )
    importance = node_importance(style_nodes(source))
    noise = settle(
        importance.filter(F.col("importance") < least).groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("noise"))
    )
    small = fits(noise, F.octet_length("host") + F.size("noise") * 8)
    joined = spread_join(source, noise, "host", "left", small).select("page_id", "url", "html", "noise")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, frozenset[int]] = {}
        for batch in batches:
            texts = []
            for html, paths in zip(batch.column(2), batch.column(3), strict=True):
                key = tuple(paths.as_py() or ())
                if key not in known:
                    known.clear()
                    known[key] = frozenset(key)
                texts.append(page_text(html.as_py(), known[key]))
            columns = [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64(), size=len(texts))]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
