"""Operator 6: main text of web pages by site style trees.

The pages of a host are merged into one style tree: a node is a path of elements, each with its
tag, classes and id (digits aside). A node's importance is the entropy of what its occurrences
hold, over the log of their number: 1 if all differ, 0 if all are alike. A node's texts are
counted, the sequences of its children's styles, and the whole texts of its branch. For small
hosts the same node's importance over all hosts is mixed in, by PRIOR occurrences. Pages of one
host with the same content (the text of their articles, if there are any) count once, so copies
don't make content look unimportant.

A block goes when its node's texts are of low importance, a branch when both its styles and its
whole texts are, inside articles too; but only where the very text comes up again and again
(MIN_OCCURRENCES), so a page's own text stays. Branches whose presentation names a role that is
no content (menus, footers, adverts, forms, comments and so on) go as well. What is left is the
text. A branch whose styles are alike on all pages while its texts vary counts as content.

Both passes parse pages in Arrow batches. Between them only hashes move: one row for each
different content of a host, then (host, path, kind, value) counts, in two steps with partial
sums, so a host of a third of all pages is no hot key.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vecloom.session import materialize, ship_package

PRIOR = 20
THRESHOLD = 0.35
MIN_OCCURRENCES = 8

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>", re.S
)
_MARKS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_SPACES = re.compile(r"\s+")
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end blocks of text; all others, unknown ones too, stand within a line.
_BLOCK = frozenset(
    "address article aside blockquote body caption center colgroup dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup "
    "option p pre search section summary table tbody td template tfoot th thead title tr ul".split()
)
#: Elements within a line whose content is no text of it.
_SKIPPED = frozenset("button canvas datalist object select svg".split())
_NO_CONTENT = frozenset(
    "head script style noscript template nav header footer aside form button select textarea iframe object svg canvas "
    "dialog menu title xmp noembed noframes option datalist".split()
)
_NO_CONTENT_MARKS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies footer header "
    "login masthead menu modal nav navbar navigation newsletter notice notices popup promo related reply replies "
    "respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
#: What may follow a first word of those in a name; with another word the name tells what the text is about.
_PLAIN_PARTS = frozenset(
    "area articles bar block body bottom box button buttons col column container content count form group holder icon icons "
    "inner item items left link links list main outer pane panel post posts right row section stories text thread title top "
    "wrap wrapper".split()
)
_CLOSES = {
    "p": frozenset("p".split()),
    "li": frozenset(["li", "p"]),
    "dt": frozenset(["dt", "dd", "p"]),
    "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]),
    "td": frozenset(["td", "th", "p"]),
    "th": frozenset(["td", "th", "p"]),
    "option": frozenset(["option"]),
}
#: A class that begins with one of these tells what a page has or lacks, not what the element is.
_ABOUT_PAGE = frozenset("has have no not is with without show hide hidden".split())
#: Elements that hold the page or its content, whatever their classes say.
_WHOLE = frozenset("html body main article".split())
TEXTS, STYLES, BRANCH = 0, 1, 2
_CLOSABLE = frozenset("p li dt dd tr td th option".split())
_HARD = _NO_CONTENT - {"form"}  # whole pages may lie in a form
_PRIME, _BASE = (1 << 61) - 1, 0x9E3779B97F4A7C1

def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class Node:
    """An open or closed block element; `begin` and `end` are the blocks of text in it."""

    __slots__ = ("tag", "style", "path", "children", "marked", "hard", "article", "heads", "parent", "begin", "end")

    def __init__(self, tag: str, marks: str, parent: Node | None, begin: int = 0):
        self.tag, self.parent, self.style = tag, parent, tag + marks
        # A hash of the styles from the root on; long chains of elements cost no more than short ones.
        self.path = _hash(f"{parent.path}/{self.style}") if parent else 0
        self.hard = tag in _HARD or bool(parent and parent.hard)
        self.marked = tag in _NO_CONTENT or (tag not in _WHOLE and _names_no_content(marks))
        self.article = bool(parent and parent.article) or tag in ("article", "main")
        self.heads = False  # whether it holds a main element or a first heading
        self.children: list[str] = []
        self.begin = self.end = begin


def _names_no_content(marks: str) -> bool:
    """Whether a class, id or role names a role that is no content: as a whole, by its last part, or by
    its first part with nothing but words of layout after it."""
    for name in re.split(r"[.\s]+", marks):
        parts = [p for p in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if p]
        if not parts or parts[0] in _ABOUT_PAGE:
            continue
        if parts[-1] in _NO_CONTENT_MARKS or (parts[0] in _NO_CONTENT_MARKS and _PLAIN_PARTS.issuperset(parts[1:])):
            return True
    return False


def _spare(blocks: list[tuple[Node, str]], nodes: list[Node]) -> None:
    """Take the mark off nodes that hold most of a page's text and its heading."""
    sums = [0]
    for node, text in blocks:
        sums.append(sums[-1] + (0 if node.hard else len(text)))
    for node in nodes:
        if node.marked and node.heads and not node.hard and 2 * (sums[node.end] - sums[node.begin]) > sums[-1]:
            node.marked = False


def _below(nodes: list[Node], chosen) -> set[Node]:
    """The nodes for which `chosen` holds, and all in them."""
    found: set[Node] = set()
    for node in nodes:  # parents come first
        if chosen(node) or node.parent in found:
            found.add(node)
    return found


def _marks(attributes: str) -> str:
    if "=" not in attributes:
        return ""
    found = ["".join(m.groups()[1:][k] or "" for k in range(3)) for m in _MARKS.finditer(attributes)]
    return "".join("." + re.sub(r"\d+", "", x.strip()) for x in found if x.strip())


def parse(page: str) -> tuple[list[tuple[Node, str]], list[Node]]:
    """Blocks of text in page order, as (innermost block element, text), and all block elements, parents first.

    Linear in the page, however deep its elements lie.
    """
    root = Node("", "", None)
    nodes, stack, blocks, run = [root], [root], [], []
    opened: Counter = Counter()

    def flush() -> None:
        if run:
            text = _SPACES.sub(" ", html_lib.unescape("".join(run))).strip()
            if text:
                blocks.append((stack[-1], text))
            run.clear()

    def close(depth: int) -> None:
        for node in stack[depth:]:
            node.end = len(blocks)
            opened[node.tag] -= 1
        del stack[depth:]

    low = None

    def skip(tag: str, at: int, also_start: bool) -> int:
        """The place after the end tag of `tag`; `also_start`: a further start tag ends it too."""
        nonlocal low
        low = page.lower() if low is None else low
        text = page if len(low) != len(page) else low
        end = text.find(f"</{tag}", at)
        if also_start:
            start = text.find(f"<{tag}", at)
            if end < 0 or 0 <= start < end:
                return start if start >= 0 else at
        end = len(page) if end < 0 else end
        return page.find(">", end) + 1 or len(page)

    at = 0
    while True:
        m = _TAG.search(page, at)
        if m is None:
            run.append(page[at:])
            break
        if m.start() > at:
            run.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _RAW and tag != "title":  # no markup, and no text of the page
            if not m[1]:
                at = skip(tag, at, False)
            continue
        if tag not in _BLOCK:
            if tag == "br":
                run.append(" ")
            elif tag in _SKIPPED and not m[1] and not m[0].endswith("/>"):
                at = skip(tag, at, True)
            continue
        if m[1]:
            if opened[tag]:
                flush()
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            elif tag == "p":
                flush()
            continue
        flush()
        closes = _CLOSES.get(tag) or (_CLOSES["p"] if tag not in _VOID else ())
        depth = len(stack)
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in closes:
                depth = k
            elif stack[k].tag not in _CLOSABLE:
                break
        close(depth)
        if tag in _VOID:
            continue
        node = Node(tag, _marks(m[3]), stack[-1], len(blocks))
        stack[-1].children.append(node.style)
        nodes.append(node)
        above = node if tag in ("h1", "main") else None
        if tag == "article":
            above = next((n for n in stack if n.tag == "form"), None)  # the form's own page lies in it
        while above is not None and not above.heads:
            above.heads = True
            above = above.parent
        if tag == "title":
            node.end, at = len(blocks), skip(tag, at, False)
            continue
        stack.append(node)
        opened[tag] += 1
    flush()
    close(1)
    root.end = len(blocks)
    _spare(blocks, nodes)
    return blocks, nodes


class _Page:
    """The blocks of a page that no mark rules out, and hashes of the branches they lie in."""

    def __init__(self, page: str):
        blocks, nodes = parse(page)
        empty = _below(nodes, lambda node: node.marked)
        self.nodes = [node for node in nodes if node not in empty]
        kept, places = [], [0]
        for node, text in blocks:
            if node not in empty:
                kept.append((node, text, _hash(text)))
            places.append(len(kept))
        self.blocks = kept
        # Hash of the texts of any run of blocks, from sums over those before it.
        self._sums, self._powers = [0], [1]
        for _, _, h in kept:
            self._sums.append((self._sums[-1] * _BASE + h) % _PRIME)
            self._powers.append(self._powers[-1] * _BASE % _PRIME)
        self.branches = {
            node: self._run(places[node.begin], places[node.end])
            for node in self.nodes
            if node.children and node.tag and node.tag not in _WHOLE and places[node.begin] < places[node.end]
        }

    def _run(self, begin: int, end: int) -> int:
        return (self._sums[end] - self._sums[begin] * self._powers[end - begin]) % _PRIME


def node_values(page: str) -> tuple[int, Counter]:
    """A hash of a page's content, and how often each (path, kind, value) comes up in it; 8-byte hashes."""
    own = _Page(page)
    found: Counter = Counter()
    for node, _, h in own.blocks:
        found[node.path, TEXTS, h] += 1
    for node, h in own.branches.items():
        found[node.path, BRANCH, h] += 1
    for node in own.nodes:
        if node.children:
            found[node.path, STYLES, _hash(" ".join(dict.fromkeys(node.children)))] += 1
    inside = [text for node, text, _ in own.blocks if node.article]
    return _hash("\n".join(inside or [text for _, text, _ in own.blocks])), found


def main_text(page: str | None, low: set[tuple[int, int, int]]) -> str:
    """Text of the blocks that are content, given the (path, kind, value) hashes that are none."""
    if not page:
        return ""
    own = _Page(page)
    if not low:
        return "\n".join(text for _, text, _ in own.blocks)
    gone = _below(own.nodes, lambda node: node in own.branches and (node.path, BRANCH, own.branches[node]) in low)
    return "\n".join(
        text for node, text, h in own.blocks if node not in gone and (node.path, TEXTS, h) not in low
    )


def _host(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def style_trees(pages: DataFrame, url: str = "url", html: str = "html", threshold: float = THRESHOLD) -> DataFrame:
    """(host, path, kind, value) of the texts and branches that are no content by their importance."""
    ship_package(pages.sparkSession)
    names = ("path", "kind", "value", "n")
    counted = "array<struct<path:long,kind:int,value:long,n:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        kind = pa.list_(pa.struct(list(zip(names, kinds, strict=True))))
        for batch in batches:
            found: dict[tuple, list] = {}
            for host, page in zip(batch["host"].to_pylist(), batch["html"], strict=True):
                content, values = node_values(page.as_py() or "")
                own = sorted((*key, n) for key, n in values.items())
                found[host, content] = min(own, found.get((host, content), own))
            rows = [[dict(zip(names, v, strict=True)) for v in own] for own in found.values()]
            columns = [pa.array([k[i] for k in found], t) for i, t in enumerate((pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, kind)], names=["host", "content", "counted"])

    rows = pages.select(_host(F.col(url)).alias("host"), F.col(html).alias("html"))
    found = rows.mapInArrow(run, f"host string, content long, counted {counted}")
    once = found.groupBy("host", "content").agg(F.min("counted").alias("counted"))
    flat = once.select("host", F.explode("counted").alias("v")).select("host", "v.*")
    values = materialize(flat.groupBy("host", "path", "kind", "value").agg(F.sum("n").alias("n")), "node-values")

    def importance(counted: DataFrame, keys: list[str], name: str) -> DataFrame:
        # Entropy of parts n of a total t is log t - sum(n log n) / t.
        sums = counted.groupBy(*keys).agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.log("n")).alias("s"))
        entropy = F.log("t") - F.col("s") / F.col("t")
        return sums.select(
            *keys,
            F.col("t").alias(f"{name}_t"),
            F.when(F.col("t") > 1, entropy / F.log("t")).otherwise(F.lit(1.0)).alias(name),
        )

    everywhere = values.groupBy("path", "kind", "value").agg(F.sum("n").alias("all_n"))
    own = importance(values, ["host", "path", "kind"], "own")
    over_all = importance(everywhere.withColumnRenamed("all_n", "n"), ["path", "kind"], "all")
    mixed = (F.col("own") * F.col("own_t") + F.col("all") * PRIOR) / (F.col("own_t") + PRIOR)
    low = own.join(over_all, ["path", "kind"]).where((mixed < threshold) & (F.greatest("own_t", "all_t") >= MIN_OCCURRENCES))
    low = materialize(low.select("host", "path", "kind"), "low-nodes")
    styles = low.where(F.col("kind") == STYLES).select("host", "path")
    branches = low.where(F.col("kind") == BRANCH).join(styles, ["host", "path"], "left_semi")
    low = low.where(F.col("kind") == TEXTS).unionByName(branches.select("host", "path", "kind"))
    again = values.join(low, ["host", "path", "kind"], "left_semi").join(everywhere, ["path", "kind", "value"])
    return again.where(F.col("all_n") >= MIN_OCCURRENCES).select("host", "path", "kind", "value")


def extract(
    pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", threshold: float = THRESHOLD
) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    Character references are decoded, white space in a block becomes one space, blocks are
    joined by newlines in page order. NULL, empty and contentless pages give an empty text.
    Pages without a host make one group. Nodes, and texts, seen fewer than MIN_OCCURRENCES times,
    on the host and elsewhere, are kept unless marked. Repeated rows are returned each; other columns are ignored; an empty table gives no rows.
    """
    low = style_trees(pages, url, html, threshold)
    low = low.groupBy("host").agg(F.collect_list(F.struct("path", "kind", "value")).alias("low"))
    low = materialize(low, "low-values")
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), _host(F.col(url)).alias("host")
    )
    kinds = pages.schema[id_col].dataType, pages.schema[url].dataType
    fields = [StructField("page_id", kinds[0]), StructField("url", kinds[1])]
    schema = StructType([*fields, StructField("text", StringType()), StructField("n_chars", LongType())])
    arrow = [to_arrow_type(k) for k in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str, set[tuple[int, int, int]]] = {}
        for batch in batches:
            texts = []
            for host, nodes, page in zip(batch["host"].to_pylist(), batch["low"], batch["html"], strict=True):
                if host not in sets:
                    if len(sets) > 1000:
                        sets.clear()
                    sets[host] = {(x["path"], x["kind"], x["value"]) for x in nodes.as_py() or ()}
                texts.append(main_text(page.as_py(), sets[host]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["page_id"].cast(arrow[0]),
                    batch["url"].cast(arrow[1]),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    out = rows.join(low, "host", "left").select("page_id", "url", "html", "host", "low").mapInArrow(run, schema)
    return out.withColumnsRenamed({"page_id": id_col, "url": url})
