"""Main text of web pages by wrapper induction.

A page is a tree of its block elements with the text blocks as leaves.  Per host, Spark counts on how many different
pages a leaf (its tags from the root, its text, its number among equal ones) stands; exact copies of a page count once,
so copied articles don't look like template.  Leaves that stand on at least ``SHARE`` of the host's pages are constant.
They make the wrapper of the host: a tree of constant leaves in page order.  ``PRIOR`` pages that hold none of them are
added to every host, so a few pages that resemble each other prove nothing; there is no switch by the size of a host.

A page is aligned with its wrapper by simple tree matching (the largest top-down, order-preserving match of nodes, by
dynamic programming).  Leaves that are matched are template, the others vary and are content.  A text that the article
happens to share with the template, but that stands elsewhere, is not matched and stays.

Where alignment can't tell, the element says so: menus, footers, forms, adverts, reader comments and the like are
recognised by tag, class and id (fixed lists below).  Inside article and main a class counts only if all of its parts
say so (``share-buttons``, not ``share-price``).

Counting combines in the tasks and shuffles numbers and tag paths, no texts; a wrapper holds at most 1 / ``SHARE`` times
the leaves of a mean page of its host.

Defined cases: null or empty html gives the empty text; a null or odd url is a host of its own; equal pages get equal
texts; a page that is all template keeps what its elements don't rule out; elements below ``DEEPEST`` others are taken as
children of the last one above; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bounded_batches, staged
from starloom.operators.skew import split_left_join

#: Share of the different pages of a host on which constant leaves stand, and pages without them that every host is granted.
SHARE, PRIOR = 0.5, 6
#: Share of all pages from which a host is dealt over many tasks in joins.
HOT_SHARE = 0.005
#: Levels of the tree of a page.
DEEPEST = 60
#: Elements without an end tag, elements whose content is no markup, elements that start a block.  Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg object select option xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol optgroup p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never the main text, and words in class or id that say so.  Fixed values.
NOT_TEXT = frozenset("nav footer aside form menu button dialog head search fieldset".split())
NOT_TEXT_WORDS = re.compile(
    r"ads?|advert\w*|breadcrumbs?|comments?|commentlist|respond|cookies?|consent|disclaimer|disqus|footer|gdpr|"
    r"menu|modal|nav|navbar|navigation|newsletter|notice|notification|outbrain|overlay|pagination|popup|promo\w*|related|replies|reply|"
    r"share|sharing|sidebar|side|social|sponsor\w*|subscribe|subscription|taboola|toolbar|widget|alert|login|signup|search"
)
#: The same outside of article and main; there they name the headline.
HEADER_WORDS = frozenset("banner header masthead".split())
#: Parts of a class or id that go with the words above, and parts that name a headline.  Fixed values.
NEUTRAL = frozenset(
    "area bar block bottom box btn button buttons container form global group inner item items left link links list main media page panel "
    "primary right row secondary section site slot top unit wrap wrapper".split()
)
HEADLINE = frozenset("article content entry post story".split())
NOT_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert".split())
#: An open element of the first kind is ended by the start of one of the second.  Fixed values.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}}
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
#: Consumes a value with its name, so nothing in a value is taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_DIGITS = re.compile(r"\d+")


class Node:
    """Element of a page or a wrapper: its tag, and in page order its children, which are nodes or :class:`Leaf`."""

    __slots__ = ("label", "children")

    def __init__(self, label: str):
        self.label, self.children = label, []


class Leaf:
    """Text block: its text, a number for text and tags from the root, and where it stands on the page."""

    __slots__ = ("label", "text", "place")

    def __init__(self, label: int, text: str = "", place: int = 0):
        self.label, self.text, self.place = label, text, place


@lru_cache(100_000)
def _says_not_text(tag: str, names: str, inside: bool) -> bool:
    """Whether tag, class or id rule an element out; ``inside`` article or main all parts of a name have to agree."""
    named = [re.split("[_-]+", name) for name in names.lower().split()]
    for parts in named:
        listed = [bool(NOT_TEXT_WORDS.fullmatch(p)) for p in parts]
        if any(listed) and (not inside or all(x or not p or p in NEUTRAL or p.isdigit() for x, p in zip(listed, parts))):
            return True
    headline = inside or any(not HEADLINE.isdisjoint(parts) for parts in named)
    if headline:
        return False
    return tag == "header" or any(not HEADER_WORDS.isdisjoint(parts) for parts in named)


def parse(source: str) -> Node:
    """Tree of the block elements that may hold main text; what stands between two of them is one leaf without label."""
    root = Node("root")
    # Tag, node (None where the element is ruled out), level, and whether an inline end tag stops here.
    stack: list[tuple[str, Node | None, int, bool]] = [("root", root, 0, True)]
    opened, open_text, at = Counter(), None, 0

    def put(part: str):
        nonlocal open_text
        node = stack[-1][1]
        if node is None:
            return
        if open_text is None:
            if not part.strip():
                return
            open_text = []
            node.children.append(open_text)
        open_text.append(part)

    def close(i: int):
        nonlocal open_text
        for tag, *_ in stack[i:]:
            opened[tag] -= 1
        del stack[i:]
        open_text = None

    while at < len(source):
        found = _TOKEN.search(source, at)
        if not found:
            put(source[at:])
            break
        if found.start() > at:
            put(source[at : found.start()])
        at, tag = found.end(), (found[2] or "").lower()
        if not tag:
            continue
        block = tag in BLOCK
        if found[1]:
            if opened[tag]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        close(i)
                        break
                    if not block and stack[i][3]:
                        break  # an inline end tag doesn't reach out of its block
            elif tag == "p":
                open_text = None
            continue
        if tag in VOID:
            if tag in ("br", "hr", "wbr"):
                put(" " if tag != "wbr" else "")
            if tag == "hr":
                open_text = None
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
            at = end.end() if end else len(source) if tag in ("script", "style", "textarea", "title") else at
            continue
        if block:
            open_text = None
            for i in range(len(stack) - 1, 0, -1):
                over = stack[i][0]
                if over == "p" or tag in ENDS.get(over, ()):
                    close(i)
                    break
                if stack[i][3]:
                    break
        _, above, level, _ = stack[-1]
        skip = above is None
        if not skip and tag not in ("html", "body", "article", "main"):
            named: dict[str, str] = {}
            for name, a, b, c in _ATTRIBUTE.findall(found[3]) if found[3].strip() else ():
                named.setdefault(name.lower(), a or b or c)
            names = f"{named.get('class', '')} {named.get('id', '')}"
            inside = opened["article"] > 0 or opened["main"] > 0
            skip = tag in NOT_TEXT or "hidden" in named or named.get("role", "").lower() in NOT_TEXT_ROLES or _says_not_text(tag, names, inside)
        if not block and (not skip or found[3].rstrip().endswith("/")):
            continue  # inline text belongs to its block
        node = None if skip else above
        if skip and above is not None:
            open_text = None
        elif not skip and level < DEEPEST:
            node = Node(tag)
            above.children.append(node)
        stack.append((tag, node, level + 1, block or above is not None))
        opened[tag] += 1
    _finish(root, "", [0])
    return root


def _finish(node: Node, path: str, seen: list[int]) -> None:
    """Turn the lists of text parts into leaves; empty ones go."""
    done = []
    for child in node.children:
        if isinstance(child, Node):
            _finish(child, f"{path}/{child.label}", seen)
            done.append(child)
        elif text := text_of(child):
            done.append(Leaf(filling(f"{path} {text}"), text, seen[0]))
            seen[0] += 1
    node.children = done


def text_of(parts: list[str]) -> str:
    return " ".join(entities.unescape("".join(parts)).split())


def filling(text: str) -> int:
    """Signed 64-bit number of a text."""
    return (xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) ^ (1 << 63)) - (1 << 63)


def leaves(node: Node, path: str = "") -> Iterator[tuple[str, Leaf]]:
    """Leaves in page order; the path counts siblings of equal tag."""
    seen: Counter = Counter()
    for child in node.children:
        if isinstance(child, Leaf):
            yield path, child
        else:
            seen[child.label] += 1
            yield from leaves(child, f"{path}/{child.label}:{seen[child.label]}")


def numbered(tree: Node) -> list[tuple[str, Leaf]]:
    """The leaves with their paths; the labels of repeated ones are told apart by their number among equal ones."""
    found, seen = list(leaves(tree)), Counter()
    for _, leaf in found:
        own = leaf.label
        if seen[own]:
            leaf.label = filling(f"{own} {seen[own]}")
        seen[own] += 1
    return found


def wrapper_tree(constant: Iterable[tuple[str, int]]) -> Node:
    """Tree of the constant leaves, given as (path, label) in page order."""
    root = Node("root")
    open_ = [("", root)]
    for path, label in constant:
        steps = path.split("/")[1:]
        keep = 1
        while keep < len(open_) and keep <= len(steps) and open_[keep][0] == steps[keep - 1]:
            keep += 1
        del open_[keep:]
        for step in steps[keep - 1 :]:
            node = Node(step.partition(":")[0])
            open_[-1][1].children.append(node)
            open_.append((step, node))
        open_[-1][1].children.append(Leaf(label))
    return root


def _pruned(node: Node, labels: set[int]) -> Node | None:
    """What of a page may match: elements above leaves of the wrapper, and these."""
    own = Node(node.label)
    for child in node.children:
        if isinstance(child, Leaf):
            if child.label in labels:
                own.children.append(child)
        elif (below := _pruned(child, labels)) is not None:
            own.children.append(below)
    return own if own.children else None


def simple_tree_matching(a: Node | Leaf, b: Node | Leaf) -> tuple[int, list[int]]:
    """Nodes in the largest top-down, order-preserving match of two trees, and the places of the leaves of ``a`` in it."""
    known: dict[tuple[int, int], tuple[int, list[int]]] = {}

    def shape(x: Node | Leaf):
        return x.label if isinstance(x, Leaf) else (x.label, *map(shape, x.children))

    def match(x: Node | Leaf, y: Node | Leaf) -> tuple[int, list[int]]:
        if x.label != y.label:
            return 0, []
        if isinstance(x, Leaf):
            return 1, [x.place]
        key = (id(x), id(y))
        if key not in known:
            known[key] = ordered(x.children, y.children)
        return known[key]

    def ordered(a: list, b: list) -> tuple[int, list[int]]:
        total, found, first = 1, [], 0
        shapes_a, shapes_b = [shape(x) for x in a], [shape(y) for y in b]
        last_a, last_b = len(a), len(b)
        while first < min(last_a, last_b) and shapes_a[first] == shapes_b[first]:  # equal trees at either end match
            first += 1
        while min(last_a, last_b) > first and shapes_a[last_a - 1] == shapes_b[last_b - 1]:
            last_a, last_b = last_a - 1, last_b - 1
        pairs = [(i, i) for i in range(first)] + [(last_a + i, last_b + i) for i in range(len(a) - last_a)]
        n, m = last_a - first, last_b - first
        table = [[0] * (m + 1)]
        for i in range(n):
            row = [0]
            for j in range(m):
                row.append(max(table[i][j + 1], row[j], table[i][j] + match(a[first + i], b[first + j])[0]))
            table.append(row)
        while n and m:
            if table[n][m] == table[n - 1][m]:
                n -= 1
            elif table[n][m] == table[n][m - 1]:
                m -= 1
            else:
                n, m = n - 1, m - 1
                pairs.append((first + n, first + m))
        for i, j in pairs:
            worth, places = match(a[i], b[j])
            total += worth
            found += places
        return total, found

    return match(a, b)


def main_text(source: str, wrapper: Node | None = None) -> str:
    tree = parse(source)
    found = numbered(tree)
    if wrapper is not None and wrapper.children:
        template = _pruned(tree, {leaf.label for _, leaf in leaves(wrapper)})
        gone = set(simple_tree_matching(template, wrapper)[1]) if template else set()
        if len(gone) < len(found):
            found = [(path, leaf) for path, leaf in found if leaf.place not in gone]
    return " ".join(leaf.text for _, leaf in found)


def host_of(url: Column) -> Column:
    named = F.regexp_extract(url.cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.coalesce(F.lower(named), F.lit(""))


def _rows(pages: DataFrame, *columns: str) -> DataFrame:
    return pages.select(*columns, host_of(F.col("url")).alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))


def page_leaves(pages: DataFrame) -> DataFrame:
    """(host, page, leaves) for every page; ``page`` is a number of its paths and texts, leaves are (path, label, place)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("path", pa.string()), ("label", pa.int64()), ("place", pa.int32())]))
        for batch in batches:
            numbers, found = [], []
            for source in batch.column("html").to_pylist():
                own = [(path, leaf.label, leaf.place) for path, leaf in numbered(parse(source))]
                numbers.append(filling(repr(own)))
                found.append([{"path": p, "label": x, "place": i} for p, x, i in own])
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(numbers, pa.int64()), pa.array(found, kind)], names=["host", "page", "leaves"])

    return _rows(pages).mapInArrow(read, "host string, page long, leaves array<struct<path:string,label:long,place:int>>")


def wrappers(pages: DataFrame) -> tuple[DataFrame, list[str]]:
    """(host, wrapper) with the constant leaves as (path, label) in page order, for hosts that have any; and the hot hosts."""
    different = staged(page_leaves(pages).groupBy("host", "page").agg(F.first("leaves").alias("leaves"), F.count("*").alias("copies")), "leaves")
    hosts = staged(different.groupBy("host").agg(F.count("*").alias("n"), F.sum("copies").alias("pages")), "hosts")
    total = hosts.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0]
    # At most 1 / HOT_SHARE names.
    hot = [r.host for r in hosts.where(F.col("pages") >= max(2, HOT_SHARE * total)).select("host").collect()]
    each = different.select("host", F.inline("leaves"))
    counts = each.groupBy("host", "label").agg(F.count("*").alias("held"), F.min("path").alias("path"), F.sum("place").alias("places"))
    counts = counts.where(F.col("held") >= SHARE * (1 + PRIOR))  # what no host can hold often enough
    often = split_left_join(counts, hosts.select("host", "n"), "host", hot, ["label"])
    constant = often.where(F.col("held") >= SHARE * (F.col("n") + PRIOR))
    leaf = F.struct((F.col("places") / F.col("held")).alias("at"), "path", "label")
    return staged(constant.groupBy("host").agg(F.sort_array(F.collect_list(leaf)).alias("wrapper")), "wrappers"), hot


def extract(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    bounded_batches(pages.sparkSession, 200)
    induced, hot = wrappers(pages)
    rows = _rows(pages, "page_id", "url").withColumn("at", F.spark_partition_id())
    # A hot host is dealt over the tasks, should the wrappers outgrow a broadcast.
    joined = split_left_join(rows, induced, "host", hot, ["at", "page_id", "url"])

    @F.arrow_udf("string")
    def text(html: pa.Array, host: pa.Array, wrapper: pa.Array) -> pa.Array:
        trees: dict[str, Node] = {}
        found = []
        for source, name, constant in zip(html.to_pylist(), host.to_pylist(), wrapper):
            if name not in trees:
                trees[name] = wrapper_tree((x["path"], x["label"]) for x in constant.as_py() or ())
            found.append(main_text(source, trees[name]))
        return pa.array(found, pa.string())

    return joined.select("page_id", "url", text("html", "host", "wrapper").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
