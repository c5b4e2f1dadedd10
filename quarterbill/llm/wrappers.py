"""Main text of pages by wrapper induction over the pages of a host.

Each page's tree is aligned with those of reference pages of its host, one for each of the
most frequent layouts, by simple tree matching: labels must be equal, order is kept, and the
most nodes are matched; runs of siblings with the same label are one repeated node. A text
of a reference that the aligned places of the other pages repeat is template; places whose text varies are slots. The main text lies
in the articles or main elements, else where the slots are, less template and what is marked
as navigation, advert, form and the like; in an article, marks are but a hint.
"""

from __future__ import annotations

import re
import struct
from collections import OrderedDict
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterbill.llm.common import same_key, stage
from quarterbill.llm.dom import BLOCK, RAW, Node, parse, tidy

LEAST_PAGES = 3  # aligned pages from which a text can be template
TEMPLATE_SHARE = 0.8  # of them must repeat it
REFERENCES = 4  # layouts of a host, the most frequent ones, whose first page is a reference
LAYOUT_DEPTH = 4  # elements down to here, with their classes, make the layout
DEEPEST = 100  # nodes below are not aligned, and so are slots

#: Elements, roles and words of class or id that mark what is not article.
DROP_TAGS = frozenset(
    "head nav footer aside form button select dialog menu svg canvas object embed audio video template datalist search".split()
) | RAW
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar sidenav footer masthead comment comments disqus respond cookie "
    "cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup share sharing social related "
    "recommended widget widgets pagination pager toolbar".split()
)
#: Of these, words that texts of an article may bear as well: what the article is about.
LOOSE_WORDS = frozenset(
    "ad ads banner sponsor sponsored promo promotion nav navigation menu masthead respond cookies consent notice notices "
    "modal overlay newsletter subscribe signup share sharing social related recommended widget widgets toolbar".split()
)
#: Reader comments differ from page to page, so no template finds them: these count in longer names, too.
COMMENT_WORDS = frozenset("comment comments disqus".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WORD = re.compile(r"[a-z]+")


def is_boilerplate(node: Node) -> bool:
    """Marked as something other than article text.

    Within an article or main element the template decides: there a class or id counts as a whole,
    not by parts of a longer name, and a loose word only if links make most of the element's text.
    """
    if node.tag == "form":  # one around the whole page is none of the article's
        return not any(n.tag in ("article", "main") for n in node.elements())
    if node.tag in DROP_TAGS:
        return True
    if node.tag in ("html", "body", "main", "article"):
        return False
    if node.tag == "header":  # a heading block within an article holds its title
        return not (_inside(node, ("article", "main")) and any(n.tag in HEADINGS for n in node.elements()))
    if not node.written:
        return False
    attributes = node.attributes()
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if attributes.get("role", "").lower() in DROP_ROLES:
        return True
    marks = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    words = set(WORD.findall(marks))
    if "header" not in words and not words & DROP_WORDS:
        return False
    if not _inside(node, ("article", "main")):
        return bool(words & DROP_WORDS) or not any(n.tag == "h1" for n in node.elements())
    if words & COMMENT_WORDS or set(marks.split()) & (DROP_WORDS - LOOSE_WORDS):
        return True
    return bool(words & DROP_WORDS) and _mostly_links(node)


def _mostly_links(node: Node) -> bool:
    """Links hold more than half of an element's text."""
    linked = total = 0
    todo: list[tuple[Node, bool]] = [(node, False)]
    while todo:
        at, link = todo.pop()
        link = link or at.tag == "a"
        for child in at.children:
            if isinstance(child, str):
                size = len(tidy(child))
                total += size
                linked += size * link
            elif child.tag not in RAW:
                todo.append((child, link))
    return 2 * linked > total


def _inside(node: Node, tags: tuple[str, ...]) -> bool:
    while node.parent is not None:
        node = node.parent
        if node.tag in tags:
            return True
    return False


# --- alignment ----------------------------------------------------------------------------


def label(node: Node) -> str:
    """What must be equal for two nodes to match: the element and its classes."""
    classes = node.attributes().get("class", "") if node.written else ""
    return f"{node.tag}.{'.'.join(sorted(classes.split()))}" if classes else node.tag


class Shape:
    """A node for alignment: label, signs of its own texts, and runs of equally labelled children.

    Aligned nodes have equal paths, so equal signs are equal texts.
    """

    __slots__ = ("label", "path", "runs", "signs")

    def __init__(self, node: Node | None, path: str = "", depth: int = 0):
        self.runs: list[list[Shape]] = []
        self.signs: list[int] = []
        if node is None:
            return
        self.label = label(node)
        self.path = f"{path}/{self.label}"
        for child in node.children:
            if isinstance(child, str):
                if text := tidy(child):
                    self.signs.append(sign(self.path, text))
            elif depth < DEEPEST and child.tag not in RAW:
                self.add(Shape(child, self.path, depth + 1))

    def add(self, child: Shape) -> None:
        if self.runs and self.runs[-1][0].label == child.label:
            self.runs[-1].append(child)
        else:
            self.runs.append([child])

    def written(self) -> bytes:
        """The tree in bytes: the signs, and a line with depth, number of signs and label for each node."""
        lines, signs, todo = [], [], [(self, 0)]
        while todo:
            shape, depth = todo.pop()
            lines.append(f"{depth} {len(shape.signs)} {shape.label}")
            signs += shape.signs
            todo += [(s, depth + 1) for run in reversed(shape.runs) for s in reversed(run)]
        return struct.pack(f"<I{len(signs)}q", len(signs), *signs) + "\n".join(lines).encode()

    @classmethod
    def read(cls, data: bytes) -> Shape:
        (n,) = struct.unpack_from("<I", data)
        signs, at = struct.unpack_from(f"<{n}q", data, 4), 0
        around: list[Shape] = []
        for line in data[4 + 8 * n :].decode().split("\n"):  # a label has no white space
            depth, own, name = line.split(" ", 2)
            shape = cls(None)
            del around[int(depth) :]
            shape.label, shape.path = name, f"{around[-1].path if around else ''}/{name}"
            shape.signs = list(signs[at : at + int(own)])
            at += int(own)
            if around:
                around[-1].add(shape)
            around.append(shape)
        return around[0]

    def layout(self) -> int:
        """Equal for pages whose outer elements are the same, in any number and order."""
        paths, level = {self.path}, [self]
        for _ in range(LAYOUT_DEPTH):
            level = [s for shape in level for run in shape.runs for s in run]
            paths |= {s.path for s in level}
        return sign("", "\n".join(sorted(paths)))


def sign(path: str, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{path}\n{text}") - (1 << 63)


def _matching(a: Shape, b: Shape, known: dict) -> tuple[int, list[tuple[int, int]]]:
    """Size of the largest ordered matching of two nodes with the same label, and its runs."""
    key = (id(a), id(b))
    if key not in known:
        x, y = a.runs, b.runs
        weight = lambda r, s: _matching(r[0], s[0], known)[0] if r[0].label == s[0].label else 0
        if [r[0].label for r in x] == [s[0].label for s in y]:
            pairs = [(i, i) for i in range(len(x))]
            size = sum(weight(r, s) for r, s in zip(x, y))
        else:
            best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
            for i, r in enumerate(x):
                for j, s in enumerate(y):
                    both = best[i][j] + weight(r, s)
                    best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], both)
            pairs, i, j = [], len(x), len(y)
            size = best[i][j]
            while i and j:
                if best[i][j] == best[i - 1][j]:
                    i -= 1
                elif best[i][j] == best[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs.append((i, j))
        known[key] = size + 1, pairs
    return known[key]


def repeated(reference: Shape, page: Shape) -> Iterator[tuple[int, bool]]:
    """For each text of the reference that is aligned: its sign, and whether the page repeats it."""
    known: dict = {}
    todo = [([reference], [page])]
    while todo:
        run, other = todo.pop()
        signs = {x for s in other for x in s.signs}
        for shape in run:
            for x in shape.signs:
                yield x, x in signs
        for i, shape in enumerate(run):
            twin = other[min(i, len(other) - 1)]
            for a, b in _matching(shape, twin, known)[1]:
                todo.append((shape.runs[a], twin.runs[b]))


# --- main text ----------------------------------------------------------------------------


def _visible(root: Node) -> Iterator[tuple[Node, str]]:
    """Elements that are not boilerplate, with their paths, in page order."""
    todo = [(root, "")]
    while todo:
        node, path = todo.pop()
        if node.parent is not None and is_boilerplate(node):
            continue
        path = f"{path}/{label(node)}"
        yield node, path
        todo += [(c, path) for c in reversed(node.children) if not isinstance(c, str)]


def _regions(root: Node, constant: set[int]) -> tuple[list[Node], set[tuple[int, int]]]:
    """The elements that hold the slots, in page order, and the template's texts as (id of element, place in it).

    They are the outermost articles, else the outermost main elements, else the smallest element
    around all slots. Elements without a text do not count.
    """
    owners, template, filled = [], set(), set()
    marked: dict[str, list[Node]] = {"article": [], "main": []}
    for node, path in _visible(root):
        kind = "main" if 'role="main"' in node.written else node.tag
        if kind in marked:
            marked[kind].append(node)
        texts = [(i, t) for i, c in enumerate(node.children) if isinstance(c, str) and (t := tidy(c))]
        fixed = {(id(node), i) for i, t in texts if sign(path, t) in constant} if constant else set()
        template |= fixed
        up: Node | None = node if texts else None
        while up is not None and id(up) not in filled:
            filled.add(id(up))
            up = up.parent
        if len(fixed) < len(texts):
            owners.append(node)
    for nodes in marked.values():
        outer: list[Node] = []
        held: set[int] = set()
        for node in nodes:  # in page order, so an element comes after those around it
            up = node.parent
            while up is not None and id(up) not in held:
                up = up.parent
            if up is None and id(node) in filled:
                outer.append(node)
                held.add(id(node))
        if outer:
            return outer, template
    if not owners:
        return [root], template
    # the smallest element around all slots
    chain = []
    at: Node | None = owners[0]
    while at is not None:
        chain.append(at)
        at = at.parent
    place = {id(n): i for i, n in enumerate(chain)}
    top = 0
    for node in owners[1:]:
        while id(node) not in place:
            node = node.parent
        top = max(top, place[id(node)])
    return [chain[top]], template


def _blocks(root: Node, constant: set[int] = frozenset()) -> list[str]:
    """The blocks of the main text, less those whose texts are all template."""
    regions, template = _regions(root, constant)
    blocks: list[str] = []
    buffer: list[str] = []
    slot = not template  # a text in the buffer is none of the template's

    def flush() -> None:
        nonlocal slot
        if slot and (text := tidy("".join(buffer))):
            blocks.append(text)
        buffer.clear()
        slot = not template

    own = {id(r) for r in regions}
    todo: list = []
    for region in reversed(regions):
        todo += [None, region]
    while todo:
        item = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, tuple):
            text, varies = item
            buffer.append(text)
            slot = slot or (varies and tidy(text) != "")
        elif id(item) not in own and is_boilerplate(item):
            continue
        elif item.tag in ("br", "wbr"):
            buffer.append(" " if item.tag == "br" else "")
        else:
            if item.tag in BLOCK:
                flush()
                todo.append(None)
            for i in range(len(item.children) - 1, -1, -1):
                child = item.children[i]
                todo.append((child, (id(item), i) not in template) if isinstance(child, str) else child)
    flush()
    return blocks


def main_text(html: str | None, constant: set[int] = frozenset()) -> str:
    """The blocks of a page's main text, one per line."""
    return "\n".join(_blocks(parse(html or ""), constant))


# --- over tables --------------------------------------------------------------------------


def host() -> F.Column:
    """The host of a URL, in small letters; null without one."""
    found = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


class _References(OrderedDict):
    """The latest reference trees of a task, by host; a bounded number."""

    def of(self, name: str, firsts: list[bytes]) -> list[Shape]:
        if name not in self:
            self[name] = [Shape.read(data) for data in firsts]
            if len(self) > 64:
                self.popitem(last=False)
        self.move_to_end(name)
        return self[name]


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    references = _References()
    for batch in batches:
        counts: dict[tuple[str, int], list[int]] = {}
        for name, data, firsts in zip(batch.host, batch.tree, batch.firsts):
            shape = Shape.read(data)
            own: dict[int, bool] = {}  # a page has one vote on a text, by whichever reference it is found
            for reference in references.of(name, firsts):
                for signed, same in repeated(reference, shape):
                    own[signed] = own.get(signed, False) or same
            for signed, same in own.items():
                vote = counts.setdefault((name, signed), [0, 0])
                vote[0] += 1
                vote[1] += same
        yield pd.DataFrame([(*k, *v) for k, v in counts.items()], columns=["host", "sign", "aligned", "same"])


def _marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for html in batch.html:
            root = parse(html)
            shape = Shape(root)
            rows.append((xxhash.xxh128_digest("\n".join(_blocks(root))), shape.layout(), shape.written()))
        batch["text"], batch["layout"], batch["tree"] = zip(*rows) if rows else ((), (), ())
        yield batch.drop(columns="html")


def voters(pages: DataFrame) -> DataFrame:
    """host, page_id, layout, tree: of each host's pages one for each text that they show.

    So copies vote once, and pages that show no text do not.
    """
    read = pages.select(host().alias("host"), "page_id", "html").where("host IS NOT NULL AND html IS NOT NULL")
    marks = [T.StructField("text", T.BinaryType()), T.StructField("layout", T.LongType()), T.StructField("tree", T.BinaryType())]
    return (
        read.mapInPandas(_marked, T.StructType([*read.drop("html").schema, *marks]))
        .where(F.col("text") != F.lit(xxhash.xxh128_digest("")))
        .groupBy("host", "text")
        .agg(F.min(F.struct("page_id", "layout", "tree")).alias("page"))
        .select("host", "page.*")
    )


def references(read: DataFrame) -> DataFrame:
    """host, firsts: the tree of the first page of each of the most frequent layouts of hosts with enough voters."""
    order = Window.partitionBy("host").orderBy(F.desc("n"), "layout")
    layouts = (
        read.groupBy("host", "layout")
        .agg(F.min(F.struct("page_id", "tree"))["tree"].alias("first"), F.count(F.lit(1)).alias("n"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= REFERENCES)
    )
    enough = read.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= LEAST_PAGES)
    return layouts.join(enough, "host").groupBy("host").agg(F.collect_list("first").alias("firsts"))


def templates(pages: DataFrame) -> DataFrame:
    """host, constant: signs of the texts that a host's pages repeat. Every text of a host votes."""
    read = stage(voters(pages), "voters")
    # written, so that the join has a shuffle on either side and a hot host can be split
    firsts = stage(references(read), "references")
    votes = read.join(firsts, "host").mapInPandas(_votes, "host string, sign long, aligned long, same long")
    return (
        votes.groupBy("host", "sign")
        .agg(F.sum("aligned").alias("aligned"), F.sum("same").alias("same"))
        .where((F.col("aligned") >= LEAST_PAGES) & (F.col("same") >= TEMPLATE_SHARE * F.col("aligned")))
        .groupBy("host")
        .agg(F.collect_list("sign").alias("constant"))  # at most the texts of the references
    )


def _texts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for htmls, constants in batches:
        yield pd.Series([main_text(h, frozenset() if c is None else set(c)) for h, c in zip(htmls, constants)], dtype=object)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: the main text of each page.

    A null or empty html gives an empty text; a page without a host, or of a host with few
    pages, is judged by itself. Rows with equal ids are pages of their own. Other columns
    are ignored; an empty table gives an empty one.
    """
    known = stage(templates(pages), "templates")
    text = F.pandas_udf(_texts, "string")("html", "constant")
    joined = same_key(pages.select("page_id", "url", "html", host().alias("host")), known, ["host"])
    return joined.select("page_id", "url", text.alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )
