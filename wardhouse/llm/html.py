"""Main text of web pages by wrapper induction.

Each page is aligned with a reference page of its host by simple tree matching. A slot of the reference whose text is
the same in nearly all pages belongs to the template; one whose text varies, and what the reference lacks, is content,
unless it stands in a part of the page that is furniture by its tag or name (menus, footers, adverts, forms, comments, ...),
whose texts may vary as well. No step recurses, so the depth of a page is bounded by its length alone.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.llm.common import arrow_flow, arrow_map, cut, text_bytes

# A slot is template if its most frequent text stands in this share of the host's different pages that have the slot,
# and in so many of them at least. Pages with the same texts throughout count once, so copies of an article are not one.
CONSTANT_SHARE, LEAST_PAGES = 0.9, 4
# Tables by host up to this size are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
# A start tag of a key ends an open element of its values.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}}
BARRIERS = frozenset("ul ol dl table select div section article main body".split())
# Parts of a page that are not its article, by tag, by role and by words of class and id.
OUT_TAGS = frozenset(
    "head nav header footer aside form script style noscript template iframe button select option input textarea svg math object"
    " embed canvas audio video dialog menu title link meta noembed noframes xmp".split()
)
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu breadcrumb"
    " breadcrumbs header masthead footer sidebar aside rail widget related cookie cookies consent gdpr notice popup modal overlay"
    " newsletter subscribe signup login share sharing social toolbar pagination pager comment comments reply replies disqus"
    " respond form search skip".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?P<self>/)?>", re.S
)
# Words that may stand beside these in a name: `site-footer` and `related-articles` are furniture, `ad-free` and
# `entry-header` are not. A header is one of the page only beside a word of SITE.
SITE = frozenset("site global main top".split())
BESIDE = SITE | frozenset(
    "bottom left right box bar block list lists item items container wrapper wrap inner outer area section links link buttons button"
    " icons panel holder group row articles posts stories news user users reader readers".split()
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
_NAME_PARTS = re.compile(r"[-_]+")
# Tables of an alignment up to this many cells are kept whole; larger ones are cut in half first.
CELLS = 1 << 22


class Node:
    __slots__ = ("tag", "out", "parts", "children")

    def __init__(self, tag: str, out: bool):
        self.tag, self.out = tag, out
        self.parts: list = []  # texts and nodes, in page order
        self.children: list[Node] = []


def names_furniture(name: str) -> bool:
    """Whether one class or id says that an element is no part of the article."""
    words = {w for w in _NAME_PARTS.split(name) if w and not w.isdigit()}
    out = words & OUT_NAMES
    return bool(out) and words - out <= (SITE if out == {"header"} else BESIDE)


def _is_out(tag: str, rest: str) -> bool:
    if tag in OUT_TAGS:
        return True
    for name, value in _ATTRIBUTE.findall(rest) if rest else ():
        name, value = name.lower(), (value[1:-1] if value[:1] in ("'", '"') else value).lower()
        if name == "hidden" or (name == "aria-hidden" and value.strip() == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name == "role" and not OUT_ROLES.isdisjoint(value.split()):
            return True
        if name in ("class", "id") and any(map(names_furniture, value.split())):
            return tag not in ("html", "body", "main", "article")
    return False


def parse(source: str) -> Node:
    """A tree of the page. Tags may be left open or closed without being opened; raw text elements end at their own end tag."""
    root = Node("#", False)
    stack, at = [root], 0
    while True:
        match = _TOKEN.search(source, at)
        text = source[at : match.start()] if match else source[at:]
        if text:
            stack[-1].parts.append(text)
        if not match:
            return root
        at = match.end()
        tag = match["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if match["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                # The end tag of an inline element or paragraph does not reach out of its block.
                if (tag in INLINE or tag == "p") and stack[k].tag in BARRIERS:
                    break
            continue
        if tag not in INLINE:
            # A block ends an open paragraph, with the inline elements left open in it.
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag not in INLINE:
                    break
        if tag in ENDS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ENDS[tag]:
                    del stack[k:]
                    break
                if stack[k].tag in BARRIERS:
                    break
        node = Node(tag, _is_out(tag, match["rest"]))
        stack[-1].parts.append(node)
        stack[-1].children.append(node)
        if tag in RAW and not match["self"]:
            end = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(source, at)
            node.parts.append(source[at : end.start()] if end else source[at:])
            at = end.end() if end else len(source)
        elif tag not in VOID and not match["self"]:
            stack.append(node)


def _is_inline(node: Node) -> bool:
    return node.tag in INLINE and not node.out


def blocks(root: Node) -> list[tuple[int, int, bool, bool, str]]:
    """(element, number in it, out, in an article, text) of every block of text in page order. Inline elements belong to
    the block around them; the other elements are numbered as they begin."""
    found: list[tuple[int, int, bool, bool, str]] = []
    elements = 0

    def flush(block: dict) -> None:
        line = " ".join(entities.unescape("".join(block["text"])).split())
        block["text"].clear()
        if line:
            found.append((block["number"], block["lines"], block["out"], block["article"], line))
            block["lines"] += 1

    first = {"number": 0, "lines": 0, "out": False, "article": False, "text": []}
    stack = [(iter(root.parts), first, True)]
    while stack:
        parts, block, own = stack[-1]
        for x in parts:
            if isinstance(x, str):
                block["text"].append(x)
                continue
            if _is_inline(x):
                if x.tag == "br":
                    block["text"].append(" ")
                stack.append((iter(x.parts), block, False))
            else:
                flush(block)
                elements += 1
                inner = {"number": elements, "lines": 0, "out": block["out"] or x.out, "article": block["article"] or x.tag in ("article", "main"), "text": []}
                stack.append((iter(x.parts), inner, True))
            break
        else:
            if own:
                flush(block)
            stack.pop()
    return found


def _elements_in(node: Node) -> Iterator[Node]:
    """The next elements below that are not inline, in page order."""
    stack = [iter(node.children)]
    while stack:
        for c in stack[-1]:
            if _is_inline(c):
                stack.append(iter(c.children))
                break
            yield c
        else:
            stack.pop()


class Shapes:
    """Trees of tags and (out) marks. Each different tree has a number, so equal trees are found by comparing numbers; its
    elements are numbered as they begin, from 0 for the root."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.label: list[tuple] = []
        self.below: list[tuple[int, ...]] = []
        self.size: list[int] = []
        self.memo: dict[tuple[int, int], tuple[int, list]] = {}

    def add(self, tag: str, out: bool, below: tuple[int, ...]) -> int:
        key = (tag, out, below)
        if key not in self.numbers:
            self.numbers[key] = len(self.label)
            self.label.append((tag, out))
            self.below.append(below)
            self.size.append(1 + sum(self.size[c] for c in below))
        return self.numbers[key]

    def of(self, root: Node) -> int:
        stack: list[tuple[Node, Iterator[Node], list[int]]] = [(root, _elements_in(root), [])]
        while True:
            node, rest, below = stack[-1]
            child = next(rest, None)
            if child is not None:
                stack.append((child, _elements_in(child), []))
                continue
            number = self.add(node.tag, node.out, tuple(below))
            stack.pop()
            if not stack:
                return number
            stack[-1][2].append(number)

    def align(self, a: int, b: int) -> tuple[int, list[tuple[int, int]]]:
        """Simple tree matching: size of the largest top-down order-preserving match of two trees, and its pairs among
        the elements right below (positions)."""
        if self.label[a] != self.label[b]:
            return 0, []
        if a == b:
            return self.size[a], [(i, i) for i in range(len(self.below[a]))]
        stack = [(a, b)]
        while stack:
            pair = stack[-1]
            need = None if pair in self.memo else self._open_pairs(*pair)
            if need:
                stack += need
                continue
            if need is not None:
                self.memo[pair] = self._match(*pair)
            stack.pop()
        return self.memo[a, b]

    def _middle(self, a: int, b: int) -> tuple[tuple[int, ...], tuple[int, ...], int, int]:
        """What lies between the equal trees at the beginning and at the end; those match each other in a largest match."""
        xs, ys = self.below[a], self.below[b]
        most = min(len(xs), len(ys))
        head = next((i for i in range(most) if xs[i] != ys[i]), most)
        tail = next((i for i in range(most - head) if xs[-1 - i] != ys[-1 - i]), most - head)
        return xs[head : len(xs) - tail], ys[head : len(ys) - tail], head, tail

    def _open_pairs(self, a: int, b: int) -> list[tuple[int, int]]:
        xs, ys, _, _ = self._middle(a, b)
        others = set(ys)
        for x in dict.fromkeys(xs):
            open_ = [(x, y) for y in others if x != y and self.label[x] == self.label[y] and (x, y) not in self.memo]
            if open_:
                return open_
        return []

    def _weight(self, x: int, y: int) -> int:
        if x == y:
            return self.size[x]
        return self.memo[x, y][0] if self.label[x] == self.label[y] else 0

    def _match(self, a: int, b: int) -> tuple[int, list[tuple[int, int]]]:
        xs, ys, head, tail = self._middle(a, b)
        pairs = [(i, i) for i in range(head)]
        total = 1 + sum(self.size[c] for c in self.below[a][:head]) + sum(self.size[c] for c in self.below[a][len(self.below[a]) - tail :])
        if xs and ys:
            ux, of_x = np.unique(xs, return_inverse=True)
            uy, of_y = np.unique(ys, return_inverse=True)
            weights = np.array([[self._weight(x, y) for y in uy.tolist()] for x in ux.tolist()], np.int64)
            inner = _best_pairs(of_x, of_y, weights)
            total += int(sum(weights[of_x[i], of_y[j]] for i, j in inner))
            pairs += [(head + i, head + j) for i, j in inner]
        pairs += [(len(self.below[a]) - tail + i, len(self.below[b]) - tail + i) for i in range(tail)]
        return total, pairs

    def matched(self, a: int, b: int) -> dict[int, int]:
        """From the element numbers of b to those of a, for all matched elements."""
        out: dict[int, int] = {}
        stack = [(a, b, 0, 0)]
        while stack:
            a, b, ours, theirs = stack.pop()
            if a == b:
                out.update(zip(range(theirs, theirs + self.size[b]), range(ours, ours + self.size[a])))
                continue
            size, pairs = self.align(a, b)
            if not size:
                continue
            out[theirs] = ours
            starts = [np.cumsum([start + 1, *(self.size[c] for c in self.below[t])]) for t, start in ((a, ours), (b, theirs))]
            stack += [(self.below[a][i], self.below[b][j], int(starts[0][i]), int(starts[1][j])) for i, j in pairs]
        return out


def _rows(of_x: np.ndarray, of_y: np.ndarray, weights: np.ndarray) -> Iterator[np.ndarray]:
    """Row by row, the weight of the best order-preserving pairs of the first xs with the first ys."""
    row = np.zeros(len(of_y) + 1, np.int64)
    yield row
    for x in of_x:
        both = row[:-1] + weights[x][of_y]
        row = np.concatenate([[0], np.maximum.accumulate(np.maximum(row[1:], both))])
        yield row


def _best_pairs(of_x: np.ndarray, of_y: np.ndarray, weights: np.ndarray) -> list[tuple[int, int]]:
    """Order-preserving pairs with the largest sum of weights. The xs are halved until a table is small (Hirschberg)."""
    pairs: list[tuple[int, int]] = []
    stack = [(0, len(of_x), 0, len(of_y))]
    while stack:
        x0, x1, y0, y1 = stack.pop()
        xs, ys = of_x[x0:x1], of_y[y0:y1]
        if not len(xs) or not len(ys):
            continue
        if len(xs) > 1 and len(xs) * len(ys) > CELLS:
            mid = len(xs) // 2
            for before in _rows(xs[:mid], ys, weights):
                pass
            for behind in _rows(xs[:mid - 1 : -1], ys[::-1], weights):
                pass
            cut_at = int((before + behind[::-1]).argmax())
            stack += [(x0, x0 + mid, y0, y0 + cut_at), (x0 + mid, x1, y0 + cut_at, y1)]
            continue
        table = np.stack(list(_rows(xs, ys, weights)))
        i, j = len(xs), len(ys)
        while i and j:
            weight = weights[xs[i - 1], ys[j - 1]]
            if weight and table[i, j] == table[i - 1, j - 1] + weight:
                pairs.append((x0 + i - 1, y0 + j - 1))
                i, j = i - 1, j - 1
            elif table[i, j] == table[i - 1, j]:
                i -= 1
            else:
                j -= 1
    return sorted(pairs)


class Aligner:
    """Slots of a page's blocks. Trees repeat, so alignments are kept, up to KEPT trees and pairs of trees."""

    KEPT = 20_000

    def __init__(self):
        self._begin()

    def _begin(self) -> None:
        self.shapes = Shapes()
        self.references: dict[bytes, int] = {}
        self.found: dict[tuple[int, int], dict[int, int]] = {}
        self.held = 0

    def __call__(self, page: bytes, reference: bytes | None) -> list[tuple[str | None, bool, bool, str]]:
        """(slot or None, out, in an article, text) by block."""
        root = parse(page.decode("utf-8", "replace"))
        if reference is None:
            return [(None, *rest) for _, _, *rest in blocks(root)]
        if len(self.shapes.label) + len(self.shapes.memo) + self.held > self.KEPT:
            self._begin()
        if reference not in self.references:
            self.references[reference] = self.shapes.of(parse(reference.decode("utf-8", "replace")))
        ours, theirs = self.references[reference], self.shapes.of(root)
        if (ours, theirs) not in self.found:
            self.found[ours, theirs] = self.shapes.matched(ours, theirs)
            self.held += len(self.found[ours, theirs]) // 8
        place = self.found[ours, theirs]
        return [(f"{place[element]}.t{line}" if element in place else None, *rest) for element, line, *rest in blocks(root)]


def host(url: Column) -> Column:
    return F.regexp_extract(F.lower(F.coalesce(url.cast("string"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)


def _by_host(pages: DataFrame, table: DataFrame, size: int) -> DataFrame:
    return pages.join(F.broadcast(table) if size <= BROADCAST_BYTES else table, "host", "left")


def template(pages: DataFrame, size: int, references: DataFrame) -> DataFrame:
    """(host, constant): the slots of each host's reference that belong to its template."""

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        aligner = Aligner()
        for batch in batches:
            out: dict = {"host": [], "slot": [], "text": [], "page": []}
            columns = (batch.column(c).to_pylist() for c in ("host", "html", "reference"))
            for name, page, reference in zip(*columns):
                rows = [(slot, text) for slot, outside, _, text in aligner(page, reference) if not outside]
                page_hash = xxhash.xxh64_intdigest("\n".join(t for _, t in rows)) >> 1
                for slot, text in rows:
                    if slot:
                        out["host"].append(name)
                        out["slot"].append(slot)
                        out["text"].append(xxhash.xxh64_intdigest(text) >> 1)
                        out["page"].append(page_hash)
            yield out

    rows = arrow_flow(_by_host(pages, references, size), flow, "host string, slot string, text long, page long")
    texts = rows.distinct().groupBy("host", "slot", "text").agg(F.count(F.lit(1)).alias("n"))
    slots = texts.groupBy("host", "slot").agg(F.sum("n").alias("pages"), F.max("n").alias("same"))
    constant = slots.where((F.col("same") >= CONSTANT_SHARE * F.col("pages")) & (F.col("same") >= LEAST_PAGES))
    # At most as many slots as one page, the reference, has.
    return constant.groupBy("host").agg(F.collect_list("slot").alias("constant"))


def main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of `df`: id, url, `text`, `n_chars` (code points of the text).

    Null and empty pages give the empty text. A null url, or one without a host, belongs to the host "". A host with few
    different pages has no template, so only furniture is left out. If a page has content in an article or main element,
    content elsewhere is left out. Repeated rows give repeated rows; other columns are ignored.
    """
    pages = df.select(df[id_col].alias("id"), df[url_col].alias("url"), host(df[url_col]).alias("host"), text_bytes(df, html_col).alias("html"))
    some = pages.where(F.octet_length("html") > 0)
    references = cut(some.groupBy("host").agg(F.min_by("html", F.struct(F.xxhash64("html"), "html")).alias("reference")))
    size = references.agg(F.sum(F.octet_length("reference"))).first()[0] or 0
    constants = cut(template(pages.select("host", "html"), size, references))
    slots = constants.agg(F.sum(F.size("constant"))).first()[0] or 0
    joined = _by_host(_by_host(pages, references, size), constants, 32 * slots)

    def per_task():
        aligner = Aligner()

        def extract(page: bytes, reference: bytes | None, constant: list | None) -> str:
            dropped = set(constant or ())
            rows = [(a, text) for slot, outside, a, text in aligner(page, reference) if not outside and slot not in dropped]
            inside = [text for a, text in rows if a]
            return "\n".join(inside or [text for _, text in rows])

        def step(batch: pa.RecordBatch) -> dict:
            columns = (batch.column(c).to_pylist() for c in ("html", "reference", "constant"))
            text = [extract(*x) for x in zip(*columns)]
            return {"id": batch.column("id"), "url": batch.column("url"), "text": text, "n_chars": [len(t) for t in text]}

        return step

    kind = df.schema[id_col].dataType.simpleString()
    return arrow_map(joined, per_task, f"id {kind}, url string, text string, n_chars long").withColumnRenamed("id", id_col)
