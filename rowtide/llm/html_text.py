"""Main text of web pages by deduction of the sites' templates from equivalence classes (operator 6).

A page is a sequence of tokens: the page itself, elements, named by their path, and whole text nodes.
Per host, round by round:

1. Tokens that occur equally often on every page, whose occurrence vectors are equal, form a class. The
   vectors are never built: the sums of the halves of a hash of (page, count) over the pages are the same
   for equal vectors, and they are added up within tasks first, so a host with a third of all pages is only
   one row per task and token. A class counts that has ``MIN_CLASS`` tokens and is on ``MIN_PAGES``
   different pages and on ``SUPPORT`` of the host's, so that odd pages leave the others their template.
2. The tokens of a class must follow each other in one order, on every page and at every repetition. The
   order is that of the sums of their places. Tokens that are outside a longest ordered part somewhere
   leave the class, which goes if too few stay.
3. Two classes must be apart, or one lie in one slot of the other wherever it occurs; a slot is what lies
   between two consecutive tokens of a class. Of two that cross, the later found goes, then that on fewer
   pages, then that of fewer tokens. The others form a tree.
4. A token that is not in the tree is another one in each slot. So equal tokens get different roles, and
   the next round finds the classes of each slot; there, tokens with the vector of the class around them
   are part of it, however few. The rounds end when one adds nothing.

The tree is the template. Text of a page is a slot's content: a text node that is not part of the
template in the slot where it stands. It counts if no element around it is named as page furniture, and, where the page
has an article or main part, if it lies in one. All such slots are extracted, in page order. A name
counts where it is the head of a class, id or role (``cookie-notice``, not ``has-sidebar`` or
``search-results``). Where names at or around the article or main part leave nothing of it, they do
not count.

Nulls and ties: null html is an empty page, with an empty text. Pages without a host in their url
share one; hosts of fewer than ``MIN_PAGES`` different pages have no template, and the elements
decide alone. Copies of a page count once for the template; pages without tokens, empty ones too, do
not count. Rows that repeat a page_id each give a
row. Broken markup is read as far as it goes. Other columns are not read. An empty table gives no
rows.
"""

from __future__ import annotations

import html
import itertools
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.shared import prepare, stage

#: Characters of html that are read at once, if they are of one host.
READ_AT_ONCE = 1 << 20
#: Different pages and share of the host's pages that a class must be on, and tokens it must have.
MIN_PAGES, SUPPORT, MIN_CLASS = 10, 0.5, 3

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead"),
    "tfoot": ("tr", "td", "th", "tbody"),
}
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
SCOPE = frozenset("ul ol dl table article section div main body html nav aside header footer form".split())

#: Elements that are furniture wherever they stand, and those that are outside of an article only.
FURNITURE = frozenset(
    "aside button canvas datalist dialog embed footer form frame frameset head iframe input menu nav noembed noframes "
    "noscript object script select style svg template textarea title".split()
)
OUTSIDE = frozenset(("header",))
#: Words in class, id or role that name furniture; the second set counts outside of an article only.
NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies dialog disqus footer gdpr menu modal nav navbar navigation "
    "newsletter notice notices popup promo promoted promotion replies respond search share sharing sidebar signup "
    "social sponsor sponsored subscribe subscription toolbar widget".split()
)
OUTSIDE_NAMES = frozenset("header masthead".split())
MAIN = frozenset("article main".split())
#: Words that say of a name that something else has it or not, and words that may follow a name.
MODIFIERS = frozenset("disable disabled enable enabled has have hide is no not show with without".split())
TAILS = frozenset(
    "area bar block body bottom box button buttons container content form group inner item items left link links list "
    "outer panel primary right secondary section slot top unit wrap wrapper".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>?|([^<]++|<)", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")


class _Element:
    __slots__ = ("tag", "path", "furniture", "main", "sure", "block", "scope")

    def __init__(self, tag: str, path: int, furniture: bool, main: bool, sure: bool):
        self.tag, self.path, self.furniture, self.main, self.sure = tag, path, furniture, main, sure
        # Depths of the nearest elements at or around it that are no inline ones, and that bound a scope.
        self.block = self.scope = 0


class _Open:
    """The open elements, and where those of each name are, so that an end tag costs a look and no walk."""

    def __init__(self) -> None:
        self.stack = [_Element("", 0, False, False, False)]
        self.depths: defaultdict[str, list[int]] = defaultdict(list)

    @property
    def top(self) -> _Element:
        return self.stack[-1]

    def push(self, element: _Element) -> None:
        depth = len(self.stack)
        element.block = self.top.block if element.tag in INLINE else depth
        element.scope = depth if element.tag in SCOPE else self.top.scope
        self.stack.append(element)
        self.depths[element.tag].append(depth)

    def innermost(self, tag: str) -> int:
        """Depth of the innermost open element of the name, 0 for none."""
        depths = self.depths.get(tag)
        return depths[-1] if depths else 0

    def close(self, depth: int) -> None:
        """Close the element at the depth and all in it."""
        for element in self.stack[depth:]:
            self.depths[element.tag].pop()
        del self.stack[depth:]


def _hash(text: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed)


def _heads(value: str) -> Iterator[str]:
    """The words that the classes, ids or roles in a value are named by."""
    for token in value.split():
        words = _NAME.findall(token)
        while len(words) > 1 and words[-1] in TAILS:
            words.pop()
        if words and MODIFIERS.isdisjoint(words[:-1]):
            yield words[-1]


class Page:
    """Tokens of a page and its text nodes: path, text, how far in furniture, whether in a main part.

    Furniture is 0 for none, 1 if only names at or around the outermost main part say so, and 2.
    """

    def __init__(self, source: str):
        self.opened: list[int] = []
        self.texts: list[tuple[int, str, int, bool, int] | None] = []
        stack = _Open()
        at, lower = 0, None
        while match := _TOKEN.match(source, at):
            at = match.end()
            closing, name, attributes, text = match.groups()
            if text is not None:
                self._text(stack.top, text)
            elif name is None:
                continue
            elif closing:
                self._close(stack, name.lower())
            else:
                tag = name.lower()
                element = self._open(stack, tag, attributes)
                if tag in RAW:
                    lower = source.lower() if lower is None else lower
                    # lower() may change the length of rare letters; then the search is done without it
                    where = lower if len(lower) == len(source) else source
                    end = where.find(f"</{tag}", at)
                    end = len(source) if end < 0 else end
                    if not element.furniture:
                        self._text(element, source[at:end])
                    at = end
        self.tokens = Counter(self.opened)
        self.found = list(self.blocks())

    def _text(self, element: _Element, raw: str) -> None:
        self.texts.append((element.path, raw, element.furniture + element.sure, element.main, len(self.opened)))

    def _break(self) -> None:
        self.texts.append(None)

    def _open(self, stack: _Open, tag: str, attributes: str) -> _Element:
        for other in CLOSES.get(tag, ()):
            self._close_in_scope(stack, other)
        if tag in ENDS_P:
            self._close_in_scope(stack, "p")
        top = stack.top
        names: list[str] = []
        heads: set[str] = set()
        hidden = False
        if attributes and "=" in attributes or "hidden" in attributes:
            for key, *values in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), "".join(values).lower()
                if key in ("class", "id", "role"):
                    names += _NAME.findall(value)
                    heads.update(_heads(value))
                hidden |= key == "hidden" or key == "aria-hidden" and value == "true"
                hidden |= key == "style" and "display:none" in value.replace(" ", "")
        named = not NAMES.isdisjoint(heads) or not top.main and not OUTSIDE_NAMES.isdisjoint(heads)
        main = top.main or tag in MAIN or "main" in names and tag == "div" and not named
        own = hidden or tag in FURNITURE or not top.main and tag in OUTSIDE
        furniture = top.furniture or own or named
        sure = top.sure or own or named and top.main
        if tag in ("html", "body"):
            furniture = sure = False
        path = _hash(f"{top.path:x}/{tag}.{' '.join(names)}")
        self.opened.append(path)
        element = _Element(tag, path, furniture, main, sure)
        if tag not in INLINE:
            self._break()
        if tag not in VOID and tag not in RAW:
            stack.push(element)
        return element

    def _close(self, stack: _Open, tag: str) -> None:
        depth, block = stack.innermost(tag), stack.top.block
        if depth and not (tag in INLINE and block > depth):
            if block >= depth:
                self._break()
            stack.close(depth)
        elif not depth and tag in ("p", "br"):
            self._break()

    def _close_in_scope(self, stack: _Open, tag: str) -> None:
        depth = stack.innermost(tag)
        if depth > stack.top.scope:
            stack.close(depth)

    def blocks(self) -> Iterator[tuple[int, str, int, bool, int]]:
        """Path, text with single spaces, furniture, main and elements before it of every stretch between block marks."""
        parts: list[tuple[int, str, int, bool, int]] = []
        for item in [*self.texts, None]:
            if item is not None:
                parts.append(item)
                continue
            for furniture in range(3):
                own = [p for p in parts if p[2] == furniture]
                text = _SPACE.sub(" ", html.unescape("".join(p[1] for p in own))).strip()
                if text:
                    yield own[0][0], text, furniture, any(p[3] for p in own), own[0][4]
            parts = []

    def sequence(self) -> tuple[np.ndarray, np.ndarray]:
        """The tokens in page order, 0 for the page itself first, and the number of the block of each that is a text, or -1."""
        blocks = self.found
        if not blocks and not self.opened:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        texts = [_text_token(path, text) for path, text, *_ in blocks]
        tokens = np.array([0, *self.opened, *texts], np.uint64).view(np.int64)
        number = np.append(np.full(len(self.opened) + 1, -1), np.arange(len(blocks)))
        # a text comes after the elements that were opened before it
        place = np.append(2 * np.arange(len(self.opened) + 1), [2 * at + 1 for *_, at in blocks])
        by = np.argsort(place, kind="stable")
        return tokens[by], number[by]


def _text_token(path: int, text: str) -> int:
    return _hash(text, path & 0xFFFFFFFF)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def page_sequences(pages: DataFrame) -> DataFrame:
    """host, page (a hash of its html), copies (rows of the host with that page), packed tokens and marks of texts.

    Only pages with copies are counted by key, and joined; of a page with very many, every task adds up its own.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Page(source).sequence() for source in batch.column(2).to_pylist()]
            some = [i for i, (tokens, _) in enumerate(found) if len(tokens)]
            named = batch.select(["host", "page"]).take(pa.array(some, pa.int32()))
            tokens = pa.array([found[i][0].tobytes() for i in some], pa.binary())
            texts = pa.array([np.packbits(found[i][1] >= 0).tobytes() for i in some], pa.binary())
            yield pa.RecordBatch.from_arrays([*named.columns, tokens, texts], names=["host", "page", "tokens", "texts"])

    chosen = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html")).where("html != ''")
    chosen = chosen.select("host", F.xxhash64("html").alias("page"), "html")
    copied = chosen.groupBy("host", "page").agg(F.count("*").alias("copies")).where("copies > 1")
    parsed = chosen.mapInArrow(read, "host string, page long, tokens binary, texts binary").join(copied, ["host", "page"], "left")
    return parsed.select("host", "page", F.coalesce("copies", F.lit(1)).alias("copies"), "tokens", "texts")


def _mixed(left: np.ndarray, right: np.ndarray | int) -> np.ndarray:
    out = left.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(right, np.int64).view(np.uint64)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return (out ^ out >> np.uint64(32)).view(np.int64)


_NODE = (
    "level int, cls long, rank int, size int, token long, is_text boolean, "
    "high long, low long, count long, support long"
)
_NODES = f"host string, pages long, {_NODE}"
_FIELDS = [field.split()[0] for field in _NODE.split(", ")]


class _Tree:
    """Nodes of a host's tree of classes, as columns."""

    def __init__(self, nodes: pa.StructArray | None):
        names = ("level", "cls", "rank", "size", "token")
        columns = [np.zeros(0, np.int64)] * 5 if nodes is None else [nodes.field(f).to_numpy(False).astype(np.int64) for f in names]
        self.level, self.cls, self.rank, self.size, self.token = columns

    def steps(self, node: np.ndarray, page: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Page, class, rank and size of nodes one behind the other."""
        return zip(page.tolist(), self.cls[node].tolist(), self.rank[node].tolist(), self.size[node].tolist(), strict=True)

    def slots(self, node: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Innermost slot (0 for none) and its class of every place that is no node."""
        at = np.flatnonzero(node >= 0)
        page = np.repeat(np.arange(len(lengths)), lengths)
        after: list[tuple[int, int]] = [(0, 0)]
        around: list[tuple[int, int]] = []
        last = -1
        for own, cls, rank, size in self.steps(node[at], page[at]):
            if own != last:
                around, last = [], own
            if rank and around:
                around.pop()
            if rank + 1 < size:
                around.append((cls, rank + 1))
            after.append(around[-1] if around else (0, 0))
        before = np.cumsum(node >= 0)
        first = np.repeat(before[np.cumsum(lengths) - lengths] - (node[np.cumsum(lengths) - lengths] >= 0), lengths)
        outer, rank = np.array(after, np.int64)[np.where(before > first, before, 0)].T
        return np.where(rank > 0, _mixed(rank, outer), 0), outer

    def roles(self, tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """Role, node (-1 for none), slot and its class of every token of pages one behind the other."""
        role, node = tokens.copy(), np.full(len(tokens), -1)
        slot, outer = np.zeros(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
        for level in np.unique(self.level).tolist():
            own = np.flatnonzero(self.level == level)
            own = own[np.argsort(self.token[own])]
            near = own[np.minimum(np.searchsorted(self.token[own], role), len(own) - 1)]
            node = np.where((node < 0) & (self.token[near] == role), near, node)
            slot, outer = self.slots(node, lengths)
            role = np.where(node < 0, _mixed(tokens, slot), tokens)
        return role, node, slot, outer


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, _Tree, np.ndarray, np.ndarray]]:
    """Host, first row, row after the last, tree, tokens and their number per row, of rows of one host that follow each other."""
    hosts, nodes, packed = batch.column("host").to_pylist(), batch.column("nodes"), batch.column("tokens").to_pylist()
    begin = 0
    for host, rows in itertools.groupby(hosts):
        end = begin + sum(1 for _ in rows)
        tree = _Tree(nodes[begin].values if nodes[begin].is_valid else None)
        tokens = np.frombuffer(b"".join(packed[begin:end]), "<i8")
        yield host, begin, end, tree, tokens, np.array([len(p) // 8 for p in packed[begin:end]])
        begin = end


def page_tokens(sequences: DataFrame) -> DataFrame:
    """host, page, copies, slot, outer (class of the slot), token, n, place (the first) and is_text, of tokens outside the tree."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column("texts").to_pylist()
            for _, begin, end, tree, tokens, lengths in _runs(batch):
                role, node, slot, outer = tree.roles(tokens, lengths)
                bits = [np.unpackbits(np.frombuffer(m, np.uint8), count=n) for m, n in zip(marks[begin:end], lengths.tolist(), strict=True)]
                row = np.repeat(np.arange(begin, end), lengths)
                place = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                by = np.lexsort((role, row))
                by = by[node[by] < 0]
                new = np.flatnonzero(np.append(True, (np.diff(row[by]) != 0) | (np.diff(role[by]) != 0))[: len(by)])
                first = by[new]
                named = batch.select(["host", "page", "copies"]).take(pa.array(row[first]))
                columns = [slot[first], outer[first], role[first], np.diff(np.append(new, len(by))), place[first], np.concatenate(bits)[first] > 0]
                yield pa.RecordBatch.from_arrays(
                    [*named.columns, *map(pa.array, columns)],
                    names=["host", "page", "copies", "slot", "outer", "token", "n", "place", "is_text"],
                )

    return sequences.mapInArrow(
        read, "host string, page long, copies long, slot long, outer long, token long, n long, place long, is_text boolean"
    )


def classes(tokens: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """host, slot, token, is_text, high and low (the class, by its occurrence vector), support, size, pages and valid.

    Copies of a page are in all sums, alike for all tokens on it, so equal vectors stay equal; support is
    the number of different pages. Tokens of a class have one support, so those of too small a one are left
    out before the sizes are taken. ``known`` are the nodes of the rounds before.
    """
    vector = F.xxhash64("page", "n")
    found = tokens.groupBy("host", "slot", "outer", "token", "is_text").agg(
        F.sum(F.shiftright(vector, 32)).alias("high"), F.sum(vector.bitwiseAND(F.lit((1 << 32) - 1))).alias("low"),
        F.round(F.sum(1 / F.col("copies"))).cast("long").alias("support"), F.sum("place").alias("place"), F.count("*").alias("count"),
    )
    found = stage(found.where(F.col("support") >= MIN_PAGES))
    sizes = found.groupBy("host", "slot", "high", "low").agg(F.count("*").cast("int").alias("size"))
    found = found.join(sizes, ["host", "slot", "high", "low"])
    part = F.lit(False)
    if known is None:
        found = found.join(found.where("token = 0").select("host", F.col("support").alias("pages")), "host")
    else:
        of = known.select("host", F.col("cls").alias("outer"), F.col("high").alias("_high"), F.col("low").alias("_low")).distinct()
        found = found.join(known.select("host", "pages").distinct(), "host").join(of, ["host", "outer"], "left")
        part = F.coalesce((F.col("high") == F.col("_high")) & (F.col("low") == F.col("_low")), part)
    found = found.withColumn("valid", (F.col("support") >= SUPPORT * F.col("pages")) & ((F.col("size") >= MIN_CLASS) | part))
    return found.withColumn("least", F.when(part, 1).otherwise(MIN_CLASS)).drop("_high", "_low")


def _packed(nodes: DataFrame) -> DataFrame:
    """host and its nodes: each is on SUPPORT of the pages, so they are no more than 1 / SUPPORT times the tokens of a mean page."""
    return nodes.groupBy("host").agg(F.collect_list(F.struct(*_FIELDS)).alias("nodes"))


def _outside(keys: list[int]) -> list[int]:
    """Which of the keys are outside a longest increasing part."""
    tails: list[int] = []
    at: list[int] = []
    back = []
    for i, key in enumerate(keys):
        k = bisect_left(tails, key)
        tails[k:k + 1], at[k:k + 1] = [key], [i]
        back.append(at[k - 1] if k else -1)
    kept, i = set(), at[-1] if at else -1
    while i >= 0:
        kept.add(i)
        i = back[i]
    return [i for i in range(len(keys)) if i not in kept]


def structure(sequences: DataFrame, level: int) -> DataFrame:
    """host and either token, one of a class of the level that is out of order somewhere, or inner, outer, low, high and n.

    These say of two classes on how many pages (n) tokens of inner are in slots of outer, and between which two
    slots (0: beside them).
    """
    schema = pa.schema([
        ("host", pa.string()), ("token", pa.int64()), ("inner", pa.int64()), ("outer", pa.int64()), ("low", pa.int64()),
        ("high", pa.int64()), ("n", pa.int64()),
    ])

    def disorder(tree: _Tree, node: np.ndarray, page: np.ndarray) -> set[int]:
        by = np.flatnonzero(tree.level[node] == level)
        if not len(by):
            return set()
        by = by[np.lexsort((tree.cls[node[by]], page[by]))]
        node, cls, page = node[by], tree.cls[node[by]], page[by]
        begins = np.flatnonzero(np.append(True, (np.diff(cls) != 0) | (np.diff(page) != 0))[: len(by)])
        ends = np.append(begins[1:], len(by))
        turn = np.arange(len(by)) - np.repeat(begins, ends - begins)
        wrong = tree.rank[node] != turn % tree.size[node]
        out: set[int] = set()
        for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
            if wrong[begin:end].any():
                times: Counter[int] = Counter()
                keys = []
                for i in node[begin:end].tolist():
                    keys.append(times[i] * int(tree.size[i]) + int(tree.rank[i]))
                    times[i] += 1
                out.update(int(tree.token[node[begin + k]]) for k in _outside(keys))
        return out

    def pairs(tree: _Tree, node: np.ndarray, page: np.ndarray) -> Iterator[tuple[int, ...]]:
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        for _, steps in itertools.groupby(tree.steps(node, page), key=lambda step: step[0]):
            around: dict[int, int] = {}
            times: Counter[int] = Counter()
            seen: dict[tuple[int, int], list[int]] = {}
            for _, cls, rank, size in steps:
                times[cls] += 1
                for outer, slot in around.items():
                    if outer != cls:
                        seen.setdefault((cls, outer), []).append(slot)
                if rank + 1 < size:
                    around[cls] = rank + 1
                else:
                    around.pop(cls, None)
            for pair, own in seen.items():
                low, high, n = found.get(pair, (max(own), 0, 0))
                found[pair] = (min(low, *own) if len(own) == times[pair[0]] else 0, max(high, *own), n + 1)
        return ((*pair, *told) for pair, told in found.items())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, _, _, tree, tokens, lengths in _runs(batch):
                node = tree.roles(tokens, lengths)[1]
                at = np.flatnonzero(node >= 0)
                if len(at):
                    page = np.repeat(np.arange(len(lengths)), lengths)[at]
                    rows += [(host, token, None, None, None, None, None) for token in sorted(disorder(tree, node[at], page))]
                    rows += [(host, None, *pair) for pair in pairs(tree, node[at], page)]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    found = sequences.mapInArrow(read, "host string, token long, inner long, outer long, low long, high long, n long")
    return found.groupBy("host", "token", "inner", "outer").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))


def _ranked(nodes: DataFrame) -> DataFrame:
    """Candidate nodes whose classes still have tokens enough, with size and rank in the class's order."""
    of = Window.partitionBy("host", "cls")
    nodes = nodes.withColumn("size", F.count("*").over(of).cast("int")).where("size >= least")
    return nodes.withColumn("rank", (F.row_number().over(of.orderBy("place", "token")) - 1).cast("int"))


def grown(sequences: DataFrame, known: DataFrame | None, found: DataFrame, level: int) -> DataFrame:
    """Nodes of the tree with those of a level's valid classes that are ordered and cross none before them."""
    ids = F.xxhash64("high", "low", "slot", F.lit(level))
    chosen = found.where("valid").withColumns({"cls": ids, "level": F.lit(level)})
    chosen = chosen.select("host", "pages", *(f for f in _FIELDS if f not in ("rank", "size")), "place", "least")
    while True:
        chosen = stage(_ranked(chosen))
        every = chosen.select("host", "pages", *_FIELDS)
        if known is not None:
            every = known.unionByName(every)
        told = stage(structure(sequences.join(_packed(every), "host"), level))
        displaced = told.where("token is not null").select("host", "token")
        if displaced.isEmpty():
            break
        chosen = chosen.drop("size", "rank").join(displaced, ["host", "token"], "left_anti")
    order = F.struct("level", -F.col("count"), -F.col("size"), "cls")
    of = every.select("host", "cls", "count", order.alias("order")).distinct()
    pairs = told.where("token is null").join(of.selectExpr("host", "cls inner", "count", "order of_inner"), ["host", "inner"])
    pairs = pairs.join(of.selectExpr("host", "cls outer", "order of_outer"), ["host", "outer"])
    cross = pairs.where("low != high or n != count").select(
        "host", F.when(F.col("of_inner") > F.col("of_outer"), F.col("inner")).otherwise(F.col("outer")).alias("cls")
    )
    return stage(every.join(cross.distinct(), ["host", "cls"], "left_anti").select("host", "pages", *_FIELDS))


def trees(pages: DataFrame) -> DataFrame:
    """Nodes (host, pages, level, class, rank in it, token ...) of the hosts' templates."""
    sequences = stage(page_sequences(pages).sortWithinPartitions("host"))
    nodes = None
    for level in itertools.count(1):
        placed = sequences.withColumn("nodes", F.lit(None).cast(f"array<struct<{_NODE.replace(' ', ':').replace(',:', ',')}>>"))
        if nodes is not None:
            placed = sequences.join(_packed(nodes), "host")
        found = stage(classes(page_tokens(placed), nodes).where("valid"))
        if found.isEmpty():
            break
        more = grown(sequences, nodes, found, level)
        if more.where(F.col("level") == level).isEmpty():
            break
        nodes = more
    return pages.sparkSession.createDataFrame([], _NODES) if nodes is None else nodes


def templates(pages: DataFrame) -> DataFrame:
    """host, nodes of its template, and the texts that are part of it in every slot."""
    plain = F.when(F.col("is_text") & (F.col("level") == 1), F.col("token"))
    nodes = trees(pages)
    return _packed(nodes).join(nodes.groupBy("host").agg(F.sort_array(F.collect_list(plain)).alias("template")), "host")


def page_text(source: str | Page, gone: Collection[int] = ()) -> str:
    """The main text: a line per block, without the blocks of some numbers."""
    page = source if isinstance(source, Page) else Page(source)
    every = [(i, *b[1:4]) for i, b in enumerate(page.found) if b[2] < 2]
    blocks = [b for b in every if not b[2]]
    if not any(main for *_, main in blocks) and any(main for *_, main in every):
        blocks = every
    if any(main for *_, main in blocks):
        blocks = [b for b in blocks if b[3]]
    return "\n".join(text for i, text, *_ in blocks if i not in gone)


def template_blocks(read: list[Page], nodes: pa.Scalar) -> list[Collection[int]]:
    """Numbers of the blocks that are part of the host's template, for every page."""
    gone: list[Collection[int]] = [()] * len(read)
    sequences = [page.sequence() for page in read] if nodes.is_valid else []
    some = [k for k, (tokens, _) in enumerate(sequences) if len(tokens)]
    if some:
        lengths = np.array([len(sequences[k][0]) for k in some])
        node = _Tree(nodes.values).roles(np.concatenate([sequences[k][0] for k in some]), lengths)[1]
        for k, own in zip(some, np.split(node, np.cumsum(lengths)[:-1]), strict=True):
            gone[k] = frozenset(sequences[k][1][own >= 0].tolist())
    return gone


def portions(hosts: list[str], sources: list[str | None]) -> Iterator[list[int]]:
    """Numbers of pages of one host, of READ_AT_ONCE characters or one page."""
    rows, held = [], 0
    for i in sorted(range(len(hosts)), key=hosts.__getitem__):
        if rows and (hosts[i] != hosts[rows[0]] or held + len(sources[i] or "") > READ_AT_ONCE):
            yield rows
            rows, held = [], 0
        rows.append(i)
        held += len(sources[i] or "")
    if rows:
        yield rows


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    prepare(pages.sparkSession)
    found = stage(_packed(trees(pages)))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, nodes = batch.column("host").to_pylist(), batch.column("nodes")
            sources = batch.column("html").to_pylist()
            texts = [""] * len(hosts)
            for rows in portions(hosts, sources):
                read = [Page(sources[i] or "") for i in rows]
                gone = template_blocks(read, nodes[rows[0]])
                for i, page, numbers in zip(rows, read, gone, strict=True):
                    texts[i] = page_text(page, numbers)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    chosen = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"), host_of(F.col("url")).alias("host")
    ).join(found, "host", "left")
    return chosen.select("page_id", "url", "html", "host", "nodes").mapInArrow(extract, "page_id long, url string, text string, n_chars long")
