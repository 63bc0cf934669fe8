"""Main text of web pages: structure, and line differences to the page with the nearest URL."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator, Sequence
from html.parser import HTMLParser
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import BATCH_ROWS, over_batches, prepare, written

# Pages that are put in URL order together, at most about.
CELL_PAGES = 20_000
# Places on either side of a page in URL order that it may be compared with.
REACH = 3
# Of them, so many at least must have a line of an article before it goes.
LEAST_BESIDE = 2

# Elements by what their text is.
NO_TEXT = frozenset("head script style noscript template svg iframe object canvas select textarea button datalist".split())
ASIDE = frozenset("nav footer aside form dialog menu".split())
MAIN = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
HOLDERS = frozenset("html body article main section div nav header footer aside form ul ol dl table td th li blockquote".split())
CLOSED_BY_OWN_KIND = frozenset("li dt dd tr td th option".split())
# Words in class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads advert advertisement advertising adverts banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notices newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead "
    "comment comments respond disqus share sharing social related popup modal contentinfo complementary search".split()
)
COMMENTS = frozenset("comment comments respond disqus".split())
# Words that turn a mark around (``no-sidebar``), and marks that an article's own parts carry.
TURNING = frozenset("no has have with without free".split())
OF_ARTICLES = frozenset("header masthead".split())
# Words that name a place or shape and leave a mark beside them what it is (``comment-list``);
# beside other words a mark is no mark within an article (``notice-period``, ``search-help``).
SHAPES = frozenset(
    "list box area section block wrapper wrap container holder link links post posts item items form bar buttons button widget "
    "inner slot unit thread top bottom left right main site page global group panel column col row count text title heading".split()
)

HIDDEN, BESIDE, OPEN, ARTICLE = 0, 1, 2, 3
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_URL = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)"


def marks_of(attrs: Sequence[tuple[str, str | None]], in_article: bool = False) -> set[str]:
    """Words of an element's classes, id and role, without those of a class that turns them around.

    Within an article a class of marks and other words is an article's own; whether such
    lines stay is left to the page difference.
    """
    names: set[str] = set()
    for key, value in attrs:
        if key in ("class", "id", "role") and value:
            for one in value.split():
                words = {w.lower() for w in _NAME.findall(one)}
                if not words & TURNING and not (in_article and words - MARKS - SHAPES):
                    names |= words
    return names


class Lines(HTMLParser):
    """Text blocks of a page with the part of the page they stand in.

    A block ends where a block element begins or ends. Unclosed elements end with the
    element around them, an open paragraph with the next block. Where an element of each name
    stands open is kept beside the stack, so that a tag costs the same at any depth.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int]] = []
        self.text: list[str] = []
        self.stack: list[tuple[str, int, bool]] = [("", OPEN, False)]
        self.open: dict[str, list[int]] = {}
        self.holders: list[int] = [0]
        self.asides = 0

    def push(self, tag: str, part: int, comments: bool) -> None:
        at = len(self.stack)
        self.stack.append((tag, part, comments))
        self.open.setdefault(tag, []).append(at)
        if tag in HOLDERS:
            self.holders.append(at)
        self.asides += tag in ASIDE

    def cut(self, at: int) -> None:
        """End the elements from a place of the stack on."""
        while len(self.stack) > at:
            tag = self.stack.pop()[0]
            self.open[tag].pop()
            if tag in HOLDERS:
                self.holders.pop()
            self.asides -= tag in ASIDE

    def last(self, tag: str) -> int:
        places = self.open.get(tag)
        return places[-1] if places else 0

    def parse_html_declaration(self, i):
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def flush(self) -> None:
        line = " ".join("".join(self.text).split())
        self.text.clear()
        if line and self.stack[-1][1] != HIDDEN:
            self.lines.append((line, self.stack[-1][1]))

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()
            self._end_open(tag)
        elif tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        _, part, comments = self.stack[-1]
        names = marks_of(attrs, part == ARTICLE)
        if part == ARTICLE:
            names -= OF_ARTICLES
        comments = comments or bool(names & COMMENTS)
        if tag in NO_TEXT or part == HIDDEN:
            now = HIDDEN
        elif comments:
            now = BESIDE
        elif tag in MAIN and not self.asides:
            now = ARTICLE
        elif tag in ASIDE or names & MARKS and tag not in ("html", "body") or tag == "header" and part != ARTICLE:
            now = BESIDE
        else:
            now = part
        if now != part:
            self.flush()
        self.push(tag, now, comments)

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)

    def _end_open(self, tag):
        """End what a new block ends: an open paragraph, or an item of its own kind."""
        at = max(self.last("p"), self.last(tag) if tag in CLOSED_BY_OWN_KIND else 0)
        if at and at >= self.holders[-1]:
            self.cut(at)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        at = self.last(tag)
        # An inline element does not end across the element that holds it.
        if not at or tag in INLINE and at < self.holders[-1]:
            return
        if any(x[1] != y[1] for x, y in zip(self.stack[at:], self.stack[at - 1 :])):
            self.flush()
        self.cut(at)

    def handle_data(self, data):
        if self.stack[-1][1] != HIDDEN:
            self.text.append(data)


def page_lines(html: str | None) -> list[tuple[str, int]]:
    """Blocks of text with their part of the page, in page order."""
    parser = Lines()
    parser.feed((html or "").replace("\x00", ""))
    parser.close()
    parser.flush()
    return parser.lines


def common_lines(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``.

    Rows of the table are kept as bits of whole numbers; very long pairs are halved first, so
    that memory stays bounded.
    """
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    inner, other = a[start : len(a) - end], b[start : len(b) - end]
    middle = _inner_lines(inner, other)
    return [*range(start), *[start + i for i in middle], *range(len(a) - end, len(a))]


def _rows(a: Sequence[int], b: Sequence[int]) -> Iterator[int]:
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        same = row & places.get(x, 0)
        row = ((row + same) | (row - same)) & full
        yield row


def _lengths(a: Sequence[int], b: Sequence[int]) -> np.ndarray:
    """Common lengths of ``a`` with every prefix of ``b``."""
    row = (1 << len(b)) - 1
    for row in _rows(a, b):
        pass
    bits = np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8)
    return np.concatenate([[0], np.cumsum(1 - np.unpackbits(bits, bitorder="little")[: len(b)].astype(np.int64))])


def _inner_lines(a: Sequence[int], b: Sequence[int], most: int = 1 << 31) -> list[int]:
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > most:
        half = len(a) // 2
        total = _lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]
        cut = int(total.argmax())
        return _inner_lines(a[:half], b[:cut], most) + [half + i for i in _inner_lines(a[half:], b[cut:], most)]
    rows = list(_rows(a, b))
    found, i, j = [], len(a), len(b)
    while i and j:
        bit = 1 << (j - 1)
        if rows[i - 1] & bit:
            j -= 1
            continue
        i -= 1
        if i and not rows[i - 1] & bit:
            continue
        found.append(i)
        j -= 1
    return found[::-1]


def _shared_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def candidates(found: Sequence[tuple[str, int]]) -> tuple[list[str], list[int] | None, list[str]]:
    """What may be main text, its places among the compared lines, and the compared lines.

    These are the lines of articles and all lines that nothing marks as something else; which
    of the latter belong to the site is left to the page difference. Lines of articles have
    negative places, counted from -1 down (a page of such lines alone has no list of places).
    All lines outside articles are compared with those of other pages.
    """
    compared = [x for x, p in found if p != ARTICLE]
    if not any(p == OPEN for _, p in found):
        inside = [x for x, p in found if p == ARTICLE]
        return inside, None if inside else [], compared
    kept, places, outside, inside = [], [], 0, 0
    for x, p in found:
        if p == ARTICLE:
            inside += 1
        else:
            outside += 1
        if p in (OPEN, ARTICLE):
            kept.append(x)
            places.append(-inside if p == ARTICLE else outside - 1)
    return kept, places, compared


def _parsed(pages: DataFrame) -> DataFrame:
    """The possible lines of every page, packed, with hashes of the lines to compare.

    ``marks`` are those outside articles, ``body`` those of articles.
    """

    def make():
        pack = zstandard.ZstdCompressor(level=6)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            lines, places, marks, body = [], [], [], []
            for html in batch.column(2).to_pylist():
                found = page_lines(html)
                kept, at, compared = candidates(found)
                lines.append(pack.compress("\n".join(kept).encode("utf-8", "replace")) if kept else None)
                places.append(at)
                marks.append([xxhash.xxh64_intdigest(x) - (1 << 63) for x in compared])
                body.append([xxhash.xxh64_intdigest(x) - (1 << 63) for x, p in found if p == ARTICLE])
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(lines, pa.binary()), pa.array(places, pa.list_(pa.int32())),
                 pa.array(marks, pa.list_(pa.int64())), pa.array(body, pa.list_(pa.int64()))],
                ["page_id", "url", "lines", "places", "marks", "body"],
            )

        return run

    kinds = dict(pages.dtypes)
    return over_batches(
        pages.select("page_id", "url", "html"), make,
        f"page_id {kinds['page_id']}, url string, lines binary, places array<int>, marks array<long>, body array<long>",
    ).withColumn("row", F.monotonically_increasing_id())


_PLACE = "host string, path string, lines_id long, marks array<long>, body array<long>"
_SHARED = "of_lines long, shared array<int>, repeated array<int>"


def _windows(places: Iterable[dict | None]) -> Iterator[list[dict | None]]:
    """Every place with REACH others on either side, in order."""
    held: deque[dict | None] = deque(maxlen=2 * REACH + 1)
    for place in places:
        held.append(place)
        if len(held) == 2 * REACH + 1:
            yield list(held)


def _shared_lines(window: Sequence[dict | None]) -> dict | None:
    """Lines of the middle place that do not belong to its page alone, if any.

    ``shared`` are lines outside articles that the nearest URL of the host has as well.
    ``repeated`` are lines of the article that stand in all articles within REACH, LEAST_BESIDE
    at least. A place that shares more than half of either article is a copy, which tells
    nothing, so that real copies of an article keep their lines.
    """
    own = window[REACH]
    near = [x if x is not None and x["host"] == own["host"] else None for x in window]
    beside = [x for x in (near[REACH - 1], near[REACH + 1]) if x]
    # Of two as near, the earlier one.
    nearest = max(beside, key=lambda x: _shared_prefix(own["path"], x["path"]), default=None)
    shared = common_lines(own["marks"], nearest["marks"]) if nearest else []
    repeated, told = set(range(len(own["body"]))), 0
    for other in (*near[:REACH], *near[REACH + 1 :]):
        if repeated and other and other["body"]:
            same = common_lines(own["body"], other["body"])
            if 2 * len(same) <= min(len(own["body"]), len(other["body"])):
                repeated &= set(same)
                told += 1
    if told < LEAST_BESIDE:
        repeated.clear()
    if not shared and not repeated:
        return None
    return {"of_lines": own["lines_id"], "shared": shared, "repeated": sorted(repeated)}


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, BATCH_ROWS)):
        yield pa.RecordBatch.from_pylist(some, schema)


def _in_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the places of one range; those at its ends come out whole, ``open`` if not compared yet."""

    def run() -> Iterator[dict]:
        n, first, last = 0, [], deque(maxlen=2 * REACH)

        def seen() -> Iterator[dict]:
            nonlocal n
            for place in _rows_of(batches):
                if n < 2 * REACH:
                    first.append(place)
                last.append((n, place))
                n += 1
                yield place

        for window in _windows(seen()):
            if found := _shared_lines(window):
                yield found
        for i, place in [*enumerate(first), *[x for x in last if x[0] >= 2 * REACH]]:
            yield place | {"open": i < REACH or i >= n - REACH}

    return _batches(run(), _RANGE_ROWS)


def _at_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the places that the ranges left open, among the ends of all ranges of a host."""
    outside = [None] * REACH
    found = (
        shared
        for window in _windows(chain(outside, _rows_of(batches), outside))
        if window[REACH]["open"] and (shared := _shared_lines(window))
    )
    return _batches(found, _SHARED_ROWS)


_SHARED_ROWS = pa.schema([("of_lines", pa.int64()), ("shared", pa.list_(pa.int32())), ("repeated", pa.list_(pa.int32()))])
_RANGE_ROWS = pa.schema(
    [*_SHARED_ROWS, ("host", pa.string()), ("path", pa.string()), ("lines_id", pa.int64()), ("marks", pa.list_(pa.int64())),
     ("body", pa.list_(pa.int64())), ("open", pa.bool_())]
)


def _differences(parsed: DataFrame, most: int) -> DataFrame:
    """Lines of each page that pages with near URLs of its host have as well.

    All places stand in one order by host and path, cut into ranges. A range is compared in
    one pass; the places at its ends meet those of the ranges beside it afterwards, so the
    cuts change nothing.
    """
    spark = parsed.sparkSession
    host, path = (F.regexp_extract(F.coalesce("url", F.lit("")), _URL, i) for i in (1, 2))
    rows = parsed.select("row", F.lower(host).alias("host"), path.alias("path"), "marks", "body")
    rows = rows.withColumn("lines_id", F.xxhash64("host", "marks", F.lit("|"), "body"))
    # Pages with the same lines tell nothing about what belongs to the site; they are one
    # place in the order, that of their first path, and get the same answer.
    kinds = rows.groupBy("host", "lines_id").agg(F.min("path").alias("path"), F.first("marks").alias("marks"), F.first("body").alias("body"))
    pages = parsed.count()
    ranges = max(1, -(-pages // most), min(spark.sparkContext.defaultParallelism, pages // BATCH_ROWS))
    order = ["host", "path", "lines_id"]
    dealt = kinds.select(*order, "marks", "body").repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    prepare(spark)
    passed = written(dealt.mapInArrow(_in_ranges, f"{_SHARED}, {_PLACE}, open boolean"), "page-ranges")
    ends = passed.where("open IS NOT NULL").select(*order, "marks", "body", "open")
    rest = ends.repartition("host").sortWithinPartitions(*order).mapInArrow(_at_ends, _SHARED)
    found = passed.where("of_lines IS NOT NULL").select("of_lines", "shared", "repeated").unionByName(rest)
    return rows.join(found, F.col("lines_id") == F.col("of_lines")).select(F.col("row").alias("at_row"), "shared", "repeated")


def main_texts(pages: DataFrame, cell_pages: int = CELL_PAGES) -> DataFrame:
    """Main text of every page: ``page_id, url, text, n_chars``.

    Pages are cut into lines (blocks) with the part of the page they stand in. Pages of a
    host are sorted by URL path, each is paired with the neighbour of other lines whose path
    shares the longer prefix, and their lines outside articles are aligned by longest common
    subsequence; shared lines are deleted. A line inside an article is deleted if it stands in
    the articles of all pages around in that order (REACH on either side, as far as the host
    has them, and LEAST_BESIDE at least) which are not copies, since pages may carry the same
    article or passage; menus, footers and the like are left out by structure as well, so that
    a page without a neighbour is right. Lines around an article that nothing marks stay
    unless the difference deletes them. The order is cut into ranges of about ``cell_pages`` pages, whose ends meet, so that hosts of any size are paired alike.
    Only hashes of lines are compared, and the packed lines are shuffled once.

    A null or empty page has the empty text; a null URL belongs to the host with no name;
    repeated rows each have a row; an empty table gives none; other columns are ignored.
    """
    parsed = written(_parsed(pages), "page-lines")
    found = _differences(parsed, cell_pages)
    joined = parsed.drop("marks", "body").join(found, F.col("row") == F.col("at_row"), "left")

    def make():
        unpack = zstandard.ZstdDecompressor()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = []
            for packed, places, shared, repeated in zip(*[batch.column(i).to_pylist() for i in (2, 3, 4, 5)]):
                lines = unpack.decompress(packed).decode().split("\n") if packed else []
                if shared or repeated:
                    gone = {*(shared or ()), *(-1 - i for i in repeated or ())}
                    at_lines = range(-1, -1 - len(lines), -1) if places is None else places
                    lines = [x for x, at in zip(lines, at_lines) if at not in gone]
                texts.append("\n".join(lines))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

        return run

    kind = dict(pages.dtypes)["page_id"]
    return over_batches(
        joined.select("page_id", "url", "lines", "places", "shared", "repeated"), make, f"page_id {kind}, url string, text string, n_chars long"
    )
