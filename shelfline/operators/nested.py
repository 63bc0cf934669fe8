"""Elements of raw pages by the nesting of their tags.

A page is cut ahead of every tag of one name, and the pieces are folded with a stack of the
elements that are open: an end tag closes the innermost, whatever stands between. All of it
is built-in expressions over one page at a time; no step shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A tag up to its end; quoted attributes may hold the end character.
_ATTRIBUTES = r"""(?:[^'">]++|"[^"]*+"|'[^']*+')*+"""
OPEN_TAG = f"^<{_ATTRIBUTES}>?"
TAG = f"</?[A-Za-z]{_ATTRIBUTES}>"
# What is no markup of the page: comments, scripts and styles.
NO_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# Items end where the next item of their list begins, or with the list.
LISTS = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
_CUT = "\u0001"
_SPAN = "array<struct<start: int, end: int>>"
_OPEN = "array<struct<start: int, level: int, hit: boolean>>"


def markup(html: Column) -> Column:
    """A page without comments, scripts and styles."""
    return F.regexp_replace(html, NO_MARKUP, "")


def _pieces(html: Column, names: tuple[str, ...]) -> Column:
    """A page cut ahead of every tag of the names; the first piece stands before the first of them."""
    ahead = rf"(?i)(?=</?(?:{'|'.join(names)})(?:[\s/>]|$))"
    return F.split(F.regexp_replace(F.replace(markup(html), F.lit(_CUT), F.lit("")), ahead, _CUT), _CUT)


def _token(tag: str, lists: tuple[str, ...], where: str | None) -> Callable[[Column], Column]:
    """What a piece begins with: an opened (1) or closed (-1) element, a list's begin (2) or end (-2)."""

    def begins(piece: Column, names: tuple[str, ...], end: bool) -> Column:
        return piece.rlike(rf"^(?i)<{'/' if end else ''}(?:{'|'.join(names)})(?:[\s/>]|$)")

    def token(piece: Column) -> Column:
        kind = F.when(begins(piece, (tag,), False), 1).when(begins(piece, (tag,), True), -1)
        if lists:
            kind = kind.when(begins(piece, lists, False), 2).when(begins(piece, lists, True), -2)
        hit = F.lit(True) if where is None else F.regexp_extract(piece, OPEN_TAG, 0).rlike(where)
        kind = kind.otherwise(0)
        return F.struct(kind.alias("kind"), (hit & (kind == 1)).alias("hit"))

    return token


def _step(state: Column, token: Column, in_lists: bool) -> Column:
    """One piece further: ``at`` counts pieces, ``level`` open lists; ``open`` is the stack."""
    at, level, stack, spans = (state[x] for x in ("at", "level", "open", "spans"))
    top = F.get(stack, F.size(stack) - 1)
    kind = token["kind"]
    ends = kind == -1
    if in_lists:
        # An item ends at its own level: by its end tag, the next item, or its list's end.
        ends = ((kind == -1) | (kind == 1) | (kind == -2)) & (top["level"] == level)
    ends = ends & top["start"].isNotNull()
    left = F.when(ends, F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0)))).otherwise(stack)
    found = F.array(F.struct(top["start"].alias("start"), at.alias("end")))
    opened = F.array(F.struct(at.alias("start"), level.alias("level"), token["hit"].alias("hit")))
    deeper = F.when(kind == 2, level + 1).when(kind == -2, F.greatest(level - 1, F.lit(0))).otherwise(level)
    return F.struct(
        (at + 1).alias("at"),
        deeper.alias("level"),
        F.when(kind == 1, F.concat(left, opened)).otherwise(left).alias("open"),
        F.when(ends & top["hit"], F.concat(spans, found)).otherwise(spans).alias("spans"),
    )


def elements(html: Column, tag: str, where: str | None = None) -> Column:
    """The markup inside every element of a tag, in page order, nested elements included.

    ``where`` is a pattern that the opening tag must hold, such as a class. An element without
    an end tag reaches to the end of the page; an end tag without an element is passed over.
    Items of lists and cells of tables also end where HTML lets their end tags be left out. A
    null page has no elements (null).
    """
    lists = LISTS.get(tag, ())
    pieces = _pieces(html, (tag, *lists))
    empty = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("level"), F.array().cast(_OPEN).alias("open"), F.array().cast(_SPAN).alias("spans")
    )

    def done(state: Column) -> Column:
        # Elements that nothing closes end with the page.
        rest = F.transform(F.filter(state["open"], lambda o: o["hit"]), lambda o: F.struct(o["start"].alias("start"), state["at"].alias("end")))
        return F.array_sort(F.concat(state["spans"], rest))

    tokens = F.transform(pieces, _token(tag, lists, where))
    spans = F.aggregate(tokens, empty, lambda s, t: _step(s, t, bool(lists)), done)

    def inside(span: Column) -> Column:
        whole = F.array_join(F.slice(pieces, span["start"] + 1, span["end"] - span["start"]), "")
        return F.regexp_replace(whole, OPEN_TAG, "")

    return F.transform(spans, inside)


def split_elements(
    pages: DataFrame, selectors: list[tuple[str, str | None]], limit: int | None = None
) -> DataFrame:
    """One row per element of a page, numbered from 0: ``page_id, url, position, item``.

    ``selectors`` are tags with patterns of their opening tags; the first that occurs on a
    page decides there. Does for nested containers what ``pages.split_containers`` does for
    patterns; ``limit`` keeps the first elements of every page only.
    """
    found = [F.get(F.filter(F.array(elements(F.col("html"), t, w)), lambda x: F.size(x) > 0), F.lit(0)) for t, w in selectors]
    rows = pages.select("page_id", "url", F.posexplode(F.coalesce(*found)).alias("position", "item"))
    return rows if limit is None else rows.where(F.col("position") < limit)


def first_text(tag: str, where: str | None = None) -> Callable[[Column], Column]:
    """A field for ``pages.extract_fields``: what stands inside the first such element, without tags."""
    return lambda item: F.regexp_replace(F.get(elements(item, tag, where), F.lit(0)), TAG, "")


def attribute(tag: str, name: str, where: str | None = None) -> Callable[[Column], Column]:
    """A field for ``pages.extract_fields``: an attribute of the first such tag that has it."""
    quoted = rf"""(?i)[\s"']{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""

    def found(item: Column) -> Column:
        tags = F.regexp_extract_all(markup(item), F.lit(rf"(?i)<{tag}(?=[\s/>]){_ATTRIBUTES}>?"), F.lit(0))
        kept = F.filter(tags, lambda t: (t.rlike(where) if where else F.lit(True)) & t.rlike(quoted))
        first = F.get(kept, F.lit(0))
        return F.concat(*[F.regexp_extract(first, quoted, i) for i in (1, 2, 3)])

    return found
