"""Records from raw pages by regular expressions.

Everything is a projection or an explode over one page at a time; no step shuffles.
Patterns are regular expressions whose first group is the wanted text. They cannot follow
nested containers; ``operators/nested.py`` does, and its fields stand beside patterns here.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.price import page_price, result_price
from shelfline.functions.text import first_filled, sanitize_text, strip
from shelfline.functions.urls import absolute_url, host_of, prefix_host
from shelfline.operators.select import linked, without_placeholders

# Phrases of a page that blocks automated readers.
BLOCK_PHRASES = [
    "captcha", "robot", "automated", "blocked", "unusual traffic", "request blocked",
    "access denied", "temporarily blocked",
]

# Fixed value: the text that marks a page with results.
RESULT_MARK = '[data-component-type="s-search-result"]'

# Fixed value: records of one result page that a reader with a limit takes (W8).
PAGE_LIMIT = 25

# Character references that page text is freed of; the ampersand comes last.
_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ",
    "&pound;": "£", "&euro;": "€", "&yen;": "¥", "&amp;": "&",
}

# Patterns for result pages; the first group holds the text or address. the
# class and attribute names in all patterns below.
RESULT_CONTAINERS = [
    r'(?s)<div[^>]*data-component-type="s-search-result"[^>]*>(.*?)(?=<div[^>]*data-component-type="s-search-result"|$)',
    r'(?s)<div[^>]*class="[^"]*s-result-item[^"]*"[^>]*>(.*?)(?=<div[^>]*class="[^"]*s-result-item|$)',
    r'(?s)<div[^>]*class="[^"]*s-widget-container[^"]*"[^>]*>(.*?)(?=<div[^>]*class="[^"]*s-widget-container|$)',
]
RESULT_TITLES = [
    r'(?s)data-cy="title-recipe".*?<h2[^>]*>.*?<span[^>]*>([^<]*)<',
    r'(?s)data-cy="title-recipe".*?<span[^>]*>([^<]*)<',
    r'(?s)<h2[^>]*>.*?<a[^>]*>.*?<span[^>]*>([^<]*)<',
    r'(?s)<h2[^>]*>.*?<span[^>]*>([^<]*)<',
    r'(?s)class="[^"]*s-size-mini[^"]*".*?class="[^"]*s-color-base[^"]*"[^>]*>([^<]*)<',
    r'class="[^"]*a-size-base-plus[^"]*"[^>]*>([^<]*)<',
]
RESULT_PRICES = [
    r'(?s)data-cy="price-recipe".*?class="[^"]*a-price[ "].*?class="[^"]*a-offscreen[^"]*"[^>]*>([^<]*)<',
    r'(?s)class="[^"]*a-price[ "].*?class="[^"]*a-offscreen[^"]*"[^>]*>([^<]*)<',
    r'(?s)data-cy="price-recipe".*?class="[^"]*a-color-price[^"]*"[^>]*>([^<]*)<',
    r'class="[^"]*a-price-whole[^"]*"[^>]*>([^<]*)<',
    r'class="[^"]*a-color-price[^"]*"[^>]*>([^<]*)<',
]
RESULT_LINKS = [
    r'(?s)data-cy="title-recipe".*?<a[^>]*href="([^"]*)"',
    r'(?s)<h2[^>]*>.*?<a[^>]*href="([^"]*)"',
    r'<a[^>]*class="[^"]*a-link-normal[^"]*"[^>]*href="([^"]*)"',
    r'<a[^>]*class="[^"]*s-link-style[^"]*"[^>]*href="([^"]*)"',
]
RESULT_RATING = r'class="[^"]*a-icon-alt[^"]*"[^>]*>([^<]*)<'

AUCTION_CONTAINERS = [r'(?s)<li[^>]*class="[^"]*s-item[ "][^>]*>(.*?)</li>']
AUCTION_TITLES = [
    r'(?s)<div[^>]*class="[^"]*s-item__title[^"]*"[^>]*>.*?<span[^>]*role="heading"[^>]*>(.*?)</span>',
    r'(?s)<div[^>]*class="[^"]*s-item__title[^"]*"[^>]*>(.*?)</div>',
]
AUCTION_LINK = r'<a[^>]*class="[^"]*s-item__link[^"]*"[^>]*href="([^"]*)"'
AUCTION_PRICE = r'(?s)<span[^>]*class="[^"]*s-item__price[^"]*"[^>]*>(.*?)</span>'
AUCTION_AVAILABILITY = r'(?s)<span[^>]*class="[^"]*SECONDARY_INFO[^"]*"[^>]*>(.*?)</span>'

# Patterns for a catalogue page of book cards.
CATALOGUE_CONTAINERS = [r'(?s)<article[^>]*class="[^"]*product_pod[^"]*"[^>]*>(.*?)</article>']
CATALOGUE_FIELDS = {
    "name_title": r'(?s)<h3>\s*<a[^>]*title="([^"]*)"',
    "name": r"(?s)<h3>\s*<a[^>]*>(.*?)</a>",
    "price": r'(?s)<p[^>]*class="price_color"[^>]*>(.*?)</p>',
    "link": r'(?s)<h3>\s*<a[^>]*href="([^"]*)"',
    "image": r'(?s)<img[^>]*src="([^"]*)"',
    "availability": r'(?s)<p[^>]*class="[^"]*instock availability[^"]*"[^>]*>(.*?)</p>',
}


def text_of(markup: Column) -> Column:
    """Text of a piece of markup: tags dropped, common character references resolved."""
    bare = F.regexp_replace(markup, r"(?s)<[^>]*>", "")
    return reduce(
        lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), _ENTITIES.items(), bare
    )


def captured(text: Column, pattern: str) -> Column:
    """First group of the first match, NULL when the pattern does not occur."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))


def fallback(text: Column, patterns: list[str]) -> Column:
    """First non-blank result over ordered patterns; later patterns run only when needed."""
    found = [F.regexp_extract(text, p, 1) for p in patterns]
    raw = first_filled(*[F.replace(f, F.lit("&nbsp;"), F.lit(" ")) for f in found])
    return strip(text_of(raw))


def _first_found(results: list[Column], found) -> Column:
    """The first result that was found; each is evaluated once, and only when needed."""
    return F.coalesce(*[F.get(F.filter(F.array(r), found), F.lit(0)) for r in results])


def containers(html: Column, patterns: list[str]) -> Column:
    """The repeated pieces of a page; the first pattern that occurs decides."""
    return _first_found([F.regexp_extract_all(html, F.lit(p), 1) for p in patterns], lambda x: F.size(x) > 0)


def split_containers(
    pages: DataFrame, patterns: list[str], limit: int | None = None
) -> DataFrame:
    """One row per repeated piece of a page, numbered from 0: ``page_id, url, position, item``.

    ``limit`` keeps the first pieces of every page only; without it all are kept.
    """
    pieces = containers(F.col("html"), patterns)
    rows = pages.select("page_id", "url", F.posexplode(pieces).alias("position", "item"))
    return rows if limit is None else rows.where(F.col("position") < limit)


def extract_fields(
    items: DataFrame, fields: dict[str, str | Callable[[Column], Column]], base: Column | None = None
) -> DataFrame:
    """Listings from pieces by a field-to-pattern map; a name and a link are required.

    A ``name_title`` pattern, where it finds something, precedes ``name``. A field may also be
    a function of the piece, such as ``nested.first_text``.
    """
    item = F.col("item")
    base = F.col("url") if base is None else base

    def found(key: str) -> Column:
        field = fields.get(key)
        if field is None:
            return F.lit(None).cast("string")
        return captured(item, field) if isinstance(field, str) else field(item)

    titled = F.nullif(text_of(found("name_title")), F.lit(""))
    listing = items.select(
        "page_id",
        "position",
        sanitize_text(F.coalesce(titled, text_of(found("name")))).alias("name"),
        page_price(text_of(found("price"))).alias("price"),
        _resolved(base, found("link")).alias("link"),
        _resolved(base, found("image")).alias("image"),
        sanitize_text(text_of(found("availability"))).alias("availability"),
    )
    return linked(listing)


def _resolved(base: Column, href: Column) -> Column:
    return F.when(href.isNotNull(), absolute_url(base, href))


def extract_results(
    items: DataFrame,
    search_term: str | Column,
    titles: list[str] = RESULT_TITLES,
    prices: list[str] = RESULT_PRICES,
    links: list[str] = RESULT_LINKS,
    rating: str = RESULT_RATING,
    host: str = "https://www.amazon.com",
    source: str = "Amazon",
) -> DataFrame:
    """Listings from search-result pieces, each field by its own fallbacks; a name is required."""
    item = F.col("item")
    term = F.lit(search_term) if isinstance(search_term, str) else search_term
    return items.select(
        "page_id",
        "position",
        fallback(item, titles).alias("name"),
        result_price(fallback(item, prices)).alias("price"),
        prefix_host(fallback(item, links), host).alias("link"),
        term.alias("search_term"),
        F.lit("In Stock").alias("availability"),
        strip(text_of(captured(item, rating))).alias("rating"),
        F.lit(source).alias("source"),
    ).where("name IS NOT NULL")


def extract_auctions(
    items: DataFrame,
    titles: list[str] = AUCTION_TITLES,
    link: str = AUCTION_LINK,
    price: str = AUCTION_PRICE,
    availability: str = AUCTION_AVAILABILITY,
    placeholders: list[str] | None = None,
) -> DataFrame:
    """Listings from auction pieces: heading with fallback, link, price text, page."""
    item = F.col("item")
    heading = F.coalesce(*[strip(text_of(captured(item, t))) for t in titles])
    stock = strip(text_of(captured(item, availability)))
    rows = items.select(
        F.col("page_id").alias("page"),
        "position",
        heading.alias("name"),
        strip(text_of(captured(item, price))).alias("price"),
        captured(item, link).alias("link"),
        F.coalesce(stock, F.lit("Unknown")).alias("availability"),
    )
    return linked(without_placeholders(rows, placeholders))


def classify_pages(
    pages: DataFrame, phrases: list[str] | None = None, mark: str = RESULT_MARK
) -> DataFrame:
    """Whether a page looks blocked, shows results, or loaded without any.

    Pages without a status column count as loaded.
    """
    lowered = F.lower("html")
    blocked = reduce(lambda a, b: a | b, [lowered.contains(p) for p in phrases or BLOCK_PHRASES])
    has_results = F.col("html").contains(mark)
    loaded = F.col("status") == 200 if "status" in pages.columns else F.lit(True)
    return pages.select(
        "page_id",
        "url",
        host_of(F.col("url")).alias("host"),
        blocked.alias("blocked"),
        has_results.alias("has_results"),
        (~has_results & loaded).alias("loaded_empty"),
    )


def block_rates(classified: DataFrame) -> DataFrame:
    """Pages, blocked pages and empty pages per host."""
    return classified.groupBy("host").agg(
        F.count("*").alias("pages"),
        F.count_if("blocked").alias("blocked"),
        F.count_if("loaded_empty").alias("loaded_empty"),
        F.avg(F.col("blocked").cast("double")).alias("blocked_rate"),
    )


def records_per_page(pages: DataFrame, patterns: list[str]) -> DataFrame:
    """Number of repeated pieces on every page, 0 for none; the pieces are not built."""
    counts = [F.regexp_count("html", F.lit(p)) for p in patterns]
    found = F.coalesce(_first_found(counts, lambda n: n > 0), F.lit(0))
    return pages.select("page_id", host_of(F.col("url")).alias("host"), found.alias("records"))


def records_per_host(pages: DataFrame, patterns: list[str]) -> DataFrame:
    return (
        records_per_page(pages, patterns)
        .groupBy("host")
        .agg(
            F.count("*").alias("pages"),
            F.sum("records").alias("records"),
            F.count_if(F.col("records") == 0).alias("empty_pages"),
        )
    )
