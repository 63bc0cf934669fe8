"""Text, category and brand expressions. All are native column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as the cleaning rules see it: the Unicode set and the four separator controls.
SPACES = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_RUNS = r"(?U)[\s\x1c-\x1f]+"
# A word character is a letter, a number of any kind or an underscore; combining marks are not.
_NOT_PLAIN = r"[^\p{L}\p{N}_ \-.,!?()]"

# Fields that text cleaning applies to.
TEXT_FIELDS = ["name", "description", "availability", "category", "brand", "seller"]

# Promotional phrases removed from names, in order.
PROMOTIONS = [
    r"\b(new|sale|discount|offer|deal|free shipping)\b",
    r"\d+%\s*off",
    r"\$?\d+\s*off",
    r"\b(limited time|while supplies last)\b",
]

# Fixed value: where a model name sits in a cleaned product name.
MODEL_PATTERN = r"\b(model|version|v\.?)\s*[:.]?\s*([a-zA-Z0-9\-]+)"

# Brands looked for in names, in order.
BRANDS = [
    "apple", "samsung", "google", "microsoft", "amazon", "sony", "lg", "dell", "hp",
    "lenovo", "acer", "asus", "nvidia", "amd", "intel",
]

# Availability wording, tested in order.
AVAILABILITY = {
    "in_stock": ["in stock", "available", "ready"],
    "out_of_stock": ["out of stock", "unavailable", "sold out"],
    "limited_stock": ["limited", "few left", "low stock"],
}

# Condition wording, tested in order.
CONDITIONS = {
    "new": ["new", "brand new", "factory sealed"],
    "used": ["used", "pre-owned", "second hand"],
    "refurbished": ["refurbished", "renewed", "reconditioned"],
    "damaged": ["damaged", "broken", "parts"],
}

# Names that are placeholders rather than products.
PLACEHOLDER_NAMES = ["New Listing", "Shop on eBay"]

# The fields a quality score counts.
SCORED_FIELDS = ["name", "price_numeric", "link", "image", "availability", "category", "brand"]


def present(c: Column) -> Column:
    """True for a value that is neither NULL nor empty."""
    return c.isNotNull() & (c != "")


def strip(c: Column) -> Column:
    """Drop white space at both ends."""
    return F.btrim(c, F.lit(SPACES))


def sanitize_text(c: Column) -> Column:
    """Trim and collapse white space."""
    return F.trim(F.regexp_replace(c, _RUNS, " "))


def clean_text(c: Column) -> Column:
    """Collapse white space, delete special characters, and turn an emptied text into NULL.

    A text that was empty before stays empty.
    """
    kept = F.nullif(F.regexp_replace(sanitize_text(c), _NOT_PLAIN, ""), F.lit(""))
    # Inside a CASE the regular expressions of NULLIF would run twice.
    return F.coalesce(kept, F.when(c == "", c))


def clean_product_name(c: Column) -> Column:
    """Remove promotional phrases and the gaps they leave."""
    bare = reduce(lambda acc, p: F.regexp_replace(acc, rf"(?iU){p}", ""), PROMOTIONS, c)
    return sanitize_text(bare)


def model_of(cleaned_name: Column) -> Column:
    """The model or version named in a cleaned product name, else NULL."""
    found = F.regexp_extract(cleaned_name, rf"(?iU){MODEL_PATTERN}", 2)
    return F.nullif(found, F.lit(""))


def _mentions(text: Column, terms: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(t) for t in terms])


def _first_label(text: Column, table: dict[str, list[str]], order: list[str]) -> Column:
    chain = reduce(
        lambda acc, label: acc.when(_mentions(text, table[label]), F.lit(label)),
        order[1:],
        F.when(_mentions(text, table[order[0]]), F.lit(order[0])),
    )
    return chain.otherwise("unknown")


def brand_of(name: Column) -> Column:
    """The first known brand, in list order, that a name contains."""
    text = F.lower(name)
    return F.initcap(F.coalesce(*[F.when(text.contains(b), F.lit(b)) for b in BRANDS]))


def availability_status(c: Column, strict: bool = False) -> Column:
    """Stock state of an availability text; the first matching wording wins.

    "unavailable" contains "available" and therefore counts as in stock. ``strict`` tests
    the out-of-stock wording first.
    """
    order = list(AVAILABILITY)
    if strict:
        order = ["out_of_stock", "limited_stock", "in_stock"]
    label = _first_label(F.lower(c), AVAILABILITY, order)
    return F.when(present(c), label)


def condition_standard(c: Column, strict: bool = False) -> Column:
    """Standard condition of a condition text; the first matching wording wins.

    "renewed" contains "new" and therefore counts as new. ``strict`` tests "new" last.
    """
    order = list(CONDITIONS)
    if strict:
        order = ["refurbished", "used", "damaged", "new"]
    label = _first_label(F.lower(c), CONDITIONS, order)
    return F.when(present(c), label)


def preview(c: Column, width: int = 50) -> Column:
    """The first ``width`` characters, with an ellipsis when something was cut."""
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("..."))).otherwise(c)


def first_filled(*candidates: Column) -> Column:
    """The first candidate that is not blank, trimmed."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in candidates])


def quality_score(columns: list[str]) -> Column:
    """Share of the scored fields that are not NULL; fields the frame lacks count as missing."""
    filled = [
        F.col(f).isNotNull().cast("int") if f in columns else F.lit(0) for f in SCORED_FIELDS
    ]
    return reduce(lambda a, b: a + b, filled) / F.lit(float(len(SCORED_FIELDS)))
