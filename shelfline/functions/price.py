"""Price and currency expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline.functions.text import present, strip

# What may be cast to a number, with white space around it. Spark's own cast also takes a
# trailing "d" or "f". The second form lets underscores group digits.
_EDGE = r"[\s\x1c-\x1f]*"
_REST = r"([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?"
_NUMBER = rf"(?U)^{_EDGE}[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+){_REST}){_EDGE}$"
_DIGITS = r"[0-9]+(_[0-9]+)*"
_GROUPED = rf"(?U)^{_EDGE}[+-]?(({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS}){_REST}){_EDGE}$"

# Currency marks and codes, tested in order.
CURRENCIES = {
    "$": "USD", "€": "EUR", "£": "GBP", "¥": "JPY", "₹": "INR",
    "usd": "USD", "eur": "EUR", "gbp": "GBP", "jpy": "JPY", "inr": "INR",
}


def to_number(text: Column) -> Column:
    """A text as a double, or NULL when it is not a plain number or an infinity."""
    return F.when(text.rlike(_NUMBER), strip(text).try_cast("double"))


def loose_number(text: Column) -> Column:
    """Like ``to_number`` but digits may be grouped with underscores, as in ``1_000``."""
    plain = F.replace(strip(text), F.lit("_"), F.lit(""))
    return F.when(text.rlike(_GROUPED), plain.try_cast("double"))


NUMBERS = ("double", "float", "bigint", "int", "smallint", "tinyint", "decimal")


def is_number(kind: str) -> bool:
    """Whether a column type holds numbers; their prices need no parsing."""
    return kind.startswith(NUMBERS)


def given(c: Column, kind: str) -> Column:
    """Whether a field has a value: a text that is not empty, a number other than zero or NaN."""
    if is_number(kind):
        return F.coalesce((c != 0) & ~F.isnan(c.cast("double")), F.lit(False))
    return present(c)


def plain_text(c: Column, kind: str) -> Column:
    """A value as text; numbers in plain decimal notation, never in powers of ten."""
    if kind in ("double", "float"):
        size = F.abs(c)
        ordinary = ((size >= 1e-3) & (size < 1e7)) | (size == 0) | F.isnan(c) | (size == float("inf"))
        digits = F.regexp_replace(F.format_string("%.20f", c), r"0+$", "")
        long = F.when(c.isNotNull(), F.regexp_replace(digits, r"\.$", ".0"))
        return F.when(ordinary, c.cast("string")).otherwise(long)
    return c.cast("string")


def no_nan(c: Column) -> Column:
    """NaN means missing."""
    return F.nullif(c.cast("double"), F.lit(float("nan")))


def analysis_price(text: Column) -> Column:
    """Price used in analysis: pound, dollar and comma are dropped; the euro sign is not."""
    return to_number(F.translate(text, "£$,", ""))


def ingest_price(text: Column) -> Column:
    """Price used when storing: dollar and comma are dropped; any other mark gives NULL."""
    return loose_number(F.translate(text, "$,", ""))


def model_price(price: Column, price_numeric: Column, kind: str = "string") -> Column:
    """Numeric price of a listing record.

    The price is used only where the numeric price is missing or zero: a number as it is, a
    text parsed. A zero is no price.
    """
    if is_number(kind):
        missing = F.coalesce(price_numeric, F.lit(0.0)) == 0.0
        return F.when(given(price, kind) & missing, price.cast("double")).otherwise(price_numeric)
    text = price
    digits = F.replace(F.regexp_replace(text, r"[^0-9.,]", ""), F.lit(","), F.lit(""))
    missing = F.coalesce(price_numeric, F.lit(0.0)) == 0.0
    return F.when(present(text) & missing, to_number(digits)).otherwise(price_numeric)


def localized_price(price: Column, kind: str = "string") -> Column:
    """Numeric price of a text whose comma may be a decimal or a thousands mark.

    A number passes through, zero counts as missing.
    """
    if is_number(kind):
        return F.when(given(price, kind), price.cast("double"))
    text = price
    kept = F.regexp_replace(text, r"[^0-9.,]", "")
    decimal_comma = kept.rlike(r"^[^.,]*,[^.,]{0,2}$")
    plain = F.when(decimal_comma, F.replace(kept, F.lit(","), F.lit("."))).otherwise(
        F.replace(kept, F.lit(","), F.lit(""))
    )
    return F.when(present(text), to_number(plain))


def page_price(text: Column) -> Column:
    """Price on a page: digits and dots only, 0.0 when that is no number."""
    parsed = to_number(F.regexp_replace(text, r"[^0-9.]", ""))
    return F.when(text.isNotNull(), F.coalesce(parsed, F.lit(0.0)))


def result_price(text: Column) -> Column:
    """Price in a search result: digits and dots only, NULL when that is no number."""
    return to_number(F.regexp_replace(text, r"[^0-9.]", ""))


def currency_of(text: Column, kind: str = "string") -> Column:
    """Currency a price text names; US dollars when it names none, as a bare number does."""
    if is_number(kind):
        return F.when(given(text, kind), F.lit("USD"))
    lowered = F.lower(text)
    marks = list(CURRENCIES.items())
    chain = reduce(
        lambda acc, kv: acc.when(lowered.contains(kv[0]), F.lit(kv[1])),
        marks[1:],
        F.when(lowered.contains(marks[0][0]), F.lit(marks[0][1])),
    ).otherwise("USD")
    return F.when(present(text), chain)


def ends_in_99(price: Column) -> Column:
    """Charm price: the decimal text of the price ends in ``.99``."""
    return F.abs(price).cast("decimal(38,12)") % 1 == F.lit("0.99").cast("decimal(38,12)")


def is_round(price: Column) -> Column:
    return F.pmod(price, F.lit(1.0)) == 0.0
