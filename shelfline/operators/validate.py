"""Named validation rules."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.price import given, is_number, loose_number
from shelfline.functions.text import present
from shelfline.functions.urls import has_web_scheme
from shelfline.operators.ingest import first_arrivals

# The accepted price range and the longest name.
PRICE_RANGE = (0.01, 100000.0)
MAX_NAME = 500

Rule = Callable[..., Column]


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def required_fields(price_kind: str = "string") -> Column:
    """Name, price and link are all given; the number 0 is no price."""
    return _sure(present(F.col("name")) & given(F.col("price"), price_kind) & present(F.col("link")))


def price_range(price_kind: str = "string") -> Column:
    """The raw price is itself a number within the range; "$10.99" is not a number."""
    price = F.col("price")
    value = price.cast("double") if is_number(price_kind) else loose_number(price)
    return _sure(value.between(*PRICE_RANGE))


def url_format() -> Column:
    return _sure(has_web_scheme(F.col("link")))


def text_length() -> Column:
    return F.coalesce(F.length("name") <= MAX_NAME, F.lit(True))


def duplicate_check() -> Column:
    """Always true for a single row; ``Validator.keep(unique=True)`` compares rows."""
    return F.lit(True)


BUILT_IN: dict[str, Rule] = {
    "required_fields": required_fields,
    "price_range": price_range,
    "url_format": url_format,
    "text_length": text_length,
    "duplicate_check": duplicate_check,
}


class Validator:
    """A set of named rules, to which users may add their own."""

    def __init__(self) -> None:
        self.rules: dict[str, Rule] = dict(BUILT_IN)

    def register(self, name: str, rule: Rule) -> None:
        self.rules[name] = rule

    def _known(self, df: DataFrame, names: list[str]) -> dict[str, Column]:
        by_kind = {required_fields, price_range}
        kind = dict(df.dtypes).get("price", "string")
        return {
            n: self.rules[n](kind) if self.rules[n] in by_kind else self.rules[n]() for n in names if n in self.rules
        }

    def verdicts(self, df: DataFrame, names: list[str]) -> DataFrame:
        """One boolean column per rule and the first rule a row fails."""
        rules = self._known(df, names)
        failed = F.coalesce(
            *[F.when(~ok, F.lit(n)) for n, ok in rules.items()], F.lit(None).cast("string")
        )
        return df.withColumns({f"ok_{n}": ok for n, ok in rules.items()} | {"first_failed_rule": failed})

    def keep(self, df: DataFrame, names: list[str], unique: bool = False) -> DataFrame:
        """Rows that pass every rule; unknown rules are ignored.

        ``unique`` also drops all but the first row of each (name, search term).
        """
        passed = reduce(lambda a, b: a & b, self._known(df, names).values(), F.lit(True))
        kept = df.where(passed)
        if unique:
            kept = first_arrivals(kept, ["name", "search_term"], sorted(df.columns))
        return kept

    def rejects(self, df: DataFrame, names: list[str]) -> DataFrame:
        """Rows that fail, each with the first rule it fails."""
        marked = self.verdicts(df, names)
        return marked.where("first_failed_rule IS NOT NULL").select(*df.columns, "first_failed_rule")
