"""Named cleaning steps and chains of them."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import price as P
from shelfline.functions import text as X
from shelfline.functions.urls import validate_url
from shelfline.operators.select import minimum_valid

log = logging.getLogger(__name__)

Step = Callable[[DataFrame], DataFrame]


def _column(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def clean_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: X.clean_text(F.col(c)) for c in X.TEXT_FIELDS if c in df.columns})


def _price_kind(df: DataFrame) -> str:
    return dict(df.dtypes)["price"]


def extract_currency(df: DataFrame) -> DataFrame:
    if "price" not in df.columns:
        return df
    found = P.currency_of(F.col("price"), _price_kind(df))
    return df.withColumn("currency", F.coalesce(found, _column(df, "currency")))


def normalize_price(df: DataFrame) -> DataFrame:
    if "price" not in df.columns:
        return df
    found = P.localized_price(F.col("price"), _price_kind(df))
    known = _column(df, "price_numeric").cast("double")
    return extract_currency(df).withColumn("price_numeric", F.coalesce(found, known))


def validate_links(df: DataFrame) -> DataFrame:
    return df.withColumns({c: validate_url(F.col(c)) for c in ("link", "image") if c in df.columns})


def normalize_availability(df: DataFrame) -> DataFrame:
    if "availability" not in df.columns:
        return df
    found = X.availability_status(F.col("availability"))
    return df.withColumn("availability_status", F.coalesce(found, _column(df, "availability_status")))


def clean_product_name(df: DataFrame) -> DataFrame:
    if "name" not in df.columns:
        return df
    cleaned = X.clean_product_name(F.col("name"))
    return df.withColumn("name", cleaned).withColumn(
        "model", F.coalesce(X.model_of(F.col("name")), _column(df, "model"))
    )


def extract_brand(df: DataFrame) -> DataFrame:
    if "name" not in df.columns:
        return df
    return df.withColumn("brand", F.coalesce(_column(df, "brand"), X.brand_of(F.col("name"))))


def standardize_condition(df: DataFrame) -> DataFrame:
    if "condition" not in df.columns:
        return df
    found = X.condition_standard(F.col("condition"))
    return df.withColumn("condition_standard", F.coalesce(found, _column(df, "condition_standard")))


BUILT_IN: dict[str, Step] = {
    "clean_text": clean_text,
    "normalize_price": normalize_price,
    "validate_url": validate_links,
    "extract_currency": extract_currency,
    "normalize_availability": normalize_availability,
    "clean_product_name": clean_product_name,
    "extract_brand": extract_brand,
    "standardize_condition": standardize_condition,
}


class Cleaner:
    """A set of named steps, to which users may add their own."""

    def __init__(self) -> None:
        self.steps: dict[str, Step] = dict(BUILT_IN)

    def register(self, name: str, step: Step) -> None:
        self.steps[name] = step

    def run(self, df: DataFrame, names: list[str]) -> DataFrame:
        """Apply the named steps in order and keep the usable listings.

        An unknown name is skipped with a warning. Every built-in step is a projection, so a
        chain stays one scan without a shuffle. The cleaned columns pass through a one-row
        array, which keeps the optimizer from repeating the steps inside the filter.
        """
        for name in names:
            step = self.steps.get(name)
            if step is None:
                log.warning("unknown cleaning step: %s", name)
                continue
            df = df.transform(step)
        for required in ("name", "link", "price"):
            if required not in df.columns:
                df = df.withColumn(required, F.lit(None).cast("string"))
        # The numeric price of a kept record comes from its price where no step has set it.
        known = _column(df, "price_numeric").cast("double")
        df = df.withColumn("price_numeric", P.model_price(F.col("price"), known, _price_kind(df)))
        cleaned = df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
        return cleaned.where(minimum_valid(_price_kind(df)))
