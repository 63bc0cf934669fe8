"""Data-quality measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits of the quality gate and of the field labels.
MIN_COMPLETENESS = 80.0
MAX_DUPLICATES = 10
MIN_VALID_PRICES = 70.0
FIELD_LIMITS = {"name": 90.0, "price": 80.0, "link": 90.0}
FIELD_GOOD = {"name": "Excellent", "price": "Good", "link": "Excellent"}


def share(part: Column, whole: Column) -> Column:
    """Percentage, NULL when there is no row."""
    return F.try_divide(part * F.lit(100.0), whole)


def completeness(df: DataFrame) -> DataFrame:
    """Percentage of rows that have a name, a price, a link and an availability."""
    rows = F.count("*")
    return df.agg(
        rows.alias("total_records"),
        share(F.count("name"), rows).alias("name_complete"),
        share(F.count("price_numeric"), rows).alias("price_complete"),
        share(F.count("link"), rows).alias("link_complete"),
        share(F.count("availability"), rows).alias("availability_complete"),
    )


def _validity() -> list[Column]:
    price = F.col("price_numeric")
    return [
        F.count_if(price > 0).alias("valid_prices"),
        F.count_if(price <= 0).alias("invalid_prices"),
        F.count_if(price.isNull()).alias("missing_prices"),
        F.count_if(F.col("link").startswith("http")).alias("valid_links"),
    ]


def validity(df: DataFrame) -> DataFrame:
    """Numbers of usable, non-positive and missing prices, and of web links."""
    return df.agg(*_validity())


def _duplicates(keys: list[str]) -> Column:
    # The struct keeps rows whose keys are NULL; NULLs equal each other here.
    return (F.count("*") - F.count_distinct(F.struct(*keys))).alias("duplicate_products")


def duplicate_count(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Number of rows after the first of each (name, search term)."""
    return df.agg(_duplicates(keys or ["name", "search_term"]))


def quality_row(df: DataFrame, *more: Column) -> DataFrame:
    """Completeness, validity and duplicates in one pass over the listings, with further sums."""
    rows = F.count("*")
    return df.agg(
        rows.alias("total_records"),
        share(F.count("name"), rows).alias("name_complete"),
        share(F.count("price_numeric"), rows).alias("price_complete"),
        share(F.count("link"), rows).alias("link_complete"),
        share(F.count("availability"), rows).alias("availability_complete"),
        *_validity(),
        _duplicates(["name", "search_term"]),
        *more,
    )


def counts_by(df: DataFrame, by: str = "search_term") -> DataFrame:
    """Rows per non-null group, largest first."""
    return (
        df.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(F.count("*").alias("listings"))
        .orderBy(F.desc("listings"), by)
    )


def price_range_by(df: DataFrame, by: str = "search_term") -> DataFrame:
    """Price range per group; a group without prices is left out."""
    p = F.col("price_numeric")
    return (
        df.where(F.col(by).isNotNull() & p.isNotNull())
        .groupBy(by)
        .agg(
            F.min(p).alias("min_price"),
            F.max(p).alias("max_price"),
            F.avg(p).alias("avg_price"),
            F.count("*").alias("priced"),
        )
    )


def field_labels(quality: DataFrame) -> DataFrame:
    """One row per checked field with its completeness and a verdict."""
    fields = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.col(f"{f}_complete").alias("completeness"),
                F.when(F.col(f"{f}_complete") >= limit, F.lit(FIELD_GOOD[f]))
                .otherwise("Needs Improvement")
                .alias("status"),
            )
            for f, limit in FIELD_LIMITS.items()
        ]
    )
    return quality.select(F.inline(fields))


def quality_gate(
    quality: DataFrame,
    min_completeness: float = MIN_COMPLETENESS,
    max_duplicates: int = MAX_DUPLICATES,
    min_valid_prices: float = MIN_VALID_PRICES,
) -> DataFrame:
    """Whether a batch is good enough: three checks and their conjunction."""
    lowest = F.least("name_complete", "price_complete", "link_complete", "availability_complete")
    valid = share(F.col("valid_prices"), F.col("total_records"))
    checked = quality.select(
        "total_records",
        F.coalesce(lowest >= min_completeness, F.lit(False)).alias("completeness_ok"),
        (F.col("duplicate_products") <= max_duplicates).alias("duplicates_ok"),
        F.coalesce(valid >= min_valid_prices, F.lit(False)).alias("prices_ok"),
    )
    return checked.withColumn(
        "passed", F.col("completeness_ok") & F.col("duplicates_ok") & F.col("prices_ok")
    )
