"""Kept sketches: percentiles and distinct counts of any span, from one small row a group and day.

Exact figures shuffle every value or name; these are for those who ask many spans of the same
listings and accept an error with a known bound. A table of sketches is written once per
batch and merged, never made anew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRICE = "price_numeric"
DAY = "scrape_date"
# Size of a quantile sketch; its ranks are within about 0.7 % of all with 99 % confidence.
QUANTILE_SIZE = 400
# Binary logarithm of the buckets of a set sketch; its counts have a standard error of 0.8 %.
SET_SIZE = 14


def daily_sketches(df: DataFrame, by: str = "search_term", price: str = PRICE, name: str = "name", day: str = DAY) -> DataFrame:
    """One row per group and day: ``by, day, listings, priced, prices, names``.

    ``prices`` is a quantile sketch of the prices (null where no price is known), ``names`` a
    set sketch of the distinct names. Both are built ahead of the shuffle, so a hot group is
    a few sketches.
    """
    return df.groupBy(by, F.col(day).alias("day")).agg(
        F.count("*").alias("listings"),
        F.count(price).alias("priced"),
        F.when(F.count(price) > 0, F.kll_sketch_agg_double(price, F.lit(QUANTILE_SIZE))).alias("prices"),
        F.hll_sketch_agg(name, F.lit(SET_SIZE)).alias("names"),
    )


def merged(sketches: DataFrame, by: Sequence[str] = (), first: str | None = None, last: str | None = None) -> DataFrame:
    """Sketches of all days from ``first`` to ``last``, per group or overall; the same columns."""
    kept = sketches
    if first is not None:
        kept = kept.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        kept = kept.where(F.col("day") <= F.lit(last).cast("date"))
    return kept.groupBy(*by).agg(
        F.sum("listings").alias("listings"), F.sum("priced").alias("priced"),
        F.when(F.count("prices") > 0, F.kll_merge_agg_double("prices")).alias("prices"),
        F.hll_union_agg("names").alias("names"),
    )


def percentiles_of_sketches(sketches: DataFrame, at: Mapping[str, float]) -> DataFrame:
    """The columns of ``at`` with the percentiles of each row's prices; null without prices."""
    known = F.col("prices").isNotNull()
    return sketches.withColumns({n: F.when(known, F.kll_sketch_get_quantile_double("prices", F.lit(float(p)))) for n, p in at.items()})


def distinct_of_sketches(sketches: DataFrame) -> DataFrame:
    """``distinct_names`` of each row."""
    return sketches.withColumn("distinct_names", F.hll_sketch_estimate("names"))


def overlaps(sketches: DataFrame, by: str, base: str) -> DataFrame:
    """Names that every group shares with one chosen group: ``by, distinct_names, shared_names``.

    What two sets share is the sum of their counts less that of their union; no name is read.
    """
    groups = merged(sketches, [by])
    chosen = groups.where(F.col(by) == base).select("names").scalar()
    with_base = groups.withColumn("base", chosen)
    size, other = F.hll_sketch_estimate("names"), F.hll_sketch_estimate("base")
    shared = size + other - F.hll_sketch_estimate(F.hll_union("names", "base"))
    return with_base.select(by, size.alias("distinct_names"), F.greatest(shared, F.lit(0).cast("long")).alias("shared_names"))
