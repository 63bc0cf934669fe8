"""Filters and projections over listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.price import given, plain_text
from shelfline.functions.temporal import time_or_default
from shelfline.functions.text import PLACEHOLDER_NAMES, present
from shelfline.schemas import LISTING_FIELDS


def named(df: DataFrame) -> DataFrame:
    """Rows with a name; the empty name stays."""
    return df.where(F.col("name").isNotNull())


def minimum_valid(price_kind: str = "string") -> Column:
    """A usable listing: a name, and a link or a price; the number 0 is no price."""
    return F.coalesce(
        present(F.col("name")) & (present(F.col("link")) | F.coalesce(given(F.col("price"), price_kind), F.lit(False))),
        F.lit(False),
    )


def linked(df: DataFrame) -> DataFrame:
    """Extracted rows that have both a name and a link."""
    return df.where(present(F.col("name")) & present(F.col("link")))


def from_source(df: DataFrame, source: str) -> DataFrame:
    """Rows of one source, whatever its case; ``all`` keeps every row."""
    if source.lower() == "all":
        return df
    return df.where(F.lower(F.coalesce(F.col("source"), F.lit(""))) == source.lower())


def in_date_range(
    df: DataFrame, start: str | None = None, end: str | None = None, column: str = "scrape_time"
) -> DataFrame:
    """Rows from ``start`` to ``end``, both days included.

    A typed time is compared as a range of instants so that the filter reaches the files; an
    ISO text is compared by its first ten characters. A missing time counts as the empty
    text: it fails a lower bound and passes an upper one.
    """
    c = F.col(column)
    if dict(df.dtypes)[column] == "string":
        day = F.substring(F.coalesce(c, F.lit("")), 1, 10)
        if start:
            df = df.where(day >= start)
        if end:
            df = df.where(day <= end)
        return df
    kind = dict(df.dtypes)[column]
    if start:
        df = df.where(c >= F.lit(start).cast(kind))
    if end:
        past_end = F.date_add(F.lit(end).cast("date"), 1).cast(kind)
        inside = c < past_end
        df = df.where(inside if start else inside | c.isNull())
    return df


def without_placeholders(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Drop blank names and the names search pages use as fillers."""
    return df.where(present(F.col("name")) & ~F.col("name").isin(names or PLACEHOLDER_NAMES))


def priced(df: DataFrame, price: str = "price_numeric") -> DataFrame:
    return df.where(F.col(price).isNotNull())


def lookup(df: DataFrame, source: str | None = None, search_term: str | None = None) -> DataFrame:
    """Stored listings, optionally of one source and one search term."""
    if source:
        df = df.where(F.col("source") == source)
    if search_term:
        df = df.where(F.col("search_term") == search_term)
    return df


def fold_extras(df: DataFrame) -> DataFrame:
    """Keep the named listing fields and gather every other column in a map."""
    known = [c for c in df.columns if c in LISTING_FIELDS]
    extra = [c for c in df.columns if c not in LISTING_FIELDS]
    if not extra:
        empty = F.create_map().cast("map<string,string>")
        return df.select(*known, empty.alias("extra_attributes"))
    kinds = dict(df.dtypes)
    pairs = F.create_map(*[x for c in extra for x in (F.lit(c), plain_text(F.col(c), kinds[c]))])
    return df.select(
        *known, F.map_filter(pairs, lambda _, v: v.isNotNull()).alias("extra_attributes")
    )


def flatten_extras(df: DataFrame, keys: list[str]) -> DataFrame:
    """The inverse of ``fold_extras`` for the given keys; an extra wins over a named field."""
    extras = F.col("extra_attributes")
    known, kinds = [c for c in df.columns if c != "extra_attributes"], dict(df.dtypes)
    kept = [
        F.when(F.map_contains_key(extras, k), extras[k]).otherwise(plain_text(F.col(k), kinds[k])).alias(k)
        if k in keys
        else F.col(k)
        for k in known
    ]
    added = [extras[k].alias(k) for k in keys if k not in known]
    return df.select(*kept, *added)


def pick_fields(df: DataFrame, fields: str | list[str]) -> DataFrame:
    """Columns named in a comma-separated list; unknown names are skipped."""
    names = fields.split(",") if isinstance(fields, str) else fields
    return df.select([n.strip() for n in names if n.strip() in df.columns])


def as_listings(df: DataFrame, source: str, search_term: str) -> DataFrame:
    """Listings made of collected rows, stamped with their origin.

    Every collected column is also kept as an extra.
    """
    direct = ["price", "link", "image", "availability"]
    name = F.coalesce(F.col("name"), F.lit("")) if "name" in df.columns else F.lit("")
    kinds = dict(df.dtypes)
    pairs = F.create_map(*[x for c in df.columns for x in (F.lit(c), plain_text(F.col(c), kinds[c]))])
    return df.select(
        name.alias("name"),
        *[
            (F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in direct
        ],
        F.lit(source).alias("source"),
        F.lit(search_term).alias("search_term"),
        F.map_filter(pairs, lambda _, v: v.isNotNull()).alias("extra_attributes"),
    )


# What a search-result item gets where it lacks a field.
RESULT_DEFAULTS = {
    "name": "Unknown", "link": "", "availability": "In Stock", "source": "Amazon",
}


def with_result_defaults(df: DataFrame, search_term: str = "unknown") -> DataFrame:
    """Fill the gaps of search-result items; their image is always empty."""
    filled = df.fillna({k: v for k, v in RESULT_DEFAULTS.items() if k in df.columns})
    for column, value in {**RESULT_DEFAULTS, "search_term": search_term}.items():
        if column not in df.columns:
            filled = filled.withColumn(column, F.lit(value))
    return filled.fillna({"search_term": search_term}).withColumn("image", F.lit(""))


def tagged(
    df: DataFrame, source: str | None = None, search_term: str | None = None, run_time: str | None = None
) -> DataFrame:
    """Stamp a batch with its source and search term, and missing times with the run's."""
    if source is not None:
        df = df.withColumn("source", F.lit(source))
    if search_term is not None:
        df = df.withColumn("search_term", F.lit(search_term))
    if run_time is not None:
        have = F.col("scrape_time") if "scrape_time" in df.columns else F.lit(None).cast("string")
        df = df.withColumn("scrape_time", time_or_default(have, run_time))
    return df


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of all sources; a column a source lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
