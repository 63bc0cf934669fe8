"""Comparison of groups (search terms, sources) with each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators.joins import join_on
from shelfline.operators.outliers import SEGMENT_ENDS, averages, positions_of, segments_of
from shelfline.operators.quality import share
from shelfline.operators.ranks import quantiles_of_counts, value_counts
from shelfline.session import materialise

PRICE = "price_numeric"


def source_performance(
    df: DataFrame, by: str = "search_term", price: str = PRICE, approximate: bool = False
) -> DataFrame:
    """Counts, completeness, price statistics and distinct names per non-null group."""
    names = F.approx_count_distinct("name") if approximate else F.count_distinct("name")
    return (
        df.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.count("*").alias("total_products"),
            F.count(price).alias("products_with_prices"),
            share(F.count(price), F.count("*")).alias("data_completeness"),
            F.avg(price).alias("avg_price"),
            F.stddev_samp(price).alias("price_std"),
            F.min(price).alias("min_price"),
            F.max(price).alias("max_price"),
            names.alias("unique_products"),
        )
    )


def cross_source_insights(df: DataFrame, by: str = "search_term", price: str = PRICE) -> DataFrame:
    """Spread of the group averages and the groups at its ends; needs two groups.

    On equal averages the group whose name sorts first is named.
    """
    return insights_of(averages(df, by, price), by)


def insights_of(group_averages: DataFrame, by: str = "search_term") -> DataFrame:
    """The spread and the ends of given group averages."""
    avg = F.col("avg_price")
    first, last = F.struct(avg, F.col(by)), F.struct(-avg, F.col(by))
    return (
        group_averages.agg(
            F.count("*").alias("sources"),
            F.var_pop(avg).alias("price_variance_across_sources"),
            F.try_divide(F.stddev_pop(avg), F.avg(avg)).alias("coefficient_of_variation"),
            (F.max(avg) - F.min(avg)).alias("price_difference"),
            F.min_by(by, first).alias("cheapest_source"),
            F.min_by(by, last).alias("most_expensive_source"),
        )
        .where("sources > 1")
    )


def market_positioning(df: DataFrame, by: str = "search_term", price: str = PRICE) -> DataFrame:
    """Market segment and percentile position of every group with prices."""
    counts = value_counts(df, price)
    fixed = materialise(averages(df, by, price), "averages")
    return positioning_of(counts, fixed, quantiles_of_counts(counts, SEGMENT_ENDS), by)


def positioning_of(
    counts: DataFrame, group_averages: DataFrame, marks: DataFrame, by: str = "search_term"
) -> DataFrame:
    """Segment and position of given, written averages among counted prices."""
    segments = segments_of(group_averages, marks).drop("avg_price")
    return join_on(segments, positions_of(counts, group_averages, by), [by])


def display_summary(df: DataFrame, by: str = "search_term", price: str = PRICE) -> DataFrame:
    """What a summary table shows per group; completeness serves as the quality score."""
    return (
        df.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.count("*").alias("total_products"),
            F.avg(price).alias("avg_price"),
            share(F.count(price), F.count("*")).alias("data_quality_score"),
        )
    )
