"""Outliers, price bands, price patterns and market position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.price import ends_in_99, is_round
from shelfline.operators.joins import with_row
from shelfline.operators.quality import share
from shelfline.operators.ranks import count_below, quantiles, quantiles_of_counts, value_counts
from shelfline.session import materialise

PRICE = "price_numeric"

# The quantiles that bound the bands, and those that bound the market segments.
BAND_ENDS = {"p25": 0.25, "p75": 0.75, "p100": 1.0}
SEGMENT_ENDS = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def iqr_fences(df: DataFrame, price: str = PRICE) -> DataFrame:
    """Quartiles and the fences 1.5 interquartile ranges outside them."""
    q = quantiles(df, price, {"q25": 0.25, "q75": 0.75})
    reach = (F.col("q75") - F.col("q25")) * 1.5
    return q.select(
        "q25", "q75", (F.col("q25") - reach).alias("lower_bound"), (F.col("q75") + reach).alias("upper_bound")
    )


def outlier_rows(df: DataFrame, price: str = PRICE) -> DataFrame:
    """Rows whose price lies strictly outside the fences."""
    p = F.col(price)
    fenced = with_row(df, iqr_fences(df, price), "fence")
    return fenced.where((p < F.col("fence.lower_bound")) | (p > F.col("fence.upper_bound"))).drop("fence")


def outlier_summary(df: DataFrame, price: str = PRICE) -> DataFrame:
    """Fences, and number and share of the priced rows outside them."""
    fences = iqr_fences(df, price)
    p = F.col(price)
    outside = (p < F.col("fence.lower_bound")) | (p > F.col("fence.upper_bound"))
    counted = with_row(df, fences, "fence").agg(
        F.count(p).alias("priced"), F.count_if(outside).alias("total_outliers")
    )
    return with_row(counted, fences, "fence").select(
        "total_outliers",
        share(F.col("total_outliers"), F.col("priced")).alias("outlier_percentage"),
        "fence.lower_bound",
        "fence.upper_bound",
    )


def zscore_outliers(df: DataFrame, k: float = 3.0, price: str = PRICE) -> DataFrame:
    """Rows more than ``k`` standard deviations from the mean (an extension)."""
    moments = df.agg(F.avg(price).alias("mean"), F.stddev_samp(price).alias("std"))
    score = F.try_divide(F.col(price) - F.col("m.mean"), F.col("m.std"))
    return with_row(df, moments, "m").withColumn("zscore", score).drop("m").where(F.abs("zscore") > k)


def price_bands(df: DataFrame, price: str = PRICE) -> DataFrame:
    """Budget, mid-range and premium counts.

    Both ends of a band belong to it, so a price on a quartile counts in two bands.
    """
    counts = value_counts(df, price)
    return bands_of(counts, quantiles_of_counts(counts, BAND_ENDS))


def bands_of(counts: DataFrame, marks: DataFrame) -> DataFrame:
    """The price bands of counted prices and their quantiles."""
    v, n = F.col("value"), F.col("n")
    low, mid, top = F.col("q.p25"), F.col("q.p75"), F.col("q.p100")

    def rows(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0).cast("long")).alias(name)

    totals = (
        with_row(counts, marks, "q")
        .agg(
            F.sum(n).alias("priced"),
            rows((v >= 0.0) & (v <= low), "budget"),
            rows((v >= low) & (v <= mid), "middle"),
            rows((v >= mid) & (v <= top), "premium"),
        )
        .where("priced > 0")
    )

    def band(name: str, lo: Column, hi: Column, found: str) -> Column:
        return F.struct(
            F.lit(name).alias("band"), lo.alias("band_min"), hi.alias("band_max"),
            F.col(found).alias("listings"), share(F.col(found), F.col("priced")).alias("percentage"),
        )

    return with_row(totals, marks, "q").select(
        F.inline(
            F.array(
                band("budget", F.lit(0.0), low, "budget"),
                band("mid-range", low, mid, "middle"),
                band("premium", mid, top, "premium"),
            )
        )
    )


def price_patterns(df: DataFrame, price: str = PRICE) -> DataFrame:
    """Numbers of charm prices and of whole-number prices."""
    p = F.col(price)
    return df.agg(
        F.count_if(ends_in_99(p)).alias("ending_in_99"), F.count_if(is_round(p)).alias("round_numbers")
    )


def averages(df: DataFrame, by: str = "search_term", price: str = PRICE) -> DataFrame:
    """Average price of every non-null group that has one."""
    return (
        df.where(F.col(by).isNotNull() & F.col(price).isNotNull())
        .groupBy(by)
        .agg(F.avg(price).alias("avg_price"))
    )


def market_segments(df: DataFrame, by: str = "search_term", price: str = PRICE) -> DataFrame:
    """Segment of each group by where its average lies among the price quartiles."""
    return segments_of(averages(df, by, price), quantiles(df, price, SEGMENT_ENDS))


def segments_of(group_averages: DataFrame, marks: DataFrame) -> DataFrame:
    """Segments of given group averages between given price quartiles."""
    avg = F.col("avg_price")
    segment = (
        F.when(avg <= F.col("q.p25"), "budget")
        .when(avg <= F.col("q.p50"), "mid-low")
        .when(avg <= F.col("q.p75"), "mid-high")
        .otherwise("premium")
    )
    return with_row(group_averages, marks, "q").withColumn("market_segment", segment).drop("q")


def percentile_positions(df: DataFrame, by: str = "search_term", price: str = PRICE) -> DataFrame:
    """Share of all priced rows that cost strictly less than each group's average."""
    fixed = materialise(averages(df, by, price), "averages")
    return positions_of(value_counts(df, price), fixed, by)


def positions_of(counts: DataFrame, group_averages: DataFrame, by: str = "search_term") -> DataFrame:
    """Percentile positions of given, written averages among counted prices."""
    total = counts.agg(F.sum("n")).scalar()
    return count_below(counts, group_averages, "avg_price").select(
        by, "avg_price", F.col("below").alias("rows_below"),
        share(F.col("below"), total).alias("percentile_position"),
    )


def price_analysis(df: DataFrame, price: str = PRICE) -> DataFrame:
    """Fences, outliers, bands and patterns in one row."""
    counts = value_counts(df, price)
    return analysis_of(counts, quantiles_of_counts(counts, BAND_ENDS))


def analysis_of(counts: DataFrame, marks: DataFrame) -> DataFrame:
    """The price analysis of counted prices and their quantiles."""
    v, n = F.col("value"), F.col("n")
    low, mid, top = F.col("q.p25"), F.col("q.p75"), F.col("q.p100")
    reach = (mid - low) * 1.5

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0).cast("long"))

    counted = with_row(counts, marks, "q").agg(
        F.sum(n).alias("priced"),
        rows((v < low - reach) | (v > mid + reach)).alias("total_outliers"),
        rows((v >= 0.0) & (v <= low)).alias("budget"),
        rows((v >= low) & (v <= mid)).alias("mid_range"),
        rows((v >= mid) & (v <= top)).alias("premium"),
        rows(ends_in_99(v)).alias("ending_in_99"),
        rows(is_round(v)).alias("round_numbers"),
        F.count("*").alias("unique_prices"),
        F.avg(n).alias("avg_products_per_price"),
    )
    return (
        with_row(counted, marks, "q")
        .select(
            "*", share(F.col("total_outliers"), F.col("priced")).alias("outlier_percentage"),
            (low - reach).alias("lower_bound"), (mid + reach).alias("upper_bound"),
        )
        .drop("q")
    )


def outlier_values_of(counts: DataFrame, marks: DataFrame) -> DataFrame:
    """Distinct prices outside the fences, with their number of rows."""
    v, low, mid = F.col("value"), F.col("q.p25"), F.col("q.p75")
    reach = (mid - low) * 1.5
    outside = with_row(counts, marks, "q").where((v < low - reach) | (v > mid + reach))
    return outside.select(v.alias("price"), F.col("n").alias("listings"))
