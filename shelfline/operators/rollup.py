"""Small tables from which most report figures follow.

One table counts the rows of every group and price, the other the rows of every group, day
and hour. Both are plain aggregates with partial aggregation, so a hot group is reduced
before it is shuffled. A report writes them once and reads no listing again for its figures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.temporal import weekday_name
from shelfline.operators.joins import with_row
from shelfline.operators.quality import share

PRICE = "price_numeric"


def price_cells(df: DataFrame, by: str = "search_term", price: str = PRICE) -> DataFrame:
    """Rows per group and price, missing groups and prices included: ``by, value, n``."""
    return df.groupBy(by, F.col(price).alias("value")).agg(F.count("*").alias("n"))


def time_cells(df: DataFrame, by: str = "search_term", price: str = PRICE) -> DataFrame:
    """Rows, priced rows and price total per group, day and hour."""
    return df.groupBy(by, "scrape_date", "scrape_hour").agg(
        F.count("*").alias("listings"), F.count(price).alias("priced"), F.sum(price).alias("price_total")
    )


def counts_of(cells: DataFrame) -> DataFrame:
    """Value counts over all groups."""
    return cells.where("value IS NOT NULL").groupBy("value").agg(F.sum("n").alias("n"))


def _weighted(center: Column) -> list[Column]:
    v, n = F.col("value"), F.col("n")
    known = F.sum(F.when(v.isNotNull(), n))
    off = v - center
    squares = F.sum(n * off * off) - F.try_divide(F.pow(F.sum(n * off), F.lit(2.0)), known)
    # Rounding may leave a tiny negative number where all prices are equal.
    variance = F.try_divide(F.greatest(squares, F.lit(0.0)), F.nullif(known - 1, F.lit(0)))
    return [
        F.sum(n).alias("total_products"),
        F.coalesce(known, F.lit(0).cast("long")).alias("products_with_prices"),
        F.try_divide(F.sum(v * n), known).alias("avg_price"),
        F.sqrt(variance).alias("price_std"),
        F.min(v).alias("min_price"),
        F.max(v).alias("max_price"),
    ]


def _centered(cells: DataFrame) -> DataFrame:
    """Cells with the overall mean, around which squares are summed without cancellation."""
    v, n = F.col("value"), F.col("n")
    mean = cells.agg(
        F.try_divide(F.sum(v * n), F.sum(F.when(v.isNotNull(), n))).alias("mean")
    )
    return with_row(cells, mean, "overall")


def statistics_of(cells: DataFrame, marks: DataFrame) -> DataFrame:
    """Overall price statistics, as ``stats.price_statistics`` computes them from rows."""
    row = with_row(_centered(cells).agg(*_weighted(F.col("overall.mean"))), marks, "q")
    return row.select(
        "total_products", "products_with_prices", F.col("avg_price").alias("mean_price"),
        F.col("price_std").alias("std_price"), "min_price", "max_price",
        F.col("q.p50").alias("median_price"), F.col("q.p25").alias("q25"), F.col("q.p75").alias("q75"),
    )


def performance_of(cells: DataFrame, by: str = "search_term") -> DataFrame:
    """Counts, completeness and price statistics per non-null group."""
    grouped = _centered(cells.where(F.col(by).isNotNull())).groupBy(by).agg(*_weighted(F.col("overall.mean")))
    return grouped.withColumn(
        "data_completeness", share(F.col("products_with_prices"), F.col("total_products"))
    )


def averages_of(cells: DataFrame, by: str = "search_term") -> DataFrame:
    """Average price of every non-null group that has one."""
    v, n = F.col("value"), F.col("n")
    return (
        cells.where(F.col(by).isNotNull() & v.isNotNull())
        .groupBy(by)
        .agg((F.sum(v * n) / F.sum("n")).alias("avg_price"))
    )


def averages_of_times(cells: DataFrame, by: str = "search_term") -> DataFrame:
    """The same averages from time cells."""
    return (
        cells.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(F.try_divide(F.sum("price_total"), F.sum("priced")).alias("avg_price"))
        .where("avg_price IS NOT NULL")
    )


def weekdays_of(cells: DataFrame) -> DataFrame:
    """Rows per day of the week, as ``stats.rows_by_weekday``."""
    return (
        cells.where(F.col("scrape_date").isNotNull())
        .groupBy(weekday_name(F.col("scrape_date")).alias("scrape_day"))
        .agg(F.sum("listings").alias("listings"))
    )


def daily_of(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Priced rows and mean price per day (and group), as ``trends.daily_means``."""
    by = by or []
    kept = cells.where(F.col("scrape_date").isNotNull())
    for b in by:
        kept = kept.where(F.col(b).isNotNull())
    return kept.groupBy(*by, "scrape_date").agg(
        F.sum("priced").alias("priced"),
        F.try_divide(F.sum("price_total"), F.sum("priced")).alias("mean_price"),
    )


def hourly_of(cells: DataFrame) -> DataFrame:
    """Rows, priced rows and mean price per hour of the day, as ``trends.hourly_activity``."""
    return (
        cells.where(F.col("scrape_hour").isNotNull())
        .groupBy("scrape_hour")
        .agg(
            F.sum("listings").alias("listings"),
            F.sum("priced").alias("priced"),
            F.try_divide(F.sum("price_total"), F.sum("priced")).alias("mean_price"),
        )
    )


def listings_of(cells: DataFrame, by: str = "search_term") -> DataFrame:
    """Rows per non-null group."""
    return cells.where(F.col(by).isNotNull()).groupBy(by).agg(F.sum("n").alias("listings"))
