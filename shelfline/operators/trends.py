"""Prices over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfline.operators.joins import join_on
from shelfline.operators.ranks import quantiles

PRICE = "price_numeric"
DAY = "scrape_date"

# Fixed value: how strong a correlation must be to name a direction.
DIRECTION_LIMIT = 0.1


def with_day_and_hour(df: DataFrame, time: str = "scrape_time") -> DataFrame:
    return df.withColumn("scrape_date", F.to_date(time)).withColumn("scrape_hour", F.hour(time))


def daily_means(df: DataFrame, by: list[str] | None = None, price: str = PRICE) -> DataFrame:
    """Priced rows and mean price per day, and per group when ``by`` is given."""
    by = by or []
    kept = df.where(F.col(DAY).isNotNull())
    for b in by:
        kept = kept.where(F.col(b).isNotNull())
    return kept.groupBy(*by, DAY).agg(F.count(price).alias("priced"), F.avg(price).alias("mean_price"))


def daily_prices(df: DataFrame, price: str = PRICE) -> DataFrame:
    """Priced rows, mean, median, deviation and range per day."""
    kept = df.where(F.col(DAY).isNotNull())
    plain = kept.groupBy(DAY).agg(
        F.count(price).alias("priced"),
        F.avg(price).alias("mean_price"),
        F.stddev_samp(price).alias("std_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
    )
    return join_on(plain, quantiles(kept, price, {"median_price": 0.5}, [DAY]), [DAY], "left")


def daily_prices_by(df: DataFrame, by: str = "search_term", price: str = PRICE) -> DataFrame:
    """Priced rows, mean and median per group and day."""
    kept = df.where(F.col(DAY).isNotNull() & F.col(by).isNotNull())
    marks = quantiles(kept, price, {"median_price": 0.5}, [by, DAY])
    return join_on(daily_means(df, [by], price), marks, [by, DAY], "left")


def numbered_days(daily: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Days numbered from 0 in date order. The input holds one row per day (and group)."""
    order = W.partitionBy(*(by or [])).orderBy(DAY)
    return daily.withColumn("day_number", F.row_number().over(order) - 1)


def series(df: DataFrame, price: str = PRICE) -> DataFrame:
    """The daily series in date order, days without prices included."""
    return daily_prices(df, price).select(DAY, "priced", "mean_price", "median_price").orderBy(DAY)


def direction(correlation: Column) -> Column:
    return (
        F.when(correlation > DIRECTION_LIMIT, "increasing")
        .when(correlation < -DIRECTION_LIMIT, "decreasing")
        .otherwise("stable")
    )


def _correlation(x: str, y: str) -> Column:
    """Pearson correlation over rows where ``x`` is known; 0 when it is undefined.

    ``corr`` raises on a constant series under ANSI arithmetic.
    """
    known = F.when(F.col(x).isNotNull(), F.col(y))
    spread = F.stddev_samp(x) * F.stddev_samp(known)
    return F.coalesce(F.try_divide(F.covar_samp(x, known), spread), F.lit(0.0))


def overall_trend(df: DataFrame, price: str = PRICE) -> DataFrame:
    """Correlation of the daily mean with time; no row unless there are two days."""
    return trend_of(daily_means(df, price=price))


def trend_of(daily: DataFrame) -> DataFrame:
    """The overall trend from daily means."""
    return (
        numbered_days(daily)
        .agg(
            F.count("*").alias("total_days"),
            F.avg("priced").alias("avg_daily_products"),
            _correlation("mean_price", "day_number").alias("price_trend_correlation"),
        )
        .where("total_days > 1")
        .withColumn("trend_direction", direction(F.col("price_trend_correlation")))
    )


def trend_by(df: DataFrame, by: str = "search_term", price: str = PRICE) -> DataFrame:
    """Trend per group, with the deviation of its daily means; needs two days."""
    return trend_of_groups(daily_means(df, [by], price), by)


def trend_of_groups(daily: DataFrame, by: str = "search_term") -> DataFrame:
    """The trend of every group from daily means per group."""
    return (
        numbered_days(daily, [by])
        .groupBy(by)
        .agg(
            F.count("*").alias("days_tracked"),
            _correlation("mean_price", "day_number").alias("price_trend_correlation"),
            F.avg("priced").alias("avg_daily_products"),
            F.stddev_samp("mean_price").alias("price_volatility"),
        )
        .where("days_tracked > 1")
        .withColumn("trend_direction", direction(F.col("price_trend_correlation")))
    )


def hourly_activity(df: DataFrame, price: str = PRICE) -> DataFrame:
    """Rows, priced rows and mean price per hour of the day."""
    return (
        df.where(F.col("scrape_hour").isNotNull())
        .groupBy("scrape_hour")
        .agg(
            F.count("*").alias("listings"),
            F.count(price).alias("priced"),
            F.avg(price).alias("mean_price"),
        )
    )


def _busiest(count: str) -> Column:
    return F.max_by("scrape_hour", F.struct(F.col(count), -F.col("scrape_hour")))


def peak_hours(df: DataFrame, price: str = PRICE) -> DataFrame:
    """The busiest hour by priced rows and by all rows; the earlier hour wins a tie."""
    return peaks_of(hourly_activity(df, price))


def peaks_of(hourly: DataFrame) -> DataFrame:
    return hourly.agg(
        _busiest("priced").alias("peak_hour_priced"), _busiest("listings").alias("peak_hour_all")
    )


def hourly_variation(df: DataFrame, price: str = PRICE) -> DataFrame:
    """Deviation of the hourly mean prices."""
    return variation_of(hourly_activity(df, price))


def variation_of(hourly: DataFrame) -> DataFrame:
    return hourly.agg(F.stddev_samp("mean_price").alias("price_variation_by_hour"))


def temporal_summary(df: DataFrame) -> DataFrame:
    """Date range, rows, days with data and the busiest hour.

    Rows are first counted per day and hour; everything else follows from those counts.
    """
    return temporal_summary_of(
        df.groupBy("scrape_date", "scrape_hour").agg(F.count("*").alias("listings"))
    )


def temporal_summary_of(cells: DataFrame) -> DataFrame:
    """The temporal summary from row counts per day and hour."""
    busiest = (
        cells.where(F.col("scrape_hour").isNotNull())
        .groupBy("scrape_hour")
        .agg(F.sum("listings").alias("listings"))
        .agg(_busiest("listings"))
        .scalar()
    )
    return cells.agg(
        F.concat(F.min("scrape_date").cast("string"), F.lit(" to "), F.max("scrape_date").cast("string")).alias("date_range"),
        F.sum("listings").alias("total_data_points"),
        F.count_distinct("scrape_date").alias("days_with_data"),
    ).select("*", busiest.alias("peak_hour"))


def price_correlation_with(
    df: DataFrame, other: str, by: str = "search_term", price: str = PRICE
) -> DataFrame:
    """Correlation of every group's daily mean prices with those of one group (an extension).

    The chosen group has one row per day, so the join adds no rows.
    """
    daily = daily_means(df, [by], price).where("mean_price IS NOT NULL")
    chosen = daily.where(F.col(by) == other).select(DAY, F.col("mean_price").alias("other_mean"))
    return (
        daily.where(F.col(by) != other).join(chosen, DAY)
        .groupBy(by)
        .agg(F.count("*").alias("shared_days"), _correlation("mean_price", "other_mean").alias("correlation"))
        .where("shared_days > 1")
    )
