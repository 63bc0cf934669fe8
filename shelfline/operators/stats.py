"""Price statistics, distributions and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfline.functions.temporal import weekday_name
from shelfline.operators.joins import join_on, with_row
from shelfline.operators.quality import share
from shelfline.operators.ranks import quantiles, quantiles_of_counts, value_counts

# The reported percentiles.
PERCENTILES = [5, 10, 25, 50, 75, 90, 95]

PRICE = "price_numeric"


def _moments(price: str = PRICE) -> list[Column]:
    return [
        F.count("*").alias("total_products"),
        F.count(price).alias("products_with_prices"),
        F.avg(price).alias("mean_price"),
        F.stddev_samp(price).alias("std_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
    ]


def price_statistics(df: DataFrame, price: str = PRICE) -> DataFrame:
    """One row: counts, mean, standard deviation, range, median and quartiles."""
    marks = quantiles(df, price, {"median_price": 0.5, "q25": 0.25, "q75": 0.75})
    return with_row(df.agg(*_moments(price)), marks, "q").select("*", "q.*").drop("q")


def summary_by(df: DataFrame, by: str = "search_term", price: str = PRICE) -> DataFrame:
    """Counts, average and range per non-null group; a group without prices stays."""
    return (
        df.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.count("*").alias("total_products"),
            F.count(price).alias("products_with_prices"),
            F.avg(price).alias("avg_price"),
            F.min(price).alias("min_price"),
            F.max(price).alias("max_price"),
        )
    )


def overall_and_by(df: DataFrame, by: str = "search_term", price: str = PRICE) -> DataFrame:
    """Overall and per-group statistics from one grouping-sets pass.

    ``level`` tells the overall row (``overall``) from a group's row. The quantiles use the
    same value counts for both levels.
    """
    sets = [[], [by]]
    level = F.when(F.grouping(by) == 1, F.lit("overall")).otherwise(F.lit("group")).alias("level")
    moments = df.groupingSets(sets, by).agg(level, *_moments(price))
    counts = value_counts(df, price, [by])
    both = counts.groupingSets([["value"], [by, "value"]], by, "value").agg(
        level, F.sum("n").alias("n")
    )
    marks = quantiles_of_counts(
        both, {"q25": 0.25, "median_price": 0.5, "q75": 0.75}, ["level", by]
    )
    return join_on(moments, marks, ["level", by], "left").where(
        (F.col("level") == "overall") | F.col(by).isNotNull()
    )


def percentiles(df: DataFrame, price: str = PRICE, points: list[int] | None = None) -> DataFrame:
    """One row per percentile of the price."""
    points = points or PERCENTILES
    return percentiles_of(quantiles(df, price, marks_at(points)), points)


def marks_at(points: list[int]) -> dict[str, float]:
    return {f"p{p}": p / 100.0 for p in points}


def percentiles_of(marks: DataFrame, points: list[int] | None = None) -> DataFrame:
    """A row of percentiles as one row per percentile."""
    names = marks_at(points or PERCENTILES)
    pairs = [F.struct(F.lit(n).alias("percentile"), F.col(n).alias("price")) for n in names]
    return marks.select(F.inline(F.array(*pairs))).where("price IS NOT NULL")


def approximate_percentiles(
    df: DataFrame, price: str = PRICE, points: list[int] | None = None, accuracy: int = 10000
) -> DataFrame:
    """Percentiles from a mergeable sketch: one pass, no shuffle of values."""
    points = points or PERCENTILES
    sketch = F.percentile_approx(price, [p / 100.0 for p in points], accuracy)
    return (
        df.agg(sketch.alias("v"))
        .select(F.posexplode("v").alias("i", "price"))
        .select(F.element_at(F.array(*[F.lit(f"p{p}") for p in points]), F.col("i") + 1).alias("percentile"), "price")
    )


def rank_errors(
    df: DataFrame, price: str = PRICE, points: list[int] | None = None, accuracy: int = 10000
) -> DataFrame:
    """Whether each approximate percentile has its rank within the sketch's bound.

    The share of prices below a value and up to it must embrace the wanted share, give or
    take one part in ``accuracy``.
    """
    found = approximate_percentiles(df, price, points, accuracy)
    one_row = found.agg(F.collect_list(F.struct("percentile", "price")).alias("v")).scalar()
    p, marks = F.col(price), points or PERCENTILES
    known = df.where(p.isNotNull()).withColumn("v", one_row)

    def counted_at(m: int) -> list[Column]:
        at = F.get(F.filter("v", lambda e: e["percentile"] == f"p{m}"), F.lit(0))["price"]
        return [F.count_if(p < at).alias(f"below_{m}"), F.count_if(p <= at).alias(f"upto_{m}")]

    sums = [c for m in marks for c in counted_at(m)]
    counted = known.agg(F.count("*").alias("n"), *sums)
    slack = F.col("n") / F.lit(float(accuracy)) + 1
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f"p{m}").alias("percentile"),
                        ((F.col(f"below_{m}") <= F.col("n") * (m / 100.0) + slack)
                         & (F.col(f"upto_{m}") >= F.col("n") * (m / 100.0) - slack)).alias("within_bound"),
                    )
                    for m in marks
                ]
            )
        )
    )


def histogram(df: DataFrame, price: str = PRICE, bins: int = 10) -> DataFrame:
    """Equal-width bins over the price range; the last bin is closed, empty bins are listed.

    A single distinct price gives a range of one around it.
    """
    rows = df.where(F.col(price).isNotNull())
    return histogram_of(rows.select(F.col(price).alias("value"), F.lit(1).cast("long").alias("n")), bins)


def histogram_of(counts: DataFrame, bins: int = 10, ends: DataFrame | None = None) -> DataFrame:
    """The histogram of counted prices; ``ends`` holds their range as lo and hi when known."""
    lo, hi = F.col("lo"), F.col("hi")
    if ends is None:
        ends = counts.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    span = (
        ends.select(
            F.when(lo == hi, lo - 0.5).otherwise(lo).alias("lo"),
            F.when(lo == hi, hi + 0.5).otherwise(hi).alias("hi"),
        )
        .select("lo", ((hi - lo) / F.lit(float(bins))).alias("step"))
    )
    start, step, x = F.col("span.lo"), F.col("span.step"), F.col("value")
    near = F.greatest(F.least(F.floor((x - start) / step), F.lit(bins - 1)), F.lit(0))
    # Rounding in the division may miss by one bin; the edges decide.
    near_bin = F.col("near")
    exact = (
        F.when(x < start + near_bin * step, near_bin - 1)
        .when((near_bin < bins - 1) & (x >= start + (near_bin + 1) * step), near_bin + 1)
        .otherwise(near_bin)
    )
    counted = (
        with_row(counts, span, "span")
        .withColumn("near", near)
        .groupBy(exact.cast("int").alias("bin"))
        .agg(F.sum("n").alias("listings"))
    )
    all_bins = counts.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        with_row(all_bins.join(F.broadcast(counted), "bin", "left"), span, "span")
        .where(start.isNotNull())
        .select(
            "bin",
            (start + F.col("bin") * step).alias("lower_edge"),
            (start + (F.col("bin") + 1) * step).alias("upper_edge"),
            F.coalesce("listings", F.lit(0).cast("long")).alias("listings"),
        )
    )


def rows_by_hour(df: DataFrame, time: str = "scrape_time") -> DataFrame:
    return (
        df.where(F.col(time).isNotNull())
        .groupBy(F.hour(time).alias("scrape_hour"))
        .agg(F.count("*").alias("listings"))
    )


def rows_by_weekday(df: DataFrame, time: str = "scrape_time") -> DataFrame:
    return (
        df.where(F.col(time).isNotNull())
        .groupBy(weekday_name(F.col(time)).alias("scrape_day"))
        .agg(F.count("*").alias("listings"))
    )


def observation_span(df: DataFrame, time: str = "scrape_time") -> DataFrame:
    return df.agg(F.min(time).alias("earliest"), F.max(time).alias("latest"))


def price_clustering(df: DataFrame, price: str = PRICE) -> DataFrame:
    """Number of distinct prices and the mean number of rows that share one."""
    return value_counts(df, price).agg(
        F.count("*").alias("unique_prices"), F.avg("n").alias("avg_products_per_price")
    )


def source_table(df: DataFrame, by: str = "search_term", price: str = PRICE) -> DataFrame:
    """Count, mean and median price per group, rounded to cents."""
    base = df.where(F.col(by).isNotNull())
    plain = base.groupBy(by).agg(F.count(price).alias("priced"), F.round(F.avg(price), 2).alias("mean_price"))
    marks = quantiles(base, price, {"median_price": 0.5}, [by])
    return join_on(plain, marks, [by], "left").withColumn("median_price", F.round("median_price", 2))


def share_by(df: DataFrame, by: str = "search_term") -> DataFrame:
    """Rows per non-null group and their share of all such rows, in percent."""
    return share_of(df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("listings")))


def share_of(counted: DataFrame) -> DataFrame:
    total = counted.agg(F.sum("listings")).scalar()
    return counted.withColumn("share_pct", F.round(share(F.col("listings"), total), 1))


def source_labels(df: DataFrame, by: str = "source") -> DataFrame:
    """Rows per source; a missing source is called Unknown."""
    label = F.coalesce(F.col(by), F.lit("Unknown")).alias(by)
    return df.groupBy(label).agg(F.count("*").alias("listings"))


def box_summary(df: DataFrame, by: str = "search_term", price: str = PRICE) -> DataFrame:
    """Quartiles and whiskers per group.

    A whisker ends at the last price within 1.5 interquartile ranges of the box. Only the
    distinct prices of a group are compared with its fences.
    """
    return box_of(value_counts(df.where(F.col(by).isNotNull()), price, [by]), by)


def box_of(counts: DataFrame, by: str = "search_term") -> DataFrame:
    """The box-plot figures of prices counted per group."""
    box = quantiles_of_counts(counts, {"q25": 0.25, "median_price": 0.5, "q75": 0.75}, [by])
    reach = (F.col("q75") - F.col("q25")) * 1.5
    inside = (F.col("value") >= F.col("q25") - reach) & (F.col("value") <= F.col("q75") + reach)
    return (
        counts.join(box, by)
        .groupBy(by)
        .agg(
            F.max("q25").alias("q25"),
            F.max("median_price").alias("median_price"),
            F.max("q75").alias("q75"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("n"))).alias("fliers"),
        )
    )


def prices_by_day(df: DataFrame, by: str = "search_term", price: str = PRICE) -> DataFrame:
    """Mean price of every group on every day, one row each; nothing has to be named ahead."""
    return (
        df.where(F.col(by).isNotNull() & F.col(price).isNotNull())
        .withColumn("day", F.date_format("scrape_time", "yyyy-MM-dd"))
        .groupBy(by, "day")
        .agg(F.avg(price).alias("mean_price"), F.count("*").alias("priced"))
    )


def pivot_by_day(
    df: DataFrame, days: list[str], by: str = "search_term", price: str = PRICE
) -> DataFrame:
    """Mean price with one row per group and one column per given day.

    A view of ``prices_by_day``; ``other_days`` counts the priced rows of all other days.
    """
    cells = prices_by_day(df, by, price)
    shown = [F.max(F.when(F.col("day") == d, F.col("mean_price"))).alias(d) for d in days]
    others = F.coalesce(F.sum(F.when(~F.coalesce(F.col("day").isin(days), F.lit(False)), F.col("priced"))), F.lit(0))
    return cells.groupBy(by).agg(*shown, others.cast("long").alias("other_days"))


def top_prices(df: DataFrame, k: int = 10, price: str = PRICE) -> DataFrame:
    """The most common prices; the lower price comes first on ties."""
    return top_of(value_counts(df, price), k)


def top_of(counts: DataFrame, k: int = 10) -> DataFrame:
    """The most common of counted prices."""
    return (
        counts.select(F.col("value").alias("price"), F.col("n").alias("listings"))
        .orderBy(F.desc("listings"), "price")
        .limit(k)
    )


def first_per_group(df: DataFrame, by: str, order: list[str], k: int = 3) -> DataFrame:
    """The first ``k`` rows of each group.

    Spark turns the rank filter into a group limit ahead of the shuffle, so a task receives
    at most ``k`` rows of a group from each input partition.
    """
    ranked = df.withColumn("rank_in_group", F.row_number().over(W.partitionBy(by).orderBy(*order)))
    return ranked.where(F.col("rank_in_group") <= k)
