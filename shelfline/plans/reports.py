"""Reports composed of the operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators import compare, outliers, quality, rollup, stats, trends
from shelfline.operators.joins import join_on, with_row
from shelfline.operators.ranks import quantiles_of_counts
from shelfline.session import materialise

# When an observation is worth reporting.
LOW_PRICE_COMPLETENESS = 80.0
MANY_DUPLICATES = 10
FAR_ABOVE_MEAN = 10.0

# Sections of a report that are put together at the same time.
BUILDERS = 8
# What the tables of a report share.
TABLES = ("prices", "times", "counts", "marks", "averages", "quality")


def quality_report(df: DataFrame) -> DataFrame:
    """Completeness, validity and duplicates in one row."""
    return quality.quality_row(df)


def timed(df: DataFrame) -> DataFrame:
    """The listings with their day and hour."""
    known = "scrape_date" in df.columns and "scrape_hour" in df.columns
    return df if known else trends.with_day_and_hour(df)


class once:
    """A property made when first asked for, by one thread while others wait."""

    def __init__(self, make: Callable[[Report], DataFrame]) -> None:
        self.make = make

    def __set_name__(self, owner: type, name: str) -> None:
        self.name = name

    def __get__(self, report: Report, owner: type | None = None) -> DataFrame:
        with report.locks[self.name]:
            if self.name not in report.__dict__:
                report.__dict__[self.name] = self.make(report)
            return report.__dict__[self.name]


class Report:
    """The tables of a report over one scan, grouped by one column.

    The two tables most figures follow from are written to the shared folder when first
    needed; after that only quality figures and distinct names read the listings.
    """

    def __init__(self, df: DataFrame, by: str = "search_term") -> None:
        self.df = timed(df)
        self.by = by
        self.locks = {name: Lock() for name in TABLES}

    @once
    def prices(self) -> DataFrame:
        return materialise(rollup.price_cells(self.df, self.by), "price-cells")

    @once
    def times(self) -> DataFrame:
        return materialise(rollup.time_cells(self.df, self.by), "time-cells")

    @once
    def counts(self) -> DataFrame:
        return rollup.counts_of(self.prices)

    @once
    def marks(self) -> DataFrame:
        """One row with every price quantile that a table needs."""
        points = stats.marks_at([0, *stats.PERCENTILES, 100])
        return materialise(quantiles_of_counts(self.counts, points), "marks")

    @once
    def averages(self) -> DataFrame:
        return materialise(rollup.averages_of(self.prices, self.by), "averages")

    @once
    def quality(self) -> DataFrame:
        return quality.quality_row(self.df)

    def statistics(self) -> DataFrame:
        return rollup.statistics_of(self.prices, self.marks)

    def summary(self) -> DataFrame:
        return rollup.performance_of(self.prices, self.by).drop("price_std", "data_completeness")

    def percentiles(self) -> DataFrame:
        return stats.percentiles_of(self.marks)

    def histogram(self, bins: int = 10) -> DataFrame:
        ends = self.marks.select(F.col("p0").alias("lo"), F.col("p100").alias("hi"))
        return stats.histogram_of(self.counts, bins, ends)

    def weekdays(self) -> DataFrame:
        return rollup.weekdays_of(self.times)

    def listings_by(self) -> DataFrame:
        return rollup.listings_of(self.prices, self.by)

    def bands(self) -> DataFrame:
        return outliers.bands_of(self.counts, self.marks)

    def outlier_values(self) -> DataFrame:
        return outliers.outlier_values_of(self.counts, self.marks)

    def common_prices(self) -> DataFrame:
        return stats.top_of(self.counts)

    def price_analysis(self) -> DataFrame:
        return outliers.analysis_of(self.counts, self.marks)

    def daily(self) -> DataFrame:
        return rollup.daily_of(self.times)

    def daily_series(self) -> DataFrame:
        """Priced rows, mean and median price of every day."""
        return trends.daily_prices(self.df)

    def daily_by(self) -> DataFrame:
        return rollup.daily_of(self.times, [self.by])

    def overall_trend(self) -> DataFrame:
        return trends.trend_of(self.daily())

    def trend_by(self) -> DataFrame:
        return trends.trend_of_groups(self.daily_by(), self.by)

    def hourly(self) -> DataFrame:
        return rollup.hourly_of(self.times)

    def peak_hours(self) -> DataFrame:
        return trends.peaks_of(self.hourly())

    def hourly_variation(self) -> DataFrame:
        return trends.variation_of(self.hourly())

    def temporal_summary(self) -> DataFrame:
        return trends.temporal_summary_of(self.times)

    def performance(self) -> DataFrame:
        named = self.df.where(F.col(self.by).isNotNull()).groupBy(self.by)
        names = named.agg(F.count_distinct("name").alias("unique_products"))
        return join_on(rollup.performance_of(self.prices, self.by), names, [self.by])

    def cross_source(self) -> DataFrame:
        return compare.insights_of(self.averages, self.by)

    def positioning(self) -> DataFrame:
        return compare.positioning_of(self.counts, self.averages, self.marks, self.by)

    def box_plot(self) -> DataFrame:
        known = self.prices.where(F.col(self.by).isNotNull() & F.col("value").isNotNull())
        return stats.box_of(known, self.by)

    def shares(self) -> DataFrame:
        return stats.share_of(rollup.listings_of(self.prices, self.by))

    def period(self) -> DataFrame:
        return self.df.agg(
            F.min("scrape_time").alias("start"),
            F.max("scrape_time").alias("end"),
            F.count("*").alias("total_records_analyzed"),
        )

    def release(self) -> None:
        """Forget the written tables; the next figure writes them anew.

        Their folders stay until the retention of the shared folder removes them.
        """
        for name in TABLES:
            self.__dict__.pop(name, None)

    def insights(self) -> DataFrame:
        return insights_of(self.quality, self.statistics(), self.overall_trend(), self.cross_source())


def insights(df: DataFrame, by: str = "search_term") -> DataFrame:
    """Observations that follow from the measures, in a fixed order; one row each.

    The listings are read twice: once for quality and price moments, once for the daily cells
    from which the trend and the group averages follow.
    """
    p = "price_numeric"
    figures = quality.quality_row(
        df, F.avg(p).alias("mean_price"), F.stddev_samp(p).alias("std_price"), F.max(p).alias("max_price")
    )
    cells = rollup.time_cells(timed(df), by)
    trend = trends.trend_of(rollup.daily_of(cells))
    return insights_of(figures, figures, trend, compare.insights_of(rollup.averages_of_times(cells, by), by))


def insights_of(
    quality_row: DataFrame, statistics: DataFrame, trend: DataFrame, cross_source: DataFrame
) -> DataFrame:
    """The observations from given figures, each a frame of at most one row."""
    facts = quality_row.sparkSession.range(1)
    for name, frame in (("q", quality_row), ("s", statistics), ("t", trend), ("c", cross_source)):
        facts = with_row(facts, frame, name)
    q, s, t, c = (F.col(n) for n in "qstc")
    # The wording of the observations.
    rules = F.array(
        F.when(
            F.coalesce(q["price_complete"], F.lit(0.0)) < LOW_PRICE_COMPLETENESS,
            F.format_string(
                "⚠️ Price data completeness is %.1f%% - consider improving data extraction",
                F.coalesce(q["price_complete"], F.lit(0.0)),
            ),
        ),
        F.when(
            q["duplicate_products"] > MANY_DUPLICATES,
            F.format_string(
                "📊 Found %d duplicate products - deduplication recommended", q["duplicate_products"]
            ),
        ),
        F.when(
            s["std_price"] > s["mean_price"],
            "💰 High price variance detected - market shows significant price diversity",
        ),
        F.when(
            s["max_price"] > s["mean_price"] * FAR_ABOVE_MEAN,
            "🔍 Potential outliers detected - some products significantly more expensive than average",
        ),
        F.when(
            t["trend_direction"] == "increasing",
            "📈 Price trend analysis shows increasing prices over time",
        ).when(
            t["trend_direction"] == "decreasing",
            "📉 Price trend analysis shows decreasing prices over time",
        ),
        F.when(
            c["cheapest_source"].isNotNull(),
            F.format_string(
                "💸 %s offers the lowest average prices, while %s has the highest (difference: $%.2f)",
                c["cheapest_source"], c["most_expensive_source"], c["price_difference"],
            ),
        ),
    )
    found = F.array_compact(rules)
    default = F.array(F.lit("✅ All metrics appear normal"))
    return facts.select(
        F.posexplode(F.when(F.size(found) > 0, found).otherwise(default)).alias("position", "insight")
    )


NUMERIC = ("bigint", "int", "double", "float", "smallint")


def long_form(frame: DataFrame, analysis: str, dimension: str | None = None) -> DataFrame:
    """Columns of a frame as rows: ``analysis_type, metric, dimension, value, text``.

    Numbers stand in ``value``, everything else (labels, names, times) in ``text``.
    """
    label = f"cast(`{dimension}` AS string)" if dimension else "cast(null AS string)"

    def cell(c: str, kind: str) -> str:
        number, text = (f"`{c}`", "null") if kind in NUMERIC else ("null", f"`{c}`")
        return (
            f"named_struct('metric', '{c}', 'dimension', {label}, 'value', cast({number} AS double), "
            f"'text', cast({text} AS string))"
        )

    # One expression: a report makes hundreds of cells.
    cells = ", ".join(cell(c, t) for c, t in frame.dtypes if c != dimension)
    return frame.selectExpr(f"'{analysis}' AS analysis_type", f"inline(array({cells}))")


def _stack(sections: Sequence[Callable[[], DataFrame]]) -> DataFrame:
    """Sections one below the other; they are put together side by side."""
    with ThreadPoolExecutor(BUILDERS) as pool:
        frames = list(pool.map(lambda build: build(), sections))
    result = frames[0]
    for f in frames[1:]:
        result = result.unionByName(f)
    return result


def statistics_sections(r: Report) -> list[Callable[[], DataFrame]]:
    """Quality, statistics and price analysis, every figure of them."""
    return [
        lambda: long_form(r.quality, "data_quality"),
        lambda: long_form(r.listings_by(), "listings_by_source", r.by),
        lambda: long_form(r.statistics(), "price_statistics"),
        lambda: long_form(r.summary(), "by_source", r.by),
        lambda: long_form(r.percentiles(), "percentiles", "percentile"),
        lambda: long_form(r.histogram(), "histogram", "bin"),
        lambda: long_form(r.hourly().select("scrape_hour", "listings"), "rows_by_hour", "scrape_hour"),
        lambda: long_form(r.weekdays(), "rows_by_weekday", "scrape_day"),
        lambda: long_form(r.period(), "period"),
        lambda: long_form(r.price_analysis(), "price_analysis"),
        lambda: long_form(r.bands(), "price_bands", "band"),
        lambda: long_form(r.outlier_values(), "outlier_values", "price"),
        lambda: long_form(r.common_prices(), "common_prices", "price"),
    ]


def trend_sections(r: Report) -> list[Callable[[], DataFrame]]:
    """Trends, with their daily series, and comparison of groups."""
    return [
        lambda: long_form(r.overall_trend(), "overall_trend"),
        lambda: long_form(r.daily_series(), "daily_series", "scrape_date"),
        lambda: long_form(r.trend_by(), "trend_by_source", r.by),
        lambda: long_form(r.hourly(), "hourly_activity", "scrape_hour"),
        lambda: long_form(r.peak_hours(), "peak_hours"),
        lambda: long_form(r.hourly_variation(), "hourly_variation"),
        lambda: long_form(r.performance(), "source_performance", r.by),
        lambda: long_form(r.cross_source(), "cross_source"),
        lambda: long_form(r.positioning(), "market_position", r.by),
        lambda: long_form(r.period(), "analysis_period"),
    ]


def insight_section(r: Report) -> Callable[[], DataFrame]:
    return lambda: long_form(r.insights(), "insights", "position")


def chart_sections(r: Report) -> list[Callable[[], DataFrame]]:
    """The data behind every chart; cells of two dimensions are labelled by both."""
    def heat() -> DataFrame:
        cells = r.daily_by().withColumn("cell", F.concat_ws(" ", r.by, F.col("scrape_date").cast("string")))
        return cells.drop(r.by, "scrape_date")

    return [
        lambda: long_form(r.histogram(20), "chart_price_distribution", "bin"),
        lambda: long_form(r.averages, "chart_average_by_source", r.by),
        lambda: long_form(r.daily(), "chart_daily_prices", "scrape_date"),
        lambda: long_form(r.box_plot(), "chart_box_plot", r.by),
        lambda: long_form(r.shares(), "chart_source_share", r.by),
        lambda: long_form(heat(), "chart_heat_cells", "cell"),
    ]


def statistics_metrics(df: DataFrame, by: str = "search_term") -> DataFrame:
    """Quality, statistics and price analysis as one metrics table."""
    return _stack(statistics_sections(Report(df, by)))


def trend_metrics(df: DataFrame, by: str = "search_term") -> DataFrame:
    """Trends and comparison of groups as one metrics table."""
    return _stack(trend_sections(Report(df, by)))


def comprehensive_metrics(df: DataFrame, by: str = "search_term") -> DataFrame:
    """The whole report as one metrics table, from one set of shared cells."""
    r = Report(df, by)
    return _stack([*statistics_sections(r), *trend_sections(r), insight_section(r)])


def custom_metrics(
    df: DataFrame, include_stats: bool = True, include_trends: bool = True, include_charts: bool = True,
    by: str = "search_term",
) -> DataFrame:
    """The requested sections as one metrics table, ready for a report writer."""
    r = Report(df, by)
    total = df.agg(F.count("*").alias("total_products"))
    sections = [lambda: long_form(total, "total")]
    if include_stats:
        sections += statistics_sections(r)
    if include_trends:
        sections += trend_sections(r)
    if include_charts:
        sections += chart_sections(r)
    if include_stats and include_trends:
        sections.append(insight_section(r))
    else:
        sections.append(lambda: long_form(limited_insight(df), "insights", "position"))
    return _stack(sections)


def limited_insight(df: DataFrame) -> DataFrame:
    """What stands for the insights of a report that lacks the figures for them."""
    # Fixed value: the wording of the note.
    limited = "Custom report generated with limited analysis"
    return df.sparkSession.range(1).select(F.lit(0).alias("position"), F.lit(limited).alias("insight"))


def stamped(metrics: DataFrame, generated_at: str, parameters: Mapping[str, str] | None = None) -> DataFrame:
    """Add the time of the run and its parameters to a metrics table."""
    pairs = [F.lit(x) for kv in (parameters or {}).items() for x in kv]
    params = F.create_map(*pairs).cast("map<string,string>")
    return metrics.withColumn("generated_at", F.lit(generated_at)).withColumn("parameters", params)


# The tables of a trend report, each built only when asked for.
TREND_TABLES = {
    "period": Report.period,
    "overall_trend": Report.overall_trend,
    "daily_series": Report.daily_series,
    "trend_by_source": Report.trend_by,
    "hourly_activity": Report.hourly,
    "peak_hours": Report.peak_hours,
    "hourly_variation": Report.hourly_variation,
    "source_performance": Report.performance,
    "cross_source": Report.cross_source,
    "market_positioning": Report.positioning,
}

# The data behind every chart.
CHART_TABLES = {
    "price_distribution": lambda r: r.histogram(20),
    "listings_by_source": lambda r: rollup.listings_of(r.prices, r.by).orderBy(F.desc("listings"), r.by),
    "average_by_source": lambda r: r.averages,
    "daily_prices": lambda r: r.daily().orderBy("scrape_date"),
    "box_plot": Report.box_plot,
    "hourly_listings": lambda r: r.hourly().select("scrape_hour", "listings"),
    "source_share": Report.shares,
    "heat_cells": Report.daily_by,
}


def trend_report(df: DataFrame, by: str = "search_term", tables: list[str] | None = None) -> dict[str, DataFrame]:
    """The tables of a trend report, or the named ones of them."""
    r = Report(df, by)
    return {name: TREND_TABLES[name](r) for name in tables or TREND_TABLES}


def chart_tables(df: DataFrame, by: str = "search_term", tables: list[str] | None = None) -> dict[str, DataFrame]:
    """The data behind every chart, or behind the named ones."""
    r = Report(df, by)
    return {name: CHART_TABLES[name](r) for name in tables or CHART_TABLES}


def custom_report(
    df: DataFrame,
    include_stats: bool = True,
    include_trends: bool = True,
    include_charts: bool = True,
    by: str = "search_term",
) -> dict[str, DataFrame]:
    """The tables of the requested sections; insights need both statistics and trends."""
    r = Report(df, by)
    report = {"total": df.agg(F.count("*").alias("total_products"))}
    if include_stats:
        report |= {
            "bands": r.bands(), "common_prices": r.common_prices(), "weekdays": r.weekdays(),
            "quality": r.quality, "statistics": r.statistics(), "summary": r.summary(),
            "percentiles": r.percentiles(), "histogram": r.histogram(), "price_analysis": r.price_analysis(),
        }
    if include_trends:
        report["temporal_summary"] = r.temporal_summary()
        report |= {f"trend_{name}": build(r) for name, build in TREND_TABLES.items()}
    if include_charts:
        report |= {f"chart_{name}": build(r) for name, build in CHART_TABLES.items()}
    if include_stats and include_trends:
        report["insights"] = r.insights()
    else:
        report["insights"] = limited_insight(df)
    return report


def field_status(df: DataFrame) -> DataFrame:
    """Verdict on the completeness of each main field."""
    return quality.field_labels(quality.quality_row(df))
