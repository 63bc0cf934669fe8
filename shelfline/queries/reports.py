"""Insights, report tables and chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import stats
from shelfline.plans import reports
from shelfline.queries.analytics import (
    BOX, CROSS, DAILY, DIRECTION, NUMBERED, PERFORMANCE, _histogram_sql,
)
from shelfline.queries.registry import EV, ORACLES, SHOP, days, query, rounded, stamps
from shelfline.queries.scans import events, shop
from shelfline.session import scratch_dir
from shelfline.sources import sinks

RUN = "2024-02-01T00:00:00"

# Means of few rows often end in an exact half at six digits; sums of sums may tip it.
DAILY_9 = DAILY.replace(", 6)", ", 9)")


def _trend(spark, folder, name):
    return reports.trend_report(events(spark, folder), tables=[name])[name]


def _chart(spark, folder, name):
    return reports.chart_tables(events(spark, folder), tables=[name])[name]


@query(f"""WITH {SHOP} SELECT count(*) AS total_records,
round(count(name) * 100.0::DOUBLE / count(*), 6) AS name_complete,
round(count(price_numeric) * 100.0::DOUBLE / count(*), 6) AS price_complete,
round(count(link) * 100.0::DOUBLE / count(*), 6) AS link_complete,
round(count(availability) * 100.0::DOUBLE / count(*), 6) AS availability_complete,
count(*) FILTER (WHERE price_numeric > 0) AS valid_prices, count(*) FILTER (WHERE price_numeric <= 0) AS invalid_prices,
count(*) FILTER (WHERE price_numeric IS NULL) AS missing_prices, count(*) FILTER (WHERE link LIKE 'http%') AS valid_links,
count(*) - (SELECT count(*) FROM (SELECT DISTINCT name, search_term FROM sh)) AS duplicate_products FROM sh""")
def e0_quality_report(spark, folder):
    return rounded(reports.quality_report(shop(spark, folder)))


SHOP_AS_EV = SHOP.replace("SELECT *, price", "SELECT *, scrape_time::DATE AS scrape_date, price").replace("sh AS", "ev AS")


def _insights_sql(ev: str) -> str:
    """The observations over a table ``ev``. The lowest and highest average are named."""
    return f"""WITH {ev},
q AS (SELECT count(price_numeric) * 100.0::DOUBLE / count(*) AS pc,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT name, search_term FROM ev)) AS dup,
  avg(price_numeric) AS m, stddev_samp(price_numeric) AS s, max(price_numeric) AS x FROM ev),
{NUMBERED}, t AS (SELECT coalesce(corr(m, i), 0) AS r FROM d),
{CROSS.replace('price_numeric IS NOT NULL', 'price_numeric IS NOT NULL AND search_term IS NOT NULL')},
c AS (SELECT (SELECT search_term FROM a ORDER BY m, search_term LIMIT 1) AS lo,
  (SELECT search_term FROM a ORDER BY m DESC, search_term LIMIT 1) AS hi, max(m) - min(m) AS diff FROM a),
l AS (SELECT list_filter([
  CASE WHEN pc < 80 THEN '⚠️ Price data completeness is ' || format('{{:.1f}}', pc) || '% - consider improving data extraction' END,
  CASE WHEN dup > 10 THEN '📊 Found ' || dup || ' duplicate products - deduplication recommended' END,
  CASE WHEN s > m THEN '💰 High price variance detected - market shows significant price diversity' END,
  CASE WHEN x > m * 10 THEN '🔍 Potential outliers detected - some products significantly more expensive than average' END,
  CASE WHEN r > 0.1 THEN '📈 Price trend analysis shows increasing prices over time'
       WHEN r < -0.1 THEN '📉 Price trend analysis shows decreasing prices over time' END,
  '💸 ' || lo || ' offers the lowest average prices, while ' || hi || ' has the highest (difference: $' || format('{{:.2f}}', diff) || ')'
], lambda z: z IS NOT NULL) AS v FROM q, t, c)
SELECT (generate_subscripts(v, 1) - 1)::INT AS position, unnest(v) AS insight FROM l"""


@query(_insights_sql(SHOP_AS_EV))
def e1_insights(spark, folder):
    rows = shop(spark, folder).withColumn("scrape_date", F.to_date("scrape_time"))
    return reports.insights(rows)


STATS_SQL = f"""WITH {EV}, q AS (SELECT count(*) AS n, count(price_numeric) AS k, avg(price_numeric) AS m,
  stddev_samp(price_numeric) AS s, min(price_numeric) AS lo, max(price_numeric) AS hi,
  quantile_cont(price_numeric, 0.5) AS md, quantile_cont(price_numeric, 0.25) AS a, quantile_cont(price_numeric, 0.75) AS b FROM ev)
SELECT 'price_statistics' AS analysis_type, unnest(['total_products','products_with_prices','mean_price','std_price','min_price',
  'max_price','median_price','q25','q75']) AS metric, NULL::VARCHAR AS dimension,
  round(unnest([n, k, m, s, lo, hi, md, a, b]::DOUBLE[]), 6) AS value, NULL::VARCHAR AS text,
  '{RUN}' AS generated_at, 'search_term' AS grouping_column FROM q"""


@query(STATS_SQL)
def e3_metrics_table(spark, folder):
    metrics = reports.long_form(stats.price_statistics(events(spark, folder)), "price_statistics")
    table = reports.stamped(metrics, RUN, {"by": "search_term"})
    return rounded(table.withColumn("grouping_column", F.col("parameters")["by"]).drop("parameters"))


FINE = ("daily_series", "chart_daily_prices", "chart_heat_cells")


def _report_roundtrip(spark, metrics, label, fmt):
    path = scratch_dir(spark, label)
    sinks.write_report(metrics, path, fmt)
    reader = spark.read.schema(metrics.schema)
    back = sinks.read_csv(spark, path, metrics.schema) if fmt == "csv" else reader.format(fmt).load(path)
    # Means of few rows are compared to nine digits, for the reason given above.
    fine = F.col("analysis_type").isin(*FINE)
    return back.withColumn("value", F.when(fine, F.round("value", 9)).otherwise(F.round("value", 6)))


@query(f"""WITH {EV} SELECT strftime(min(scrape_time), '%Y-%m-%d %H:%M:%S') AS start,
strftime(max(scrape_time), '%Y-%m-%d %H:%M:%S') AS "end", count(*) AS total_records_analyzed FROM ev""")
def e4_trend_report_period(spark, folder):
    return stamps(_trend(spark, folder, "period"), "start", "end")


@query(f"WITH {EV} {PERFORMANCE} FROM ev GROUP BY 1")
def e4_trend_report_performance(spark, folder):
    return rounded(_trend(spark, folder, "source_performance"))


@query(f"""WITH {EV}, {NUMBERED}, t AS (SELECT count(*) AS total_days, avg(n) AS avg_daily, coalesce(corr(m, i), 0) AS r FROM d)
SELECT total_days, round(avg_daily, 6) AS avg_daily_products, round(r, 6) AS price_trend_correlation,
{DIRECTION} AS trend_direction FROM t""")
def e4_trend_report_overall(spark, folder):
    return rounded(_trend(spark, folder, "overall_trend"))


SEGMENTS = f"""WITH {EV}, {CROSS}, q AS (SELECT quantile_cont(price_numeric, 0.25) AS p25,
  quantile_cont(price_numeric, 0.5) AS p50, quantile_cont(price_numeric, 0.75) AS p75 FROM ev)
SELECT a.search_term, CASE WHEN any_value(m) <= any_value(p25) THEN 'budget' WHEN any_value(m) <= any_value(p50) THEN 'mid-low'
  WHEN any_value(m) <= any_value(p75) THEN 'mid-high' ELSE 'premium' END AS market_segment,
  round(any_value(m), 6) AS avg_price, count(*) FILTER (WHERE price_numeric < m) AS rows_below,
  round(count(*) FILTER (WHERE price_numeric < m) * 100.0::DOUBLE / count(price_numeric), 6) AS percentile_position
FROM a, ev, q GROUP BY 1"""


@query(SEGMENTS)
def e4_market_positioning(spark, folder):
    return rounded(_trend(spark, folder, "market_positioning"))


@query(_histogram_sql(20))
def e5_chart_price_distribution(spark, folder):
    return rounded(_chart(spark, folder, "price_distribution"))


@query(f"WITH {EV} {DAILY_9} FROM ev GROUP BY ev.scrape_date ORDER BY ev.scrape_date")
def e5_chart_daily_prices(spark, folder):
    return rounded(days(_chart(spark, folder, "daily_prices"), "scrape_date"), 9)


@query(f"WITH {EV}, {BOX}")
def e5_chart_box_plot(spark, folder):
    return rounded(_chart(spark, folder, "box_plot"))


@query(f"""WITH {EV} {DAILY_9}, search_term FROM ev GROUP BY search_term, ev.scrape_date""")
def e5_chart_heat_cells(spark, folder):
    return rounded(days(_chart(spark, folder, "heat_cells"), "scrape_date"), 9)


@query(f"WITH {EV} SELECT search_term, round(avg(price_numeric), 6) AS avg_price FROM ev GROUP BY 1")
def e5_chart_average_by_source(spark, folder):
    return rounded(_chart(spark, folder, "average_by_source"))


HOURLY = """h AS (SELECT scrape_hour, count(*) AS n, count(price_numeric) AS k, avg(price_numeric) AS m FROM ev GROUP BY 1)"""


@query(f"WITH {EV}, {HOURLY} SELECT scrape_hour, n AS listings, k AS priced, round(m, 6) AS mean_price FROM h")
def e4_trend_report_hourly(spark, folder):
    return rounded(_trend(spark, folder, "hourly_activity"))


@query(f"""WITH {EV}, {HOURLY} SELECT (SELECT scrape_hour FROM h ORDER BY k DESC, 1 LIMIT 1) AS peak_hour_priced,
(SELECT scrape_hour FROM h ORDER BY n DESC, 1 LIMIT 1) AS peak_hour_all""")
def e4_trend_report_peaks(spark, folder):
    return _trend(spark, folder, "peak_hours")


@query(f"""WITH {EV}, d AS (SELECT search_term, scrape_date, count(price_numeric) AS n, avg(price_numeric) AS m,
  row_number() OVER (PARTITION BY search_term ORDER BY scrape_date) - 1 AS i FROM ev GROUP BY 1, 2),
t AS (SELECT search_term, count(*) AS days_tracked, avg(n) AS avg_daily, coalesce(corr(m, i), 0) AS r,
  stddev_samp(m) AS v FROM d GROUP BY 1 HAVING count(*) > 1)
SELECT search_term, days_tracked, round(r, 6) AS price_trend_correlation, round(avg_daily, 6) AS avg_daily_products,
round(v, 6) AS price_volatility, {DIRECTION} AS trend_direction FROM t""")
def e4_trend_report_by_source(spark, folder):
    return rounded(_trend(spark, folder, "trend_by_source"))


@query(f"WITH {EV} SELECT search_term, count(*) AS listings, "
       "round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM ev), 1) AS share_pct FROM ev GROUP BY 1")
def e5_chart_source_share(spark, folder):
    return _chart(spark, folder, "source_share")


@query(f"""WITH {EV}, f AS (SELECT quantile_cont(price_numeric, 0.25) AS a, quantile_cont(price_numeric, 0.75) AS b,
  max(price_numeric) AS x, a - 1.5 * (b - a) AS lo, b + 1.5 * (b - a) AS hi FROM ev),
c AS (SELECT price_numeric AS p, count(*) AS n FROM ev WHERE price_numeric IS NOT NULL GROUP BY 1)
SELECT sum(n)::BIGINT AS priced, coalesce(sum(n) FILTER (WHERE p < lo OR p > hi), 0)::BIGINT AS total_outliers,
coalesce(sum(n) FILTER (WHERE p >= 0 AND p <= a), 0)::BIGINT AS budget,
coalesce(sum(n) FILTER (WHERE p >= a AND p <= b), 0)::BIGINT AS mid_range,
coalesce(sum(n) FILTER (WHERE p >= b AND p <= x), 0)::BIGINT AS premium,
coalesce(sum(n) FILTER (WHERE p::VARCHAR LIKE '%.99'), 0)::BIGINT AS ending_in_99,
coalesce(sum(n) FILTER (WHERE p % 1 = 0), 0)::BIGINT AS round_numbers,
count(*) AS unique_prices, round(avg(n), 6) AS avg_products_per_price,
round(coalesce(sum(n) FILTER (WHERE p < lo OR p > hi), 0) * 100.0::DOUBLE / sum(n), 6) AS outlier_percentage,
round(any_value(lo), 6) AS lower_bound, round(any_value(hi), 6) AS upper_bound FROM c, f""")
def o0_price_analysis(spark, folder):
    return rounded(reports.Report(events(spark, folder)).price_analysis())


STATS_ROWS = f"""WITH {EV}, q AS (SELECT count(*) AS n, count(price_numeric) AS k, avg(price_numeric) AS m,
  stddev_samp(price_numeric) AS s, min(price_numeric) AS lo, max(price_numeric) AS hi,
  quantile_cont(price_numeric, 0.5) AS md, quantile_cont(price_numeric, 0.25) AS a, quantile_cont(price_numeric, 0.75) AS b FROM ev)
SELECT n AS total_products, k AS products_with_prices, round(m, 6) AS mean_price, round(s, 6) AS std_price,
  lo AS min_price, hi AS max_price, round(md, 6) AS median_price, round(a, 6) AS q25, round(b, 6) AS q75 FROM q"""


@query(STATS_ROWS)
def e3_statistics_from_cells(spark, folder):
    return rounded(reports.Report(events(spark, folder)).statistics())


def _long_sql(analysis: str, wide: str, metrics: list[str], dimension: str | None = None, texts: list[str] = ()) -> str:
    """SQL that turns the columns of a wide query into rows of a metrics table."""
    label = f"{dimension}::VARCHAR" if dimension else "NULL::VARCHAR"
    names = ", ".join(f"'{m}'" for m in [*metrics, *texts])
    values = ", ".join([f"{m}::DOUBLE" for m in metrics] + ["NULL"] * len(texts))
    words = ", ".join(["NULL"] * len(metrics) + [f"{t}::VARCHAR" for t in texts])
    return (
        f"SELECT '{analysis}' AS analysis_type, unnest([{names}]) AS metric, {label} AS dimension, "
        f"unnest([{values}]::DOUBLE[]) AS value, unnest([{words}]::VARCHAR[]) AS text FROM ({wide}) w"
    )


QUALITY_SQL = f"""WITH {EV} SELECT count(*) AS total_records, 100.0 AS name_complete,
round(count(price_numeric) * 100.0::DOUBLE / count(*), 6) AS price_complete, 100.0 AS link_complete,
round(count(*) FILTER (WHERE search_term <> 'error') * 100.0::DOUBLE / count(*), 6) AS availability_complete,
count(*) FILTER (WHERE price_numeric > 0) AS valid_prices, count(*) FILTER (WHERE price_numeric <= 0) AS invalid_prices,
count(*) FILTER (WHERE price_numeric IS NULL) AS missing_prices, count(*) AS valid_links,
count(*) - (SELECT count(*) FROM (SELECT DISTINCT name, search_term FROM ev)) AS duplicate_products FROM ev"""

SPAN_SQL = f"""WITH {EV} SELECT min(scrape_time)::VARCHAR AS start, max(scrape_time)::VARCHAR AS "end", count(*) AS total_records_analyzed FROM ev"""
MARKS = """m AS (SELECT quantile_cont(price_numeric, 0.25) AS a, quantile_cont(price_numeric, 0.75) AS b,
  max(price_numeric) AS x, count(price_numeric) AS k FROM ev)"""
BANDS_SQL = f"""WITH {EV}, {MARKS}, e AS (SELECT unnest(['budget', 'mid-range', 'premium']) AS band, unnest([0.0, a, b]) AS band_min,
  unnest([a, b, x]) AS band_max, k FROM m)
SELECT band, round(band_min, 6) AS band_min, round(band_max, 6) AS band_max, count(price_numeric) AS listings,
round(count(price_numeric) * 100.0::DOUBLE / any_value(k), 6) AS percentage
FROM e LEFT JOIN ev ON price_numeric BETWEEN e.band_min AND e.band_max GROUP BY 1, 2, 3"""
OUTLIERS_SQL = f"""WITH {EV}, {MARKS} SELECT price_numeric AS price, count(*) AS listings FROM ev, m
WHERE price_numeric < a - 1.5 * (b - a) OR price_numeric > b + 1.5 * (b - a) GROUP BY 1"""

STATISTICS_PARTS = [
    _long_sql("data_quality", QUALITY_SQL, [
        "total_records", "name_complete", "price_complete", "link_complete", "availability_complete",
        "valid_prices", "invalid_prices", "missing_prices", "valid_links", "duplicate_products",
    ]),
    _long_sql("listings_by_source", f"WITH {EV} SELECT search_term, count(*) AS listings FROM ev GROUP BY 1", ["listings"], "search_term"),
    _long_sql("price_statistics", STATS_ROWS, [
        "total_products", "products_with_prices", "mean_price", "std_price", "min_price", "max_price",
        "median_price", "q25", "q75",
    ]),
    _long_sql("by_source", f"WITH {EV} {PERFORMANCE} FROM ev GROUP BY 1", [
        "total_products", "products_with_prices", "avg_price", "min_price", "max_price",
    ], "search_term"),
    _long_sql("percentiles", ORACLES["a9_percentiles"], ["price"], "percentile"),
    _long_sql("histogram", _histogram_sql(10), ["lower_edge", "upper_edge", "listings"], "bin"),
    _long_sql("rows_by_hour", f"WITH {EV} SELECT scrape_hour, count(*) AS listings FROM ev GROUP BY 1", ["listings"], "scrape_hour"),
    _long_sql("rows_by_weekday", f"WITH {EV} SELECT dayname(scrape_time) AS scrape_day, count(*) AS listings FROM ev GROUP BY 1",
              ["listings"], "scrape_day"),
    _long_sql("period", SPAN_SQL, ["total_records_analyzed"], None, ["start", '"end"']).replace("'\"end\"'", "'end'"),
    _long_sql("price_analysis", ORACLES["o0_price_analysis"], [
        "priced", "total_outliers", "budget", "mid_range", "premium", "ending_in_99", "round_numbers",
        "unique_prices", "avg_products_per_price", "outlier_percentage", "lower_bound", "upper_bound",
    ]),
    _long_sql("price_bands", BANDS_SQL, ["band_min", "band_max", "listings", "percentage"], "band"),
    _long_sql("outlier_values", OUTLIERS_SQL, ["listings"], "price"),
    _long_sql("common_prices", f"""WITH {EV} SELECT price_numeric AS price, count(*) AS listings FROM ev WHERE price_numeric IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""", ["listings"], "price"),
]

SERIES_SQL = f"""WITH {EV} SELECT strftime(ev.scrape_date, '%Y-%m-%d') AS scrape_date, count(price_numeric) AS priced,
round(avg(price_numeric), 9) AS mean_price, round(stddev_samp(price_numeric), 9) AS std_price, min(price_numeric) AS min_price,
max(price_numeric) AS max_price, round(quantile_cont(price_numeric, 0.5), 9) AS median_price FROM ev GROUP BY ev.scrape_date"""

TREND_PARTS = [
    _long_sql("overall_trend", ORACLES["w2_overall_trend"], [
        "total_days", "avg_daily_products", "price_trend_correlation",
    ], None, ["trend_direction"]),
    _long_sql("daily_series", SERIES_SQL, ["priced", "mean_price", "std_price", "min_price", "max_price", "median_price"], "scrape_date"),
    _long_sql("trend_by_source", ORACLES["w3_trend_by_source"], [
        "days_tracked", "price_trend_correlation", "avg_daily_products", "price_volatility",
    ], "search_term", ["trend_direction"]),
    _long_sql("hourly_activity", ORACLES["a15_hourly_activity"], ["listings", "priced", "mean_price"], "scrape_hour"),
    _long_sql("peak_hours", ORACLES["w4_peak_hours"], ["peak_hour_priced", "peak_hour_all"]),
    _long_sql("hourly_variation", ORACLES["w6_hourly_variation"], ["price_variation_by_hour"]),
    _long_sql("source_performance", ORACLES["a16_source_performance"], [
        "total_products", "products_with_prices", "data_completeness", "avg_price", "price_std", "min_price",
        "max_price", "unique_products",
    ], "search_term"),
    _long_sql("cross_source", f"""SELECT * FROM ({ORACLES['a17_cross_source_dispersion']}) d,
({ORACLES['a18_cheapest_and_dearest']}) n""", [
        "sources", "price_variance_across_sources", "coefficient_of_variation", "price_difference",
    ], None, ["cheapest_source", "most_expensive_source"]),
    _long_sql("market_position", SEGMENTS, ["avg_price", "rows_below", "percentile_position"], "search_term", ["market_segment"]),
    _long_sql("analysis_period", SPAN_SQL, ["total_records_analyzed"], None, ["start", '"end"']).replace("'\"end\"'", "'end'"),
]

INSIGHTS_SQL = f"""SELECT 'insights' AS analysis_type, 'insight' AS metric, position::VARCHAR AS dimension, NULL::DOUBLE AS value,
insight AS text FROM ({_insights_sql(EV)}) w"""

CHART_PARTS = [
    _long_sql("chart_price_distribution", _histogram_sql(20), ["lower_edge", "upper_edge", "listings"], "bin"),
    _long_sql("chart_average_by_source", f"WITH {EV} SELECT search_term, round(avg(price_numeric), 6) AS avg_price FROM ev GROUP BY 1",
              ["avg_price"], "search_term"),
    _long_sql("chart_daily_prices", f"WITH {EV} {DAILY_9} FROM ev GROUP BY ev.scrape_date", ["priced", "mean_price"], "scrape_date"),
    _long_sql("chart_box_plot", f"WITH {EV}, {BOX}", ["q25", "median_price", "q75", "whisker_low", "whisker_high", "fliers"], "search_term"),
    _long_sql("chart_source_share", ORACLES["e5_chart_source_share"], ["listings", "share_pct"], "search_term"),
    _long_sql("chart_heat_cells", f"""WITH {EV}, h AS ({DAILY_9}, search_term FROM ev GROUP BY search_term, ev.scrape_date)
SELECT search_term || ' ' || scrape_date AS cell, priced, mean_price FROM h""", ["priced", "mean_price"], "cell"),
]

TOTAL_SQL = _long_sql("total", f"WITH {EV} SELECT count(*) AS total_products FROM ev", ["total_products"])
LIMITED_SQL = """SELECT 'insights' AS analysis_type, 'insight' AS metric, '0' AS dimension, NULL::DOUBLE AS value,
'Custom report generated with limited analysis' AS text"""


def _six(parts: list[str]) -> str:
    return f"""SELECT analysis_type, metric, dimension, CASE WHEN analysis_type IN {FINE} THEN round(value, 9) ELSE round(value, 6) END AS value,
text FROM ({' UNION ALL '.join(parts)}) u"""


STATISTICS_SQL, TRENDS_SQL = _six(STATISTICS_PARTS), _six(TREND_PARTS)


@query(STATISTICS_SQL)
def s9_statistics_report(spark, folder):
    return _report_roundtrip(spark, reports.statistics_metrics(events(spark, folder)), "statistics", "json")


@query(STATISTICS_SQL)
def s9_statistics_report_csv(spark, folder):
    return _report_roundtrip(spark, reports.statistics_metrics(events(spark, folder)), "statistics", "csv")


@query(TRENDS_SQL)
def s10_trend_report(spark, folder):
    return _report_roundtrip(spark, reports.trend_metrics(events(spark, folder)), "trends", "json")


@query(_six([*STATISTICS_PARTS, *TREND_PARTS, INSIGHTS_SQL]))
def s12_comprehensive_report(spark, folder):
    """Statistics, trends and insights in one report, from one set of shared cells."""
    return _report_roundtrip(spark, reports.comprehensive_metrics(events(spark, folder)), "comprehensive", "json")


@query(_six([TOTAL_SQL, *STATISTICS_PARTS, *TREND_PARTS, *CHART_PARTS, INSIGHTS_SQL]))
def e2_custom_report_sections(spark, folder):
    """A custom report with every section, written and read back."""
    return _report_roundtrip(spark, reports.custom_metrics(events(spark, folder)), "custom", "json")


@query(_six([TOTAL_SQL, *TREND_PARTS, LIMITED_SQL]))
def e2_limited_report(spark, folder):
    """A custom report without statistics and charts has no insights either."""
    metrics = reports.custom_metrics(events(spark, folder), include_stats=False, include_charts=False)
    return _report_roundtrip(spark, metrics, "custom", "csv")


@query(f"{SERIES_SQL}")
def e4_trend_report_daily_series(spark, folder):
    return rounded(days(_trend(spark, folder, "daily_series"), "scrape_date"), 9)
