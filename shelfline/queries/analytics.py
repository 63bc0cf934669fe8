"""Aggregations, outliers, trends and comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import compare, jobs, outliers, quality, sketches, stats, trends
from shelfline.operators.ranks import quantiles
from shelfline.queries.registry import EV, JOBS, RAW_SHOP, SHOP, days, query, rounded
from shelfline.queries.scans import events, shop
from shelfline.session import materialise
from shelfline.sources import adapters as A

DAYS = [f"2024-01-{d:02d}" for d in range(1, 31)]


@query(f"""WITH {SHOP} SELECT count(*) AS total_records,
round(count(name) * 100.0::DOUBLE / count(*), 6) AS name_complete,
round(count(price_numeric) * 100.0::DOUBLE / count(*), 6) AS price_complete,
round(count(link) * 100.0::DOUBLE / count(*), 6) AS link_complete,
round(count(availability) * 100.0::DOUBLE / count(*), 6) AS availability_complete FROM sh""")
def a1_completeness(spark, folder):
    return rounded(quality.completeness(shop(spark, folder)))


@query(f"""WITH {SHOP} SELECT count(*) FILTER (WHERE price_numeric > 0) AS valid_prices,
count(*) FILTER (WHERE price_numeric <= 0) AS invalid_prices,
count(*) FILTER (WHERE price_numeric IS NULL) AS missing_prices,
count(*) FILTER (WHERE link LIKE 'http%') AS valid_links FROM sh""")
def a2_validity(spark, folder):
    return quality.validity(shop(spark, folder))


@query(f"""WITH {SHOP} SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT name, search_term FROM sh))
AS duplicate_products FROM sh""")
def a3_duplicates(spark, folder):
    return quality.duplicate_count(shop(spark, folder))


@query(f"""WITH {EV} SELECT search_term, count(*) AS listings FROM ev GROUP BY 1 ORDER BY 2 DESC, 1""")
def a4_listings_per_source(spark, folder):
    return quality.counts_by(events(spark, folder))


@query(f"""WITH {EV} SELECT search_term, min(price_numeric) AS min_price, max(price_numeric) AS max_price,
round(avg(price_numeric), 6) AS avg_price, count(*) AS priced FROM ev
WHERE price_numeric IS NOT NULL GROUP BY 1""")
def a5_price_range_by_source(spark, folder):
    return rounded(quality.price_range_by(events(spark, folder)))


@query(f"""WITH {EV} SELECT count(*) AS total_products, count(price_numeric) AS products_with_prices,
round(avg(price_numeric), 6) AS mean_price, round(stddev_samp(price_numeric), 6) AS std_price,
min(price_numeric) AS min_price, max(price_numeric) AS max_price,
round(quantile_cont(price_numeric, 0.5), 6) AS median_price,
round(quantile_cont(price_numeric, 0.25), 6) AS q25, round(quantile_cont(price_numeric, 0.75), 6) AS q75
FROM ev""")
def a6_price_statistics(spark, folder):
    return rounded(stats.price_statistics(events(spark, folder)))


@query(f"""WITH {SHOP} SELECT source, count(*) AS total_products, count(price_numeric) AS products_with_prices,
round(avg(price_numeric), 4) AS avg_price, min(price_numeric) AS min_price, max(price_numeric) AS max_price
FROM sh WHERE source IS NOT NULL GROUP BY 1""")
def a7_summary_by_source(spark, folder):
    return rounded(stats.summary_by(shop(spark, folder), "source"), 4)


@query(f"""WITH {EV} SELECT CASE WHEN grouping(search_term) = 1 THEN 'overall' ELSE 'group' END AS level,
search_term, count(*) AS total_products, count(price_numeric) AS products_with_prices,
round(avg(price_numeric), 6) AS mean_price, round(stddev_samp(price_numeric), 6) AS std_price,
min(price_numeric) AS min_price, max(price_numeric) AS max_price,
round(quantile_cont(price_numeric, 0.5), 6) AS median_price,
round(quantile_cont(price_numeric, 0.25), 6) AS q25, round(quantile_cont(price_numeric, 0.75), 6) AS q75
FROM ev GROUP BY GROUPING SETS ((), (search_term))""")
def a8_overall_and_by_source(spark, folder):
    return rounded(stats.overall_and_by(events(spark, folder)))


@query(f"""WITH {EV}, q AS (SELECT unnest([5,10,25,50,75,90,95]) AS p,
unnest((SELECT quantile_cont(price_numeric, [0.05,0.1,0.25,0.5,0.75,0.9,0.95]) FROM ev)) AS v)
SELECT 'p' || p AS percentile, round(v, 6) AS price FROM q""")
def a9_percentiles(spark, folder):
    return rounded(stats.percentiles(events(spark, folder)))


@query()
def a9_approximate_percentiles(spark, folder):
    return rounded(stats.approximate_percentiles(events(spark, folder)))


@query("SELECT unnest(['p5', 'p10', 'p25', 'p50', 'p75', 'p90', 'p95']) AS percentile, true AS within_bound")
def a9_approximate_ranks(spark, folder):
    """Whether the rank of each approximate percentile keeps to the bound of the sketch."""
    return stats.rank_errors(events(spark, folder), accuracy=100)


@query(f"""WITH {SHOP} SELECT source, round(quantile_cont(price_numeric, 0.05), 6) AS p5,
round(quantile_cont(price_numeric, 0.5), 6) AS p50, round(quantile_cont(price_numeric, 0.95), 6) AS p95
FROM sh WHERE price_numeric IS NOT NULL GROUP BY 1""")
def a9_percentiles_by_source(spark, folder):
    rows = quantiles(shop(spark, folder), "price_numeric", {"p5": 0.05, "p50": 0.5, "p95": 0.95}, ["source"])
    return rounded(rows)


def _histogram_sql(bins: int) -> str:
    return f"""WITH {EV}, s AS (SELECT min(price_numeric) AS lo, max(price_numeric) AS hi FROM ev),
e AS (SELECT i::INT AS bin, lo + i * ((hi - lo) / {bins}.0::DOUBLE) AS a,
             lo + (i + 1) * ((hi - lo) / {bins}.0::DOUBLE) AS b FROM s, range({bins}) t(i)),
c AS (SELECT price_numeric AS p, count(*) AS n FROM ev WHERE price_numeric IS NOT NULL GROUP BY 1)
SELECT bin, round(a, 6) AS lower_edge, round(b, 6) AS upper_edge,
  coalesce((SELECT sum(n) FROM c WHERE p >= a AND (p < b OR bin = {bins - 1})), 0)::BIGINT AS listings FROM e"""


@query(_histogram_sql(10))
def a10_histogram(spark, folder):
    return rounded(stats.histogram(events(spark, folder)))


@query(f"""WITH {EV} SELECT scrape_hour, count(*) AS listings FROM ev GROUP BY 1""")
def a11_rows_by_hour(spark, folder):
    return stats.rows_by_hour(events(spark, folder))


@query(f"""WITH {EV} SELECT dayname(scrape_time) AS scrape_day, count(*) AS listings FROM ev GROUP BY 1""")
def a11_rows_by_weekday(spark, folder):
    return stats.rows_by_weekday(events(spark, folder))


@query(f"""WITH {EV} SELECT strftime(min(scrape_time), '%Y-%m-%d %H:%M:%S.%f') AS earliest,
strftime(max(scrape_time), '%Y-%m-%d %H:%M:%S.%f') AS latest FROM ev""")
def a12_observation_span(spark, folder):
    span = stats.observation_span(events(spark, folder))
    return span.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) for c in span.columns])


DAILY = """SELECT strftime(scrape_date, '%Y-%m-%d') AS scrape_date, count(price_numeric) AS priced,
round(avg(price_numeric), 6) AS mean_price"""


@query(f"""WITH {EV} {DAILY}, round(stddev_samp(price_numeric), 6) AS std_price,
min(price_numeric) AS min_price, max(price_numeric) AS max_price,
round(quantile_cont(price_numeric, 0.5), 6) AS median_price FROM ev GROUP BY ev.scrape_date""")
def a13_daily_prices(spark, folder):
    return rounded(days(trends.daily_prices(events(spark, folder)), "scrape_date"))


@query(f"""WITH {EV} {DAILY}, search_term,
round(quantile_cont(price_numeric, 0.5), 6) AS median_price FROM ev GROUP BY search_term, ev.scrape_date""")
def a14_daily_prices_by_source(spark, folder):
    return rounded(days(trends.daily_prices_by(events(spark, folder)), "scrape_date"))


@query(f"""WITH {EV} SELECT scrape_hour, count(*) AS listings, count(price_numeric) AS priced,
round(avg(price_numeric), 6) AS mean_price FROM ev GROUP BY 1""")
def a15_hourly_activity(spark, folder):
    return rounded(trends.hourly_activity(events(spark, folder)))


PERFORMANCE = """SELECT search_term, count(*) AS total_products, count(price_numeric) AS products_with_prices,
round(count(price_numeric) * 100.0::DOUBLE / count(*), 6) AS data_completeness,
round(avg(price_numeric), 6) AS avg_price, round(stddev_samp(price_numeric), 6) AS price_std,
min(price_numeric) AS min_price, max(price_numeric) AS max_price, count(DISTINCT name) AS unique_products"""


@query(f"""WITH {EV} {PERFORMANCE} FROM ev GROUP BY 1""")
def a16_source_performance(spark, folder):
    return rounded(compare.source_performance(events(spark, folder)))


CROSS = """a AS (SELECT search_term, avg(price_numeric) AS m FROM ev
  WHERE price_numeric IS NOT NULL GROUP BY 1)"""


@query(f"""WITH {EV}, {CROSS} SELECT count(*) AS sources, round(var_pop(m), 6) AS price_variance_across_sources,
round(stddev_pop(m) / avg(m), 6) AS coefficient_of_variation, round(max(m) - min(m), 6) AS price_difference FROM a""")
def a17_cross_source_dispersion(spark, folder):
    rows = compare.cross_source_insights(events(spark, folder))
    return rounded(rows.drop("cheapest_source", "most_expensive_source"))


@query(f"""WITH {EV}, {CROSS} SELECT (SELECT search_term FROM a ORDER BY m, search_term LIMIT 1) AS cheapest_source,
(SELECT search_term FROM a ORDER BY m DESC, search_term LIMIT 1) AS most_expensive_source""")
def a18_cheapest_and_dearest(spark, folder):
    rows = compare.cross_source_insights(events(spark, folder))
    return rows.select("cheapest_source", "most_expensive_source")


@query("""WITH c AS (SELECT o_totalprice AS p, count(*) AS n FROM orders GROUP BY 1)
SELECT count(*) AS unique_prices, round(avg(n), 6) AS avg_products_per_price FROM c""")
def a19_price_clustering(spark, folder):
    rows = A.table(spark, folder, "orders").withColumnRenamed("o_totalprice", "price_numeric")
    return rounded(stats.price_clustering(rows))


@query(f"""WITH {EV} SELECT strftime(min(scrape_time), '%Y-%m-%d') || ' to ' || strftime(max(scrape_time), '%Y-%m-%d')
AS date_range, count(*) AS total_data_points, count(DISTINCT scrape_date) AS days_with_data,
(SELECT scrape_hour FROM ev GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS peak_hour FROM ev""")
def a20_temporal_summary(spark, folder):
    return trends.temporal_summary(events(spark, folder))


@query(f"""WITH {EV} SELECT search_term, count(*) AS total_products, round(avg(price_numeric), 6) AS avg_price,
round(count(price_numeric) * 100.0::DOUBLE / count(*), 6) AS data_quality_score FROM ev GROUP BY 1""")
def a21_display_summary(spark, folder):
    return rounded(compare.display_summary(events(spark, folder)))


@query(f"""WITH {RAW_SHOP}, {JOBS} SELECT 'total_listings' AS item, NULL AS search_term, count(*) AS value FROM raw
UNION ALL SELECT 'listings', search_term, count(*) FROM raw GROUP BY 2
UNION ALL SELECT 'completed_jobs', NULL, count(*) FROM jobs WHERE status = 'completed'
UNION ALL SELECT 'pending_jobs', NULL, count(*) FROM jobs WHERE status = 'pending'""")
def a22_store_status(spark, folder):
    return jobs.store_status(A.shop_listings(spark, folder), A.jobs(spark, folder))


@query(f"""WITH {RAW_SHOP} SELECT coalesce(source, 'Unknown') AS source, count(*) AS listings FROM raw GROUP BY 1""")
def a23_source_labels(spark, folder):
    return stats.source_labels(A.shop_listings(spark, folder))


@query(f"""WITH {EV} SELECT search_term, count(price_numeric) AS priced, round(avg(price_numeric), 2) AS mean_price,
round(quantile_cont(price_numeric, 0.5), 2) AS median_price FROM ev GROUP BY 1""")
def a24_source_table(spark, folder):
    return stats.source_table(events(spark, folder))


@query(f"""WITH {EV} SELECT search_term, count(*) AS listings,
round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM ev), 1) AS share_pct FROM ev GROUP BY 1""")
def a25_source_share(spark, folder):
    return stats.share_by(events(spark, folder))


BOX = """q AS (SELECT search_term AS s, quantile_cont(price_numeric, 0.25) AS a,
  quantile_cont(price_numeric, 0.5) AS m, quantile_cont(price_numeric, 0.75) AS b FROM ev GROUP BY 1)
SELECT search_term, round(any_value(a), 6) AS q25, round(any_value(m), 6) AS median_price,
round(any_value(b), 6) AS q75,
min(price_numeric) FILTER (WHERE price_numeric >= a - 1.5 * (b - a)) AS whisker_low,
max(price_numeric) FILTER (WHERE price_numeric <= b + 1.5 * (b - a)) AS whisker_high,
count(*) FILTER (WHERE price_numeric < a - 1.5 * (b - a) OR price_numeric > b + 1.5 * (b - a)) AS fliers
FROM ev JOIN q ON s = search_term WHERE price_numeric IS NOT NULL GROUP BY 1"""


@query(f"WITH {EV}, {BOX}")
def a26_box_summary(spark, folder):
    return rounded(stats.box_summary(events(spark, folder)))


@query(
    f"WITH {EV} SELECT search_term, "
    + ", ".join(
        f"""round(avg(price_numeric) FILTER (WHERE scrape_date = DATE '{d}'), 6) AS "{d}\""""
        for d in DAYS
    )
    + f""", count(price_numeric) FILTER (WHERE NOT (strftime(scrape_date, '%Y-%m-%d') IN {tuple(DAYS)})) AS other_days
      FROM ev GROUP BY 1"""
)
def a27_price_pivot(spark, folder):
    return rounded(stats.pivot_by_day(events(spark, folder), DAYS))


@query(f"""WITH {SHOP} SELECT search_term, strftime(scrape_time, '%Y-%m-%d') AS day, round(avg(price_numeric), 6) AS mean_price,
count(*) AS priced FROM sh WHERE search_term IS NOT NULL AND price_numeric IS NOT NULL GROUP BY 1, 2""")
def a27_prices_by_day(spark, folder):
    """Mean prices of all days, whichever they are."""
    return rounded(stats.prices_by_day(shop(spark, folder)))


FENCES = """f AS (SELECT quantile_cont(price_numeric, 0.25) AS a, quantile_cont(price_numeric, 0.75) AS b,
  a - 1.5 * (b - a) AS lo, b + 1.5 * (b - a) AS hi FROM ev)"""


@query(f"""WITH {EV}, {FENCES} SELECT round(a, 6) AS q25, round(b, 6) AS q75,
round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound FROM f""")
def o1_iqr_fences(spark, folder):
    return rounded(outliers.iqr_fences(events(spark, folder)))


@query(f"""WITH {EV}, {FENCES} SELECT id, price_numeric FROM ev, f WHERE price_numeric < lo OR price_numeric > hi""")
def o2_outlier_rows(spark, folder):
    return outliers.outlier_rows(events(spark, folder)).select("id", "price_numeric")


@query(f"""WITH {EV}, {FENCES} SELECT count(*) FILTER (WHERE price_numeric < lo OR price_numeric > hi) AS total_outliers,
round(count(*) FILTER (WHERE price_numeric < lo OR price_numeric > hi) * 100.0::DOUBLE / count(price_numeric), 6)
  AS outlier_percentage,
round(any_value(lo), 6) AS lower_bound, round(any_value(hi), 6) AS upper_bound FROM ev, f""")
def o2_outlier_summary(spark, folder):
    return rounded(outliers.outlier_summary(events(spark, folder)))


@query(f"""WITH {EV}, q AS (SELECT quantile_cont(price_numeric, 0.25) AS a, quantile_cont(price_numeric, 0.75) AS b,
  max(price_numeric) AS x, count(price_numeric) AS n FROM ev),
bands AS (SELECT 'budget' AS band, 0.0::DOUBLE AS band_min, a AS band_max, n FROM q
  UNION ALL SELECT 'mid-range', a, b, n FROM q UNION ALL SELECT 'premium', b, x, n FROM q)
SELECT band, round(band_min, 6) AS band_min, round(band_max, 6) AS band_max, count(*) AS listings,
round(count(*) * 100.0::DOUBLE / any_value(n), 6) AS percentage
FROM bands JOIN ev ON price_numeric BETWEEN band_min AND band_max GROUP BY band, band_min, band_max""")
def o3_price_bands(spark, folder):
    return rounded(outliers.price_bands(events(spark, folder)))


@query("""SELECT count(*) FILTER (WHERE l_extendedprice::VARCHAR LIKE '%.99') AS ending_in_99,
count(*) FILTER (WHERE l_extendedprice % 1 = 0) AS round_numbers FROM lineitem""")
def o4_o5_price_patterns(spark, folder):
    rows = A.table(spark, folder, "lineitem").withColumnRenamed("l_extendedprice", "price_numeric")
    return outliers.price_patterns(rows)


@query("""SELECT l_extendedprice AS price, count(*) AS listings FROM lineitem GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 10""")
def o6_top_prices(spark, folder):
    rows = A.table(spark, folder, "lineitem").withColumnRenamed("l_extendedprice", "price_numeric")
    return stats.top_prices(rows)


SEGMENT = """a AS (SELECT search_term, avg(price_numeric) AS m FROM ev WHERE price_numeric IS NOT NULL GROUP BY 1),
q AS (SELECT quantile_cont(price_numeric, 0.25) AS p25, quantile_cont(price_numeric, 0.5) AS p50,
  quantile_cont(price_numeric, 0.75) AS p75 FROM ev),
seg AS (SELECT search_term, m, CASE WHEN m <= p25 THEN 'budget' WHEN m <= p50 THEN 'mid-low'
  WHEN m <= p75 THEN 'mid-high' ELSE 'premium' END AS market_segment FROM a, q)"""


@query(f"WITH {EV}, {SEGMENT} SELECT search_term, round(m, 6) AS avg_price, market_segment FROM seg")
def o7_market_segments(spark, folder):
    return rounded(outliers.market_segments(events(spark, folder)))


BELOW = """SELECT a.search_term, round(any_value(m), 6) AS avg_price,
count(*) FILTER (WHERE price_numeric < m) AS rows_below,
round(count(*) FILTER (WHERE price_numeric < m) * 100.0::DOUBLE / count(price_numeric), 6) AS percentile_position
FROM a, ev GROUP BY 1"""


@query(f"WITH {EV}, {CROSS} {BELOW}")
def o8_percentile_positions(spark, folder):
    return rounded(outliers.percentile_positions(events(spark, folder)))


@query(f"""WITH {SHOP.replace('sh AS', 'ev AS')}, {CROSS.replace('search_term', 'source')}
{BELOW.replace('search_term', 'source')}""".replace("WHERE price_numeric IS NOT NULL GROUP BY", "WHERE price_numeric IS NOT NULL AND source IS NOT NULL GROUP BY"))
def o8_percentile_positions_many_sources(spark, folder):
    return rounded(outliers.percentile_positions(shop(spark, folder), "source"))


@query(f"""WITH {EV}, s AS (SELECT avg(price_numeric) AS m, stddev_samp(price_numeric) AS d FROM ev)
SELECT id, round((price_numeric - m) / d, 6) AS zscore FROM ev, s WHERE abs((price_numeric - m) / d) > 3.0""")
def o9_zscore_outliers(spark, folder):
    return rounded(outliers.zscore_outliers(events(spark, folder)).select("id", "zscore"))


NUMBERED = """d AS (SELECT scrape_date, count(price_numeric) AS n, avg(price_numeric) AS m,
  row_number() OVER (ORDER BY scrape_date) - 1 AS i FROM ev GROUP BY 1)"""
DIRECTION = "CASE WHEN r > 0.1 THEN 'increasing' WHEN r < -0.1 THEN 'decreasing' ELSE 'stable' END"


@query(f"""WITH {EV}, {NUMBERED} SELECT strftime(scrape_date, '%Y-%m-%d') AS scrape_date, n AS priced,
round(m, 6) AS mean_price, i::INT AS day_number FROM d""")
def w1_numbered_days(spark, folder):
    return rounded(days(trends.numbered_days(trends.daily_means(events(spark, folder))), "scrape_date"))


@query(f"""WITH {EV}, {NUMBERED}, t AS (SELECT count(*) AS total_days, avg(n) AS avg_daily, coalesce(corr(m, i), 0) AS r FROM d)
SELECT total_days, round(avg_daily, 6) AS avg_daily_products, round(r, 6) AS price_trend_correlation,
{DIRECTION} AS trend_direction FROM t""")
def w2_overall_trend(spark, folder):
    return rounded(trends.overall_trend(events(spark, folder)))


@query(f"""WITH {EV}, d AS (SELECT search_term, scrape_date, count(price_numeric) AS n, avg(price_numeric) AS m,
  row_number() OVER (PARTITION BY search_term ORDER BY scrape_date) - 1 AS i FROM ev GROUP BY 1, 2),
t AS (SELECT search_term, count(*) AS days_tracked, avg(n) AS avg_daily, coalesce(corr(m, i), 0) AS r,
  stddev_samp(m) AS v FROM d GROUP BY 1 HAVING count(*) > 1)
SELECT search_term, days_tracked, round(r, 6) AS price_trend_correlation, round(avg_daily, 6) AS avg_daily_products,
round(v, 6) AS price_volatility, {DIRECTION} AS trend_direction FROM t""")
def w3_trend_by_source(spark, folder):
    return rounded(trends.trend_by(events(spark, folder)))


@query(f"""WITH {EV} SELECT
(SELECT scrape_hour FROM ev GROUP BY 1 ORDER BY count(price_numeric) DESC, 1 LIMIT 1) AS peak_hour_priced,
(SELECT scrape_hour FROM ev GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS peak_hour_all""")
def w4_peak_hours(spark, folder):
    return trends.peak_hours(events(spark, folder))


@query(f"""WITH {EV}, d AS (SELECT search_term, scrape_date, avg(price_numeric) AS m,
  row_number() OVER (PARTITION BY search_term ORDER BY scrape_date) - 1 AS i FROM ev GROUP BY 1, 2),
t AS (SELECT search_term, coalesce(corr(m, i), 0) AS r FROM d GROUP BY 1 HAVING count(*) > 1)
SELECT {DIRECTION} AS trend_direction, count(*) AS sources FROM t GROUP BY 1""")
def w5_direction_labels(spark, folder):
    rows = trends.trend_by(events(spark, folder))
    return rows.groupBy("trend_direction").agg(F.count("*").alias("sources"))


@query(f"""WITH {EV}, h AS (SELECT scrape_hour, avg(price_numeric) AS m FROM ev GROUP BY 1)
SELECT round(stddev_samp(m), 6) AS price_variation_by_hour FROM h""")
def w6_hourly_variation(spark, folder):
    return rounded(trends.hourly_variation(events(spark, folder)))


@query(f"""WITH {EV} {DAILY}, round(quantile_cont(price_numeric, 0.5), 6) AS median_price
FROM ev GROUP BY ev.scrape_date ORDER BY ev.scrape_date""")
def w9_daily_series(spark, folder):
    return rounded(days(trends.series(events(spark, folder)), "scrape_date"))


@query(f"""WITH {EV}, d AS (SELECT search_term AS s, scrape_date AS t, avg(price_numeric) AS m FROM ev
  WHERE price_numeric IS NOT NULL GROUP BY 1, 2)
SELECT x.s AS search_term, count(*) AS shared_days, round(coalesce(corr(x.m, y.m), 0), 6) AS correlation
FROM d x JOIN d y ON x.t = y.t AND x.s <> 'purchase' AND y.s = 'purchase' GROUP BY 1 HAVING count(*) > 1""")
def w10_price_correlation(spark, folder):
    return rounded(trends.price_correlation_with(events(spark, folder), "purchase"))


SPAN = ("2024-01-05", "2024-01-20")


def _sketches(spark, folder):
    return materialise(sketches.daily_sketches(events(spark, folder)), "sketches")


@query(f"""WITH {EV}, s AS (SELECT search_term, count(*) AS n FROM ev WHERE price_numeric IS NOT NULL
  AND scrape_date BETWEEN DATE '{SPAN[0]}' AND DATE '{SPAN[1]}' GROUP BY 1)
SELECT search_term, n AS priced, percentile, true AS within_bound FROM s, (SELECT unnest(['p5', 'p25', 'p50', 'p75', 'p95']) AS percentile)""")
def a9_percentiles_of_kept_sketches(spark, folder):
    """Whether the exact ranks of percentiles merged from daily sketches keep to the bound, for a span of days."""
    at = {"p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
    kept = sketches.merged(_sketches(spark, folder), ["search_term"], *SPAN).where("priced > 0")
    marks = sketches.percentiles_of_sketches(kept, at).select(
        "search_term", "priced", F.inline(F.array(*[F.struct(F.lit(n).alias("percentile"), F.lit(p).alias("share"), F.col(n).alias("price")) for n, p in at.items()]))
    )
    rows = events(spark, folder).where(F.col("scrape_date").between(*[F.lit(d).cast("date") for d in SPAN]) & F.col("price_numeric").isNotNull())
    joined = marks.join(rows.select("search_term", "price_numeric"), "search_term").groupBy("search_term", "priced", "percentile", "share")
    # Equal prices share all ranks between those below and those up to them.
    ranks = joined.agg(
        (F.count_if(F.col("price_numeric") < F.col("price")) / F.count("*")).alias("low"),
        (F.count_if(F.col("price_numeric") <= F.col("price")) / F.count("*")).alias("high"),
    )
    error = F.greatest(F.col("low") - F.col("share"), F.col("share") - F.col("high"), F.lit(0.0))
    return ranks.select("search_term", "priced", "percentile", (error <= 0.02).alias("within_bound"))


@query(f"WITH {EV} SELECT search_term, count(*) AS listings, true AS within_bound, true AS shared_within_bound FROM ev GROUP BY 1")
def a16_distinct_names_of_kept_sketches(spark, folder):
    """Whether distinct names, and those shared with the views, from daily sketches are near the exact counts."""
    daily, rows = _sketches(spark, folder), events(spark, folder)
    told = sketches.overlaps(daily, "search_term", "view").join(sketches.merged(daily, ["search_term"]).select("search_term", "listings"), "search_term")
    names = rows.select("search_term", "name").distinct()
    viewed = names.where("search_term = 'view'").select("name").withColumn("viewed", F.lit(1))
    exact = names.join(viewed, "name", "left").groupBy("search_term").agg(F.count("*").alias("n"), F.count("viewed").alias("shared"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.greatest(F.col("n") * 0.06, F.lit(3.0))
    return told.join(exact, "search_term").select(
        "search_term", "listings", near("distinct_names", "n").alias("within_bound"), near("shared_names", "shared").alias("shared_within_bound")
    )
