"""Statistics on the two five-row fixtures, and exactness of the distributed quantiles."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfline.operators import compare, outliers, quality, stats, trends
from shelfline.operators.ranks import count_below, quantiles, value_counts
from shelfline.plans import reports
from shelfline.sources.listings import scan, timed_scan


def rows(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0].asDict()


@pytest.fixture(scope="module")
def five_scan(five):
    return timed_scan(five).cache()


@pytest.fixture(scope="module")
def mixed_scan(mixed):
    return timed_scan(mixed).cache()


def test_quality(five_scan, mixed_scan):
    q = one(quality.quality_row(five_scan))
    assert (q["name_complete"], q["price_complete"], q["link_complete"], q["availability_complete"]) == (100,) * 4
    assert (q["valid_prices"], q["invalid_prices"], q["missing_prices"]) == (5, 0, 0)
    assert (q["valid_links"], q["duplicate_products"]) == (5, 0)
    q = one(quality.quality_row(mixed_scan))
    assert q["total_records"] == 5 and q["price_complete"] == 80 and q["name_complete"] == 100
    assert (q["valid_prices"], q["missing_prices"], q["valid_links"]) == (4, 1, 4)


def test_price_statistics(five_scan, mixed_scan):
    s = one(stats.price_statistics(five_scan))
    assert s["mean_price"] == pytest.approx(31.494) and s["median_price"] == 15.99
    assert s["std_price"] == pytest.approx(39.02034764868613)
    assert (s["min_price"], s["max_price"], s["q25"], s["q75"]) == (5.0, 99.99, 10.99, 25.5)
    s = one(stats.price_statistics(mixed_scan))
    assert s["median_price"] == pytest.approx(18.245) and s["std_price"] == pytest.approx(43.93131988304775)
    assert s["q25"] == pytest.approx(9.4925) and s["q75"] == pytest.approx(44.1225)


def test_percentiles_and_histogram(five_scan):
    p = rows(stats.percentiles(five_scan))
    assert p["p5"][0] == pytest.approx(6.198) and p["p90"][0] == pytest.approx(70.194)
    assert p["p95"][0] == pytest.approx(85.092)
    h = sorted(stats.histogram(five_scan).collect())
    assert [r["listings"] for r in h] == [2, 1, 1, 0, 0, 0, 0, 0, 0, 1]
    assert h[0]["lower_edge"] == 5.0 and h[1]["lower_edge"] == pytest.approx(14.499)
    assert h[-1]["upper_edge"] == pytest.approx(99.99)


def test_histogram_of_one_price(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "price_numeric double")
    h = sorted(stats.histogram(df).collect())
    assert (h[0]["lower_edge"], h[-1]["upper_edge"]) == (4.5, 5.5)
    assert [r["listings"] for r in h] == np.histogram([5.0, 5.0], bins=10)[0].tolist()


def test_hours_and_weekdays(five_scan):
    assert rows(stats.rows_by_hour(five_scan)) == {10: (2,), 11: (1,), 12: (1,), 13: (1,)}
    assert rows(stats.rows_by_weekday(five_scan)) == {"Monday": (4,), "Tuesday": (1,)}


def test_daily_and_hourly(five_scan):
    d = {str(r["scrape_date"]): r for r in trends.daily_prices(five_scan).collect()}
    first, second = d["2024-01-01"], d["2024-01-02"]
    assert first["priced"] == 4 and first["mean_price"] == pytest.approx(35.37)
    assert first["median_price"] == pytest.approx(18.245)
    assert first["std_price"] == pytest.approx(43.93131988304775)
    assert (second["priced"], second["mean_price"], second["std_price"]) == (1, 15.99, None)
    h = {r["scrape_hour"]: (r["priced"], r["mean_price"]) for r in trends.hourly_activity(five_scan).collect()}
    assert h[10] == (2, pytest.approx(13.49)) and h[12] == (1, 99.99)
    assert one(trends.peak_hours(five_scan)) == {"peak_hour_priced": 10, "peak_hour_all": 10}
    variation = one(trends.hourly_variation(five_scan))["price_variation_by_hour"]
    assert variation == pytest.approx(43.48436538956655)


def test_comparison(five_scan):
    p = {r["search_term"]: r for r in compare.source_performance(five_scan).collect()}
    assert p["books"]["total_products"] == 3 and p["books"]["avg_price"] == pytest.approx(17.493333, abs=1e-6)
    assert p["books"]["price_std"] == pytest.approx(7.370890945695325)
    assert p["electronics"]["price_std"] == pytest.approx(67.16807314491015)
    c = one(compare.cross_source_insights(five_scan))
    assert c["price_variance_across_sources"] == pytest.approx(306.279167361, abs=1e-6)
    assert c["coefficient_of_variation"] == pytest.approx(0.500107161, abs=1e-9)
    assert c["price_difference"] == pytest.approx(35.001667, abs=1e-6)
    assert (c["cheapest_source"], c["most_expensive_source"]) == ("books", "electronics")
    m = {r["search_term"]: r for r in compare.market_positioning(five_scan).collect()}
    assert m["books"]["market_segment"] == "mid-high" and m["electronics"]["market_segment"] == "premium"
    assert m["books"]["percentile_position"] == 60 and m["electronics"]["percentile_position"] == 80


def test_outliers_and_bands(five_scan, mixed_scan):
    o = one(outliers.outlier_summary(five_scan))
    assert o["lower_bound"] == pytest.approx(-10.775) and o["upper_bound"] == pytest.approx(47.265)
    assert (o["total_outliers"], o["outlier_percentage"]) == (1, 20.0)
    assert [r["price_numeric"] for r in outliers.outlier_rows(five_scan).collect()] == [99.99]
    bands = {r["band"]: r["listings"] for r in outliers.price_bands(five_scan).collect()}
    assert bands == {"budget": 2, "mid-range": 3, "premium": 2}
    assert one(outliers.price_patterns(five_scan)) == {"ending_in_99": 3, "round_numbers": 1}
    o = one(outliers.iqr_fences(mixed_scan))
    assert o["lower_bound"] == pytest.approx(-42.4525) and o["upper_bound"] == pytest.approx(96.0675)


def test_trends(five_scan, mixed_scan):
    t = one(trends.overall_trend(five_scan))
    assert t["price_trend_correlation"] == pytest.approx(-1.0) and t["trend_direction"] == "decreasing"
    by = {r["search_term"]: r for r in trends.trend_by(five_scan).collect()}
    assert set(by) == {"books"}
    assert by["books"]["price_volatility"] == pytest.approx(1.5945257915756652)
    assert trends.overall_trend(mixed_scan).count() == 0


def test_flat_series_has_no_correlation(spark):
    df = spark.sql("SELECT DATE'2024-01-01' + INTERVAL '1' DAY * id AS scrape_date, 5.0D AS price_numeric FROM range(3)")
    t = one(trends.overall_trend(df))
    assert (t["price_trend_correlation"], t["trend_direction"]) == (0.0, "stable")


def test_clustering(spark):
    df = spark.createDataFrame([(p,) for p in (10.99, 25.5, 99.99, 5.0, 10.99, 25.5)], "price_numeric double")
    assert one(stats.price_clustering(df)) == {"unique_prices": 4, "avg_products_per_price": 1.5}
    assert [tuple(r) for r in stats.top_prices(df, 2).collect()] == [(10.99, 2), (25.5, 2)]


def test_empty_listings(spark, five):
    empty = timed_scan(five.limit(0))
    q = one(quality.quality_row(empty))
    assert q["total_records"] == 0 and q["price_complete"] is None
    s = one(stats.price_statistics(empty))
    assert s["total_products"] == 0 and s["mean_price"] is None and s["median_price"] is None
    for frame in (
        stats.percentiles(empty), stats.histogram(empty), outliers.price_bands(empty), outliers.outlier_rows(empty),
        compare.cross_source_insights(empty), compare.market_positioning(empty), trends.trend_by(empty),
    ):
        assert frame.count() == 0
    assert one(quality.quality_gate(quality.quality_row(empty)))["passed"] is False
    assert [r["insight"][:1] for r in reports.insights(empty).collect()]


def test_report_from_cells_agrees_with_operators(five_scan):
    r = reports.Report(five_scan)
    want, have = one(stats.price_statistics(five_scan)), one(r.statistics())
    assert set(want) == set(have)
    for k, v in want.items():
        assert have[k] == pytest.approx(v)
    for made, direct in (
        (r.performance(), compare.source_performance(five_scan)), (r.trend_by(), trends.trend_by(five_scan)),
        (r.hourly(), trends.hourly_activity(five_scan)), (r.box_plot(), stats.box_summary(five_scan)),
    ):
        a, b = (
            sorted(tuple(x.asDict()[c] for c in sorted(direct.columns)) for x in f.collect()) for f in (made, direct)
        )
        for x, y in zip(a, b):
            assert list(x) == [pytest.approx(v) if isinstance(v, float) else v for v in y]


def test_insight_wording(five_scan):
    found = [r["insight"] for r in reports.insights(five_scan).orderBy("position").collect()]
    assert found == [
        "💰 High price variance detected - market shows significant price diversity",
        "📉 Price trend analysis shows decreasing prices over time",
        "💸 books offers the lowest average prices, while electronics has the highest (difference: $35.00)",
    ]


def test_custom_report_sections(five_scan):
    full = reports.custom_report(five_scan)
    assert {"quality", "statistics", "trend_overall_trend", "chart_box_plot", "insights"} <= set(full)
    limited = reports.custom_report(five_scan, include_stats=False, include_charts=False)
    assert "quality" not in limited and not any(k.startswith("chart_") for k in limited)
    assert limited["insights"].first()["insight"].startswith("Custom report")


prices = st.lists(
    st.one_of(
        st.integers(-300, 100000).map(lambda c: c / 100),
        st.floats(-1e12, 1e12, allow_nan=False).map(lambda f: f + 0.0),
        st.sampled_from([0.0, 0.01, 9.99, 1e-9, 1e15]),
    ),
    min_size=1, max_size=40,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(prices)
def test_quantiles_are_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "p double")
    probs = {"a": 0.0, "b": 0.05, "c": 0.25, "d": 0.5, "e": 0.9, "f": 1.0}
    got = quantiles(df, "p", probs).first()
    scale = max(1.0, max(abs(v) for v in values))
    for name, p in probs.items():
        assert got[name] == pytest.approx(float(np.quantile(values, p)), abs=1e-9 * scale)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(prices, prices)
def test_count_below_is_exact(spark, values, probes):
    counts = value_counts(spark.createDataFrame([(v,) for v in values], "p double"), "p")
    asked = spark.createDataFrame(list(enumerate(probes)), "i int, m double")
    for r in count_below(counts, asked, "m").collect():
        assert r["below"] == sum(v < r["m"] for v in values)


def test_quantiles_of_a_hot_group(spark):
    """One group and one price hold most rows; all figures stay exact."""
    df = spark.range(40_000).select(
        F.when(F.col("id") < 30_000, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.when(F.col("id") < 20_000, 9.99).otherwise(F.round(F.rand(3) * 1000, 2)).cast("double").alias("p"),
    ).cache()
    probs = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    for r in quantiles(df, "p", probs, ["g"]).collect():
        values = [x["p"] for x in df.where(F.col("g") == r["g"]).select("p").collect()]
        assert [r["q25"], r["q50"], r["q75"]] == pytest.approx(np.quantile(values, list(probs.values())).tolist())


def test_value_counts_are_bounded_by_distinct_prices(spark):
    df = spark.range(50_000).select((F.col("id") % 3).cast("double").alias("p"))
    assert value_counts(df, "p").count() == 3


def test_scan_accepts_numeric_and_text_prices(spark, five):
    numeric = five.withColumn("price", F.lit(float("nan")))
    assert scan(numeric).where("price_numeric IS NOT NULL").count() == 0
    assert scan(five).where("price_numeric IS NOT NULL").count() == 5
