"""Scalar functions on hand-made edge rows."""

from __future__ import annotations

import re
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from shelfline.functions import price as P
from shelfline.functions import temporal as D
from shelfline.functions import text as X
from shelfline.functions import urls as U

N = None
PRICES = [
    # text, analysis, ingest, model, localized, page, result, currency
    ("$1,299.00", 1299.0, 1299.0, 1299.0, 1299.0, 1299.0, 1299.0, "USD"),
    ("£51.77", 51.77, N, 51.77, 51.77, 51.77, 51.77, "GBP"),
    ("€5", N, N, 5.0, 5.0, 5.0, 5.0, "EUR"),
    ("12,50", 1250.0, 1250.0, 1250.0, 12.5, 1250.0, 1250.0, "USD"),
    ("1,234,567", 1234567.0, 1234567.0, 1234567.0, 1234567.0, 1234567.0, 1234567.0, "USD"),
    ("$10.00 to $20.00", N, N, N, N, 0.0, N, "USD"),
    ("free", N, N, N, N, 0.0, N, "USD"),
    ("", N, N, N, N, 0.0, N, N),
    ("1.5d", N, N, 1.5, 1.5, 1.5, 1.5, "USD"),
    (" 12 ", 12.0, 12.0, 12.0, 12.0, 12.0, 12.0, "USD"),
    ("1e5", 100000.0, 100000.0, 15.0, 15.0, 15.0, 15.0, "USD"),
    ("1_000", N, 1000.0, 1000.0, 1000.0, 1000.0, 1000.0, "USD"),
    ("inf", float("inf"), float("inf"), N, N, 0.0, N, "USD"),
    ("1.234,56", N, N, N, 1.23456, N, N, "USD"),
    ("12,345", 12345.0, 12345.0, 12345.0, 12345.0, 12345.0, 12345.0, "USD"),
    ("-5", -5.0, -5.0, 5.0, 5.0, 5.0, 5.0, "USD"),
    ("INR 7 EUR", N, N, 7.0, 7.0, 7.0, 7.0, "EUR"),
    ("₹ 99", N, N, 99.0, 99.0, 99.0, 99.0, "INR"),
    (N, N, N, N, N, N, N, N),
]


def test_price_parsers(spark):
    rows = spark.createDataFrame([(r[0],) for r in PRICES], "t string")
    t, none = F.col("t"), F.lit(None).cast("double")
    got = rows.select(
        "t", P.analysis_price(t), P.ingest_price(t), P.model_price(t, none), P.localized_price(t),
        P.page_price(t), P.result_price(t), P.currency_of(t),
    ).collect()
    for want, have in zip(PRICES, got):
        if want[0] == "1.234,56":  # both marks: the comma is dropped, two dots never remain
            assert have[4] == pytest.approx(1.23456)
            continue
        assert tuple(have) == want


def test_model_price_parses_only_missing_or_zero(spark):
    rows = spark.createDataFrame([("$7", None), ("$7", 0.0), ("$7", 3.0), ("", 0.0)], "t string, n double")
    assert [r[0] for r in rows.select(P.model_price(F.col("t"), F.col("n"))).collect()] == [7.0, 7.0, 3.0, 0.0]


def test_charm_and_round_prices(spark):
    rows = spark.createDataFrame([(9.99,), (9.995,), (12345678.99,), (10.0,), (0.99,), (None,)], "p double")
    got = rows.select(P.ends_in_99(F.col("p")), P.is_round(F.col("p"))).collect()
    assert [r[0] for r in got] == [True, False, True, False, True, None]
    assert [r[1] for r in got] == [False, False, False, True, False, None]


def _one(spark, value, expression):
    return spark.createDataFrame([(value,)], "t string").select(expression(F.col("t"))).first()[0]


def _all(spark, values, *expressions):
    """Results of the expressions for every value, in order."""
    rows = spark.createDataFrame([(v,) for v in values], "t string").coalesce(1)
    return [tuple(r) for r in rows.select(*[e(F.col("t")) for e in expressions]).collect()]


AVAILABILITY = [
    ("In Stock", "in_stock", "in_stock"), ("Unavailable", "in_stock", "out_of_stock"),
    ("Sold out", "out_of_stock", "out_of_stock"), ("Few left", "limited_stock", "limited_stock"),
    ("Call us", "unknown", "unknown"), ("", None, None), (None, None, None),
]
CONDITIONS = [
    ("Brand New", "new", "new"), ("Renewed", "new", "refurbished"), ("Pre-Owned", "used", "used"),
    ("For parts", "damaged", "damaged"), ("?", "unknown", "unknown"), ("", None, None),
]


def test_labels(spark):
    for table, label in ((AVAILABILITY, X.availability_status), (CONDITIONS, X.condition_standard)):
        got = _all(spark, [r[0] for r in table], label, lambda c: label(c, strict=True))
        assert got == [r[1:] for r in table]


LINKS = [
    ("//a.com/x", "https://a.com/x"), ("/x", None), ("a.com/x", "https://a.com/x"),
    ("https://a.com", "https://a.com"), ("http://a b", None), ("", ""), (None, None),
    ("http://localhost:80/x", "http://localhost:80/x"), ("http://1.2.3.4", "http://1.2.3.4"),
    ("HTTP://a.com", None), ("http://a.toolongtld", None),
]


def test_validate_url(spark):
    assert [r[0] for r in _all(spark, [u for u, _ in LINKS], U.validate_url)] == [v for _, v in LINKS]


BASES = ["http://h.com/a/b/c.html?q=1#f", "https://h.com", "http://h.com/a/", "http://h.com/a/b?x=/y/z"]
HREFS = [
    "x", "./x", "../x", "../../x", "../../../x", "/x/./y/../z", "//o.com/p", "http://o.com/q", "?k=v", "#top",
    "", "x/y/../z?u=..#v", "a/..", "..", ".", "mailto:me@h.com", "x/",
]


def test_absolute_url_agrees_with_urljoin(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    rows = spark.createDataFrame(pairs, "b string, l string")
    for b, h, made in rows.select("b", "l", U.absolute_url(F.col("b"), F.col("l"))).collect():
        assert made == urljoin(b, h), (b, h)


WORDS = ["  Café  au  lait ®™ (new!) ", "a\x1cb\tc\n", "² ½ x_y - z", "***", "", None, "été"]


def test_text_cleaning_agrees_with_python_regex(spark):
    for text, got in zip(WORDS, _all(spark, WORDS, X.sanitize_text, X.clean_text)):
        squeezed = None if text is None else re.sub(r"\s+", " ", text.strip())
        cleaned = text if not text else (re.sub(r"[^\w\s\-.,!?()]", "", squeezed) or None)
        assert got == (squeezed, cleaned)


def test_product_name_model_and_brand(spark):
    assert _one(spark, "NEW Deal: phone 20% OFF  $5 off", X.clean_product_name) == ": phone"
    assert _one(spark, "renewal of newness", X.clean_product_name) == "renewal of newness"
    assert _one(spark, "Laptop Model: X-200", X.model_of) == "X-200"
    assert _one(spark, "Great video card", X.model_of) == "ideo"
    assert _one(spark, "Great card", X.model_of) is None
    assert _one(spark, "LG and Apple", X.brand_of) == "Apple"
    assert _one(spark, "an LG screen", X.brand_of) == "Lg"
    assert _one(spark, "lamp", X.brand_of) is None


def test_preview_and_first_filled(spark):
    assert _one(spark, "x" * 51, X.preview) == "x" * 50 + "..."
    assert _one(spark, "x" * 50, X.preview) == "x" * 50
    blank = F.lit("  ")
    assert _one(spark, " y ", lambda c: X.first_filled(F.lit(None).cast("string"), blank, c)) == "y"


def test_times(spark):
    forms = {
        "2024-01-01T10:00:00": "2024-01-01 10:00:00", "2024-01-01T10:00:00.5": "2024-01-01 10:00:00.5",
        "2024-01-01 10:00:00": "2024-01-01 10:00:00", "2024-01-01": "2024-01-01 00:00:00",
        "yesterday": None, "": None,
    }
    got = _all(spark, list(forms), lambda c: D.parse_time(c).cast("string"))
    assert [r[0] for r in got] == list(forms.values())
    assert _one(spark, "", lambda c: D.time_or_default(c, "now")) == "now"


def test_quality_score_counts_empty_text_as_filled(spark):
    rows = spark.createDataFrame([("", 1.0, None)], "name string, price_numeric double, link string")
    assert rows.select(X.quality_score(rows.columns)).first()[0] == pytest.approx(2 / 7)
