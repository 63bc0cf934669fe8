"""Joins, ingest, jobs, streams, sinks, validation and page extraction."""

from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from shelfline import session
from shelfline.operators import ingest, joins, pages, select
from shelfline.operators import jobs as J
from shelfline.operators.cleaning import Cleaner
from shelfline.operators.stats import first_per_group
from shelfline.operators.validate import Validator
from shelfline.plans import reports
from shelfline.schemas import COLLECTED_ITEM, STORED_FIELDS
from shelfline.sources import listings as L
from shelfline.sources import sinks
from shelfline.streaming import arrivals


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_listings_keep_all_rows_when_joined_to_jobs(spark, five, jobs):
    orphan = five.withColumn("job_id", F.when(F.col("job_id") == 3, None).otherwise(F.col("job_id")))
    got = as_set(L.scan(orphan, jobs), "product_id", "job_status", "job_search_term")
    assert got == {
        (1, "completed", "books"), (2, "completed", "books"), (3, "completed", "electronics"),
        (4, "completed", "electronics"), (5, None, None),
    }


@pytest.fixture(params=["-1", "10MB"])
def join_limit(request, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def with_extras(df):
    return df.withColumn("extra_attributes", F.create_map(F.lit("a"), F.col("name")))


def test_joins_hold_a_hot_key_of_equal_rows(spark, join_limit):
    """A third of the rows are equal and share one key; rows carry a map."""
    rows = spark.range(3000).select(
        F.when(F.col("id") < 1000, 1).when(F.col("id") < 1100, None).otherwise(F.col("id") % 50).alias("job_id"),
        F.when(F.col("id") < 1000, F.lit("same")).otherwise(F.col("id").cast("string")).alias("name"),
    )
    jobs = spark.range(25).selectExpr(
        "id AS job_id", "'t' || id AS search_term", "'pending' AS status", "timestamp'2024-01-01' AS created_at"
    )
    got = joins.attach_jobs(with_extras(rows), jobs)
    assert got.count() == 3000 and got.where("job_id = 1 AND job_search_term = 't1'").count() == 1000 + 38
    assert got.where("job_id IS NULL AND job_status IS NULL").count() == 100
    links = with_extras(rows.withColumn("link", F.col("job_id").cast("string")))
    fresh = joins.unseen(links, jobs.select(F.col("job_id").cast("string").alias("link")))
    assert fresh.columns == links.columns
    assert fresh.count() == 100 + rows.where("job_id >= 25").count()


def test_a_batch_is_read_once(spark, tmp_path, join_limit):
    batch, stored = str(tmp_path / "batch"), str(tmp_path / "stored")
    rows = spark.range(50).selectExpr("if(id % 5 = 0, null, id % 20) AS link", "id AS scrape_time", "'x' AS name")
    rows.write.parquet(batch)
    rows.where("link < 5").write.parquet(stored)
    fresh = ingest.new_rows(with_extras(spark.read.parquet(batch)), spark.read.parquet(stored), ["scrape_time"])
    assert sorted(r.scrape_time for r in fresh.where("link IS NOT NULL").collect()) == [6, 7, 8, 9, 11, 12, 13, 14, 16, 17, 18, 19]
    assert fresh.where("link IS NULL").count() == 10
    # One scan of the batch and one of the store, however long their paths are.
    plan = spark._jvm.PythonSQLUtils.explainString(fresh._jdf.queryExecution(), "formatted")
    assert len(re.findall(r"(?m)^[ :+-]*\* Scan parquet|^[ :+-]*Scan parquet", plan.split("\n\n")[0])) == 2
    assert sorted({f.split("/")[-2] for f in fresh.inputFiles()}) == ["batch", "stored"]


def test_first_arrivals_order_maps_by_their_entries(spark):
    rows = spark.createDataFrame([(1, {"b": "2"}), (1, {"a": "9"}), (None, {"a": "1"}), (None, {"a": "0"})], "k int, m map<string, string>")
    got = ingest.first_arrivals(rows, ["k"], ["m"])
    assert {(r.k, tuple(r.m.items())) for r in got.collect()} == {(1, (("a", "9"),)), (None, (("a", "0"),))}
    listings = with_extras(rows.withColumns({"name": F.lit("n"), "search_term": F.lit("t")}))
    assert Validator().keep(listings, ["duplicate_check"], unique=True).count() == 1


@pytest.mark.parametrize("limit", ["10485760b", "-1"])
def test_unseen_links(spark, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    stored = spark.createDataFrame([("a",), ("a",), (None,)], "link string")
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "link string, n int")
    assert as_set(joins.unseen(batch, stored), "link", "n") == {("b", 2), ("b", 3), (None, 4)}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_per_link(spark):
    rows = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "early"), (None, 3, "x"), (None, 3, "x"), ("", 4, "y")],
        "link string, n int, name string",
    )
    got = sorted(map(str, ingest.first_per_link(rows, ["n", "name"]).collect()))
    assert len(got) == 4 and sum("early" in g for g in got) == 1 and sum("'x'" in g for g in got) == 2


def test_hot_link_is_reduced_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("link"), "id")
    plan = ingest.first_arrivals(rows, ["link"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"(?s)WindowGroupLimit .*Final.*Exchange.*WindowGroupLimit .*Partial", plan)


def test_first_rows_per_group_are_limited_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") < 0).alias("g"), "id")
    ranked = first_per_group(rows, "g", ["id"], 3)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert sorted(r["id"] for r in ranked.collect()) == [0, 1, 2]


def test_batches_are_stored_once(spark, five, tmp_path):
    store = str(tmp_path / "store")
    batch = five.withColumn("source", F.lit("Custom"))
    ingest.append_batch(batch, store, job_id=1)
    ingest.append_batch(batch.withColumn("name", F.lit("again")), store, job_id=2)
    extra = batch.limit(2).withColumn("link", F.concat(F.lit("new-"), F.col("product_id").cast("string")))
    ingest.append_batch(extra.unionByName(extra), store, job_id=3)
    ingest.append_batch(extra.unionByName(extra), store, job_id=3)
    stored = ingest.read_store(spark, store)
    assert stored.count() == 7 and stored.where("name = 'again'").count() == 0
    assert as_set(stored.where("job_id = 1"), "price") == {(10.99,), (25.5,), (99.99,), (5.0,), (15.99,)}
    assert set(STORED_FIELDS) < set(stored.columns)


def test_every_insert_adds_unless_it_is_a_repeat(spark, five, tmp_path):
    store = str(tmp_path / "store")
    for run, part in (("a", "product_id <= 2"), ("b", "product_id > 2"), ("b", "product_id > 2")):
        ingest.append_batch(five.where(part).withColumn("source", F.lit("x")), store, 1, run=run)
    assert ingest.read_store(spark, store).count() == 5
    unlinked = five.limit(2).drop("job_id").withColumns({"link": F.lit(None).cast("string"), "source": F.lit("x")})
    for _ in range(2):
        ingest.append_batch(unlinked, store)
    assert ingest.read_store(spark, store).where("job_id IS NULL").count() == 4


def test_store_is_empty_before_the_first_batch(spark, tmp_path):
    assert ingest.read_store(spark, str(tmp_path / "none")).count() == 0


def test_rows_to_store_parse_prices_and_fill_columns(spark):
    rows = spark.createDataFrame([("$1,299.00", "a"), ("£5", "b"), ("nan", "c"), (None, "d")], "price string, link string")
    stored = ingest.to_stored(rows, 9)
    assert as_set(stored, "link", "price", "job_id") == {("a", 1299.0, 9), ("b", None, 9), ("c", None, 9), ("d", None, 9)}


def test_latest_job_state_and_duration(spark):
    log = spark.sql("""SELECT * FROM VALUES
      (1, 'books', 'pending', TIMESTAMP'2024-01-01 09:00:00', NULL),
      (1, 'books', 'running', TIMESTAMP'2024-01-01 09:10:00', NULL),
      (1, 'books', 'completed', TIMESTAMP'2024-01-01 09:30:00', NULL),
      (2, 'x', 'pending', TIMESTAMP'2024-01-01 09:00:00', NULL),
      (3, 'y', 'running', TIMESTAMP'2024-01-01 09:00:00', NULL),
      (3, 'y', 'failed', TIMESTAMP'2024-01-01 09:00:00', 'timeout')
      AS t(job_id, search_term, status, event_time, message)""")
    state = J.job_durations(J.latest_jobs(log))
    got = as_set(state, "job_id", "status", "duration_s", "error_message")
    assert got == {(1, "completed", 1200.0, None), (2, "pending", None, None), (3, "failed", 0.0, "timeout")}
    assert as_set(J.next_pending(state, 5), "job_id", "remaining") == {(2, 0)}


def test_fixture_job_durations(jobs):
    typed = jobs.withColumns({c: F.try_to_timestamp(c) for c in ("created_at", "completed_at")})
    assert as_set(J.job_durations(typed, "created_at"), "job_id", "duration_s") == {(1, 1800.0), (2, 2700.0), (3, 1500.0)}


def test_retention_keeps_rows_without_a_time(spark, five, tmp_path):
    rows = L.normalised(five.withColumn("scrape_time", F.when(F.col("product_id") > 1, F.col("scrape_time"))))
    kept = J.retained(rows, "2024-01-03 10:00:00", days=1)
    assert as_set(kept, "product_id") == {(1,), (5,)}
    assert J.retention_counts(rows, "2024-01-03 10:00:00", 1).first().asDict() == {"removed": 3, "kept": 2}


def test_incremental_ingest_reads_only_new_files(spark, five, tmp_path):
    source, store, progress = (str(tmp_path / n) for n in ("in", "store", "progress"))
    order = ["scrape_time", "name"]

    def run():
        stream = arrivals.arriving(spark, source, five.schema)
        arrivals.ingest_arrivals(stream, store, progress, order=order).awaitTermination()
        return ingest.read_store(spark, store).count()

    five.where("product_id <= 3").write.parquet(source)
    assert run() == 3
    assert run() == 3
    five.where("product_id >= 3").withColumn("name", F.lit("later")).write.mode("append").parquet(source)
    assert run() == 5
    assert as_set(ingest.read_store(spark, store).where("link LIKE '%/3'"), "name") == {("Product C",)}


def test_streams_share_a_store(spark, five, tmp_path):
    """Streams with progress of their own, and one that starts anew, never replace each other's rows."""
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    five.write.parquet(source)
    for progress, part in (("p1", "product_id = 1"), ("p2", "product_id <= 3"), ("p3", "product_id >= 3"), ("p1", "product_id > 0")):
        stream = arrivals.arriving(spark, source, five.schema)
        arrivals.ingest_arrivals(
            stream, store, str(tmp_path / progress), lambda df, p=part: df.where(p), ["scrape_time"]
        ).awaitTermination()
    assert sorted(r.link[-1] for r in ingest.read_store(spark, store).collect()) == list("12345")


def test_hours_of_a_stream(spark, five, tmp_path):
    source = str(tmp_path / "in")
    five.unionByName(five).coalesce(1).write.parquet(source)
    rows = spark.read.parquet(source).withColumn("price_numeric", F.lit(1.0))
    stream = arrivals.arriving(spark, source, five.schema).withColumn("price_numeric", F.lit(1.0))
    hours = str(tmp_path / "hours")
    arrivals.run_to_files(arrivals.hourly_counts(stream), hours, str(tmp_path / "p2"))
    closed = spark.read.parquet(hours)
    assert as_set(closed, F.hour("hour_start"), "listings") == {(10, 2), (11, 2), (12, 2), (13, 2)}
    assert as_set(arrivals.open_hours(rows, closed), F.dayofmonth("hour_start"), "listings") == {(2, 2)}
    late = five.where("product_id = 1").withColumn("scrape_time", F.lit("2023-12-01T00:00:00"))
    late.write.mode("append").parquet(source)
    arrivals.run_to_files(arrivals.hourly_counts(stream), hours, str(tmp_path / "p2"))
    assert spark.read.parquet(hours).where("hour_start < '2024-01-01'").count() == 0


def test_item_array_files(spark, tmp_path):
    items = [{"name": "a", "price": 1.5, "link": "l"}, {"name": "b", "price": None, "odd": 1}]
    (tmp_path / "good.json").write_text(json.dumps(items, indent=2), encoding="utf-8")
    (tmp_path / "bad.json").write_text('[{"name": "c", ', encoding="utf-8")
    got = L.read_items(spark, str(tmp_path / "good.json"))
    assert as_set(got, "name", "price", "link") == {("a", 1.5, "l"), ("b", None, None)}
    assert got.schema == COLLECTED_ITEM
    (tmp_path / "odd.json").write_text('[{"name": "d", "price": "$5"}]', encoding="utf-8")
    assert as_set(L.read_items(spark, str(tmp_path / "odd.json")), "name", "price") == {("d", None)}
    assert L.read_items(spark, str(tmp_path / "bad.json")).count() == 0
    assert L.read_items(spark, str(tmp_path / "missing.json")).count() == 0


def test_csv_reads_back_any_text(spark, tmp_path):
    rows = spark.createDataFrame(
        [('say "hi", now', "x\ny"), ("", None), ("back\\slash", "é€")], "name string, note string"
    )
    path = str(tmp_path / "csv")
    sinks.write_csv(rows, path)
    assert as_set(sinks.read_csv(spark, path, rows.schema), "name", "note") == as_set(rows, "name", "note")


def test_files_that_lack_a_column(spark, five, tmp_path):
    path = str(tmp_path / "rows")
    five.drop("image").write.parquet(path)
    five.write.mode("append").parquet(path)
    for rows in (L.read_parquet(spark, path, five.schema), L.read_parquet(spark, path, merge=True)):
        assert rows.count() == 10 and rows.where("image IS NULL").count() == 5


def test_sheets_and_export(spark, five, tmp_path):
    path = str(tmp_path / "sheets")
    long = five.withColumn("search_term", F.when(F.col("search_term") == "books", F.lit("a b " * 10)))
    sinks.write_by_term(long, path)
    sheets = spark.read.parquet(path)
    assert as_set(sheets, "sheet") == {("a_b_" * 10,)} and sheets.count() == 3
    sinks.write_by_term(long, path + "-short", name_length=31)
    assert as_set(spark.read.parquet(path + "-short"), "sheet") == {(("a_b_" * 10)[:31],)}
    rows = five.withColumn("source", F.when(F.col("product_id") > 1, "eBay"))
    got = sinks.configured_export(rows, "name, nothing,price", "EBAY", "2024-01-01", "2024-01-01")
    assert got.columns == ["name", "price"] and got.count() == 3


def test_date_range_treats_missing_times_as_empty_text(spark):
    rows = spark.createDataFrame([("2024-01-05T23:59:59",), ("2024-01-06T00:00:00",), (None,)], "scrape_time string")
    typed = rows.withColumn("scrape_time", F.try_to_timestamp("scrape_time"))
    for df in (rows, typed):
        assert select.in_date_range(df, "2024-01-05", "2024-01-05").count() == 1
        assert select.in_date_range(df, None, "2024-01-05").count() == 2
        assert select.in_date_range(df, "2024-01-06").count() == 1


def test_report_sink_formats(spark, five, tmp_path):
    metrics = reports.stamped(
        reports.long_form(L.scan(five).groupBy("search_term").count(), "n", "search_term"), "2024-01-01", {"k": "v"}
    )
    for fmt in ("json", "csv", "parquet", "other"):
        sinks.write_report(metrics, str(tmp_path / fmt), fmt)
    back = spark.read.schema(metrics.schema).json(str(tmp_path / "other"))
    assert as_set(back, "dimension", "value", F.col("parameters")["k"]) == {("books", 3.0, "v"), ("electronics", 2.0, "v")}
    assert sinks.read_csv(spark, str(tmp_path / "csv"), "a string").count() == 2


def test_extras_fold_and_flatten(spark):
    rows = spark.createDataFrame([("a", "1", None)], "name string, color string, size string")
    folded = select.fold_extras(rows)
    assert folded.first()["extra_attributes"] == {"color": "1"}
    flat = select.flatten_extras(folded, ["color", "size"]).first().asDict()
    assert flat == {"name": "a", "color": "1", "size": None}


def test_validation_rules_and_rejects(spark, mixed):
    v = Validator()
    assert as_set(v.keep(mixed, ["required_fields", "unknown"]), "product_id") == {(1,), (2,), (4,), (5,)}
    assert v.keep(mixed, ["price_range"]).count() == 0
    assert v.keep(mixed.withColumn("price", F.lit("10.99")), ["price_range"]).count() == 5
    assert as_set(v.rejects(mixed, ["required_fields", "url_format"]), "product_id", "first_failed_rule") == {
        (3, "required_fields")
    }
    long = mixed.withColumn("name", F.repeat(F.lit("x"), 501))
    assert v.keep(long, ["text_length"]).count() == 0
    same = mixed.withColumn("name", F.lit("n"))
    assert as_set(v.keep(same, ["duplicate_check"], unique=True), "search_term") == {("books",), ("electronics",)}
    assert v.keep(same, ["duplicate_check"]).count() == 5


def test_cleaning_chain_drops_unusable_rows(mixed):
    cleaned = Cleaner().run(mixed, ["clean_text", "no such step", "normalize_price", "normalize_availability"])
    got = as_set(cleaned, "product_id", "price_numeric", "currency", "availability_status")
    assert got == {
        (1, 10.99, "USD", "in_stock"), (2, 25.5, "GBP", "out_of_stock"), (4, 99.99, "USD", None), (5, 5.0, "USD", "in_stock"),
    }


CARD = """<article class="product_pod"><h3><a href="../x_{0}/index.html" title="Book &amp; {0}">Book...</a></h3>
<img src="/media/{0}.jpg"/><p class="price_color">£5{0}.77</p>
<p class="instock availability"><i></i>  In
 stock </p></article>"""


def test_catalogue_page(spark):
    html = "<html>" + CARD.format(1) + "<article class='x'></article>" + CARD.format(2) + "</html>"
    page = spark.createDataFrame([(1, "http://books.example.com/catalogue/page-1.html", html)], "page_id int, url string, html string")
    items = pages.split_containers(page, pages.CATALOGUE_CONTAINERS)
    got = pages.extract_fields(items, pages.CATALOGUE_FIELDS).orderBy("position").collect()
    assert [tuple(r) for r in got] == [
        (1, i, f"Book & {i + 1}", 50.0 + i + 1.77, f"http://books.example.com/x_{i + 1}/index.html",
         f"http://books.example.com/media/{i + 1}.jpg", "In stock") for i in range(2)
    ]


RESULT = """<div class="s-result-item" data-component-type="s-search-result"><div data-cy="title-recipe">
<a class="a-link-normal" href="/dp/{0}"><h2 class="x"><span> Laptop {0} </span></h2></a></div>
<span class="a-icon-alt">4.{0} out of 5</span><span class="a-price"><span class="a-offscreen">$1,0{0}0.50</span></span></div>"""


def test_search_results_page(spark):
    html = "".join(RESULT.format(i) for i in range(9)) * 4
    page = spark.createDataFrame([(1, "http://a.example.com", html)], "page_id int, url string, html string")
    assert pages.split_containers(page, pages.RESULT_CONTAINERS, limit=pages.PAGE_LIMIT).count() == 25
    got = pages.extract_results(pages.split_containers(page, pages.RESULT_CONTAINERS), "laptop").orderBy("position").collect()
    assert len(got) == 36
    r = got[1].asDict()
    assert (r["name"], r["price"], r["rating"], r["source"]) == ("Laptop 1", 1010.5, "4.1 out of 5", "Amazon")
    assert r["link"] == "https://www.amazon.com/dp/1" and r["availability"] == "In Stock"


AUCTION = """<li class="s-item s-x"><a class="s-item__link" href="http://e.example.com/{0}">
<div class="s-item__title"><span role="heading">{1}</span></div></a><span class="s-item__price">$5.00 to $6.00</span></li>"""


def test_auction_page(spark):
    html = AUCTION.format(1, "Shop on eBay") + AUCTION.format(2, " Phone <b>x</b> ")
    page = spark.createDataFrame([(7, "http://e.example.com", html)], "page_id int, url string, html string")
    got = pages.extract_auctions(pages.split_containers(page, pages.AUCTION_CONTAINERS)).collect()
    assert [tuple(r) for r in got] == [(7, 1, "Phone x", "$5.00 to $6.00", "http://e.example.com/2", "Unknown")]


def test_page_classes(spark):
    rows = spark.createDataFrame(
        [(1, "http://a.com/x", "Are you a ROBOT?", 200), (2, "http://a.com/y", "ok " + pages.RESULT_MARK, 200),
         (3, "http://b.com:80/", "nothing", 503)],
        "page_id int, url string, html string, status int",
    )
    classes = pages.classify_pages(rows)
    assert as_set(classes, "page_id", "host", "blocked", "has_results", "loaded_empty") == {
        (1, "a.com", True, False, True), (2, "a.com", False, True, False), (3, "b.com", False, False, False),
    }
    assert as_set(pages.block_rates(classes), "host", "pages", "blocked_rate") == {("a.com", 2, 0.5), ("b.com", 1, 0.0)}


def test_stream_keeps_the_first_row_of_each_link(spark, tmp_path):
    """The earliest row of a batch counts; late files and rows without a link are kept."""
    source, store, progress = (str(tmp_path / n) for n in ("in", "store", "progress"))
    schema = "link string, scrape_time timestamp, n int"
    rows = "SELECT link, CAST(t AS timestamp) AS scrape_time, n FROM VALUES {} AS v(link, t, n)"

    def run(values):
        spark.sql(rows.format(values)).coalesce(1).write.mode("append").parquet(source)
        shape = spark.createDataFrame([], schema).schema
        stream = arrivals.arriving(spark, source, shape)
        arrivals.first_links(stream, store, progress, ["scrape_time", "n"]).awaitTermination()
        return as_set(ingest.read_store(spark, store, shape), "link", "n")

    hot = ", ".join(f"('hot', '2024-01-10 00:00:{59 - i}', {i})" for i in range(50))
    assert run(hot + ", (NULL, '2024-01-10 00:00:00', 77), (NULL, '2024-01-10 00:00:00', 77)") == {("hot", 49), (None, 77)}
    late = "('b', '2023-01-01 00:00:00', 1), ('b', '2022-01-01 00:00:00', 2), ('hot', '2020-01-10 02:00:00', 99), (NULL, NULL, 78)"
    assert run(late) == {("hot", 49), (None, 77), ("b", 2), (None, 78)}
    assert ingest.read_store(spark, store).count() == 5


def plan_of(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_retention_reaches_the_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.sql("SELECT timestamp'2024-01-01' AS scrape_time").write.parquet(path)
    plan = plan_of(J.retained(spark.read.parquet(path), "2024-01-31", 10))
    assert re.search(r"PushedFilters: \[Or\(IsNull\(scrape_time\),GreaterThanOrEqual\(scrape_time", plan)


def test_cleaning_steps_run_once(mixed):
    """The filter on the cleaned rows does not repeat the steps."""
    plan = plan_of(Cleaner().run(mixed, ["clean_product_name", "normalize_price", "validate_url"]))
    tree = plan.split("== Physical Plan ==")[1]
    assert tree.count("limited time") <= 2  # the name itself and its model, in one projection
    assert "limited time" not in "".join(x for x in tree.splitlines() if x.startswith("Condition"))


def test_insights_read_the_listings_twice(spark, five, tmp_path):
    path = str(tmp_path / "rows")
    L.timed_scan(five).write.parquet(path)
    plan = plan_of(reports.insights(spark.read.parquet(path)))
    assert len(set(re.findall(r"ReadSchema: (\S+)", plan))) <= 2


def test_scratch_needs_a_shared_location(spark, monkeypatch):
    class Session:
        def __init__(self, **conf):
            self.conf = self
            self.known = conf

        def get(self, key, default=None):
            return self.known.get(key, default)

        def set(self, key, value):
            self.known[key] = value

    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1000]", "k8s://host"):
        with pytest.raises(ValueError, match="checkpoint"):
            session.scratch_dir(Session(**{"spark.master": master}), "x")
    assert session.scratch_dir(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "s3://b/t/"}), "x").startswith("s3://b/t/x-")
    alone = Session(**{"spark.master": "local[4]"})
    assert session.scratch_dir(alone, "x").startswith(alone.get("spark.checkpoint.dir"))
