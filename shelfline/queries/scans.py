"""Scans, sinks, filters, projections, unions and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions import text as X
from shelfline.operators import joins, select, stats
from shelfline.operators.outliers import percentile_positions
from shelfline.operators.quality import counts_by
from shelfline.operators.ranks import value_counts
from shelfline.queries.registry import EV, JOBS, RAW_SHOP, SHOP, days, query, rounded, stamps
from shelfline.schemas import COLLECTED_ITEM
from shelfline.session import scratch_dir
from shelfline.sources import adapters as A
from shelfline.sources import listings as L
from shelfline.sources import arrays, sinks

TEN = "name, link, image, availability, search_term, source, strftime(scrape_time, '%Y-%m-%d %H:%M:%S') AS scrape_time, job_id"


def events(spark, folder):
    """The analysis scan over events, with date and hour."""
    return L.timed_scan(A.event_listings(spark, folder))


def shop(spark, folder):
    """The analysis scan over order lines, without the jobs' columns."""
    return L.scan(A.shop_listings(spark, folder))


@query(f"""WITH {RAW_SHOP}, {JOBS}
SELECT name, price AS price_numeric,
       coalesce('$' || format('{{:,.2f}}', price), 'Call for price') AS price,
       link, image, availability, raw.search_term, source,
       strftime(scrape_time, '%Y-%m-%d %H:%M:%S') AS scrape_time, raw.job_id,
       jobs.search_term AS job_search_term, jobs.status AS job_status,
       strftime(jobs.created_at, '%Y-%m-%d %H:%M:%S') AS job_created_at
FROM raw LEFT JOIN jobs USING (job_id) WHERE name IS NOT NULL""")
def s1_listings_scan(spark, folder):
    rows = L.scan(A.shop_listings(spark, folder, price_text=True), A.jobs(spark, folder))
    return stamps(rows, "scrape_time", "job_created_at")


@query(f"""WITH {EV} SELECT id, name, price_numeric, price_numeric AS price, search_term,
strftime(scrape_time, '%Y-%m-%d %H:%M:%S') AS scrape_time,
strftime(scrape_date, '%Y-%m-%d') AS scrape_date, scrape_hour FROM ev""")
def s2_timed_scan(spark, folder):
    rows = events(spark, folder).drop("link", "availability")
    return stamps(days(rows, "scrape_date"), "scrape_time")


@query(f"""WITH {RAW_SHOP} SELECT {TEN}, price FROM raw
WHERE source = 'Brand#3' AND search_term = 'SMALL'""")
def s3_listing_lookup(spark, folder):
    return stamps(select.lookup(A.shop_listings(spark, folder), "Brand#3", "SMALL"), "scrape_time")


PAGE_LINKS = """WITH hits AS (
  SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)"', 1)) AS link FROM pages)
SELECT link AS name, page_id::DOUBLE AS price, link, 'books' AS search_term,
       '2024-01-01T00:00:00' AS scrape_time, 'In Stock' AS availability,
       NULL::VARCHAR AS rating, 'Amazon' AS source
FROM hits"""


def _page_items(spark, folder):
    """Every page's links as collected items."""
    link = F.regexp_extract_all("html", F.lit('<li><a href="([^"]*)"'), 1)

    def item(x):
        return F.struct(
            x.alias("name"), F.col("page_id").cast("double").alias("price"), x.alias("link"),
            F.lit("books").alias("search_term"), F.lit("2024-01-01T00:00:00").alias("scrape_time"),
            F.lit("In Stock").alias("availability"), F.lit("Amazon").alias("source"),
        )

    found = A.pages(spark, folder).select("page_id", link.alias("links"))
    return found.select("page_id", F.transform("links", item).alias("items"))


@query(PAGE_LINKS)
def s4_item_array_scan(spark, folder):
    """Every page's links written as one JSON array per page and read back as rows."""
    path = scratch_dir(spark, "item-arrays")
    _page_items(spark, folder).select(F.to_json("items").alias("value")).write.text(path)
    return L.read_items(spark, path, COLLECTED_ITEM, whole_files=False)


@query(PAGE_LINKS)
def s4_split_item_arrays(spark, folder):
    """The same items as one array for every hundred pages, its files cut into several splits each.

    Every array is one record and one file of a single folder, which is listed at once.
    """
    path = scratch_dir(spark, "item-arrays")
    some = _page_items(spark, folder).groupBy(F.expr("page_id div 100").alias("part"))
    array = F.to_json(F.flatten(F.collect_list("items")), {"pretty": "true"}).alias("value")
    some.agg(array).select("value").write.option("maxRecordsPerFile", 1).text(path)
    return arrays.read_array_items(spark, path, COLLECTED_ITEM, split_bytes=1 << 14)


@query(f"""WITH {RAW_SHOP} SELECT name, price, link, search_term, source, job_id FROM raw""")
def s5_raw_json_by_source(spark, folder):
    rows = A.shop_listings(spark, folder).select("name", "price", "link", "search_term", "source", "job_id")
    path = scratch_dir(spark, "raw-json")
    sinks.write_raw_json(rows, path)
    return spark.read.schema(rows.schema).json(path).select(rows.columns)


@query(f"""WITH {RAW_SHOP} SELECT {TEN}, price FROM raw""")
def s6_csv_export(spark, folder):
    rows = stamps(A.shop_listings(spark, folder), "scrape_time")
    path = scratch_dir(spark, "csv")
    sinks.write_csv(rows, path)
    return sinks.read_csv(spark, path, rows.schema)


@query(f"""WITH {RAW_SHOP} SELECT {TEN}, price FROM raw""")
def s7_json_export(spark, folder):
    rows = stamps(A.shop_listings(spark, folder), "scrape_time")
    path = scratch_dir(spark, "json")
    sinks.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query(f"""WITH {RAW_SHOP} SELECT name, price, link, search_term, job_id,
replace(search_term, ' ', '_') AS sheet FROM raw WHERE search_term IS NOT NULL""")
def s8_partition_per_term(spark, folder):
    rows = A.shop_listings(spark, folder).select("name", "price", "link", "search_term", "job_id")
    path = scratch_dir(spark, "sheets")
    sinks.write_by_term(rows, path)
    return spark.read.parquet(path)


@query(f"""WITH {RAW_SHOP} SELECT name, price, search_term FROM raw
WHERE lower(coalesce(source, '')) = 'brand#7'
  AND scrape_time >= DATE '1997-01-01' AND scrape_time < DATE '1999-01-01'""")
def s11_configured_export(spark, folder):
    rows = sinks.configured_export(
        A.shop_listings(spark, folder), "name, price, nothing, search_term",
        source="BRAND#7", start="1997-01-01", end="1998-12-31",
    )
    path = scratch_dir(spark, "export")
    sinks.export(rows, path, "parquet")
    return spark.read.parquet(path)


@query(f"""WITH {RAW_SHOP} SELECT {TEN}, price FROM raw WHERE name IS NOT NULL""")
def f1_named(spark, folder):
    return stamps(select.named(A.shop_listings(spark, folder)), "scrape_time")


@query(f"""WITH {RAW_SHOP} SELECT name, price, link, job_id, (name IS NOT NULL AND name <> ''
  AND (coalesce(link, '') <> '' OR price IS NOT NULL)) AS usable FROM raw""")
def f2_minimum_valid(spark, folder):
    rows = A.shop_listings(spark, folder).select("name", "price", "link", "job_id")
    return rows.withColumn("usable", select.minimum_valid("double"))


@query("""WITH it AS (
  SELECT page_id, unnest(regexp_extract_all(html, '(?s)<(?:li|p)>(.*?)</(?:li|p)>', 1)) AS item FROM pages),
g AS (SELECT page_id, regexp_extract(item, '<a href="([^"]*)"', 1) AS link,
             regexp_extract(item, '<a[^>]*>([^<]*)</a>', 1) AS name FROM it)
SELECT page_id, name, link FROM g WHERE name <> '' AND link <> ''""")
def f3_linked_records(spark, folder):
    item = F.regexp_extract_all("html", F.lit(r"(?s)<(?:li|p)>(.*?)</(?:li|p)>"), 1)
    rows = A.pages(spark, folder).select("page_id", F.explode(item).alias("item"))
    return select.linked(
        rows.select(
            "page_id",
            F.regexp_extract("item", r"<a[^>]*>([^<]*)</a>", 1).alias("name"),
            F.regexp_extract("item", r'<a href="([^"]*)"', 1).alias("link"),
        )
    )


@query(f"""WITH {RAW_SHOP} SELECT name, price, source FROM raw
WHERE lower(coalesce(source, '')) = 'brand#11'""")
def f4_source_filter(spark, folder):
    return select.from_source(A.shop_listings(spark, folder), "BRAND#11").select("name", "price", "source")


@query("""SELECT event_id AS id, event_type AS search_term, strftime(ts, '%Y-%m-%d %H:%M:%S') AS scrape_time
FROM events WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""")
def f5_date_range(spark, folder):
    rows = select.in_date_range(A.event_listings(spark, folder), "2024-01-05", "2024-01-20")
    return stamps(rows.select("id", "search_term", "scrape_time"), "scrape_time")


@query(f"""WITH {RAW_SHOP} SELECT name, link FROM raw
WHERE coalesce(name, '') <> '' AND name NOT IN ('red widget', 'blue bolt')""")
def f6_without_placeholders(spark, folder):
    rows = A.shop_listings(spark, folder).select("name", "link")
    return select.without_placeholders(rows, ["red widget", "blue bolt"])


@query(f"""WITH {EV} SELECT id, price_numeric FROM ev WHERE price_numeric IS NOT NULL""")
def f7_priced(spark, folder):
    return select.priced(events(spark, folder)).select("id", "price_numeric")


@query("""SELECT coalesce(json_extract_string(props, '$.k'), NULL) AS k, event_type AS search_term,
'replaced-' || event_type AS name, event_id::VARCHAR AS origin FROM events""")
def pr1_flatten_extras(spark, folder):
    """An extra key wins over the named field it clashes with."""
    src = A.table(spark, folder, "events")
    extra = F.create_map(
        F.lit("k"), F.get_json_object("props", "$.k"),
        F.lit("name"), F.concat(F.lit("replaced-"), F.col("event_type")),
        F.lit("origin"), F.col("event_id").cast("string"),
    )
    rows = src.select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("name"),
        F.col("event_type").alias("search_term"), extra.alias("extra_attributes"),
    )
    return select.flatten_extras(rows, ["name", "k", "origin"])


@query("""SELECT event_type AS search_term, event_id::VARCHAR AS event_id, props,
3 AS extras FROM events""")
def pr2_fold_extras(spark, folder):
    src = A.table(spark, folder, "events").select(
        F.col("event_type").alias("search_term"), "event_id", "props", "user_id",
        F.lit(None).cast("string").alias("nothing"),
    )
    folded = select.fold_extras(src)
    extras = F.col("extra_attributes")
    return folded.select(
        "search_term", extras["event_id"].alias("event_id"), extras["props"].alias("props"),
        F.size(extras).alias("extras"),
    )


@query("SELECT p_name AS name, p_retailprice AS price FROM part")
def pr3_pick_fields(spark, folder):
    rows = A.table(spark, folder, "part").withColumnsRenamed({"p_name": "name", "p_retailprice": "price"})
    return select.pick_fields(rows, " name ,price, nosuch")


@query("""SELECT p_name AS name, p_retailprice AS price, NULL::VARCHAR AS link, 'Custom' AS source,
'parts' AS search_term, p_partkey::VARCHAR AS extra_key, p_name AS extra_name FROM part""")
def pr4_listing_factory(spark, folder):
    rows = A.table(spark, folder, "part").withColumnsRenamed({"p_name": "name", "p_retailprice": "price"})
    made = select.as_listings(rows, "Custom", "parts")
    extras = F.col("extra_attributes")
    return made.select(
        "name", "price", "link", "source", "search_term",
        extras["p_partkey"].alias("extra_key"), extras["name"].alias("extra_name"),
    )


@query(f"""WITH {RAW_SHOP} SELECT coalesce(name, 'Unknown') AS name, coalesce(link, '') AS link, '' AS image,
coalesce(availability, 'In Stock') AS availability, coalesce(source, 'Amazon') AS source,
coalesce(search_term, 'laptop') AS search_term, price FROM raw""")
def pr5_result_defaults(spark, folder):
    rows = A.shop_listings(spark, folder).drop("scrape_time", "job_id")
    return select.with_result_defaults(rows, "laptop")


@query("""SELECT p_partkey AS id, 'BooksToScrape' AS source, 'books' AS search_term,
'2024-01-01T00:00:00' AS scrape_time FROM part""")
def pr6_tagged_batch(spark, folder):
    rows = A.table(spark, folder, "part").select(F.col("p_partkey").alias("id"))
    return select.tagged(rows, "BooksToScrape", "books", "2024-01-01T00:00:00")


@query("""SELECT doc_id, CASE WHEN length(text) > 50 THEN substring(text, 1, 50) || '...' ELSE text END
AS preview FROM documents""")
def pr7_name_preview(spark, folder):
    return A.table(spark, folder, "documents").select("doc_id", X.preview(F.col("text")).alias("preview"))


@query(f"""WITH {RAW_SHOP}, {JOBS}
SELECT raw.job_id, price, jobs.status AS job_status, jobs.search_term AS job_search_term,
       strftime(created_at, '%Y-%m-%d %H:%M:%S') AS job_created_at
FROM raw LEFT JOIN jobs USING (job_id)""")
def j1_listings_with_jobs(spark, folder):
    rows = joins.attach_jobs(A.shop_listings(spark, folder).select("job_id", "price"), A.jobs(spark, folder))
    return stamps(rows, "job_created_at")


@query(f"""WITH {RAW_SHOP},
stored AS (SELECT link FROM raw WHERE scrape_time < DATE '1998-07-01'),
incoming AS (SELECT name, link, job_id FROM raw WHERE scrape_time >= DATE '1998-07-01')
SELECT i.* FROM incoming i
WHERE i.link IS NULL OR NOT EXISTS (SELECT 1 FROM stored s WHERE s.link = i.link)""")
def j2_unseen_links(spark, folder):
    rows = A.shop_listings(spark, folder)
    stored = rows.where("scrape_time < DATE'1998-07-01'")
    incoming = rows.where("scrape_time >= DATE'1998-07-01'").select("name", "link", "job_id")
    return joins.unseen(incoming, stored)


@query(f"""WITH {EV}, a AS (
  SELECT search_term, avg(price_numeric) AS m FROM ev WHERE price_numeric IS NOT NULL GROUP BY 1)
SELECT a.search_term, count(*) FILTER (WHERE price_numeric < m) AS rows_below
FROM a, ev GROUP BY 1""")
def j3_rows_below_average(spark, folder):
    return percentile_positions(events(spark, folder)).select("search_term", "rows_below")


@query(f"""WITH {EV}, s AS (SELECT avg(price_numeric) AS m, max(price_numeric) AS x FROM ev)
SELECT id, round(price_numeric - m, 6) AS above_mean, round(price_numeric / x, 6) AS of_max
FROM ev, s WHERE price_numeric > m""")
def j4_scalar_lookup(spark, folder):
    """Whole-table figures used on every row, as one scalar subquery."""
    ev = events(spark, folder)
    p = F.col("price_numeric")
    s = ev.agg(F.struct(F.avg(p).alias("m"), F.max(p).alias("x")).alias("s")).scalar()
    return rounded(
        ev.where(p > s["m"]).select("id", (p - s["m"]).alias("above_mean"), (p / s["x"]).alias("of_max"))
    )


@query(f"""WITH {EV} SELECT id, strftime(scrape_time, '%Y-%m-%d %H:%M:%S') AS scrape_time
FROM ev ORDER BY ev.scrape_time""")
def t1_time_order(spark, folder):
    rows = L.timed_scan(A.event_listings(spark, folder), ordered=True)
    return stamps(rows.select("id", "scrape_time"), "scrape_time")


@query(f"""WITH {SHOP} SELECT source, count(*) AS listings FROM sh WHERE source IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1""")
def t2_frequency_order(spark, folder):
    return counts_by(shop(spark, folder), "source")


@query("""SELECT user_id::VARCHAR AS name, count(*) AS listings FROM events GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 10""")
def t3_top_ten(spark, folder):
    name = F.col("user_id").cast("string").alias("name")
    rows = A.table(spark, folder, "events").groupBy(name).agg(F.count("*").alias("listings"))
    return rows.orderBy(F.desc("listings"), "name").limit(10)


@query("""SELECT 'doc-' || doc_id AS name, NULL::DOUBLE AS price, source, lang FROM documents
UNION ALL SELECT p_name, p_retailprice, p_brand, NULL FROM part
UNION ALL SELECT url, NULL, NULL, NULL FROM pages""")
def u1_union_of_sources(spark, folder):
    docs = A.table(spark, folder, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"), "source", "lang"
    )
    parts = A.table(spark, folder, "part").select(
        F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"), F.col("p_brand").alias("source")
    )
    found = A.pages(spark, folder).select(F.col("url").alias("name"))
    return select.union_sources(docs, parts, found)


@query(f"""WITH {SHOP} SELECT DISTINCT search_term, source FROM sh""")
def u2_distinct_values(spark, folder):
    return shop(spark, folder).select("search_term", "source").distinct()


@query(f"""WITH {SHOP} SELECT price_numeric AS value, count(*) AS n FROM sh
WHERE price_numeric IS NOT NULL GROUP BY 1""")
def u2_value_counts(spark, folder):
    return value_counts(shop(spark, folder), "price_numeric")


@query(f"""WITH {EV} SELECT * EXCLUDE (rn) FROM (
  SELECT search_term, id, row_number() OVER (PARTITION BY search_term ORDER BY id) AS rn,
         row_number() OVER (PARTITION BY search_term ORDER BY id)::INT AS rank_in_group FROM ev)
WHERE rn <= 3""")
def w7_first_rows_per_source(spark, folder):
    rows = events(spark, folder).select("search_term", "id")
    return stats.first_per_group(rows, "search_term", ["id"], 3)
