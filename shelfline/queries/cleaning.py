"""Price, text, URL and time functions, validation and cleaning chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions import price as P
from shelfline.functions import temporal as D
from shelfline.functions import text as X
from shelfline.functions import urls as U
from shelfline.operators import quality, select
from shelfline.operators.cleaning import Cleaner, normalize_price
from shelfline.operators.select import minimum_valid
from shelfline.operators.validate import Validator
from shelfline.queries.registry import EV, SHOP, query, rounded
from shelfline.queries.scans import events, shop
from shelfline.sources import adapters as A

PRICES = """src AS (SELECT o_orderkey AS id, o_totalprice AS total, format('{:,.2f}', o_totalprice) AS g,
  format('{:.2f}', o_totalprice) AS f, o_orderpriority AS k FROM orders),
pr AS (SELECT id, total, CASE k WHEN '1-URGENT' THEN '$' || g WHEN '2-HIGH' THEN '£' || g
  WHEN '3-MEDIUM' THEN 'EUR ' || replace(f, '.', ',') WHEN '4-NOT SPECIFIED' THEN '$' || f || ' to $' || g
  ELSE f END AS price FROM src)"""

ITEMS = """src AS (SELECT *, p_partkey::VARCHAR AS k, format('{:,.2f}', p_retailprice) AS g,
  format('{:.2f}', p_retailprice) AS f FROM part),
it AS (SELECT p_partkey AS id,
  CASE p_type WHEN 'ECONOMY' THEN 'SALE: ' || p_name || '  20% off' WHEN 'STANDARD' THEN 'New ' || p_name || ' Model: X-' || k
    WHEN 'MEDIUM' THEN 'Samsung ' || p_name || ' version 2' WHEN 'LARGE' THEN 'LG and Apple' || chr(9) || p_name || ' free shipping!'
    WHEN 'SMALL' THEN p_name || ' $5 off, limited time' WHEN 'PROMO' THEN 'Great ' || p_name || ' video card ®' END AS name,
  CASE WHEN p_size <= 10 THEN '$' || g WHEN p_size <= 20 THEN '£' || f WHEN p_size <= 30 THEN replace(f, '.', ',') || ' €'
    WHEN p_size <= 40 THEN 'GBP ' || g WHEN p_size <= 45 THEN f ELSE 'Call for price' END AS price,
  CASE WHEN p_size <= 10 THEN 'https://shop.example.com/p/' || k WHEN p_size <= 20 THEN '//shop.example.com/p/' || k
    WHEN p_size <= 30 THEN '/p/' || k WHEN p_size <= 40 THEN 'shop.example.com/p/' || k
    WHEN p_size <= 45 THEN 'http://bad host/' || k ELSE '' END AS link,
  CASE p_type WHEN 'ECONOMY' THEN 'In Stock' WHEN 'STANDARD' THEN 'Unavailable' WHEN 'MEDIUM' THEN ' Sold out '
    WHEN 'LARGE' THEN 'Few left' WHEN 'SMALL' THEN 'Call us' END AS availability,
  CASE p_type WHEN 'ECONOMY' THEN 'Brand New' WHEN 'STANDARD' THEN 'Renewed' WHEN 'MEDIUM' THEN 'Pre-Owned'
    WHEN 'LARGE' THEN 'For parts' WHEN 'SMALL' THEN '?' END AS condition,
  p_brand AS search_term FROM src)"""


def _prices(spark, folder, **columns):
    rows = A.order_prices(spark, folder)
    return rows.select("id", *[c.alias(n) for n, c in columns.items()])


@query(f"""WITH {PRICES} SELECT id, try_cast(regexp_replace(price, '[£$,]', '', 'g') AS DOUBLE) AS value FROM pr""")
def p1_analysis_price(spark, folder):
    return _prices(spark, folder, value=P.analysis_price(F.col("price")))


@query(f"""WITH {PRICES} SELECT id, try_cast(trim(regexp_replace(price, '[$,]', '', 'g')) AS DOUBLE) AS value FROM pr""")
def p2_ingest_price(spark, folder):
    return _prices(spark, folder, value=P.ingest_price(F.col("price")))


@query(f"""WITH {PRICES} SELECT id, CASE WHEN total > 100000 THEN total
ELSE try_cast(regexp_replace(price, '[^0-9.]', '', 'g') AS DOUBLE) END AS value FROM pr""")
def p3_model_price(spark, folder):
    known = F.when(F.col("total") > 100000, F.col("total")).otherwise(0.0)
    return _prices(spark, folder, value=P.model_price(F.col("price"), known))


@query(f"""WITH {PRICES}, c AS (SELECT id, regexp_replace(price, '[^0-9.,]', '', 'g') AS t FROM pr)
SELECT id, try_cast(CASE WHEN contains(t, ',') AND contains(t, '.') THEN replace(t, ',', '')
  WHEN len(string_split(t, ',')) = 2 AND length(split_part(t, ',', 2)) <= 2 THEN replace(t, ',', '.')
  ELSE replace(t, ',', '') END AS DOUBLE) AS value FROM c""")
def p4_localized_price(spark, folder):
    return _prices(spark, folder, value=P.localized_price(F.col("price")))


@query(f"""WITH {PRICES} SELECT id, coalesce(try_cast(regexp_replace(price, '[^0-9.]', '', 'g') AS DOUBLE), 0.0) AS value FROM pr""")
def p5_page_price(spark, folder):
    return _prices(spark, folder, value=P.page_price(F.col("price")))


@query(f"""WITH {PRICES} SELECT id, try_cast(regexp_replace(price, '[^0-9.]', '', 'g') AS DOUBLE) AS value FROM pr""")
def p6_result_price(spark, folder):
    return _prices(spark, folder, value=P.result_price(F.col("price")))


CURRENCY = """CASE WHEN contains(price, '$') THEN 'USD' WHEN contains(price, '€') THEN 'EUR'
WHEN contains(price, '£') THEN 'GBP' WHEN contains(lower(price), 'eur') THEN 'EUR'
WHEN contains(lower(price), 'gbp') THEN 'GBP' ELSE 'USD' END"""


@query(f"WITH {PRICES} SELECT id, {CURRENCY} AS currency FROM pr")
def p7_currency(spark, folder):
    return _prices(spark, folder, currency=P.currency_of(F.col("price")))


LOCAL = """try_cast(CASE WHEN contains(t, ',') AND contains(t, '.') THEN replace(t, ',', '')
  WHEN len(string_split(t, ',')) = 2 AND length(split_part(t, ',', 2)) <= 2 THEN replace(t, ',', '.')
  ELSE replace(t, ',', '') END AS DOUBLE)"""


@query(f"""WITH {ITEMS}, c AS (SELECT *, regexp_replace(price, '[^0-9.,]', '', 'g') AS t FROM it)
SELECT id, {CURRENCY} AS currency, {LOCAL} AS price_numeric FROM c""")
def p8_normalized_price(spark, folder):
    return normalize_price(A.raw_items(spark, folder)).select("id", "currency", "price_numeric")


# Parts with a price that is a number: none, zero, a very large, a very small and a plain one.
NUMBERS = """nu AS (SELECT p_partkey AS id, p_name AS name, CASE WHEN p_size % 2 = 0 THEN 'http://shop.example.com/' || p_partkey END AS link,
  CASE p_size % 5 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 12345678.0::DOUBLE + p_partkey WHEN 2 THEN 0.0001::DOUBLE
    WHEN 3 THEN p_retailprice::DOUBLE END AS price FROM part)"""


def _numbers(spark, folder):
    size = F.col("p_size") % 5
    price = (
        F.when(size == 0, F.lit(0.0)).when(size == 1, F.col("p_partkey") + F.lit(12345678.0)).when(size == 2, F.lit(0.0001))
        .when(size == 3, F.col("p_retailprice").cast("double"))
    )
    link = F.concat(F.lit("http://shop.example.com/"), F.col("p_partkey").cast("string"))
    return A.table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.when(F.col("p_size") % 2 == 0, link).alias("link"), price.alias("price"),
    )


@query(f"""WITH {NUMBERS} SELECT id, CASE WHEN price <> 0 THEN 'USD' END AS currency, nullif(price, 0) AS price_numeric FROM nu""")
def p8_numeric_price(spark, folder):
    return normalize_price(_numbers(spark, folder)).select("id", "currency", "price_numeric")


@query(f"""WITH {NUMBERS} SELECT id, CASE WHEN id % 3 = 0 THEN 5.0::DOUBLE WHEN price <> 0 THEN price ELSE 0.0::DOUBLE END AS value FROM nu""")
def p3_numeric_price(spark, folder):
    known = F.when(F.col("id") % 3 == 0, 5.0).otherwise(0.0)
    return _numbers(spark, folder).select("id", P.model_price(F.col("price"), known, "double").alias("value"))


@query(f"""WITH {NUMBERS} SELECT * FROM nu WHERE name <> '' AND (link <> '' OR price <> 0)""")
def f2_numeric_prices(spark, folder):
    return _numbers(spark, folder).where(minimum_valid("double"))


@query(f"""WITH {NUMBERS} SELECT *, coalesce(name <> '' AND price <> 0 AND link <> '', false) AS ok_required_fields,
coalesce(price BETWEEN 0.01 AND 100000, false) AS ok_price_range FROM nu""")
def v1_numeric_prices(spark, folder):
    return Validator().verdicts(_numbers(spark, folder), ["required_fields", "price_range"]).drop("first_failed_rule")


@query(f"""WITH {NUMBERS} SELECT *, nullif(price, 0) AS price_numeric, CASE WHEN price <> 0 THEN 'USD' END AS currency
FROM nu WHERE name <> '' AND (link <> '' OR price <> 0)""")
def v7_numeric_prices(spark, folder):
    return Cleaner().run(_numbers(spark, folder), ["normalize_price", "validate_url"])


@query(f"""WITH {NUMBERS} SELECT id, name, price::VARCHAR AS shown FROM nu""")
def pr2_numeric_extras(spark, folder):
    """Numbers among the extras are written in plain decimals."""
    rows = _numbers(spark, folder).withColumnRenamed("price", "weight")
    return select.fold_extras(rows).select(
        F.col("extra_attributes")["id"].cast("long").alias("id"), "name", F.col("extra_attributes")["weight"].alias("shown")
    )


WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


@query(rf"""SELECT doc_id, nullif(regexp_replace(trim(regexp_replace(text, '{WS}+', ' ', 'g')),
'[^\p{{L}}\p{{N}}_ \-.,!?()]', '', 'g'), '') AS cleaned FROM documents""")
def xt1_clean_text(spark, folder):
    return A.table(spark, folder, "documents").select("doc_id", X.clean_text(F.col("text")).alias("cleaned"))


@query(rf"""SELECT doc_id, trim(regexp_replace(text, '{WS}+', ' ', 'g')) AS cleaned FROM documents""")
def xt2_sanitize_text(spark, folder):
    return A.table(spark, folder, "documents").select("doc_id", X.sanitize_text(F.col("text")).alias("cleaned"))


# The SQL side of the promotion, model and address patterns.
PROMO = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0},
 '(?i)\b(new|sale|discount|offer|deal|free shipping)\b', '', 'g'), '(?i)\d+%\s*off', '', 'g'),
 '(?i)\$?\d+\s*off', '', 'g'), '(?i)\b(limited time|while supplies last)\b', '', 'g'), '\s+', ' ', 'g'))"""


@query(f"WITH {ITEMS} SELECT id, {PROMO.format('name')} AS cleaned FROM it")
def xt3_clean_name(spark, folder):
    return A.raw_items(spark, folder).select("id", X.clean_product_name(F.col("name")).alias("cleaned"))


MODEL = r"nullif(regexp_extract({0}, '(?i)\b(model|version|v\.?)\s*[:.]?\s*([a-zA-Z0-9\-]+)', 2), '')"


@query(f"WITH {ITEMS} SELECT id, {MODEL.format(PROMO.format('name'))} AS model FROM it")
def xt4_model(spark, folder):
    cleaned = X.clean_product_name(F.col("name"))
    return A.raw_items(spark, folder).select("id", X.model_of(cleaned).alias("model"))


@query(r"""SELECT doc_id, nullif(regexp_extract(text,
'(?i)(?:^|[^\p{L}\p{M}\p{N}_])(model|version|v\.?)\s*[:.]?\s*([a-zA-Z0-9\-]+)', 2), '') AS model FROM documents""")
def xt4_model_in_documents(spark, folder):
    return A.table(spark, folder, "documents").select("doc_id", X.model_of(F.col("text")).alias("model"))


# Fixed values of the SQL side, written out so that a slip in the library's lists shows.
BRAND_NAMES = (
    "Apple", "Samsung", "Google", "Microsoft", "Amazon", "Sony", "Lg", "Dell", "Hp", "Lenovo", "Acer", "Asus", "Nvidia",
    "Amd", "Intel",
)
STOCK_WORDS = {
    "in_stock": ("in stock", "available", "ready"),
    "out_of_stock": ("out of stock", "unavailable", "sold out"),
    "limited_stock": ("limited", "few left", "low stock"),
}
CONDITION_WORDS = {
    "new": ("new", "brand new", "factory sealed"),
    "used": ("used", "pre-owned", "second hand"),
    "refurbished": ("refurbished", "renewed", "reconditioned"),
    "damaged": ("damaged", "broken", "parts"),
}


def _brand_sql(text: str) -> str:
    cases = " ".join(f"WHEN contains(lower({text}), '{b.lower()}') THEN '{b}'" for b in BRAND_NAMES)
    return f"CASE {cases} END"


@query(f"WITH {ITEMS} SELECT id, {_brand_sql('name')} AS brand FROM it")
def xt5_brand(spark, folder):
    return A.raw_items(spark, folder).select("id", X.brand_of(F.col("name")).alias("brand"))


@query(f"SELECT doc_id, {_brand_sql('text')} AS brand FROM documents")
def xt5_brand_in_documents(spark, folder):
    return A.table(spark, folder, "documents").select("doc_id", X.brand_of(F.col("text")).alias("brand"))


def _label_sql(column: str, table: dict[str, tuple[str, ...]], order: list[str]) -> str:
    cases = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({column}), '{t}')" for t in table[k]) + f" THEN '{k}'"
        for k in order
    )
    return f"CASE WHEN coalesce({column}, '') = '' THEN NULL {cases} ELSE 'unknown' END"


@query(f"""WITH {ITEMS} SELECT id, {_label_sql('availability', STOCK_WORDS, list(STOCK_WORDS))} AS status,
{_label_sql('availability', STOCK_WORDS, ['out_of_stock', 'limited_stock', 'in_stock'])} AS strict_status FROM it""")
def xt6_availability(spark, folder):
    c = F.col("availability")
    return A.raw_items(spark, folder).select(
        "id", X.availability_status(c).alias("status"), X.availability_status(c, strict=True).alias("strict_status")
    )


@query(f"""WITH {ITEMS} SELECT id, {_label_sql('condition', CONDITION_WORDS, list(CONDITION_WORDS))} AS condition,
{_label_sql('condition', CONDITION_WORDS, ['refurbished', 'used', 'damaged', 'new'])} AS strict_condition FROM it""")
def xt7_condition(spark, folder):
    c = F.col("condition")
    return A.raw_items(spark, folder).select(
        "id", X.condition_standard(c).alias("condition"),
        X.condition_standard(c, strict=True).alias("strict_condition"),
    )


URL_OK = (
    r"(?i)^https?://(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+[A-Z]{2,6}\.?|localhost|"
    r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?::\d+)?(?:/?|[/?]\S+)$"
)
FULL_URL = """CASE WHEN link LIKE 'http://%' OR link LIKE 'https://%' THEN link WHEN link LIKE '//%' THEN 'https:' || link
WHEN link LIKE '/%' THEN NULL ELSE 'https://' || link END"""


@query(f"""WITH {ITEMS}, u AS (SELECT id, link, {FULL_URL} AS f FROM it)
SELECT id, CASE WHEN link = '' THEN '' WHEN regexp_matches(f, '{URL_OK}') THEN f END AS link FROM u""")
def xt8_validate_url(spark, folder):
    return A.raw_items(spark, folder).select("id", U.validate_url(F.col("link")).alias("link"))


@query(f"""SELECT page_id, CASE WHEN regexp_matches(url, '{URL_OK}') THEN url END AS link FROM pages""")
def xt8_validate_page_urls(spark, folder):
    return A.pages(spark, folder).select("page_id", U.validate_url(F.col("url")).alias("link"))


@query("""WITH h AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<li><a href="/([^"]*)"', 1)) AS tail FROM pages),
r AS (SELECT *, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS root,
  regexp_extract(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*(.*/)', 1) AS folder,
  regexp_extract(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*(.*/)[^/]+/[^/]*$', 1) AS parent FROM h)
SELECT page_id, tail, root || '/' || tail AS from_root,
  root || coalesce(nullif(folder, ''), '/') || tail AS from_folder,
  root || coalesce(nullif(parent, ''), '/') || tail AS from_parent,
  regexp_extract(url, '^([a-z]+:)', 1) || '//cdn.example.com/' || tail AS from_scheme FROM r""")
def xt9_absolute_url(spark, folder):
    tail = F.regexp_extract_all("html", F.lit('<li><a href="/([^"]*)"'), 1)
    rows = A.pages(spark, folder).select("page_id", "url", F.explode(tail).alias("tail"))
    base, t = F.col("url"), F.col("tail")

    def resolved(prefix: str):
        return U.absolute_url(base, F.concat(F.lit(prefix), t))

    return rows.select(
        "page_id", "tail",
        resolved("/").alias("from_root"),
        resolved("./").alias("from_folder"),
        resolved("../").alias("from_parent"),
        resolved("//cdn.example.com/").alias("from_scheme"),
    )


@query("""SELECT page_id, coalesce(nullif(trim(regexp_extract(html, '<h9>([^<]*)</h9>', 1)), ''),
nullif(trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)), ''),
nullif(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '')) AS heading FROM pages""")
def xt10_first_filled(spark, folder):
    patterns = ["<h9>([^<]*)</h9>", "<h1>([^<]*)</h1>", "<title>([^<]*)</title>"]
    found = [F.regexp_extract("html", p, 1) for p in patterns]
    return A.pages(spark, folder).select("page_id", X.first_filled(*found).alias("heading"))


@query("""SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS spaced,
strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS iso, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S.%f') AS day_only,
NULL::VARCHAR AS broken FROM events""")
def xd1_parse_time(spark, folder):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    forms = {
        "spaced": text,
        "iso": F.replace(text, F.lit(" "), F.lit("T")),
        "day_only": F.substring(text, 1, 10),
        "broken": F.concat(F.lit("on "), text),
    }
    return A.table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        *[F.date_format(D.parse_time(c), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(n) for n, c in forms.items()],
    )


@query("""SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS day, hour(ts)::INT AS hour, dayname(ts) AS weekday FROM events""")
def xd2_date_parts(spark, folder):
    return A.table(spark, folder, "events").select(
        F.col("event_id").alias("id"), D.day_text(F.col("ts")).alias("day"),
        F.hour("ts").alias("hour"), D.weekday_name(F.col("ts")).alias("weekday"),
    )


@query("""SELECT event_id AS id, CASE WHEN event_type = 'error' THEN '2024-02-01T00:00:00' ELSE strftime(ts, '%Y-%m-%d') END
AS scrape_time FROM events""")
def xd3_default_time(spark, folder):
    kind = F.col("event_type")
    known = F.when(kind != "error", D.day_text(F.col("ts"))).otherwise(F.lit(""))
    return A.table(spark, folder, "events").select(
        F.col("event_id").alias("id"), D.time_or_default(known, "2024-02-01T00:00:00").alias("scrape_time")
    )


@query(f"""WITH {SHOP} SELECT round(((name IS NOT NULL)::INT + (price_numeric IS NOT NULL)::INT + (link IS NOT NULL)::INT
 + (image IS NOT NULL)::INT + (availability IS NOT NULL)::INT) / 7.0::DOUBLE, 6) AS score, count(*) AS listings FROM sh GROUP BY 1""")
def xm1_quality_score(spark, folder):
    rows = shop(spark, folder)
    score = F.round(X.quality_score(rows.columns), 6).alias("score")
    return rows.groupBy(score).agg(F.count("*").alias("listings"))


@query(f"""WITH {EV} SELECT search_term, round(avg(price_numeric), 1) AS one_digit, round(avg(price_numeric), 2) AS two_digits
FROM ev GROUP BY 1""")
def xm2_report_rounding(spark, folder):
    p = F.avg("price_numeric")
    return events(spark, folder).groupBy("search_term").agg(
        F.round(p, 1).alias("one_digit"), F.round(p, 2).alias("two_digits")
    )


@query("""SELECT event_id AS id, json_extract_string(props, '$.k') AS k, 1 AS keys,
'{"event_type":"' || event_type || '","k":"' || json_extract_string(props, '$.k') || '"}' AS as_json FROM events""")
def xj1_map_and_json(spark, folder):
    props = F.from_json("props", "map<string,string>")
    rows = A.table(spark, folder, "events").select(F.col("event_id").alias("id"), "event_type", props.alias("m"))
    return rows.select(
        "id", F.col("m")["k"].alias("k"), F.size(F.map_keys("m")).alias("keys"),
        F.to_json(F.struct("event_type", F.col("m")["k"].alias("k"))).alias("as_json"),
    )


RULES = ["required_fields", "price_range", "url_format", "text_length", "duplicate_check"]
RULE_SQL = f"""ok AS (SELECT id, coalesce(name, '') <> '' AND price <> '' AND coalesce(link, '') <> '' AS ok_required_fields,
  coalesce(try_cast(price AS DOUBLE) BETWEEN 0.01 AND 100000, false) AS ok_price_range,
  link LIKE 'http://%' OR link LIKE 'https://%' AS ok_url_format, true AS ok_text_length, true AS ok_duplicate_check FROM it)"""


@query(f"""WITH {ITEMS}, {RULE_SQL} SELECT *, CASE WHEN NOT ok_required_fields THEN 'required_fields'
WHEN NOT ok_price_range THEN 'price_range' WHEN NOT ok_url_format THEN 'url_format' END AS first_failed_rule FROM ok""")
def v1_v5_rule_verdicts(spark, folder):
    rows = Validator().verdicts(A.raw_items(spark, folder), RULES)
    return rows.select("id", *[f"ok_{r}" for r in RULES], "first_failed_rule")


@query("SELECT doc_id, length(text) <= 500 AS ok FROM documents")
def v4_text_length(spark, folder):
    rows = A.table(spark, folder, "documents").withColumnRenamed("text", "name")
    return Validator().verdicts(rows, ["text_length"]).select("doc_id", F.col("ok_text_length").alias("ok"))


@query(f"""WITH {ITEMS} SELECT name, search_term, min(id) AS id FROM it GROUP BY 1, 2""")
def v5_unique_rows(spark, folder):
    rows = A.raw_items(spark, folder).select("id", "name", "search_term")
    return Validator().keep(rows, ["duplicate_check"], unique=True)


@query(f"""WITH {ITEMS} SELECT id FROM it WHERE coalesce(name, '') <> '' AND price <> '' AND coalesce(link, '') <> ''
AND (link LIKE 'http://%' OR link LIKE 'https://%')""")
def v6_valid_rows(spark, folder):
    kept = Validator().keep(A.raw_items(spark, folder), ["required_fields", "nosuch", "url_format"])
    return kept.select("id")


@query(f"""WITH {ITEMS}, {RULE_SQL} SELECT id, CASE WHEN NOT ok_required_fields THEN 'required_fields'
ELSE 'url_format' END AS first_failed_rule FROM ok WHERE NOT ok_required_fields OR NOT ok_url_format""")
def v6_rejected_rows(spark, folder):
    rows = Validator().rejects(A.raw_items(spark, folder), ["required_fields", "url_format"])
    return rows.select("id", "first_failed_rule")


CHAIN = [
    "clean_product_name", "normalize_price", "validate_url", "no_such_step", "normalize_availability",
    "extract_brand", "standardize_condition",
]


@query(f"""WITH {ITEMS}, c AS (SELECT *, {PROMO.format('name')} AS n, regexp_replace(price, '[^0-9.,]', '', 'g') AS t,
  {FULL_URL} AS f FROM it),
d AS (SELECT id, n AS name, {LOCAL} AS price_numeric, {CURRENCY} AS currency, {MODEL.format('n')} AS model,
  CASE WHEN link = '' THEN '' WHEN regexp_matches(f, '{URL_OK}') THEN f END AS link,
  {_label_sql('availability', STOCK_WORDS, list(STOCK_WORDS))} AS availability_status, {_brand_sql('n')} AS brand,
  {_label_sql('condition', CONDITION_WORDS, list(CONDITION_WORDS))} AS condition_standard FROM c)
SELECT * FROM d WHERE name <> ''""")
def v7_cleaning_chain(spark, folder):
    rows = Cleaner().run(A.raw_items(spark, folder), CHAIN)
    return rows.drop("price", "availability", "condition", "search_term")


@query(f"""WITH {ITEMS} SELECT id, CASE WHEN regexp_matches(name, '[a-z]') THEN upper(name) ELSE name END AS name FROM it""")
def g1_user_step(spark, folder):
    """A step that the user registers runs like a built-in one."""
    cleaner = Cleaner()
    cleaner.register("shout", lambda df: df.withColumn("name", F.upper("name")))
    return cleaner.run(A.raw_items(spark, folder), ["shout"]).select("id", "name")


@query(f"""WITH {ITEMS} SELECT id, price FROM it WHERE price LIKE '$%'""")
def g2_user_rule(spark, folder):
    """A rule that the user registers runs like a built-in one."""
    validator = Validator()
    validator.register("dollars", lambda: F.col("price").startswith("$"))
    return validator.keep(A.raw_items(spark, folder), ["dollars"]).select("id", "price")


SHARES = """q AS (SELECT count(*) AS n, count(name) * 100.0::DOUBLE / count(*) AS a, count(price_numeric) * 100.0::DOUBLE / count(*) AS b,
  count(link) * 100.0::DOUBLE / count(*) AS c, count(availability) * 100.0::DOUBLE / count(*) AS d,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT name, search_term FROM sh)) AS dup,
  count(*) FILTER (WHERE price_numeric > 0) * 100.0::DOUBLE / count(*) AS v FROM sh)"""


@query(f"""WITH {SHOP}, {SHARES} SELECT n AS total_records, least(a, b, c, d) >= 80 AS completeness_ok, dup <= 10 AS duplicates_ok,
v >= 70 AS prices_ok, least(a, b, c, d) >= 80 AND dup <= 10 AND v >= 70 AS passed FROM q""")
def v8_quality_gate(spark, folder):
    return quality.quality_gate(quality.quality_row(shop(spark, folder)))


@query(f"""WITH {SHOP}, {SHARES}, f AS (SELECT 'name' AS field, a AS x, 90 AS lim, 'Excellent' AS good FROM q
  UNION ALL SELECT 'price', b, 80, 'Good' FROM q UNION ALL SELECT 'link', c, 90, 'Excellent' FROM q)
SELECT field, round(x, 6) AS completeness, CASE WHEN x >= lim THEN good ELSE 'Needs Improvement' END AS status FROM f""")
def v9_field_labels(spark, folder):
    return rounded(quality.field_labels(quality.quality_row(shop(spark, folder))))
