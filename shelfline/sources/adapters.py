"""The star-schema and event tables seen as listings, jobs and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHOP = "http://shop.example.com/"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_listings(spark: SparkSession, folder: str) -> DataFrame:
    """Events as listings.

    User 0 is anonymous and has no name, a value below 1 is no price, and errors have no
    availability.
    """
    user, value = F.col("user_id"), F.col("value")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.when(user != 0, F.concat(F.lit("user-"), user.cast("string"))).alias("name"),
        F.when(value >= 1.0, value).alias("price"),
        F.concat(F.lit(SHOP + "e/"), F.col("event_id").cast("string")).alias("link"),
        F.when(F.col("event_type") != "error", "In Stock").alias("availability"),
        F.col("event_type").alias("search_term"),
        F.col("ts").cast("timestamp").alias("scrape_time"),
    )


def shop_listings(spark: SparkSession, folder: str, price_text: bool = False) -> DataFrame:
    """Order lines as listings of their parts.

    Lines sold at the full discount of 0.1 show no price, returned-and-open lines (N, F) no
    link, not-returned lines no availability, and parts of the largest size no name. PROMO
    parts have no search term and parts of Brand#25 no source.
    """
    lines = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    address = F.concat(
        F.lit(SHOP), F.col("l_partkey").cast("string"), F.lit("/"), F.col("l_suppkey").cast("string")
    )
    shown = F.col("l_discount") < 0.1
    if price_text:
        price = F.when(shown, F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))).otherwise(
            "Call for price"
        )
    else:
        price = F.when(shown, F.col("l_extendedprice"))
    flag = F.col("l_returnflag")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.when(F.col("p_size") < 50, F.col("p_name")).alias("name"),
        price.alias("price"),
        F.when(~((flag == "N") & (F.col("l_linestatus") == "F")), address).alias("link"),
        F.concat(F.lit(SHOP + "img/"), F.col("l_partkey").cast("string"), F.lit(".jpg")).alias("image"),
        F.when(flag == "A", "In Stock").when(flag == "R", "Out of Stock").alias("availability"),
        F.nullif(F.col("p_type"), F.lit("PROMO")).alias("search_term"),
        F.nullif(F.col("p_brand"), F.lit("Brand#25")).alias("source"),
        F.col("l_shipdate").cast("timestamp").alias("scrape_time"),
        F.col("l_orderkey").alias("job_id"),
    )


def jobs(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as jobs."""
    state = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("job_id"),
        F.col("o_orderpriority").alias("search_term"),
        F.when(state == "F", "completed").when(state == "O", "pending").otherwise("running").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def job_events(spark: SparkSession, folder: str) -> DataFrame:
    """A log of job states: orders are queued, may start a day later, and end when shipped."""
    orders = table(spark, folder, "orders")
    shipped = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("shipped"))
    )
    state = F.col("o_orderstatus")
    queued = F.col("o_orderdate").cast("timestamp")
    started = F.when(state != "O", queued + F.expr("INTERVAL 1 DAY"))
    ended = F.when(state == "F", F.greatest(F.col("shipped").cast("timestamp"), started))

    def entry(status: str, at):
        return F.struct(F.lit(status).alias("status"), at.alias("event_time"))

    log = F.array(entry("pending", queued), entry("running", started), entry("completed", ended))
    return (
        orders.join(shipped, "o_orderkey", "left")
        .select(
            F.col("o_orderkey").alias("job_id"),
            F.col("o_orderpriority").alias("search_term"),
            F.inline(log),
        )
        .where("event_time IS NOT NULL")
        .withColumn("message", F.lit(None).cast("string"))
    )


def order_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Raw price texts: every order total in one of several notations."""
    total = F.format_number("o_totalprice", 2)
    plain = F.format_string("%.2f", "o_totalprice")
    kind = F.col("o_orderpriority")
    text = (
        F.when(kind == "1-URGENT", F.concat(F.lit("$"), total))
        .when(kind == "2-HIGH", F.concat(F.lit("£"), total))
        .when(kind == "3-MEDIUM", F.concat(F.lit("EUR "), F.replace(plain, F.lit("."), F.lit(","))))
        .when(kind == "4-NOT SPECIFIED", F.concat(F.lit("$"), plain, F.lit(" to $"), total))
        .otherwise(plain)
    )
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), text.alias("price"), F.col("o_totalprice").alias("total")
    )


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", "url", "html")


def raw_items(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as freshly collected items, in the notations collectors meet.

    The part type picks the wording of the name, availability and condition; the size band
    picks the notation of the price and the link.
    """
    key = F.col("p_partkey").cast("string")
    size = F.col("p_size")
    cents = F.format_number("p_retailprice", 2)
    plain = F.format_string("%.2f", "p_retailprice")
    kind = F.col("p_type")

    def by_type(values: dict):
        chain = F.lit(None).cast("string")
        for k, v in values.items():
            chain = F.when(kind == k, v if not isinstance(v, str) else F.lit(v)).otherwise(chain)
        return chain

    name = by_type(
        {
            "ECONOMY": F.concat(F.lit("SALE: "), F.col("p_name"), F.lit("  20% off")),
            "STANDARD": F.concat(F.lit("New "), F.col("p_name"), F.lit(" Model: X-"), key),
            "MEDIUM": F.concat(F.lit("Samsung "), F.col("p_name"), F.lit(" version 2")),
            "LARGE": F.concat(F.lit("LG and Apple\t"), F.col("p_name"), F.lit(" free shipping!")),
            "SMALL": F.concat(F.col("p_name"), F.lit(" $5 off, limited time")),
            "PROMO": F.concat(F.lit("Great "), F.col("p_name"), F.lit(" video card ®")),
        }
    )
    price = (
        F.when(size <= 10, F.concat(F.lit("$"), cents))
        .when(size <= 20, F.concat(F.lit("£"), plain))
        .when(size <= 30, F.concat(F.replace(plain, F.lit("."), F.lit(",")), F.lit(" €")))
        .when(size <= 40, F.concat(F.lit("GBP "), cents))
        .when(size <= 45, plain)
        .otherwise("Call for price")
    )
    link = (
        F.when(size <= 10, F.concat(F.lit("https://shop.example.com/p/"), key))
        .when(size <= 20, F.concat(F.lit("//shop.example.com/p/"), key))
        .when(size <= 30, F.concat(F.lit("/p/"), key))
        .when(size <= 40, F.concat(F.lit("shop.example.com/p/"), key))
        .when(size <= 45, F.concat(F.lit("http://bad host/"), key))
        .otherwise("")
    )
    availability = by_type(
        {
            "ECONOMY": "In Stock", "STANDARD": "Unavailable", "MEDIUM": " Sold out ",
            "LARGE": "Few left", "SMALL": "Call us",
        }
    )
    condition = by_type(
        {
            "ECONOMY": "Brand New", "STANDARD": "Renewed", "MEDIUM": "Pre-Owned",
            "LARGE": "For parts", "SMALL": "?",
        }
    )
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        name.alias("name"),
        price.alias("price"),
        link.alias("link"),
        availability.alias("availability"),
        condition.alias("condition"),
        F.col("p_brand").alias("search_term"),
    )
