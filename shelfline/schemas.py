"""Column sets and schemas of the listing model."""

from __future__ import annotations

from pyspark.sql import types as T

# The named fields of a listing, in order. Anything else is an extra.
LISTING_FIELDS = [
    "name", "price", "price_numeric", "link", "image", "availability", "description",
    "rating", "reviews_count", "category", "brand", "model", "condition", "shipping_cost",
    "seller", "source", "search_term", "scrape_time", "page_number", "position_on_page",
]

# The stored columns of a listing, without its key and job.
STORED_FIELDS = [
    "name", "price", "link", "image", "availability", "scrape_time", "search_term", "source",
]

STORED_LISTING = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("link", T.StringType()),
        T.StructField("image", T.StringType()),
        T.StructField("availability", T.StringType()),
        T.StructField("scrape_time", T.StringType()),
        T.StructField("search_term", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("job_id", T.LongType()),
    ]
)

COLLECTED_ITEM = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("link", T.StringType()),
        T.StructField("search_term", T.StringType()),
        T.StructField("scrape_time", T.StringType()),
        T.StructField("availability", T.StringType()),
        T.StructField("rating", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

JOB_EVENT = T.StructType(
    [
        T.StructField("job_id", T.LongType()),
        T.StructField("search_term", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("message", T.StringType()),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

# Job states.
JOB_STATES = ["pending", "running", "completed", "failed", "cancelled"]

# The sources a listing may come from.
LISTING_SOURCES = ["BooksToScrape", "eBay", "Amazon", "Custom"]
