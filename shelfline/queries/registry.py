"""Registration of queries, and the SQL views of the test tables as listings."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Events as listings, after the name filter of the analysis scan.
EV = """ev AS (
  SELECT event_id AS id, 'user-' || user_id AS name,
         CASE WHEN value >= 1.0 THEN value END AS price_numeric,
         event_type AS search_term, ts AS scrape_time, ts::DATE AS scrape_date,
         hour(ts)::INT AS scrape_hour
  FROM events WHERE user_id <> 0)"""

# Order lines as listings, before the name filter.
RAW_SHOP = """raw AS (
  SELECT CASE WHEN p_size < 50 THEN p_name END AS name,
         CASE WHEN l_discount < 0.1 THEN l_extendedprice END AS price,
         CASE WHEN NOT (l_returnflag = 'N' AND l_linestatus = 'F')
              THEN 'http://shop.example.com/' || l_partkey || '/' || l_suppkey END AS link,
         'http://shop.example.com/img/' || l_partkey || '.jpg' AS image,
         CASE l_returnflag WHEN 'A' THEN 'In Stock' WHEN 'R' THEN 'Out of Stock' END AS availability,
         nullif(p_type, 'PROMO') AS search_term, nullif(p_brand, 'Brand#25') AS source,
         l_shipdate AS scrape_time, l_orderkey AS job_id
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

SHOP = RAW_SHOP + """,
sh AS (SELECT *, price AS price_numeric FROM raw WHERE name IS NOT NULL)"""

JOBS = """jobs AS (
  SELECT o_orderkey AS job_id, o_orderpriority AS search_term,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'running' END AS status,
         o_orderdate AS created_at
  FROM orders)"""

JOB_LOG = """shipped AS (SELECT l_orderkey AS k, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1),
folded AS (
  SELECT o_orderkey AS job_id, o_orderpriority AS search_term,
         CASE WHEN o_orderstatus = 'O' THEN 'pending'
              WHEN o_orderstatus = 'F' AND coalesce(shipped, o_orderdate) IS NOT NULL THEN 'completed'
              ELSE 'running' END AS status,
         o_orderdate AS created_at,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 1 DAY END AS started_at,
         CASE WHEN o_orderstatus = 'F' THEN greatest(shipped, o_orderdate + INTERVAL 1 DAY) END AS completed_at
  FROM orders LEFT JOIN shipped ON k = o_orderkey)"""


def query(sql: str | None = None):
    """Register a function ``(spark, folder) -> DataFrame`` under its own name."""

    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, folder)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, for comparison between engines that sum in another order."""
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def stamps(df: DataFrame, *columns: str) -> DataFrame:
    """Times as text to the second."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


def days(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as text."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})
