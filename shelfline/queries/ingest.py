"""Ingest, jobs, retention and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import ingest, jobs, links
from shelfline.queries.registry import JOB_LOG, JOBS, RAW_SHOP, query, rounded, stamps
from shelfline.session import materialise, scratch_dir
from shelfline.sources import adapters as A
from shelfline.streaming import arrivals, hours, seen

ORDERS = """co AS (SELECT 'order of customer ' || o_custkey AS name, o_totalprice AS price,
  'http://shop.example.com/c/' || o_custkey AS link, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS scrape_time,
  o_orderpriority AS search_term, o_orderkey AS job_id FROM orders)"""


def _orders(df):
    """Orders as collected rows; a customer's orders share a link."""
    customer = F.col("o_custkey").cast("string")
    return df.select(
        F.concat(F.lit("order of customer "), customer).alias("name"),
        F.col("o_totalprice").alias("price"),
        F.concat(F.lit("http://shop.example.com/c/"), customer).alias("link"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("scrape_time"),
        F.col("o_orderpriority").alias("search_term"),
        F.col("o_orderkey").alias("job_id"),
    )


@query(f"""WITH {RAW_SHOP} SELECT name, price, link, image, availability,
strftime(scrape_time, '%Y-%m-%d %H:%M:%S') AS scrape_time, search_term, source, 7::BIGINT AS job_id FROM raw""")
def i1_rows_to_store(spark, folder):
    rows = A.shop_listings(spark, folder, price_text=True).drop("job_id")
    return ingest.to_stored(stamps(rows, "scrape_time"), job_id=7)


@query(f"""WITH {RAW_SHOP} SELECT name, price, link, strftime(scrape_time, '%Y-%m-%d %H:%M:%S') AS scrape_time, job_id FROM raw
QUALIFY link IS NULL OR row_number() OVER (PARTITION BY link ORDER BY raw.scrape_time, job_id, name NULLS FIRST, price NULLS FIRST) = 1""")
def i2_first_per_link(spark, folder):
    rows = A.shop_listings(spark, folder).select("name", "price", "link", "scrape_time", "job_id")
    return stamps(ingest.first_per_link(rows, ["scrape_time", "job_id", "name", "price"]), "scrape_time")


@query("""SELECT p_name AS name, p_retailprice AS price, NULL::VARCHAR AS link, NULL::VARCHAR AS image,
NULL::VARCHAR AS availability, NULL::VARCHAR AS scrape_time, p_type AS search_term, NULL::VARCHAR AS source,
NULL::BIGINT AS job_id FROM part""")
def i3_missing_columns(spark, folder):
    rows = A.table(spark, folder, "part").select(
        F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"), F.col("p_type").alias("search_term")
    )
    return ingest.with_missing_columns(rows)


TWO_BATCHES = f"""WITH {ORDERS}, b AS (SELECT *, CASE WHEN scrape_time < '1998' THEN 1 ELSE 2 END AS batch FROM co)
SELECT name, price, link, scrape_time, search_term, {{job}}::BIGINT AS job_id FROM b
QUALIFY row_number() OVER (PARTITION BY link ORDER BY batch, scrape_time, b.job_id::VARCHAR) = 1"""


def _early_and_late(spark, folder):
    # The order's key tells rows of one time apart.
    rows = _orders(A.table(spark, folder, "orders")).withColumn("source", F.col("job_id").cast("string"))
    return rows.where("scrape_time < '1998'"), rows.where("scrape_time >= '1998'")


def _stored(spark, store):
    return ingest.read_store(spark, store).select("name", "price", "link", "scrape_time", "search_term", "job_id")


@query(TWO_BATCHES.format(job="batch"))
def i4_two_batches(spark, folder):
    """Two batches appended to a store, the second one twice: each link is stored once."""
    store = scratch_dir(spark, "store")
    early, late = _early_and_late(spark, folder)
    for job, batch in ((1, early), (2, late), (2, late)):
        ingest.append_batch(batch, store, job, ["scrape_time", "source"], run=str(job))
    return _stored(spark, store)


@query(TWO_BATCHES.format(job="7"))
def i5_two_inserts_of_one_job(spark, folder):
    """A second insert under the same job adds to the first."""
    store = scratch_dir(spark, "store")
    for batch in _early_and_late(spark, folder):
        ingest.append_batch(batch, store, 7, ["scrape_time", "source"])
    return _stored(spark, store)


@query(f"""WITH {ORDERS}, n AS (SELECT name, price, scrape_time, CASE WHEN scrape_time < '1998' THEN link END AS link,
  CASE WHEN scrape_time < '1998' THEN 1 ELSE 2 END AS batch, job_id FROM co)
SELECT name, price, link, scrape_time, NULL::BIGINT AS job_id FROM n
QUALIFY link IS NULL OR row_number() OVER (PARTITION BY link ORDER BY batch, scrape_time, n.job_id::VARCHAR) = 1""")
def i6_inserts_without_job(spark, folder):
    """Inserts that belong to no job; rows without a link are all stored."""
    store = scratch_dir(spark, "store")
    early, late = _early_and_late(spark, folder)
    for batch in (early, late.withColumn("link", F.lit(None).cast("string"))):
        ingest.append_batch(batch.drop("job_id"), store, order=["scrape_time", "source"])
    return _stored(spark, store).drop("search_term")


STAMP_JOB = """SELECT job_id, search_term, status, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at, strftime(completed_at, '%Y-%m-%d %H:%M:%S') AS completed_at"""


def _folded(spark, folder):
    return jobs.latest_jobs(A.job_events(spark, folder))


@query(f"WITH {JOB_LOG} {STAMP_JOB} FROM folded")
def l1_latest_job_state(spark, folder):
    rows = _folded(spark, folder).drop("error_message")
    return stamps(rows, "created_at", "started_at", "completed_at")


@query(f"WITH {JOB_LOG} {STAMP_JOB} FROM folded")
def l8_snapshot_and_tail(spark, folder):
    """A written snapshot of some entries, merged with the rest, early and late ones in both."""
    log = A.job_events(spark, folder)
    early = F.pmod(F.xxhash64("job_id", "status"), F.lit(3)) > 0
    snapshot = materialise(jobs.job_states(log.where(early)), "job-states")
    rows = jobs.latest_jobs(log.where(~early), snapshot).drop("error_message")
    return stamps(rows, "created_at", "started_at", "completed_at")


@query(f"WITH {JOB_LOG} SELECT job_id, search_term FROM folded WHERE status = 'pending'")
def l2_pending_jobs(spark, folder):
    return jobs.pending_jobs(_folded(spark, folder)).select("job_id", "search_term")


@query(f"""WITH {JOB_LOG}, n AS (SELECT l_orderkey AS job_id, count(*) AS n FROM lineitem GROUP BY 1)
SELECT folded.job_id, status, coalesce(n, 0) AS total_products FROM folded LEFT JOIN n ON n.job_id = folded.job_id""")
def l3_job_outcomes(spark, folder):
    lines = A.table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("job_id"))
    return jobs.job_outcomes(_folded(spark, folder), lines).select("job_id", "status", "total_products")


@query(f"""WITH {JOB_LOG} SELECT job_id, epoch(completed_at) - epoch(started_at) AS duration_s FROM folded""")
def l4_job_durations(spark, folder):
    return rounded(jobs.job_durations(_folded(spark, folder)).select("job_id", "duration_s"))


@query(f"""WITH {RAW_SHOP} SELECT CASE WHEN grouping(source) = 1 THEN 'total' ELSE 'source' END AS level, source,
count(*) AS items FROM raw GROUP BY ROLLUP (source)""")
def l5_run_totals(spark, folder):
    return jobs.run_totals(A.shop_listings(spark, folder))


AS_OF = "2024-01-31 00:00:00"


@query(f"""SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS scrape_time FROM events
WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAYS""")
def l6_retained(spark, folder):
    rows = A.event_listings(spark, folder).select("id", "scrape_time")
    return stamps(jobs.retained(rows, AS_OF, days=10), "scrape_time")


@query(f"""SELECT count(*) FILTER (WHERE ts < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAYS) AS removed,
count(*) FILTER (WHERE NOT ts < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAYS) AS kept FROM events""")
def l6_retention_counts(spark, folder):
    return jobs.retention_counts(A.event_listings(spark, folder), AS_OF, days=10)


def _event_rows(spark, folder):
    return stamps(A.event_listings(spark, folder), "scrape_time").drop("id")


@query(f"""SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS scrape_time, 'http://shop.example.com/e/' || event_id AS link,
event_type AS search_term FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAYS""")
def l6_rewritten_store(spark, folder):
    """Every row that retention leaves in a store."""
    store, target = scratch_dir(spark, "listings"), scratch_dir(spark, "retained")
    ingest.append_batch(_event_rows(spark, folder), store)
    jobs.rewrite_retained(spark, store, target, AS_OF, days=10)
    return ingest.read_store(spark, target).select("scrape_time", "link", "search_term")


@query(f"""SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS scrape_time, 'http://shop.example.com/e/' || event_id AS link,
CASE WHEN event_id % 2 = 0 AND ts >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAYS THEN 1 ELSE 2 END::BIGINT AS job_id FROM events""")
def l7_append_after_retention(spark, folder):
    """A store goes on after retention: what was removed may be stored anew, what is left stays."""
    store, target = scratch_dir(spark, "listings"), scratch_dir(spark, "retained")
    rows = _event_rows(spark, folder)
    even = F.regexp_extract("link", "([0-9]+)$", 1).cast("long") % 2 == 0
    ingest.append_batch(rows.where(even), store, 1, run="first")
    jobs.rewrite_retained(spark, store, target, AS_OF, days=10)
    for _ in range(2):
        ingest.append_batch(rows, target, 2, run="second")
    return ingest.read_store(spark, target).select("scrape_time", "link", "job_id")


@query(f"""WITH {JOBS}, p AS (SELECT * FROM jobs WHERE status = 'pending')
SELECT job_id, search_term, (SELECT greatest(count(*) - 5, 0) FROM p)::BIGINT AS remaining FROM p ORDER BY job_id LIMIT 5""")
def t4_next_pending_jobs(spark, folder):
    return jobs.next_pending(A.jobs(spark, folder)).select("job_id", "search_term", "remaining")


@query(f"""WITH {ORDERS} SELECT name, price, link, scrape_time, search_term, job_id FROM co
QUALIFY row_number() OVER (PARTITION BY link ORDER BY co.scrape_time, job_id) = 1""")
def r1_incremental_ingest(spark, folder):
    """Order files as they arrive; the second run finds nothing new."""
    schema = A.table(spark, folder, "orders").schema
    store, checkpoint = scratch_dir(spark, "store"), scratch_dir(spark, "progress")
    for _ in range(2):
        stream = arrivals.arriving(spark, folder, schema, pattern="orders.parquet")
        arrivals.ingest_arrivals(stream, store, checkpoint, _orders, ["scrape_time", "job_id"]).awaitTermination()
    return _stored(spark, store)


@query(f"""WITH {ORDERS} SELECT name, price, link, scrape_time, search_term, job_id FROM co
QUALIFY row_number() OVER (PARTITION BY link ORDER BY (co.scrape_time >= '1998')::INT, co.scrape_time, job_id) = 1""")
def r4_two_streams(spark, folder):
    """Two streams with progress of their own fill one store, one after the other."""
    schema = A.table(spark, folder, "orders").schema
    store = scratch_dir(spark, "store")
    for part in ("scrape_time < '1998'", "scrape_time >= '1998'"):
        stream = arrivals.arriving(spark, folder, schema, pattern="orders.parquet")
        arrivals.ingest_arrivals(
            stream, store, scratch_dir(spark, "progress"), lambda df, p=part: _orders(df).where(p), ["scrape_time", "job_id"]
        ).awaitTermination()
    return _stored(spark, store)


@query(f"""WITH {ORDERS}, n AS (SELECT name, price, CASE WHEN job_id % 7 > 0 THEN link END AS link, scrape_time, search_term,
  job_id, (co.scrape_time < '1996')::INT AS batch FROM co)
SELECT name, price, link, scrape_time, search_term, job_id FROM n
QUALIFY link IS NULL OR row_number() OVER (PARTITION BY link ORDER BY batch, n.scrape_time, n.job_id) = 1""")
def r2_stream_first_links(spark, folder):
    """Files of later rows come first, then one with older rows; some rows have no link."""
    rows = _orders(A.table(spark, folder, "orders"))
    rows = rows.withColumn("link", F.when(F.col("job_id") % 7 > 0, F.col("link")))
    files, store, progress = (scratch_dir(spark, x) for x in ("arrivals", "links", "progress"))
    for part in ("scrape_time >= '1996'", "scrape_time < '1996'"):
        rows.where(part).write.mode("append").parquet(files)
        stream = arrivals.arriving(spark, files, rows.schema)
        arrivals.first_links(stream, store, progress, ["scrape_time", "job_id"]).awaitTermination()
    return ingest.read_store(spark, store, rows.schema).select(rows.columns)


@query("""WITH h AS (SELECT date_trunc('hour', ts) AS h, count(*) AS listings, count(CASE WHEN value >= 1.0 THEN value END) AS priced,
  avg(CASE WHEN value >= 1.0 THEN value END) AS m FROM events GROUP BY 1)
SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS hour_start, listings, priced, round(m, 6) AS mean_price FROM h
WHERE h + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOURS FROM events)""")
def r3_stream_hourly_counts(spark, folder):
    """Hours that the watermark has passed when the last file has been read."""
    schema = A.table(spark, folder, "events").schema
    raw = arrivals.arriving(spark, folder, schema, pattern="events.parquet")
    value = F.col("value")
    stream = raw.select(
        F.col("ts").cast("timestamp").alias("scrape_time"), F.when(value >= 1.0, value).alias("price_numeric")
    )
    return rounded(stamps(_hours(spark, stream), "hour_start"))


def _hours(spark, stream):
    path = scratch_dir(spark, "hours")
    arrivals.run_to_files(arrivals.hourly_counts(stream), path, scratch_dir(spark, "progress"))
    return spark.read.parquet(path)


@query("""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_start, count(*) AS listings,
count(CASE WHEN value >= 1.0 THEN value END) AS priced, round(avg(CASE WHEN value >= 1.0 THEN value END), 6) AS mean_price
FROM events GROUP BY 1""")
def r3_all_hours(spark, folder):
    """The hours a stream has emitted, and those still open when its input ends."""
    events = A.table(spark, folder, "events")

    def timed(df):
        value = F.when(F.col("value") >= 1.0, F.col("value"))
        return df.select(F.col("ts").cast("timestamp").alias("scrape_time"), value.alias("price_numeric"))

    closed = _hours(spark, timed(arrivals.arriving(spark, folder, events.schema, pattern="events.parquet")))
    return rounded(stamps(closed.unionByName(arrivals.open_hours(timed(events), closed)), "hour_start"))


# Buckets of the indexes below; a store of a cluster has more.
FEW_BUCKETS = 16


@query(TWO_BATCHES.format(job="batch"))
def i7_indexed_batches(spark, folder):
    """Two batches appended by way of an index of links, the second one twice."""
    store = scratch_dir(spark, "store")
    index = links.LinkIndex(spark, scratch_dir(spark, "links"), FEW_BUCKETS)
    early, late = _early_and_late(spark, folder)
    for job, batch in ((1, early), (2, late), (2, late)):
        links.append_indexed(batch, store, index, str(job), job, ["scrape_time", "source"])
    return _stored(spark, store)


@query(f"""WITH {ORDERS} SELECT name, price, link, scrape_time, search_term, job_id FROM co
WHERE link NOT IN (SELECT link FROM co WHERE co.scrape_time < '1994') AND co.scrape_time >= '1994'""")
def j5_indexed_unseen_links(spark, folder):
    """Orders whose customer no earlier order has, found in an index made from a store."""
    rows = _orders(A.table(spark, folder, "orders"))
    store = scratch_dir(spark, "store")
    ingest.append_batch(rows.where("scrape_time < '1994'"), store, order=["scrape_time", "job_id"])
    index = links.indexed(spark, store, scratch_dir(spark, "links"), FEW_BUCKETS)
    return index.unseen(rows.where("scrape_time >= '1994'"))


@query(f"""WITH {ORDERS}, n AS (SELECT name, price, CASE WHEN job_id % 7 > 0 THEN link END AS link, scrape_time, search_term,
  job_id, (co.scrape_time < '1996')::INT AS batch FROM co)
SELECT name, price, link, scrape_time, search_term, job_id FROM n
QUALIFY link IS NULL OR row_number() OVER (PARTITION BY link ORDER BY batch, n.scrape_time, n.job_id) = 1""")
def r5_first_links_in_time(spark, folder):
    """The same rows as ``r2_stream_first_links``, with one state entry a link and an index."""
    rows = _orders(A.table(spark, folder, "orders"))
    rows = rows.withColumn("link", F.when(F.col("job_id") % 7 > 0, F.col("link")))
    files, store, progress = (scratch_dir(spark, x) for x in ("arrivals", "store", "progress"))
    index = links.LinkIndex(spark, scratch_dir(spark, "links"), FEW_BUCKETS)
    for part in ("scrape_time >= '1996'", "scrape_time < '1996'"):
        rows.where(part).write.mode("append").parquet(files)
        stream = arrivals.arriving(spark, files, rows.schema)
        seen.first_links_in_time(stream, store, index, progress, ["scrape_time", "job_id"]).awaitTermination()
    return ingest.read_store(spark, store, rows.schema).select(rows.columns)


@query("""WITH e AS (SELECT date_trunc('hour', ts) AS h, value, ts < TIMESTAMP '2024-01-20' AS second FROM events),
t AS (SELECT max(ts) - INTERVAL 2 HOURS AS closed FROM events),
r AS (SELECT h, value, second AND h + INTERVAL 1 HOUR <= closed AS late FROM e, t)
SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS hour_start, count(*) FILTER (WHERE NOT late) AS listings,
  round(avg(value) FILTER (WHERE NOT late), 6) AS mean_price, count(*) FILTER (WHERE late) AS late_rows FROM r GROUP BY 1""")
def r6_hours_and_late_rows(spark, folder):
    """Later events arrive first; of the earlier ones, each counts in its hour or among the late rows."""
    events = A.table(spark, folder, "events").select(F.col("ts").cast("timestamp").alias("scrape_time"), F.col("value").alias("price_numeric"))
    files, out, progress = (scratch_dir(spark, x) for x in ("arrivals", "hours", "progress"))
    for part in ("scrape_time >= '2024-01-20'", "scrape_time < '2024-01-20'"):
        events.where(part).write.mode("append").parquet(files)
        hours.count_hours(arrivals.arriving(spark, files, events.schema), out, progress).awaitTermination()
    late = hours.late_rows(spark, out, events).groupBy("hour_start").agg(F.count("*").alias("late_rows"))
    whole = hours.hours(spark, out).select("hour_start", "listings", "mean_price").join(late, "hour_start", "full")
    return rounded(stamps(whole.na.fill(0, ["listings", "late_rows"]), "hour_start"))
