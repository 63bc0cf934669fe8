"""Job states, job outcomes and retention."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.temporal import seconds_between
from shelfline.operators.ingest import read_store, write_stored
from shelfline.schemas import STORED_LISTING

# Fixed value: days that listings are kept.
RETENTION_DAYS = 30


def job_states(job_events: DataFrame) -> DataFrame:
    """What the fold of a log keeps of every job; such states merge in any order.

    A state holds the latest entry, the first time, the latest start and end, and the latest
    failure, all of them largest or smallest values: entries that come late or twice change
    nothing but what they ought to.
    """
    t, status = F.col("event_time"), F.col("status")
    done = status.isin("completed", "failed", "cancelled")
    stage = F.when(status == "pending", 0).when(status == "running", 1).otherwise(2)
    return job_events.groupBy("job_id").agg(
        F.max(F.struct(t.alias("at"), stage.alias("stage"), status.alias("status"), "search_term")).alias("last"),
        F.min(t).alias("created_at"),
        F.max(F.when(status == "running", t)).alias("started_at"),
        F.max(F.when(done, t)).alias("completed_at"),
        F.max(F.when(status == "failed", F.struct(t.alias("at"), "message"))).alias("failure"),
    )


def merged_states(*states: DataFrame) -> DataFrame:
    """Several tables of job states as one."""
    every = reduce(DataFrame.unionByName, states)
    return every.groupBy("job_id").agg(
        F.max("last").alias("last"), F.min("created_at").alias("created_at"), F.max("started_at").alias("started_at"),
        F.max("completed_at").alias("completed_at"), F.max("failure").alias("failure"),
    )


def jobs_of(states: DataFrame) -> DataFrame:
    """Jobs as the states tell them."""
    return states.select(
        "job_id", "last.search_term", "last.status", "created_at", "started_at", "completed_at",
        F.col("failure.message").alias("error_message"),
    )


def latest_jobs(job_events: DataFrame, snapshot: DataFrame | None = None) -> DataFrame:
    """State of every job, folded from its log of status changes.

    Creation is the first entry; start and completion are the latest entries of that kind.
    Among entries of one time the later stage decides, so the fold is deterministic. With a
    ``snapshot`` (``job_states`` of an earlier part of the log, written out) only the entries
    that have arrived since are read; any cut of the log gives the same jobs.
    """
    states = job_states(job_events)
    return jobs_of(states if snapshot is None else merged_states(snapshot, states))


def pending_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.where(F.col("status") == "pending")


def next_pending(jobs: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` pending jobs, each with the number of pending jobs not shown."""
    waiting = pending_jobs(jobs)
    total = waiting.agg(F.count("*")).scalar()
    return (
        waiting.orderBy("job_id")
        .limit(k)
        .withColumn("remaining", F.greatest(total - F.lit(k), F.lit(0)).cast("long"))
    )


def job_outcomes(jobs: DataFrame, listings: DataFrame) -> DataFrame:
    """Number of listings each job stored; jobs without any count 0."""
    counted = (
        listings.where(F.col("job_id").isNotNull())
        .groupBy("job_id")
        .agg(F.count("*").alias("total_products"))
    )
    return jobs.join(counted, "job_id", "left").withColumn(
        "total_products", F.coalesce("total_products", F.lit(0).cast("long"))
    )


def job_durations(jobs: DataFrame, start: str = "started_at", end: str = "completed_at") -> DataFrame:
    return jobs.withColumn("duration_s", seconds_between(F.col(start), F.col(end)))


def run_totals(listings: DataFrame, by: str = "source") -> DataFrame:
    """Items per source and, in the row whose level is ``total``, of the whole run."""
    level = F.when(F.grouping(by) == 1, "total").otherwise("source").alias("level")
    return listings.rollup(by).agg(level, F.count("*").alias("items"))


def store_status(listings: DataFrame, jobs: DataFrame) -> DataFrame:
    """Store overview in long form; a missing search term is a line of its own."""
    terms = listings.groupBy("search_term").agg(F.count("*").alias("value"))
    per_term = terms.select(F.lit("listings").alias("item"), "search_term", "value")
    total = terms.agg(F.coalesce(F.sum("value"), F.lit(0).cast("long")).alias("value")).select(
        F.lit("total_listings").alias("item"), F.lit(None).cast("string").alias("search_term"), "value"
    )
    states = jobs.agg(
        F.count_if(F.col("status") == "completed").alias("completed"),
        F.count_if(F.col("status") == "pending").alias("pending"),
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("completed_jobs").alias("item"), F.lit(None).cast("string").alias("search_term"), F.col("completed").alias("value")),
                F.struct(F.lit("pending_jobs").alias("item"), F.lit(None).cast("string").alias("search_term"), F.col("pending").alias("value")),
            )
        )
    )
    return total.unionByName(per_term).unionByName(states)


def _cutoff(as_of: str, days: int) -> Column:
    return F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")


def retained(df: DataFrame, as_of: str, days: int = RETENTION_DAYS, time: str = "scrape_time") -> DataFrame:
    """Rows not older than ``days`` before ``as_of``; rows without a time stay."""
    return df.where(F.col(time).isNull() | (F.col(time) >= _cutoff(as_of, days)))


def retention_counts(
    df: DataFrame, as_of: str, days: int = RETENTION_DAYS, time: str = "scrape_time"
) -> DataFrame:
    old = F.coalesce(F.col(time) < _cutoff(as_of, days), F.lit(False))
    return df.agg(F.count_if(old).alias("removed"), F.count_if(~old).alias("kept"))


def rewrite_retained(
    spark: SparkSession, store: str, target: str, as_of: str, days: int = RETENTION_DAYS,
    schema: T.StructType = STORED_LISTING, time: str = "scrape_time",
) -> None:
    """Write the retained part of a store to a new place, in the same layout.

    Months that have passed are never read, since the store is laid out by month; in the month
    in which the limit falls, rows are compared by their time. Batches keep their names, so
    later appends and repeats work on the new store as on the old one. The store being read
    is never overwritten; the caller swaps the two when the write has succeeded.
    """
    month, limit = F.col("stored_month"), _cutoff(as_of, days)
    first = F.trunc(limit, "month")
    rows = read_store(spark, store, schema).where(month.isNull() | (month >= first))
    typed = F.col(time).try_cast("timestamp")
    write_stored(rows.where(month.isNull() | (month > first) | typed.isNull() | (typed >= limit)), target)
