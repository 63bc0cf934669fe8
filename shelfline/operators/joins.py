"""Joins of many rows to one row per key.

They are plain joins: Spark broadcasts a small side and splits the partitions of a hot key by
itself (adaptive execution splits them by map output, so equal rows are spread as well).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _apart(right: DataFrame, keys: list[str]) -> DataFrame:
    """Rename the join keys of one side so that both sides can be named in a condition."""
    for k in keys:
        right = right.withColumnRenamed(k, f"right_{k}")
    return right


def join_on(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", never_null: tuple = ()
) -> DataFrame:
    """Equi-join in which NULL keys match each other; the left keys are kept."""
    condition = [
        F.col(k) == F.col(f"right_{k}") if k in never_null else F.col(k).eqNullSafe(F.col(f"right_{k}"))
        for k in keys
    ]
    joined = left.join(_apart(right, keys), condition, how)
    return joined.drop(*[f"right_{k}" for k in keys])


def with_row(df: DataFrame, frame: DataFrame, name: str) -> DataFrame:
    """Add the columns of a one-row frame to every row, as the struct ``name``.

    The frame is evaluated once, as a scalar subquery; the struct is NULL when it is empty.
    """
    return df.withColumn(name, frame.select(F.struct("*").alias(name)).scalar())


def attach_jobs(listings: DataFrame, jobs: DataFrame) -> DataFrame:
    """Left join to the job of each listing: search term, status and creation time.

    Listings keep all their rows; ``jobs`` has one row per job.
    """
    wanted = jobs.select(
        "job_id",
        F.col("search_term").alias("job_search_term"),
        F.col("status").alias("job_status"),
        F.col("created_at").alias("job_created_at"),
    )
    return listings.join(wanted, "job_id", "left")


def unseen(incoming: DataFrame, stored: DataFrame, key: str = "link") -> DataFrame:
    """Rows whose key is not stored yet. A NULL key never conflicts.

    Of the store only the key column is read. The batch is evaluated once, and a key that is
    repeated on either side multiplies nothing.
    """
    return incoming.join(stored.select(key), key, "left_anti").select(*incoming.columns)
