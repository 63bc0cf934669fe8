"""Batch ingest with first-write-wins links."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.price import ingest_price, no_nan
from shelfline.operators.joins import unseen
from shelfline.schemas import STORED_LISTING


def in_order(df: DataFrame, names: list[str]) -> list[Column]:
    """Columns to sort by; a map, which has no order of its own, counts by its sorted entries."""
    kinds = dict(df.dtypes)

    def sortable(c: str) -> Column:
        if kinds[c].startswith("map"):
            return F.array_sort(F.map_entries(c))
        return F.to_json(F.struct(c)) if "map<" in kinds[c] else F.col(c)

    return [sortable(c) for c in names]


def first_arrivals(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order; NULL keys equal each other.

    The row limit of the window is applied in every map task as well, so a key that holds a
    third of the input is reduced before the shuffle. ``order`` should tell any two different
    rows apart.
    """
    first = W.partitionBy(*keys).orderBy(*in_order(df, order))
    return df.withColumn("arrival", F.row_number().over(first)).where("arrival = 1").drop("arrival")


def first_per_link(df: DataFrame, order: list[str], link: str = "link") -> DataFrame:
    """First-write-wins on the link; rows without a link are all kept, each as a key of its own."""
    alone = F.when(F.col(link).isNull(), F.monotonically_increasing_id())
    marked = df.withColumn("alone", alone)
    return first_arrivals(marked, [link, "alone"], order).drop("alone")


def with_missing_columns(df: DataFrame) -> DataFrame:
    """Add the stored columns an older batch lacks, in stored order and type."""
    have = dict(df.dtypes)

    def column(field):
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        return F.col(field.name).cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in STORED_LISTING.fields])


def to_stored(df: DataFrame, job_id: int | None = None) -> DataFrame:
    """Rows as they are stored: numeric price, the batch's job, the stored columns.

    Numeric prices pass through; texts are parsed.
    """
    if dict(df.dtypes)["price"] == "string":
        price = no_nan(ingest_price(F.col("price")))
    else:
        price = no_nan(F.col("price"))
    df = df.withColumn("price", price)
    if job_id is not None:
        df = df.withColumn("job_id", F.lit(job_id).cast("long"))
    return with_missing_columns(df)


def new_rows(batch: DataFrame, stored: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The rows of a batch that an append may add: first per link, and link not yet stored."""
    return unseen(first_per_link(batch, order or sorted(batch.columns)), stored)


def stored_month(time: str = "scrape_time") -> Column:
    """The first day of the month a row is stored under; NULL for a missing or unreadable time."""
    return F.trunc(F.substring(F.col(time).cast("string"), 1, 10).try_cast("date"), "month")


def read_store(spark: SparkSession, store: str, schema: T.StructType = STORED_LISTING) -> DataFrame:
    """The stored rows with their month and the batch that wrote each; empty before the first batch."""
    layout = [T.StructField("stored_month", T.DateType()), T.StructField("batch_id", T.StringType())]
    schema = T.StructType([*schema.fields, *layout])
    try:
        return spark.read.schema(schema).parquet(store)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_stored(rows: DataFrame, store: str) -> None:
    """Write rows that have their ``stored_month`` and ``batch_id``, replacing those folders only."""
    # REBALANCE keeps the files of a large month apart and those of small months whole.
    (
        rows.hint("rebalance", "stored_month").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("stored_month", "batch_id")
        .parquet(store)
    )


def write_batch(
    batch: DataFrame, store: str, batch_id: str, order: list[str] | None = None, time: str = "scrape_time"
) -> None:
    """Append a batch to a parquet store, keeping the first listing of each link.

    New rows go to the batch's own folders, one per month, and are compared with the other
    batches only. A repeated batch therefore replaces its earlier output and adds nothing
    twice. ``batch_id`` names one batch of one run; whoever writes new rows uses a new one.
    """
    spark = batch.sparkSession
    others = read_store(spark, store, batch.schema).where(F.col("batch_id") != batch_id)
    fresh = new_rows(batch, others, order)
    write_stored(fresh.withColumn("stored_month", stored_month(time)).withColumn("batch_id", F.lit(batch_id)), store)


def append_batch(
    batch: DataFrame, store: str, job_id: int | None = None, order: list[str] | None = None, run: str | None = None
) -> None:
    """Store listings, optionally those that one job collected.

    Every call adds, also under a job that has stored rows before. Give a ``run`` of its own
    to a call that may have to be repeated: the repeat then replaces what the first try wrote.
    """
    write_batch(to_stored(batch, job_id), store, f"run-{run or uuid.uuid4().hex}", order)
