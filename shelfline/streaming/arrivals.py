"""Recurring ingest as streams."""

from __future__ import annotations

from collections.abc import Callable
from queue import Queue

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfline.operators.ingest import to_stored, write_batch


def arriving(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream of the files that arrive in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def into_store(
    stream: DataFrame, checkpoint: str, store_batch: Callable[[DataFrame, str], None], mode: str = "append"
) -> StreamingQuery:
    """Hand each micro-batch over with its name: the stream's own id and the batch number.

    The id lives with the progress of the stream. A restart goes on under the same id, so a
    repeated micro-batch has its old name; another stream, or one without progress, has
    other names.
    """
    names: Queue[str] = Queue()

    def each(batch: DataFrame, number: int) -> None:
        stream_id = names.get()
        names.put(stream_id)
        batch.persist()
        try:
            store_batch(batch, f"stream-{stream_id}-{number:010d}")
        finally:
            batch.unpersist()

    query = (
        stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    names.put(query.id)
    return query


def ingest_arrivals(
    stream: DataFrame,
    store: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    order: list[str] | None = None,
) -> StreamingQuery:
    """Store what has arrived since the last run, first listing per link, then stop.

    Each micro-batch owns its folders of the store. When Spark repeats one after a failure, it
    replaces them, so no row is stored twice; streams that share a store never touch each
    other's folders.
    """
    return into_store(
        stream, checkpoint, lambda batch, name: write_batch(to_stored(prepare(batch)), store, name, order)
    )


def first_links(
    stream: DataFrame, store: str, checkpoint: str, order: list[str], time: str = "scrape_time"
) -> StreamingQuery:
    """The first row of each link that a stream brings, all columns kept, then stop.

    Within a micro-batch the first in ``order`` counts; a link that is stored already stays as
    it is, however late its other rows come. Rows without a link are all kept. Read the
    result with ``read_store`` and the schema of the stream.
    """
    return into_store(stream, checkpoint, lambda batch, name: write_batch(batch, store, name, order, time))


def hourly_counts(
    stream: DataFrame, time: str = "scrape_time", price: str = "price_numeric", delay: str = "2 hours"
) -> DataFrame:
    """Rows, priced rows and mean price per clock hour.

    An hour is emitted once the watermark has passed it; rows later than that are dropped.
    The hours that are still open when the input ends stay in the state until more arrives;
    ``open_hours`` gives them from the files themselves.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    return _per_hour(timed.withWatermark(time, delay), time, price)


def open_hours(rows: DataFrame, closed: DataFrame, time: str = "scrape_time", price: str = "price_numeric") -> DataFrame:
    """The hours of all rows that a stream has not emitted yet: ``closed`` holds those it has."""
    counted = _per_hour(rows.withColumn(time, F.col(time).cast("timestamp")), time, price)
    return counted.join(closed.select("hour_start"), "hour_start", "left_anti")


def _per_hour(timed: DataFrame, time: str, price: str) -> DataFrame:
    return (
        timed.groupBy(F.window(time, "1 hour"))
        .agg(
            F.count("*").alias("listings"),
            F.count(price).alias("priced"),
            F.avg(price).alias("mean_price"),
        )
        .select(F.col("window.start").alias("hour_start"), "listings", "priced", "mean_price")
    )


def run_to_files(frame: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything available into parquet files and stop."""
    query = (
        frame.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
