"""Hours on a stream, with the rows that come too late for them kept and counted."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline.streaming.arrivals import into_store

_CELLS = "hour_start timestamp, listings long, priced long, price_total double, batch_id string"
_LIMITS = "seen_until timestamp, batch_id string"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _put(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def _closed_until(limits: DataFrame, delay: str):
    """The time that has passed for good: the latest seen, less the delay; null before any."""
    return limits.agg((F.max("seen_until") - F.expr(f"INTERVAL {delay}")).alias("t")).scalar()


def count_hours(
    stream: DataFrame, folder: str, checkpoint: str, time: str = "scrape_time", price: str = "price_numeric", delay: str = "2 hours"
) -> StreamingQuery:
    """Sort what has arrived into hours and late rows, then stop.

    A row is late when its hour had ended ``delay`` before the latest time that earlier
    micro-batches have seen. Late rows are kept whole under ``late``; of the others a
    micro-batch leaves one cell an hour under ``hours``, summed ahead of the shuffle. Rows
    without a time are late rows, too, since no hour has them. All is named by the stream
    and the number of the micro-batch, so a repeat replaces its own; what a repeat judges by
    are the limits of the other batches.
    """
    spark = stream.sparkSession

    def each(batch: DataFrame, name: str) -> None:
        limits = _read(spark, f"{folder}/limits", _LIMITS).where(F.col("batch_id") < name)
        at = F.col(time).cast("timestamp")
        timed = batch.withColumns({"batch_id": F.lit(name), "hour_start": F.date_trunc("hour", at), "closed_until": _closed_until(limits, delay)})
        late = F.col("hour_start").isNull() | F.coalesce(F.col("hour_start") + F.expr("INTERVAL 1 HOUR") <= F.col("closed_until"), F.lit(False))
        cells = timed.where(~late).groupBy("batch_id", "hour_start").agg(
            F.count("*").alias("listings"), F.count(price).alias("priced"), F.sum(price).alias("price_total")
        )
        _put(cells, f"{folder}/hours")
        _put(timed.where(late).drop("closed_until"), f"{folder}/late")
        # The limit comes last: without it the next batch would only find fewer rows late.
        seen = timed.where(at.isNotNull()).groupBy("batch_id").agg(F.max(at).alias("seen_until"))
        _put(seen, f"{folder}/limits")

    return into_store(stream, checkpoint, each)


def hours(spark: SparkSession, folder: str, delay: str = "2 hours") -> DataFrame:
    """Every hour's rows, priced rows and mean price, and whether it is ``closed`` for good."""
    until = _closed_until(_read(spark, f"{folder}/limits", _LIMITS), delay)
    cells = _read(spark, f"{folder}/hours", _CELLS).groupBy("hour_start").agg(
        F.sum("listings").alias("listings"), F.sum("priced").alias("priced"),
        F.try_divide(F.sum("price_total"), F.sum("priced")).alias("mean_price"),
    )
    return cells.withColumn("closed", F.coalesce(F.col("hour_start") + F.expr("INTERVAL 1 HOUR") <= until, F.lit(False)))


def late_rows(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """The late rows, with the columns of ``like``, their hour and their batch."""
    schema = ", ".join(f"`{c}` {t}" for c, t in like.dtypes)
    return _read(spark, f"{folder}/late", f"{schema}, hour_start timestamp, batch_id string")
