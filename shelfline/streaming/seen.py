"""First rows of links on a stream, with state that is bounded in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline.operators.ingest import in_order
from shelfline.operators.links import LinkIndex, write_indexed
from shelfline.streaming.arrivals import into_store

TTL = "7 days"


def first_of_links(stream: DataFrame, order: list[str], link: str = "link", ttl: str = TTL) -> DataFrame:
    """The rows of a stream without those whose link it has brought within the same ``ttl``.

    Run it in update mode. The state is an aggregate with one entry a link, in windows of
    ``ttl`` over the time of arrival; Spark drops a window from the state when the watermark,
    the arrival of the batch before, has passed it. Arrival never goes back, so no row is
    too late, whatever its own time. Of the rows of a link in one micro-batch the first in
    ``order`` passes, none if an earlier micro-batch of the window had one. Links that come
    again in a later window pass anew and are to be compared with the store. Rows of a hot
    link are reduced to one in every task ahead of the shuffle; rows without a link all pass
    and have no state.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    arrived = stream.where(F.col(link).isNotNull()).select(
        F.current_timestamp().alias("arrived"), F.col(link).alias("of_link"), row.alias("row"), *in_order(stream, order)
    )
    arrived = arrived.toDF("arrived", "of_link", "row", *[f"k{i}" for i in range(len(order))])
    place = F.struct("arrived", *[f"k{i}" for i in range(len(order))])
    first = arrived.withWatermark("arrived", "0 seconds").groupBy(F.window("arrived", ttl), "of_link").agg(
        F.min_by("row", place).alias("row"), F.min("arrived").alias("since"), F.max("arrived").alias("until")
    )
    # An entry that an earlier batch made is only updated.
    return first.where("since = until").select("row.*").unionByName(stream.where(F.col(link).isNull()))


def first_links_in_time(
    stream: DataFrame, store: str, index: LinkIndex, checkpoint: str, order: list[str], time: str = "scrape_time",
    ttl: str = TTL,
) -> StreamingQuery:
    """The first row of each link that a stream brings, all columns kept, then stop.

    The state answers for links seen within ``ttl`` and is bounded by their number; only the
    others are looked up in the index of the store, and of that only the buckets they fall
    in. The result is that of ``arrivals.first_links``. A repeated micro-batch replaces its
    own rows and entries.
    """
    recent = first_of_links(stream, order, index.link, ttl)
    return into_store(recent, checkpoint, lambda batch, name: write_indexed(batch, store, index, name, order, time), "update")
