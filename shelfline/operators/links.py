"""An index of stored links by bucket, with a small sketch of every bucket.

A batch asks which of its links are stored. Its links fall into buckets; of those buckets the
sketches are read, four bytes a link, and of the buckets in which a sketch says "perhaps" the
links themselves. A sketch is a set of marks (hashes of the links by another function than
the bucket's), so batches add to it without reading it, and sketches of batches or stores are
merged by appending them. What a sketch cannot tell apart is compared link by link: the
answer is exact whatever the marks.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.ingest import first_per_link, read_store, stored_month, to_stored, write_stored
from shelfline.session import materialise

BUCKETS = 256


class LinkIndex:
    """Links of a listing store, laid out by bucket and batch under one folder.

    The number of buckets is written with the index and stays; ``buckets`` counts only for a
    new one. It bounds the lists of buckets that the driver holds, and the files of a batch.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, link: str = "link"):
        self.spark, self.path, self.link = spark, path.rstrip("/"), link
        layout = f"{self.path}/layout"
        try:
            self.buckets = spark.read.schema("buckets int").parquet(layout).first()["buckets"]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.parquet(layout)
            self.buckets = buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.link), F.lit(self.buckets)).cast("int")

    def _mark(self) -> Column:
        return F.hash(self.link)

    def _part(self, name: str, fields: str) -> DataFrame:
        schema = f"{fields}, bucket int, batch_id string"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def marks(self) -> DataFrame:
        """The sketches: ``mark, bucket, batch_id``."""
        return self._part("marks", "mark int")

    def links(self) -> DataFrame:
        """The stored links: ``link, bucket, batch_id``."""
        return self._part("links", f"{self.link} string")

    def _buckets_of(self, rows: DataFrame) -> list[int]:
        return sorted(r.bucket for r in rows.select("bucket").distinct().collect())

    def perhaps(self, links: DataFrame, batch_id: str | None = None) -> DataFrame:
        """The links that a sketch holds a mark of: ``link, bucket, mark``.

        ``links`` has ``link, bucket, mark``. Only sketches of its own buckets are read, and
        none of the batch ``batch_id``.
        """
        marks = self.marks().where(F.col("bucket").isin(self._buckets_of(links)))
        if batch_id is not None:
            marks = marks.where(F.col("batch_id") != batch_id)
        return links.join(marks.select("bucket", "mark"), ["bucket", "mark"], "left_semi")

    def confirmed(self, perhaps: DataFrame, batch_id: str | None = None) -> DataFrame:
        """The links among ``perhaps`` that are stored; only their buckets are read."""
        stored = self.links().where(F.col("bucket").isin(self._buckets_of(perhaps)))
        if batch_id is not None:
            stored = stored.where(F.col("batch_id") != batch_id)
        return perhaps.join(stored.select("bucket", self.link), ["bucket", self.link], "left_semi").select(self.link)

    def unseen(self, rows: DataFrame, batch_id: str | None = None) -> DataFrame:
        """The rows whose link no other batch has stored; a NULL link is never stored.

        ``rows`` is evaluated twice, so it should be a table or persisted.
        """
        links = rows.where(F.col(self.link).isNotNull()).select(self.link).distinct()
        keyed = materialise(links.withColumns({"bucket": self._bucket(), "mark": self._mark()}), "asked-links")
        known = self.confirmed(materialise(self.perhaps(keyed, batch_id), "perhaps-links"), batch_id)
        return rows.join(known, self.link, "left_anti").select(*rows.columns)

    def add(self, rows: DataFrame) -> None:
        """Enter the links of rows that have a ``batch_id``; a repeat replaces the batch's own.

        A batch writes one file a bucket, in the order of its links.
        """
        keyed = rows.where(F.col(self.link).isNotNull()).select(self.link, "batch_id").distinct()
        placed = keyed.withColumns({"bucket": self._bucket(), "mark": self._mark()})
        # Both parts come from one table, sorted and dealt by bucket once.
        placed = materialise(placed.repartition("bucket").sortWithinPartitions("bucket", "batch_id", self.link), "entered-links")
        # The sketch comes last: links that no sketch knows yet are not looked for.
        for name, column in (("links", self.link), ("marks", "mark")):
            (
                placed.select(column, "bucket", "batch_id").write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch_id").parquet(f"{self.path}/{name}")
            )

    def catch_up(self, stored: DataFrame) -> None:
        """Enter the batches of a store that the index lacks, as after a crash between the two."""
        entered = self.marks().select("batch_id").distinct()
        self.add(stored.join(entered, "batch_id", "left_anti").select(self.link, "batch_id"))

    def compacted(self, path: str, batch_id: str = "compacted") -> LinkIndex:
        """The same index at a new place as one batch, its many small files merged."""
        target = LinkIndex(self.spark, path, self.buckets, self.link)
        target.add(self.links().select(self.link, F.lit(batch_id).alias("batch_id")))
        return target


def write_indexed(
    batch: DataFrame, store: str, index: LinkIndex, batch_id: str, order: list[str] | None = None, time: str = "scrape_time"
) -> None:
    """Append a batch to a store, the first row of each link that no other batch has stored.

    Does what ``ingest.write_batch`` does, but reads no link of the store beyond the buckets
    whose sketches say that one may be there. A batch that failed half-way is repeated under
    its own name, which replaces what it left in the store and in the index.
    """
    fresh = materialise(first_per_link(batch, order or sorted(batch.columns)), "fresh-rows")
    if fresh.isEmpty():  # a stream also runs batches that only move its watermark
        return
    new = index.unseen(fresh, batch_id).withColumn("batch_id", F.lit(batch_id))
    new = materialise(new.withColumn("stored_month", stored_month(time)), "new-rows")
    write_stored(new, store)
    index.add(new)


def append_indexed(
    batch: DataFrame, store: str, index: LinkIndex, run: str, job_id: int | None = None, order: list[str] | None = None
) -> None:
    """``ingest.append_batch`` by way of the index."""
    write_indexed(to_stored(batch, job_id), store, index, f"run-{run}", order)


def indexed(spark: SparkSession, store: str, path: str, buckets: int = BUCKETS) -> LinkIndex:
    """An index of a store that has none yet, or the one at ``path`` with all batches entered."""
    index = LinkIndex(spark, path, buckets)
    index.catch_up(read_store(spark, store))
    return index
