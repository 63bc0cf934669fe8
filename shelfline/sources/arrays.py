"""JSON arrays of any size, each read by many tasks.

Files are cut at every closing brace, wherever Spark splits them, so a task starts in the
middle of an array without knowing whether it stands in a string, or how deep. Every piece
says what it does to both, quotes are summed up to every piece, then depths, and a piece in
which the depth falls to zero ends an item. Sums within a split are window sums over its
pieces; the state at the begin of a split comes from a window over the few splits of its file.
Splits smaller than the session's are read several by one task: the number of tasks, and of
files of the intermediate tables, follows the input as it does for any other read.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.schemas import COLLECTED_ITEM
from shelfline.session import materialise

_SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
_CORRUPT = "_corrupt_record"


@contextmanager
def _splits_of(spark: SparkSession, size: int | None):
    before = spark.conf.get(_SPLIT_BYTES)
    if size is not None:
        spark.conf.set(_SPLIT_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.set(_SPLIT_BYTES, before)


def _opened(text: Column, in_string: int) -> Column:
    """Opening braces outside strings, for a piece that begins outside or inside of one."""
    quoted = F.concat(F.lit('"'), text) if in_string else text
    outside = F.regexp_replace(quoted, r'(?s)"[^"]*(?:"|$)', "")
    return F.length(outside) - F.length(F.replace(outside, F.lit("{"), F.lit("")))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands ahead of every closing brace of the files: ``file, split, k, value`` and its measures."""
    meta = F.col("_metadata")
    rows = spark.read.option("lineSep", "}").text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("split"), meta["file_size"].alias("size"),
        F.monotonically_increasing_id().alias("k"), "value",
    )
    bare = rows.withColumn("bare", F.regexp_replace("value", r"(?s)\\.", ""))
    quotes = F.length("bare") - F.length(F.replace("bare", F.lit('"'), F.lit("")))
    return bare.select(
        "file", "split", "size", "k", "value", F.octet_length("value").cast("long").alias("bytes"),
        (quotes % 2).alias("odd"), _opened(F.col("bare"), 0).alias("open0"), _opened(F.col("bare"), 1).alias("open1"),
    )


def _so_far():
    """The pieces of a split up to each."""
    return W.partitionBy("file", "split").orderBy("k").rowsBetween(W.unboundedPreceding, W.currentRow)


def _changes(pieces: DataFrame, lasts: DataFrame) -> DataFrame:
    """Change of depth by every piece, if its split begins outside (0) or inside (1) a string."""
    marked = pieces.join(lasts, "file").withColumn("before", (F.sum("odd").over(_so_far()) - F.col("odd")) % 2)
    after = (F.col("before") + F.col("odd")) % 2
    # The text behind the last brace of a file is no piece that a brace ends.
    braced = ~((F.col("k") == F.col("last_k")) & F.col("tail"))
    return marked.withColumns(
        {
            f"change{s}": F.when(F.col("before") == s, F.col("open0")).otherwise(F.col("open1"))
            - (braced & (after == s)).cast("int")
            for s in (0, 1)
        }
    ).withColumns({"braced0": braced & (after == 0), "braced1": braced & (after == 1)})


def _items(spark: SparkSession, path: str, strict: bool, split_bytes: int | None) -> DataFrame:
    pieces = _pieces(spark, path)
    # As many tasks as the session's own splits make; empty files make none.
    tasks = max(1, pieces.rdd.getNumPartitions())
    # Only this read has the small splits, the tables written from it have the session's.
    with _splits_of(spark, split_bytes):
        pieces = materialise(pieces.coalesce(tasks), "json-pieces")
    # The files' last pieces; whether a brace follows one is told by the size of its file.
    lasts = pieces.groupBy("file").agg(
        F.max_by("k", F.struct("split", "k")).alias("last_k"), F.max_by("value", F.struct("split", "k")).alias("end"),
        F.min_by("value", F.struct("split", "k")).alias("begin"), (F.sum(F.col("bytes") + 1) != F.first("size")).alias("tail"),
    )
    lasts = materialise(lasts, "json-files")
    narrow = _changes(pieces.drop("value"), lasts.select("file", "last_k", "tail"))
    splits = narrow.groupBy("file", "split").agg(
        F.sum("odd").alias("odd"), F.sum("change0").alias("change0"), F.sum("change1").alias("change1")
    )
    ahead = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.withColumn("inside", F.coalesce(F.sum("odd").over(ahead), F.lit(0)) % 2)
    splits = splits.withColumn("change", F.when(F.col("inside") == 0, F.col("change0")).otherwise(F.col("change1")))
    splits = splits.withColumn("depth", F.coalesce(F.sum("change").over(ahead), F.lit(0)))
    splits = materialise(splits.select("file", "split", "inside", "depth", "change", "odd"), "json-splits")
    if strict:
        whole = splits.groupBy("file").agg((F.sum("change") == 0).alias("level"), (F.sum("odd") % 2 == 0).alias("quoted"))
        sound = lasts.join(whole, "file").where("level AND quoted").where(
            F.col("tail") & F.col("end").rlike(r"(?s)\]\s*$") & F.col("begin").rlike(r"^\s*\[")
        )
        pieces = pieces.join(sound.select("file"), "file", "left_semi")
    placed = _changes(pieces, lasts.select("file", "last_k", "tail")).join(splits.select("file", "split", "inside", "depth"), ["file", "split"])
    of_split = lambda name: F.when(F.col("inside") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    placed = placed.withColumn("depth", F.col("depth") + F.sum(of_split("change")).over(_so_far()))
    placed = placed.withColumn("ends", (of_split("braced") & (F.col("depth") == 0)).cast("int"))
    placed = placed.withColumn("item", F.sum("ends").over(_so_far()) - F.col("ends"))
    part = F.when(F.col("braced0") | F.col("braced1"), F.concat("value", F.lit("}"))).otherwise(F.col("value"))
    # Within a split no further shuffle is needed: it is dealt by file and split.
    parts = placed.groupBy("file", "split", "item").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", part.alias("part")))), lambda p: p["part"]), "").alias("text"),
        F.max("ends").alias("ends"),
    )
    parts = materialise(parts, "json-parts")
    # Only the first and the unfinished items of splits may go on in others.
    border = (F.col("item") == 0) | (F.col("ends") == 0)
    done = parts.where(~border).select("text")
    counts = parts.groupBy("file", "split").agg(F.sum("ends").alias("n"))
    counts = counts.withColumn("first", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    joined = parts.where(border).join(counts, ["file", "split"]).groupBy("file", (F.col("first") + F.col("item")).alias("item")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "text"))), lambda p: p["text"]), "").alias("text"),
        F.max("ends").alias("ends"),
    )
    return done.unionByName(joined.where("ends = 1").select("text"))


def read_array_items(
    spark: SparkSession, path: str, schema: T.StructType = COLLECTED_ITEM, strict: bool = True, split_bytes: int | None = None
) -> DataFrame:
    """Items of files that each hold one JSON array of objects, as ``listings.read_items`` gives them.

    A file is read in splits (of ``split_bytes``, else as the session says), each by itself, and
    items that cross a split are put together. There are as many tasks as the session's splits,
    so that a task reads several smaller ones. With ``strict`` a file that
    is no whole array, such as one cut short, gives no rows; without it the items ahead of
    the damage are kept. A missing path gives no rows; elements that are no objects, and
    items that are no sound JSON, are left out. Compressed files, which cannot be split, must
    end in more than a brace.
    """
    try:
        texts = _items(spark, path, strict, split_bytes)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    checked = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    # An item follows the bracket or comma ahead of it.
    item = F.regexp_extract("text", r"(?s)\{.*$", 0)
    rows = texts.select(F.from_json(item, checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}).alias("x")).select("x.*")
    some = F.coalesce(*[F.col(f.name).cast("string") for f in schema.fields]).isNotNull()
    return rows.where(F.col(_CORRUPT).isNull() | some).drop(_CORRUPT)
