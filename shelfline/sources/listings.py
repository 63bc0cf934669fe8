"""Scans of listings and collected items."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.price import analysis_price, no_nan
from shelfline.functions.temporal import parse_time
from shelfline.operators.joins import attach_jobs
from shelfline.operators.select import named
from shelfline.operators.trends import with_day_and_hour
from shelfline.schemas import COLLECTED_ITEM


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None, merge: bool = False) -> DataFrame:
    """A parquet table.

    Files may lack columns that were added later: give the ``schema``, or ``merge`` the files'
    own, which reads the footer of every file.
    """
    reader = spark.read.option("mergeSchema", merge)
    return (reader.schema(schema) if schema else reader).parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table; give ``partitionColumn`` and its bounds to read it in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def normalised(listings: DataFrame) -> DataFrame:
    """Named listings with a numeric price and a typed time.

    Texts are parsed, and what cannot be parsed becomes NULL; typed columns pass through.
    """
    kind = dict(listings.dtypes)
    if kind["price"] == "string":
        price = no_nan(analysis_price(F.col("price")))
    else:
        price = no_nan(F.col("price"))
    df = named(listings).withColumn("price_numeric", price)
    if "scrape_time" in kind:
        time = F.col("scrape_time")
        typed = parse_time(time) if kind["scrape_time"] == "string" else time.cast("timestamp")
        df = df.withColumn("scrape_time", typed)
    return df


def scan(listings: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """The analysis scan: normalised listings, with their jobs' columns where ``jobs`` is given."""
    df = normalised(listings)
    return df if jobs is None else attach_jobs(df, jobs)


def timed_scan(
    listings: DataFrame, jobs: DataFrame | None = None, ordered: bool = False
) -> DataFrame:
    """The scan with date and hour columns; sorted only when the caller wants output order."""
    df = with_day_and_hour(scan(listings, jobs))
    return df.orderBy("scrape_time") if ordered else df


def read_items(
    spark: SparkSession,
    path: str,
    schema: T.StructType = COLLECTED_ITEM,
    whole_files: bool = True,
) -> DataFrame:
    """Items from files that hold a JSON array of them.

    With ``whole_files`` a file is one array. Otherwise every line is an array (or a single
    item), so that large files can be split. A missing path gives no rows, and so does
    content that is not JSON.
    """
    corrupt = "_corrupt_record"
    checked = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    reader = (
        spark.read.schema(checked)
        .option("multiLine", whole_files)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
    )
    # An item with one unreadable field is kept without it.
    some = F.coalesce(*[F.col(f.name).cast("string") for f in schema.fields]).isNotNull()
    try:
        return reader.json(path).where(F.col(corrupt).isNull() | some).drop(corrupt)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
