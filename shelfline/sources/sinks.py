"""Writers for listings and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators.select import from_source, in_date_range, pick_fields

# Rows in one CSV file at most: a file whose fields may span lines is read by one task.
CSV_FILE_ROWS = 250_000


def write_raw_json(df: DataFrame, path: str, by: str = "source") -> None:
    """Collected rows as JSON, one folder per source.

    REBALANCE gives a large source many files and keeps a small one whole.
    """
    df.hint("rebalance", by).write.partitionBy(by).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """All columns as CSV with a header. Quotes are doubled, so that any text reads back.

    Files are kept short, since one whose fields span lines cannot be split for reading.
    """
    df.write.option("header", True).option("escape", '"').option("maxRecordsPerFile", CSV_FILE_ROWS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back what ``write_csv`` wrote; fields may span lines.

    An unquoted empty field is NULL and a quoted one the empty text, which Spark tells apart
    once another mark stands for NULL; this one occurs in no text.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("nullValue", "\u0000")
        .option("multiLine", True)
        .csv(path)
    )


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per line; NULL fields are written, so that every record is complete."""
    df.write.option("ignoreNullFields", False).json(path)


def sheet_name(term: Column, length: int | None = None) -> Column:
    """Partition name of a search term: spaces to underscores.

    A ``length`` cuts it, as spreadsheets need; terms that begin alike then share a name.
    """
    name = F.replace(term, F.lit(" "), F.lit("_"))
    return name if length is None else F.substring(name, 1, length)


def write_by_term(
    df: DataFrame, path: str, by: str = "search_term", fmt: str = "parquet", name_length: int | None = None
) -> None:
    """One output partition per non-null search term."""
    sheets = df.where(F.col(by).isNotNull()).withColumn("sheet", sheet_name(F.col(by), name_length))
    sheets.hint("rebalance", "sheet").write.partitionBy("sheet").format(fmt).save(path)


def write_report(metrics: DataFrame, path: str, fmt: str = "json") -> None:
    """A metrics table as JSON, CSV or parquet; an unknown format means JSON.

    REBALANCE writes a small report as one file and one with very many groups as several.
    """
    sized = metrics.hint("rebalance")
    if fmt == "csv":
        flat = [
            F.to_json(c).alias(c) if t.startswith(("map", "array", "struct")) else F.col(c)
            for c, t in sized.dtypes
        ]
        write_csv(sized.select(*flat), path)
    elif fmt == "parquet":
        sized.write.parquet(path)
    else:
        write_json(sized, path)


def configured_export(
    df: DataFrame,
    fields: str | list[str] | None = None,
    source: str = "all",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """The rows and columns a configured export asks for."""
    picked = in_date_range(from_source(df, source), start, end)
    return pick_fields(picked, fields) if fields else picked


def export(df: DataFrame, path: str, fmt: str) -> None:
    """Write an export as CSV, JSON or parquet."""
    writers = {"csv": write_csv, "json": write_json, "parquet": lambda d, p: d.write.parquet(p)}
    writers[fmt.lower()](df, path)
