"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import before_in_group, hashable, numbered, order_key, unit, with_rows


def interleave(rows: DataFrame, shards: int = 16, seed: int = 5, source: str = "source", key: str = "doc_id") -> DataFrame:
    """Deal rows into shards that all have the mixture of the whole; adds ``shard`` and ``slot``.

    Rows of a source stand in a seeded random order of their keys; the k-th of n rows gets
    the fractional rank (k - 1/2) / n. All rows sorted by it are cut into shards whose row
    counts differ by one at most; ``slot`` counts from 0 within a shard. No task sorts more
    than a cell of some thousand keys, whatever the size of a source; the rows themselves are
    written once and shuffled once, and never sorted.

    A null source is a source of its own, a null key orders like an empty one, and repeated
    rows are rows like any others (equal keys are ordered by the hash of the whole row, so a
    rerun can exchange only equal rows). An empty table stays empty. Input columns named
    ``shard`` or ``slot`` are replaced.
    """
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    keyed = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        order_key(seed, F.col(key)).alias("key"),
        F.xxhash64(*hashable(rows, kept)).alias("tie"),
        F.coalesce(F.col(source), F.lit("")).alias("src"),
        F.col(source).isNull().alias("no_src"),
        F.lit(1).cast("long").alias("one"),
    )
    table = numbered(keyed, "rows")
    ranked = before_in_group(table.drop("row"), ["no_src", "src"], "key", ["tie"], {"one": "rows"})
    dealt = ranked.withColumn("part", (2 * F.col("rows_before") + 1).cast("double") / (2 * F.col("rows_total")))
    # Sources of one size share their fractional ranks; their rows are ordered by the keys.
    dealt = dealt.drop("rows_before", "rows_total")
    placed = before_in_group(
        dealt, [], "part", ["key", "no_src", "src", "tie"], {"one": "all"}, place=F.col("part"), within=unit(F.col("key"))
    )
    placed = placed.withColumnsRenamed({"all_before": "place", "all_total": "n_rows"})
    placed = placed.withColumn("shard", F.expr(f"cast((place * {shards}) div n_rows AS int)"))
    slot = F.col("place") - F.expr(f"(shard * n_rows + {shards - 1}) div {shards}")
    return with_rows(placed.select("rid", "shard", slot.alias("slot")), table).select("row.*", "shard", "slot")


def sized(docs: DataFrame) -> DataFrame:
    """Id, source, UTF-8 bytes plus 1 and checksum of every text; a null text has no bytes."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
