"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import before_in_group, hashable, numbered, order_key, over_batches, with_rows

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
EPOCHS = 2


def _sized(docs: DataFrame, kept: list[str], seed: int) -> DataFrame:
    """The kept columns as ``row``, with the words, the key and the source of every document.

    Texts are read once and the result is written, so that later passes read a few numbers.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("source", F.lit("")).alias("src"),
        F.col("source").isNull().alias("no_src"),
        order_key(seed, F.col("doc_id")).alias("key"),
        F.xxhash64(*hashable(docs, docs.columns)).alias("tie"),
    )

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            # Bytes are split at ASCII white space, as a size is defined.
            sizes = [len(t.encode("utf-8", "replace").split()) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), *batch.columns[2:], pa.array(sizes, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["row", "src", "no_src", "key", "tie", "size"])

        return run

    fields = [f for f in rows.schema.fields if f.name != "text"]
    shape = T.StructType([*fields, T.StructField("size", T.LongType())])
    return numbered(over_batches(rows, make, shape), "sizes")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, epochs: float) -> DataFrame:
    """The words wanted from each source.

    ``sizes`` has one row per source (``no_src``, ``src``, ``size_total``). Weights repeat
    over the sources in code point order, null last. All targets sum to ``share`` times all
    words, but none is above ``epochs`` times its source: with a level v, a source gets
    min(cap, weight * v). Sources in order of cap / weight are full one after another, and
    the level that is left for the rest is highest where the first one is not full.
    """
    named = W.orderBy("no_src", "src")
    listed = sizes.withColumn("turn", (F.row_number().over(named) - 1) % len(weights))
    listed = listed.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("turn").cast("int") + 1))
    listed = listed.withColumn("cap", F.col("size_total") * F.lit(float(epochs)))
    filled = W.orderBy(F.col("cap") / F.col("weight"), "no_src", "src")
    upto, everything = filled.rowsBetween(W.unboundedPreceding, W.currentRow), W.partitionBy()
    left = F.sum("size_total").over(everything) * F.lit(float(share)) - (F.sum("cap").over(upto) - F.col("cap"))
    rest = F.sum("weight").over(everything) - (F.sum("weight").over(upto) - F.col("weight"))
    level = listed.withColumn("level", left / rest)
    level = level.withColumn("level", F.max("level").over(everything))
    return level.select("no_src", "src", F.least(F.col("cap"), F.col("weight") * F.col("level")).alias("target"))


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = 8
) -> DataFrame:
    """How many words of every document a mixture by source weights takes.

    Returns ``doc_id, size, source_size, target, taken``. Documents of a source stand in a
    fixed random order; running word counts ahead of each give its place. A source's budget
    (its target in whole words) takes whole rounds over the source first and then the
    documents in order, the last one in part. ``taken`` counts words, repeats included.

    Null or empty texts have size 0 and are never taken; a null source is one source, last
    in order; equal ids are ordered by size and then by the hash of the row, so that a rerun
    can exchange equal rows only. An empty table gives no rows; other columns are ignored.
    """
    taken = _taken(_sized(docs, ["doc_id"], seed), "row", weights, share, epochs)
    return taken.select("row.doc_id", "size", "source_size", "target", "taken")


def _taken(rows: DataFrame, kept: str, weights: Sequence[float], share: float, epochs: int) -> DataFrame:
    sizes = rows.groupBy("no_src", "src").agg(F.sum("size").alias("size_total"))
    targets = source_targets(sizes, weights, share, epochs)
    rows = rows.select(kept, "no_src", "src", "key", "tie", "size")
    joined = before_in_group(rows, ["no_src", "src"], "key", ["size", "tie"], {"size": "size"}, targets, lead=("size",))
    joined = joined.withColumn("budget", F.floor(F.col("target") + 0.5).cast("long"))
    joined = joined.withColumn("rounds", F.when(F.col("size_total") > 0, F.expr("budget div size_total")).otherwise(F.lit(0)))
    joined = joined.withColumn("rest", F.col("budget") - F.col("rounds") * F.col("size_total"))
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("size_before")))
    return joined.select(
        kept, "size", F.col("size_total").alias("source_size"), "target",
        (F.col("rounds") * F.col("size") + extra).cast("long").alias("taken"),
    )


def mixed(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = 8
) -> DataFrame:
    """The documents of the mixture, each repeated as often as it is taken.

    Texts are never cut: a document taken in part is kept whole when at least half of it is
    taken. Columns stay as they are; empty documents, which no budget counts, are left out
    with the documents that are not taken. Null sources, equal ids and repeated rows are treated
    as in ``mix``; an empty table stays empty.
    """
    rows = _sized(docs, docs.columns, seed)
    taken = _taken(rows, "rid", weights, share, epochs).where("size > 0")
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    copies = with_rows(taken.select("rid", times.alias("times")).where("times > 0"), rows)
    return copies.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
