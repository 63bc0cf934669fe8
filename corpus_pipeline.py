"""From raw documents to training shards; every stage reads what its predecessor wrote.

``STAGES`` in order: the quality classifier drops what it rejects, near-duplicate detection
keeps one document of each group, documents that hold test items are dropped, sources are
mixed to their target weights (whole documents, repeated by rounds), and the mixture is dealt
into shards. The stages call the operators with the parameters of their queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import decontaminate, mixing, quality, shards, simhash
from shelfline.llm.common import prepare, table, written

# Operators of these stages have no SQL form (trees, fingerprints, an automaton).
ORACLE_SQL: str | None = None
SHARDS = 16


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts.

    Null and empty texts are scored like any others, rows that repeat go or stay together,
    other columns stay as they are, and an empty table stays empty.
    """
    prepare(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that of the smallest id; null ids come last.

    Texts without words, null or empty, are one group; of equal rows one stays, and of rows
    with one id in a group the one whose hash comes first. An empty table stays empty.
    """
    prepare(spark)
    return simhash.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no window of a test item.

    Null and empty texts hold none and stay, rows that repeat go or stay together, other
    columns stay as they are, and an empty table stays empty.
    """
    prepare(spark)
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture, each as often as it is taken.

    Texts without words, null or empty, are in no mixture; a null source is a source, rows
    that repeat are rows like any others, and an empty table stays empty.
    """
    return mixing.mixed(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture with their ``shard`` and their place in it, ``slot``.

    Every row is dealt, whatever its text; columns that have these names are replaced. An
    empty table stays empty.
    """
    return shards.interleave(docs, SHARDS)


STAGES = [
    ("quality classifier", accept_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing to target weights", mix_sources),
    ("sharding", deal_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
