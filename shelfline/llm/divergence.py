"""Divergence of the sources of a language from one another, over cubes of counts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfline.llm.common import prepare, written
from shelfline.llm.tally import HELD, pieces, summed

LEAST_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
# Groups along one side of a cell and terms along its depth, about.
GROUPS = 16
TERMS = 1_024
# Letters: A-Z in lower case, a-z and all bytes of other alphabets; the rest separates.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents that hold the term."""
    # Null texts, languages and sources are empty ones.
    texts = docs.select(_named(docs, "lang"), _named(docs, "source"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, Counter] = {}
        holders: dict[tuple, Counter] = {}
        held = 0

        def sums() -> Iterator[pa.RecordBatch]:
            for (lang, source), terms, ns in summed(counts):
                found_in = holders[lang, source]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang, pa.string()), len(terms)), pa.repeat(pa.scalar(source, pa.string()), len(terms)),
                     pa.array(terms, pa.binary()), pa.array(ns, pa.int64()), pa.array([found_in[t] for t in terms], pa.int64())],
                    ["lang", "source", "term", "n", "docs"],
                )

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = counts.setdefault((lang, source), Counter())
                before, seen = len(own), set()
                for words in pieces(text.translate(LETTERS)):
                    own.update(words)
                    seen.update(words)
                holders.setdefault((lang, source), Counter()).update(seen)
                held += len(own) - before
                if held >= HELD:
                    yield from sums()
                    counts, holders, held = {}, {}, 0
        yield from sums()

    prepare(docs.sparkSession)
    found = texts.mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    return (
        found.groupBy("lang", "source", F.col("term").cast("string").alias("term"))
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def _named(docs: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def _smoothed(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)) in whole numbers of any size."""
    above = (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (total + 2 * terms).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def _cell(key: tuple, rows: pa.Table) -> pa.Table:
    """Partial divergences of all pairs of a group block and another, over a block of terms.

    Every row is a slice: a group with its probabilities of the terms that it has, the
    others have ``p_none``. Pairs within a block are taken once.
    """
    lang, side, other = (key[i].as_py() for i in range(3))
    names = rows.column("source").to_pylist()
    blocks = rows.column("block").to_pylist()
    width = rows.column("n_terms")[0].as_py()
    p = np.repeat(np.array(rows.column("p_none").to_pylist(), np.int64)[:, None], width, axis=1)
    for i, entries in enumerate(rows.column("entries")):
        if entries.is_valid and len(entries.values):
            at, value = entries.values.flatten()
            p[i, at.to_numpy() - 1] = value.to_numpy()
    order = sorted(range(len(names)), key=lambda i: (blocks[i], names[i]))
    a, b, value = [], [], []
    for k, i in enumerate(order):
        partners = order[k + 1 :] if side == other else [j for j in order if blocks[i] == side and blocks[j] == other]
        # Differences are below SCALE + 2, so that their squares fit 64 bits.
        for first in range(0, len(partners), GROUPS):
            some = partners[first : first + GROUPS]
            apart, both = p[some] - p[i], p[some] + p[i]
            value += (apart * apart // both).sum(1).tolist()
            a += [names[i]] * len(some)
            b += [names[j] for j in some]
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "value": pa.array(value, pa.int64())})


def divergence(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, group_block: int = GROUPS, term_block: int = TERMS
) -> DataFrame:
    """How far the sources of each language are apart, and the terms that mark a source.

    Returns ``lang, source, part, item, value, rank``. A language keeps the terms that occur
    in at least ``least_docs`` of its documents. A group is a source within a language; its
    smoothed whole-number probability p of a kept term is compared by
    floor((p - q)^2 / (p + q)). Part ``pair`` ranks all other groups of the language by the
    sum of it over all kept terms; part ``term`` ranks the ``top`` terms that are likelier in
    the group than in the language.

    Pairs of groups and terms span a cube. A task owns the cell (group block, group block,
    term block): every slice, a group's probabilities in one term block, is replicated to the
    cells of its group block, the cells give partial sums, and those are added up along the
    term axis. A cell has some ``2 * group_block * term_block`` numbers. Counts are summed in
    the tasks that read the texts, so that a hot source or term is a few rows a task.

    Null texts, languages and sources are empty ones; a group without terms, or of a language
    that keeps none, has pairs too (in the latter case of value 0). Equal values are ordered
    by the item's UTF-8 bytes, repeated rows count as often as they stand there, other
    columns are ignored, an empty table gives no rows.
    """
    counts = written(term_counts(docs), "term-counts")
    totals = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    totals = written(totals.where(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    groups = docs.select(_named(docs, "lang"), _named(docs, "source")).distinct()
    vocabulary = totals.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_n"))
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(vocabulary, "lang", "left").na.fill(0, ["terms", "lang_n"])
    blocks = lambda n, size: F.greatest(F.ceil(n / F.lit(float(size))), F.lit(1)).cast("long")
    langs = written(
        langs.withColumns({"term_blocks": blocks(F.col("terms"), term_block), "group_blocks": blocks(F.col("sources"), group_block)}),
        "languages",
    )
    # Terms get a number within their block.
    inside = W.partitionBy("lang", "part").orderBy("term")
    kept = totals.join(langs, "lang").withColumn("part", F.pmod(F.xxhash64("term"), "term_blocks"))
    kept = written(
        kept.withColumn("at", F.row_number().over(inside)).select(
            "lang", "term", "part", "at", _smoothed(F.col("total"), F.col("lang_n"), F.col("terms")).alias("q")
        ),
        "numbered-terms",
    )
    found = written(counts.drop("docs").join(kept, ["lang", "term"]), "found-terms")
    sums = found.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = groups.join(sums, ["lang", "source"], "left").na.fill(0, ["group_n"]).join(langs, "lang")
    groups = written(
        groups.select(
            "lang", "source", "group_n", "terms", "term_blocks", "group_blocks",
            F.pmod(F.xxhash64("source"), "group_blocks").alias("block"),
            F.when(F.col("terms") > 0, _smoothed(F.lit(0).cast("long"), F.col("group_n"), F.col("terms"))).otherwise(F.lit(0)).alias("p_none"),
        ),
        "groups",
    )
    likely = found.join(groups.select("lang", "source", "group_n", "terms"), ["lang", "source"])
    likely = likely.withColumn("p", _smoothed(F.col("n"), F.col("group_n"), F.col("terms")))
    pairs = _pairs(likely, groups, kept)
    apart = F.expr("(p - q) * (p - q) div (p + q)")
    marks = likely.where("p > q").select("lang", "source", F.col("term").alias("item"), apart.alias("value"))
    ranked = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(ranked).alias("rank")
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank).unionByName(
        marks.select("lang", "source", F.lit("term").alias("part"), "item", "value", rank).where(F.col("rank") <= top)
    )


def _pairs(likely: DataFrame, groups: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every group and every other one of its language."""
    entries = likely.groupBy("lang", "source", "part").agg(F.collect_list(F.struct("at", "p")).alias("entries"))
    widths = kept.groupBy("lang", "part").agg(F.count("*").cast("int").alias("n_terms"))
    # A slice of every group for every block, with entries or without.
    slices = groups.withColumn("part", F.explode(F.expr("sequence(0L, term_blocks - 1)")))
    slices = slices.join(entries, ["lang", "source", "part"], "left").join(widths, ["lang", "part"], "left").na.fill(0, ["n_terms"])
    placed = slices.withColumn("partner", F.explode(F.expr("sequence(0L, group_blocks - 1)"))).select(
        "lang", F.least("block", "partner").alias("side"), F.greatest("block", "partner").alias("other"), "part",
        "source", "block", "p_none", "n_terms", "entries",
    )
    partial = placed.groupBy("lang", "side", "other", "part").applyInArrow(_cell, "lang string, a string, b string, value long")
    whole = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return whole.select("lang", "value", F.inline(ways))
