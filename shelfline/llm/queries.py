"""Registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import (
    decontaminate, divergence, licenses, mixing, pages, quality, secrets, shards, simhash, spelling, tokens, topk, urls,
)
from shelfline.llm.common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        prepare(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_license_scan(spark, folder):
    return licenses.license_scan(table(spark, folder, "documents"))


@query
def op2_quality_classifier(spark, folder):
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_decontamination(spark, folder):
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("spans")


@query
def op4_token_counts(spark, folder):
    return tokens.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op5_sharding(spark, folder):
    return shards.interleave(shards.sized(table(spark, folder, "documents")), 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op6_exact_top_k(spark, folder):
    return topk.top_k(table(spark, folder, "embeddings"))


@query
def op7_html_extraction(spark, folder):
    return pages.main_texts(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op8_source_mixing(spark, folder):
    return mixing.mix(table(spark, folder, "documents")).withColumn("target", F.round("target", 6))


@query
def op9_secret_scan(spark, folder):
    return secrets.secret_scan(table(spark, folder, "documents"))


@query
def op10_simhash_near_dedup(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op11_source_divergence(spark, folder):
    return divergence.divergence(table(spark, folder, "documents"))


@query
def op12_spelling_variants(spark, folder):
    return spelling.spelling_variants(table(spark, folder, "documents"))


@query
def op13_url_filter(spark, folder):
    return urls.url_verdicts(table(spark, folder, "pages"))
