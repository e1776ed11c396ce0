"""Registered queries of the numbered operators, with production parameters, and their SQL.

Each query reads its whole tables. ``ORACLE`` has the SQL of those that SQL can express; the
others are tested against brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tankflow.llm import (clusters, hostrules, language, mixing, pieces, pii, resample, simhash, suffixes, tokenfiles,
                          toxicity, urlrules, winnowing)
from tankflow.llm.common import prepare, table
from tankflow.llm.sql import ORACLE  # noqa: F401

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def put(f):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(prepare(spark), sf_dir)
        query.__name__, query.__doc__ = name, f.__doc__
        REGISTRY[name] = query
        return f
    return put


@register("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity, grade and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@register("op2_url_filters")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, fixed rule and verdict of every page, and the mined rule that matches."""
    return urlrules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@register("op3_pii")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of base spans, and all spans."""
    docs = table(spark, sf_dir, "documents")
    return pii.report(docs, pii.train(docs))


@register("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, size and checksum of every document's ids, read back from the written files."""
    return tokenfiles.read(spark, tokenfiles.write(table(spark, sf_dir, "documents"), WORD_TOKENIZER, END_ID))


@register("op5_host_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word statistics, base verdict and host verdict of every document."""
    found = hostrules.judge(table(spark, sf_dir, "documents"))
    return found.drop("host").withColumn("host_rate", F.round("host_rate", 9))


@register("op6_language")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; those whose id's crc32 leaves 2 by 4 aren't learned from."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return language.identify(docs, language.train(docs.where(~held_out)), extra={"held_out": held_out})


@register("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, and the smallest id that its links reach."""
    return simhash.group(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


@register("op8_suffix_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated bytes of every document, and the digest of what is left without them."""
    return suffixes.deduplicate(table(spark, sf_dir, "documents"))


@register("op9_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item, and the items."""
    found = winnowing.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@register("op10_sentencepiece")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by the merge agenda, and their decoded text, as digests."""
    return pieces.round_trip(table(spark, sf_dir, "documents"), PIECE_MODEL)


@register("op11_clusters")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and final centroid of every usable vector."""
    return clusters.cluster(table(spark, sf_dir, "embeddings"))


@register("op12_resample")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank in the draw of every document, towards the benchmark's words."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op13_mix")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a mix of all sources by weight takes."""
    return mixing.mix(table(spark, sf_dir, "documents"))
