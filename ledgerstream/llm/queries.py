"""The operators with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstream.llm import collocations, decontam, htmltext, langid, licences, lm, manifest, mixing, sharding, simhash, suffixes, urls, vectors
from ledgerstream.llm.common import remainder

SHARDS = 40


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repeated so that a source weighs the square root of its size, in random order."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op2_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(_table(spark, sf_dir, "documents"), SHARDS)


def op3_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _table(spark, sf_dir, "pages").select("page_id", "url", htmltext.extract(F.col("html")).alias("text"))
    return text.select("*", F.char_length("text").cast("long").alias("n_chars"))


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _table(spark, sf_dir, "documents").select("doc_id", licences.scan(F.col("text")).alias("found"))
    return found.select("doc_id", "found.*")


def op5_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each benchmark item that a document holds."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.with_matches(docs, _table(spark, sf_dir, "benchmark"), "held").select("doc_id", F.inline("held"))


def op7_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"))


def op8_gru_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"), remainder("doc_id", 7) == 2)


def op9_simhash_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_hyperdimensional_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang",
                                                     (remainder("doc_id", 5) == 0).alias("held_out"))
    found = langid.identify(docs, docs.filter("not held_out"))
    return docs.select("doc_id", "held_out", found.alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score")


def op11_collocation_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(_table(spark, sf_dir, "documents"), manifest.tampered())


def op13_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_poisson_mixing, op2_byte_shards, op3_tag_path_text, op4_licence_scan, op5_learned_partitions,
        op6_cgk_decontamination, op7_url_verdicts, op8_gru_scores, op9_simhash_index,
        op10_hyperdimensional_langid, op11_collocation_tiles, op12_merkle_manifest,
        op13_suffix_repeats)}
