"""The registered queries of this subpackage, over whole tables, and the SQL that some of them are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, digest, extract, langid, lmscore, merkle, mixing, neighbours, phrases, quotes, simhash, urlfilter, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score(table(spark, sf_dir, "documents"))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.digests(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's messages hold no quotes, so they are first turned into mail that quotes, all of them."""
    return quotes.link_quotes(quotes.quoted_mail(table(spark, sf_dir, "conversations")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(table(spark, sf_dir, "documents"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_simhash_near_dedup, op2_url_filters, op3_lm_scoring, op4_document_fingerprints, op5_benchmark_decontamination, op6_warc, op7_html_extraction, op8_chat_formatting, op9_language_id, op10_mixing_sources, op11_phrase_collocations, op12_merkle_manifest, op13_nearest_neighbours)}
ORACLE_SQL = {"op2_url_filters": urlfilter.oracle(), "op5_benchmark_decontamination": decontaminate.ORACLE, "op6_warc": warc.ORACLE, "op7_html_extraction": extract.ORACLE, "op8_chat_formatting": quotes.ORACLE, "op10_mixing_sources": mixing.ORACLE, "op11_phrase_collocations": phrases.ORACLE, "op12_merkle_manifest": merkle.ORACLE}
