"""Queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import cotraining, flac, mixing, near_dedup, pieces, quality_rules, sharding, site_style_tree, url_filter, warc
from tramline.llm.common import table


#: The vocabulary file is a parameter; this is where public ones are installed.
PIECE_MODEL = os.environ.get("TRAMLINE_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op1_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.digests(flac.encode_texts(table(spark, sf_dir, "documents")))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The rules that the contract of op2 states.
URL_RULES = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style_tree.extract(table(spark, sf_dir, "pages"))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.resolve(warc.captures_of(table(spark, sf_dir, "pages")))
    return out.select("record_id", "canonical_url", F.unix_timestamp("date").alias("date_s"), "refers_to", "verdict", warc.header_text(F.col("headers")).alias("headers"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.groups(table(spark, sf_dir, "documents"), k=3, percent=85)
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shuffled(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_media_columns": op1_media_columns,
    "op2_url_filter": op2_url_filter,
    "op3_html_extraction": op3_html_extraction,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_near_dedup": op6_near_dedup,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_mixing": op8_mixing,
    "op9_sharding": op9_sharding,
    "op10_quality_rules": op10_quality_rules,
}

SQL: dict[str, str] = {
    "op6_near_dedup": near_dedup.ORACLE_SQL,
    "op7_warc_revisits": warc.ORACLE_SQL,
    "op8_mixing": mixing.ORACLE_SQL,
    "op10_quality_rules": quality_rules.ORACLE_SQL,
}
