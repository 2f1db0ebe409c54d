"""Corpus pipeline: quality rules, quality classifier, near-duplicate removal, mixing, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.llm import cotraining, mixing, near_dedup, pieces, quality_rules
from tramline.llm.common import materialise, table
from tramline.llm.queries import PIECE_MODEL


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and aren't depleted, without lines that are frequent over their source."""
    return quality_rules.clean(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier finds good."""
    return cotraining.kept(docs.select("doc_id", "text", "lang", "source", "n_chars"), table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8)."""
    return near_dedup.deduplicated(docs.select("doc_id", "text", "lang", "source", "n_chars"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time that a document is taken, and for parts of documents at the ends of runs of blocks."""
    return mixing.mixed(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every row of the mix."""
    return pieces.encode(docs, PIECE_MODEL)


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("near-duplicates", near_dedup_stage),
    ("mixing", mixing_stage),
    ("tokens", tokens_stage),
]

#: Fitting a classifier and sampling segmentations can't be said in SQL; the tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written in the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs)
    return docs
