"""Corpus pipeline: five stages from documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return the columns of
``documents``. ``run`` writes what a stage returns as Parquet in the shared folder and reads it back for the next one.
Null and empty texts are rejected by the first stage, so later stages see texts only; repeated rows are one document from
the second stage on; extra columns pass through until packing; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cutline.llm import exact_dedup, mixing, ngram_join, packing, quality
from cutline.llm.common import stored, table
from cutline.llm.queries import vocabulary

#: Share of the kept tokens that mixing aims for, and how far its targets flatten the marginals.
MIX_RATE, MIX_POWER = 0.9, 0.9


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity their language's threshold allows."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest doc_id."""
    return ngram_join.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample that meets the target shares of source, language and topic."""
    return mixing.sample(docs, power=MIX_POWER, rate=MIX_RATE)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of 2,048 tokens, with their ids."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), end_id=1, window=2048)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("n-gram Jaccard join", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can't express the language model, the randomised join or the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
