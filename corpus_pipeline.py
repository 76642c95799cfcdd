"""From raw documents to packed training sequences, in stages that each write their rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import cotrain, decontaminate, langid, minhash, packing
from tidemill.llm.base import small_batches, stored
from tidemill.llm.queries import SEQUENCE, WORD_BPE
from tidemill.session import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier finds good."""
    small_batches(spark)
    return cotrain.keep_good(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is identified."""
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return minhash.keep_first(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten words in a row of a benchmark item.  With no coverage allowed, a document that holds
    some goes as a whole."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), coverage_limit=0.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of all documents left, in as few sequences as can be."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path(WORD_BPE), SEQUENCE), SEQUENCE)


STAGES = [("quality", quality), ("language", language), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", pack)]
#: the classifiers can't be written in SQL; tests/llm/test_pipeline.py holds the stages against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
