"""Corpus pipeline over ``documents``: language ID, exact dedup, n-gram Jaccard join, best-fit packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roaskit.llm import exact_dedup, jaccard, langid, packing
from roaskit.llm.common import Scratch, table, texts_in_slices


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents in which no language can be told (no text, or no letter in it)."""
    texts_in_slices(spark)
    return langid.keep_told(docs, langid.fit(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    texts_in_slices(spark)
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, one row with the smallest id stays."""
    texts_in_slices(spark)
    return jaccard.drop_near_duplicates(docs, words=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every document's tokens in sequences of 2048."""
    texts_in_slices(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language), ("exact_dedup", exact_copies), ("ngram_jaccard", near_copies),
          ("best_fit_packing", pack)]

#: A trained network and token ids are not SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
