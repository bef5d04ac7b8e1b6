"""The corpus pipeline: documents to token ids, one operator per stage.

Each stage takes (spark, docs, sf_dir), works on every row that the stage before kept, and returns
a DataFrame; it is written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm import bpe, mixing, preference, simhash, substrings
from sparkwright.llm.common import materialise, read_documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled rows among them."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return preference.keep_good(docs.select(*COLUMNS), preference.train(docs, labels))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of fingerprints within 3 bits (3-word shingles)."""
    return simhash.keep_one(docs.select(*COLUMNS), shingle=3, most=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 13-word runs that start in a smaller document; every row stays, n_chars
    is that of the new text."""
    cut = substrings.remove_repeats(docs, 13, keep_layout=True, carry=("lang", "source"))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn under the raked source, language and topic weights."""
    return mixing.keep_sampled(docs.select(*COLUMNS))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_classifier", quality_classifier), ("simhash_dedup", simhash_dedup),
          ("substring_dedup", substring_dedup), ("source_mixing", source_mixing),
          ("bpe_encoding", bpe_encoding)]

#: Fingerprint classes, suffix trees and byte-pair encoding have no plain SQL; tests compare the
#: pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
