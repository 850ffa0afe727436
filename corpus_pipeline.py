"""A training-corpus pipeline: quality, exact copies, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet
and read again as the next stage's docs.

Null texts count as empty: such documents are scored, deduplicated with empty ones and packed as their end id.
Rows with a null id are never learned from or linked as near copies, and otherwise treated like any. Of repeated rows one
stays. Very long texts are taken whole. Equal scores fall on the same side of the cut. Further columns, whatever their names, pass through
all stages but the last. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samewise.llm import exact_dedup, ngram_join, packing, pairwise_quality, pii_bootstrap
from samewise.llm.common import read_table, remove, scratch_removed, shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise classifier accepts."""
    return pairwise_quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard of 0.8 or more."""
    return ngram_join.one_of_each(docs, size=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii_bootstrap.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality classifier", quality), ("exact dedup", exact_copies), ("n-gram Jaccard join", near_copies), ("PII", personal_data), ("packing", packed)]

#: Fitted weights, bootstrapped patterns and packing are beyond SQL; a test predicts run()'s rows by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; a stage's scratch and the stage before go once it is written."""
    docs, last = read_table(spark, sf_dir, "documents"), []
    for i, (_, stage) in enumerate(STAGES):
        path = shared_folder(spark, f"stage{i}")
        with scratch_removed(spark):
            stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        remove(spark, last)
        docs, last = spark.read.parquet(path), [path]
    return docs
