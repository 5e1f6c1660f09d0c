"""From raw documents to token ids in five stages; each is written as Parquet and read again as the next one's input.

A stage takes (spark, docs, sf_dir) and returns a DataFrame: all but the last the rows of documents that stay, with
their columns, the last one row a document with its tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.llm.bpe import decoded, encoded
from caudal.llm.common import importable, stored, table
from caudal.llm.containment import without_contained
from caudal.llm.cotraining import good
from caudal.llm.exact_dedup import without_duplicates
from caudal.llm.simhash_dedup import without_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier finds good."""
    return good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return without_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (fingerprints of four-word shingles that link at four or fewer differing bits) the
    document with the smallest doc_id."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return without_contained(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each document, and the text they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return decoded(encoded(docs, path, public_tokenizers.PATTERN), path).select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: The classifier and the fingerprints can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
