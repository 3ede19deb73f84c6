"""The corpus pipeline: quality, near-duplicates, repeated passages, source mix, packing.

Every stage takes (spark, docs, sf_dir) and all that the one before it kept; the runner writes each
result as Parquet and reads it back for the next. All stages but the last return the columns of
``documents``. None of them can be stated in SQL as a whole, so each is tested against a plain version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from silverlode.llm import mixing, order_minhash, packing, paragraphs, quality
from silverlode.llm.frames import small_batches, stored, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the discriminant, learnt from ``labels``, rejects."""
    small_batches(spark)
    _, model = quality.learnt(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of every class of near copies."""
    small_batches(spark)
    return order_minhash.first_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document holds; n_chars follows the text."""
    small_batches(spark)
    return paragraphs.without_passages(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents by their raked source, language and topic weights."""
    small_batches(spark)
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the token pieces of what is left into sequences of 4096."""
    small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 1, 4096)


STAGES = [
    ("quality classifier", classify),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", passages),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

# Order MinHash, the discriminant and the packing plan are not SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
