"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``docs`` as they came.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkrank.llm.langid import keep_identified, learn_languages
from sparkrank.llm.line_dedup import line_dedup
from sparkrank.llm.packing import pack_documents
from sparkrank.llm.simhash import drop_near_duplicates
from sparkrank.llm.suffix_dedup import drop_repeated_strings
from sparkrank.sources.scratch import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; those without a letter or in doubt go."""
    return keep_identified(docs, learn_languages(docs, public_tokenizers.path("piece_bpe_32k.model")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has are cut out of ``text``."""
    return line_dedup(docs, report=None)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Groups are components of SimHash fingerprints (three-word shingles) at 2 or fewer differing bits.
    Null and blank texts are one group.
    """
    return drop_near_duplicates(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that an earlier document has are cut out of ``text``."""
    return drop_repeated_strings(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 1024 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_strings),
    ("best_fit_packing", packing),
]

# XXH64 fingerprints and their components have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
