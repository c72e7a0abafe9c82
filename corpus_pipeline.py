"""From raw documents to packed training batches.

Stages work on all rows their predecessor kept: poor texts go, then copies, then near copies, then passages that repeat
in what is left; the last stage deals the remaining texts into batches of nearly equal lengths. Every stage is written
to the shared folder and read back, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import exact_dedup, packing, quality, simhash, suffix_dedup
from tidemill.llm.common import small_batches
from tidemill.session import written

PASSAGE = 250  # bytes; some fifty words, short of a long sentence that two authors may share
PASSAGE_WORDS = 51  # words that make a passage in fewer bytes, too


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents the quality score does not reject.

    Missing, empty and very long texts are scored like others; equal rows stay or go together; no rows give no rows.
    """
    small_batches(spark)
    return quality.kept_documents(spark, docs, folder)


def without_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document with the smallest doc_id of all that are equal but for white space.

    A missing text equals an empty one; missing doc_ids come last; of repeated rows one stays; no rows give no rows.
    """
    return exact_dedup.kept_documents(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group linked by fingerprints at most two bits apart.

    Texts without words are one group; the smallest doc_id stays, missing ones come last; no rows give no rows.
    """
    small_batches(spark)
    return simhash.kept_documents(docs, simhash.SHINGLE)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, later copies of repeated passages cut out of their texts.

    The first copy in the order of doc_id stays; a missing text stays missing; no rows give no rows.
    """
    small_batches(spark)
    return suffix_dedup.cleaned_documents(docs, PASSAGE, words=PASSAGE_WORDS)


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Where each piece of each text stands in the batches.

    A missing or empty text is one piece of length 0, a long one is cut into several; no rows give no rows.
    """
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("suffix-array dedup", without_repeated_passages),
    ("packing", packed),
]

ORACLE_SQL = None  # SQL expresses neither the classifier nor the boundaries of the buckets


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, folder), name.replace(" ", "-"))
    return docs
