"""From raw documents to packed training sequences, stage by stage.

Quality rules, exact copies, near copies, repeated passages, packing. Each stage works on all that
the one before kept; between stages the documents are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from telemill.acceptance.registry import with_shared_folder
from telemill.llm import exact_dedup, ngram_join, packing, quality, repeats
from telemill.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.quality_filter(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, that with the largest id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links connect, that with the smallest id."""
    return ngram_join.drop_near_copies(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document, or they themselves before, have.
    A document with nothing left goes."""
    return repeats.drop_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    names = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    return packing.packed_documents(docs, *map(public_tokenizers.path, names))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", packed),
]

#: SQL has no word for several stages; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


@with_shared_folder
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
