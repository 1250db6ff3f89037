"""From raw documents to packed training sequences: quality rules, language, exact and near copies, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; all but the last return
the columns of documents. ORACLE_SQL is None: SQL can express neither the network nor the tokenizer.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from videonet.llm import exact_dedup, language_id, packing, quality_rules, simhash
from videonet.llm.common import settle, table

ORACLE_SQL: str | None = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the thresholds of their language and source."""
    return quality_rules.keep_good(docs)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language_id.keep_identified(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints over four words are linked by four or fewer differing bits."""
    return simhash.drop_near_duplicates(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", good_quality),
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again by the next; its scratch tables go once it is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(spark, partial(stage, spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
