"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import ngram_join, packing, pii, quality, repeats
from ledgerlens.llm.common import DOCUMENT_COLUMNS, stored, table
from ledgerlens.llm.queries import WORD_VOCABULARY

NEAR_DUPLICATES = ngram_join.Likeness(words=5, share=80, share_of=100)


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*DOCUMENT_COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones; it learns from all labelled documents it may."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep_good(_columns(docs), model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of every group of near-duplicates."""
    return ngram_join.one_of_each(_columns(docs), ngram_join.linked_groups(docs, NEAR_DUPLICATES))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur more than once; n_chars stays that of the original."""
    return repeats.remove_repeats(_columns(docs))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask_documents(_columns(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(WORD_VOCABULARY))


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram jaccard join", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


# The classifier, the sets' links and the tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None
