"""Prepare documents for training: drop toxic ones and copies, mask personal data, pack.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept. All
but the last return the columns of ``documents``.

In all stages a null text counts as empty, texts of any length are worked on whole, and an
empty table gives an empty result; rows without an id are judged like others. Repeated rows are
scored alike, and one of them is left by ``exact_dedup``. Columns may have any names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import pii, toxicity
from shelfmark.llm.common import staged
from shelfmark.llm.exact_dedup import keep_one_copy
from shelfmark.llm.near_dup import keep_one_of_each
from shelfmark.llm.packing import pack_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by a lexicon learned from ``labels``; empty ones stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of texts equal but for the case of A-Z; of all empty texts one stays."""
    return keep_one_copy(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each component of documents alike by four fifths of their five-word shingles; texts
    without words and rows without an id stay."""
    return keep_one_of_each(docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; every document stays, a null text as null."""
    return pii.mask_pii(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens; an empty text has its closing id only."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("pii", mask_pii),
    ("packing", packing),
]

#: Trained scores, minhashes and token ids are beyond SQL; the tests compare the rows with a
#: brute-force version on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that every stage keeps."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
