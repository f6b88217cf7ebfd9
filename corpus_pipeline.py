"""A training-corpus pipeline over ``documents``: each stage is written as Parquet and reread by the next.

Every stage works on all documents its predecessor kept; all but the last return the columns of
``documents``. Null texts count as empty; repeated rows are documents of their own until a stage that
deduplicates, which keeps one of them; an empty table passes through as an empty table. Very long texts go through every
stage whole; extra columns stay with their rows up to packing, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm.common import table, written
from ledgerlake.llm.exact_dedup import keep_first
from ledgerlake.llm.mixing import mixed
from ledgerlake.llm.ngram_join import keep_one
from ledgerlake.llm.packing import pack
from ledgerlake.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose sentence scores combine to 0.5 or more go; the model learns from ``labels``."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (up to runs of white space) the row of the smallest doc_id stays."""
    return keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 of their 5-word shingles that of the smallest doc_id stays."""
    return keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: whole copies, and the Pareto order sample for one more."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 ids: doc_id, start, length, ids, doc_tokens, sequence_id, offset."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", packing),
]

# a trained classifier, connected components and a tokenizer are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
