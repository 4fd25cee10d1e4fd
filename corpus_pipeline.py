"""A corpus from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes
each as Parquet to the shared folder and gives the next one what it reads back.
All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import decontaminate, language_crf, near_dups, packing
from tallyloom.llm.common import Work, table
from tallyloom.llm.registry import vocabulary


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that no learned language fits: texts without a letter, null ones too, and unusual letters.

    Every row is judged by its own text, so repeated rows, null doc_ids and ids
    of several texts stay or go alike.  Without a label every row stays; an
    empty table stays empty.  All columns are kept, whatever their names.
    """
    return language_crf.keep_written(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: similarity 0.8 or more on five-word shingles.

    That of the smallest doc_id stays, of equal ones any one row.  Every row is a
    document of its own, so a doc_id loses no text that no other row stands
    for.  Null doc_ids, null texts and texts without a word all stay; an empty
    table stays empty.
    """
    return near_dups.deduplicate(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold an item of the benchmark, within its edit budget.

    Null and empty texts and items hold nothing and are found nowhere.  Repeated
    rows and null doc_ids go by their texts; without items every row stays.
    """
    return decontaminate.without_leaks(spark, docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences of 2048 tokens.

    A null or empty text is one piece, its end id.  Every row has its own place,
    repeated ones too; an empty table gives none.
    """
    return packing.pack_documents(spark, docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the learned and the packed; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    work = Work(spark, "pipeline")
    for name, stage in STAGES:
        docs = work.save(stage(spark, docs, sf_dir), name)
    return docs
