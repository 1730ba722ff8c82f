"""A corpus pipeline: toxic documents go, boilerplate lines go, one of each group of near copies stays, documents with
benchmark passages go, and the rest is encoded.

Each stage reads what its predecessor wrote to the shared folder, so a lost executor costs part of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridwarden.llm.bpe import bpe_query
from gridwarden.llm.common import stored, table
from gridwarden.llm.decontaminate import decontaminate
from gridwarden.llm.line_dedup import drop_boilerplate
from gridwarden.llm.ngram_join import one_of_each
from gridwarden.llm.toxicity import clean_documents

#: Lines on more than this share of a host's pages go, at every size.
LINE_RATIO = 0.02


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_boilerplate(docs, ratio=LINE_RATIO)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_query(spark, sf_dir, docs)


#: (name, function of session, documents and the tables' folder); all but the last return the columns of documents.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("BPE encoding", encoding),
]

#: A trained network and a tokenizer can't be expressed in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
