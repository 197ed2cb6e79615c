"""From raw documents to packed training sequences: the stages, in order, on Parquet between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tempora.llm import queries
from tempora.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in which no language has a clear share of the words, go."""
    return queries.in_known_language(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies stays, that of the smallest doc_id."""
    return queries.one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts."""
    return queries.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets get surrogates."""
    return queries.with_surrogates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences, one row for each piece of a document."""
    return queries.packed(docs)


STAGES = [("language", language), ("near_copies", near_copies), ("decontaminate", decontaminate), ("surrogates", surrogates), ("pack", pack)]
#: Learned models, random hashes and tokenizers are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
