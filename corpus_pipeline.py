"""Corpus cleaning: language, quality, near copies, benchmark passages, source mix.

Each stage takes what its predecessor kept, written as Parquet and read again. All but the last return the columns of
documents. The last stage returns the mixed corpus: one row per draw of a document (a source may be drawn twice, so may
its documents), with the document's columns, its words, its source's size and target, and the draw's number, shard and
words taken.

Defined cases: null ids, texts, languages and sources pass as the stages' docstrings say (a text without letters goes at
the first stage); repeated rows are one row after the near-copy stage; a very long text is one row throughout; ties are
broken by each stage as it says; an empty table gives an empty result; extra columns are carried through all stages, and
those named like a column that the last stage adds give way to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableveil.llm import decontaminate, language_id, near_dedup, quality_rules, source_mix
from tableveil.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.reject(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.reject(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.reject(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.reject(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus, one row per draw: shards together, each shuffled."""
    return source_mix.emit(source_mix.mix(docs, carry=True))


STAGES = [("language_id", language), ("quality_rules", quality), ("near_dedup", near_copies), ("decontaminate", benchmark), ("source_mix", mix)]

#: Learned models and hashing have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
