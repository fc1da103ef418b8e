"""A training-data pipeline over ``documents``: five stages, each one operator of ``roadspark.llm``.

Every stage works on all rows that its predecessor kept, and what it rejects is gone. All but
the last return the columns of ``documents``; between stages the rows are Parquet files in
the shared folder.

1. quality: scores by pairwise ranking, learned from ``labels``; rejected documents go.
2. language: cross-parsing language ID; documents of no known language go.
3. near_duplicates: one document of each group of near copies stays.
4. decontamination: documents with passages of ``benchmark`` go.
5. sentencepiece: token ids of what is left, as digests of ids, byte spans and decoded text.

Nulls, empty texts, repeated rows and empty tables have the results that each operator's
docstring states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roadspark.llm import decontam, langid, neardup, pieces, quality
from roadspark.llm.common import saved, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs, langid.train(docs))


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicate(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_duplicates", keep_one_of_copies),
    ("decontamination", keep_uncontaminated),
    ("sentencepiece", to_pieces),
]

#: SQL cannot express the stages; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
