"""From documents to packed training sequences, in four stages.

Each stage takes what its predecessor kept; all but the last return the columns
of ``documents``. A stage reads its own input only, so a language is learnt from
the documents that are still there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from openroles.llm import jaccard, language, packing, quality_rules
from openroles.llm.common import table, written
from openroles.llm.queries import tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy in force keeps."""
    return quality_rules.keep(docs)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognized, by profiles learnt from ``docs``."""
    return language.keep(docs, language.learn(docs))


def first_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of linked ones."""
    return jaccard.keep_first(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their token ids, sequence and place."""
    return packing.place(packing.pieces(docs, tokenizer_file("byte_bpe_50k.json")))


STAGES = [("quality_rules", quality), ("language_id", known_language), ("ngram_jaccard_join", first_of_copies),
          ("best_fit_packing", packed)]

#: Vector profiles and packing have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
