"""A training corpus from the documents table: five stages, each an operator of tracelark.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the caller
writes it and hands the table read back to the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tracelark.llm.decontaminate import without_contaminated
from tracelark.llm.language import identified
from tracelark.llm.neardup import one_of_each
from tracelark.llm.packing import pack
from tracelark.llm.pii import sanitised
from tracelark.llm.tables import written

TOKENIZER = "word_bpe_49k.json"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the field can tell; texts without letters go."""
    return identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts that share 0.8 of their runs of five words: the one with the smallest id."""
    return one_of_each(docs, width=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and terms that give it away replaced in their texts."""
    return sanitised(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 tokens, each window the mixture of sources of what is left."""
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("private_data", private_data),
    ("packing", packing),
]

#: Training the language field and tokenising can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, with what each keeps written for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
