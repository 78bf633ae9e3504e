"""Documents to packed training sequences, in four stages.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and gives a DataFrame that is
written as Parquet and read again as the next one's docs. The first three give the columns of
``documents``: they take rows away and change none. The last gives one row per packed piece.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from landgate.llm import jaccard, language, packing, quality
from landgate.llm.tables import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, and those whose language can't be told, go."""
    return language.keep_identified(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the line rules or the rules on whole texts reject go; the others stay whole."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of similar documents the one with the smallest doc_id stays."""
    return jaccard.one_of_each(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language_id),
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: A learned random field decides in the first stage, which SQL can't express.
ORACLE_SQL = None
