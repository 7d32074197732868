"""The corpus pipeline: each stage applies one operator of ``encore.llm`` to all rows that the
stage before kept, and is written before the next one reads it.

Stages that change texts keep ``n_chars`` true to them; all other columns pass through. A document
whose text empties stays, as an empty text; packing gives it its end id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import language, line_dedup, packing, simhash, suffixes
from encore.llm.base import table
from encore.session import stage_table

#: Least repeated passage in bytes: 51 words of three letters, with a blank after each but the last,
#: take 203. Grams of its anchors are shorter than usual, so that segments stay few.
PASSAGE = 200
PASSAGE_GRAM = 64


def _counted(docs: DataFrame) -> DataFrame:
    length = F.char_length(F.coalesce("text", F.lit(""))).cast("bigint")
    return docs.withColumn("n_chars", length) if "n_chars" in docs.columns else docs


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: those without a letter or a sure prediction go."""
    return language.keep_known(docs, language.train(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three documents or more stay in the one of the largest id only."""
    return _counted(line_dedup.keep_lines(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints, the one with the smallest id stays."""
    return simhash.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``PASSAGE`` bytes or more that start anywhere else as well are cut from the texts."""
    return _counted(suffixes.remove_repeats(docs, PASSAGE, PASSAGE_GRAM))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of the model's length."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", keep_known_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_passages),
    ("best_fit_packing", pack),
]

#: The trained language stage and the passage stage can't be said in SQL; tests run the pipeline
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
