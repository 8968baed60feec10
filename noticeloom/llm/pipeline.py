"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's input.

A null or empty text fails the quality rules and goes there, so does a table without rows; repeated rows are one document
listed twice until the near-duplicate stage keeps one. Columns besides doc_id, text, source and n_chars are carried along,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.llm import bpe, lines, mixing, quality, simhash
from noticeloom.llm.common import Scratch
from noticeloom.llm.queries import vocabulary_path


def good_only(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that weak supervision judges good, whole."""
    return quality.keep_good(docs)


def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later copies of repeated line runs taken out of their texts; n_chars follows the text."""
    return lines.dedup_lines(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the least doc_id."""
    return simhash.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, from never to three times."""
    return mixing.mix_rows(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, tokens (array of int) and n_tokens (long) of every row: what training reads."""
    return bpe.bpe_tokens(docs, vocabulary_path()).withColumn("n_tokens", F.size("tokens").cast("long"))


STAGES = [("quality_rules", good_only), ("line_dedup", lines_once), ("simhash_near_dedup", one_of_each), ("pareto_mix", mixed), ("bpe", encoded)]
#: SQL cannot express the rules' model, the mix and the encoder; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents in sf_dir; every stage's result lies in the shared folder until the program ends."""
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.keep(docs, name)
    return docs
