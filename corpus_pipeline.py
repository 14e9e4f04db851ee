"""From raw documents to packed training sequences.

``STAGES`` lists the stages in order.  Each takes all that its predecessor
kept and returns a DataFrame; ``run`` writes it as Parquet to the shared
scratch folder and reads it again, so a stage never runs twice and a lost
executor costs no earlier stage.  All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.llm.common import read, written
from loanmart.llm.line_dedup import drop_common_lines
from loanmart.llm.packing import pack
from loanmart.llm.quality import select_good
from loanmart.llm.simhash import drop_near_duplicates
from loanmart.llm.substring_dedup import remove_repeats


def counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``n_chars`` follows a text that a stage has changed."""
    return docs.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else c for c in columns))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier rejects go."""
    return select_good(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 code points or more found in 3 or more documents stay only in the last of them."""
    return counted(drop_common_lines(docs), docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Paragraphs alike in several documents stay only in the first of them."""
    return counted(remove_repeats(docs), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left in sequences of 1024 tokens."""
    return pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: SQL has neither the classifier nor the tokenizer; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
