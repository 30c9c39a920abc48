"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows the stage before kept;
``run`` writes every stage's rows to the shared folder and reads them again. All stages
but the last return the columns of ``documents``. Nulls, empty tables and repeated rows
follow the operators: texts that are null or without a letter go in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vidpulse.llm import jaccard, language, packing, pii, quality
from vidpulse.llm.common import ship, table, tokenizer_path
from vidpulse.session import stage


def find_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language compression tells with some margin."""
    ship(spark)
    return language.identified(docs, language.learn(docs))


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that fail them."""
    ship(spark)
    return quality.clean(docs)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    ship(spark)
    return jaccard.one_of_each(docs)


def drop_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates, addresses and keys under pseudonyms, with the session's secret or the trial key."""
    ship(spark)
    return pii.pseudonymised(docs, pii.secret_of(spark, pii.TRIAL_KEY))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their ids."""
    ship(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language ID", find_language),
    ("quality rules", clean_lines),
    ("n-gram Jaccard join", one_per_group),
    ("PII", drop_personal),
    ("packing", pack),
]

#: Compression, keyed permutations and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
