"""A corpus pipeline over ``documents``: drop toxic texts, drop texts whose
language is not recognised, keep one of each group of near-duplicates, drop
texts that hold benchmark items, tokenize the rest.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run`
writes each result as Parquet into the shared checkpoint folder and reads it
back as the next stage's ``docs``. All stages but the last return the columns
of ``docs``, and only rows of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderflow.llm.common import stage, table
from orderflow.llm.decontaminate import keep_uncontaminated
from orderflow.llm.langid import fit_languages, keep_recognised
from orderflow.llm.minhash import keep_one_of_each
from orderflow.llm.pieces import with_token_ids
from orderflow.llm.severity import fit_severity, keep_clean, label_grades


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Severity model of the labelled documents; rows of a grade above 0 go."""
    model = fit_severity(table(spark, sf_dir, "documents"), label_grades(table(spark, sf_dir, "labels")))
    return keep_clean(docs, model)


def drop_unrecognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language model of the labelled documents; rows it rejects go."""
    return keep_recognised(docs, fit_languages(table(spark, sf_dir, "documents")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each linked group stays; rows
    without an id all stay. Rows that repeat an id are judged by id and text."""
    return keep_one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds a benchmark item within its edit budget go."""
    return keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns and the piece ids of the text."""
    return with_token_ids(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unrecognised),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("sentencepiece", tokenize),
]

#: Fitted models and near-duplicate groups are beyond SQL; the tests compare
#: the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
