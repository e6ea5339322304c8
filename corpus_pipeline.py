"""The corpus pipeline: documents in; toxic, repeated and contaminated ones out; tokens of the rest at the end.

Each stage is a function of (spark, docs, sf_dir) whose result is written as Parquet and read again as the next one's
docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrolake.llm import decontaminate, line_dedup, simhash, toxicity
from cirrolake.llm.common import table, written
from cirrolake.llm.queries import byte_bpe, toxicity_model
from cirrolake.session import importable_by_workers

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(function: Stage) -> Stage:
    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable_by_workers(spark)
        return function(spark, docs, sf_dir)

    return run


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine scores 0.5 or more go. It learns from the labelled rows of sf_dir, as in op7."""
    return toxicity.clean(docs.select(COLUMNS), toxicity_model(spark, sf_dir))


@stage
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that occur earlier go from the texts; documents stay, if need be with an empty text."""
    kept = line_dedup.without_repeats(docs.select(COLUMNS))
    shorter = F.when(F.col("lines_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", shorter).select(COLUMNS)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    return simhash.one_of_each(docs.select(COLUMNS))


@stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontaminate.clean(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


@stage
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) of every document."""
    return byte_bpe(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", tokenize),
]

#: The stages' hashes and trained scores cannot be written in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = written(step(spark, docs, sf_dir), name)
    return docs
