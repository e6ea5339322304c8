"""What the text operators share: reading tables, written intermediate tables, and words as bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrolake.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of `df` as a table in the shared folder: cuts the lineage, and later reads see the same rows."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, label)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed_texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) alone, null texts as empty ones; other columns can have any name and do not travel."""
    return df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def text_key(text: str = "text") -> Column:
    """With doc_id the identity of a row: rows equal in both are one document and get one result."""
    return F.xxhash64(F.col(text))


def unused(taken: list[str], name: str) -> str:
    """`name`, with underscores behind it until no column of `taken` has it, in small letters or large."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name


def as_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A string column in UTF-8; nulls are empty."""
    return [value or b"" for value in batch.column(column).cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z only) words between white space (space, tab to carriage return)."""
    return text.lower().split()


def batchwise(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """`step` over every Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(step, batches)

    return df.mapInArrow(run, schema)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of at most `rows` rows, so that what a batch gives stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
