"""Shared by the corpus operators: Arrow streaming and intermediate tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.sources.shared_folder import fresh_folder

#: Rows turned into Python objects at a time, so that a batch of very long texts stays small.
SLICE = 128


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if nothing else is set."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_folder(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the id and the whole text; NULL text is empty. Every other column is left behind."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )


def one_text_per_id(texts: DataFrame) -> DataFrame:
    """Of the texts of one id the one that is first by its hash, whatever the order of the rows."""
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return texts.groupBy("doc_id").agg(least).select("doc_id", "least.text")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def row_mapper(
    score: Callable[[str], tuple], names: list[str], types: list[pa.DataType], prepare: Callable | None = None
) -> Callable:
    """A ``mapInArrow`` function: (doc_id, text) in, doc_id and the values of ``score(text)`` out.

    ``prepare`` makes the scoring function inside the worker, once per task.
    """
    schema = pa.schema([("doc_id", pa.int64()), *zip(names, types, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = prepare() if prepare else score
        for batch in slices(batches):
            values = [one(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id")]
            columns += [pa.array([v[i] for v in values], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run
