"""Surrogate keys: dense, stable, numbered without bringing rows together in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.sources.shared_folder import fresh_folder

# Spark numbers the files of a write by the partitions they are from.
_FILE_NUMBER = r"part-(\d+)"


def assign_surrogate_keys(
    new_rows: DataFrame, keys: Sequence[str], start_after: int = 0, name: str = "sk"
) -> DataFrame:
    """Number rows start_after + 1, start_after + 2, ... in the order of their (unique) keys.

    The rows are range-partitioned by the whole key, which balances partitions however the key values are
    spread, sorted within partitions, and written once. A row's position in its file plus the sizes of the
    files before it is its number. Positions are those of the stored files, so a lost executor cannot
    renumber anything, and sizes come from the files' footers.
    """
    spark, folder = new_rows.sparkSession, fresh_folder(new_rows.sparkSession, "numbered")
    new_rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(folder)
    stored = spark.read.schema(new_rows.schema).parquet(folder)
    file = F.regexp_extract(F.col("_metadata.file_name"), _FILE_NUMBER, 1).cast("int")
    sizes = stored.select(file.alias("__file")).groupBy("__file").agg(F.count(F.lit(1)).alias("__size"))
    # One row per file: a bounded table, fit for a running sum in one task and for broadcast.
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__file", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    placed = stored.select("*", file.alias("__file"), F.col("_metadata.row_index").alias("__place"))
    number = F.col("__offset") + F.col("__place") + F.lit(start_after + 1)
    return placed.join(F.broadcast(offsets), on="__file").select(
        *new_rows.columns, number.cast("bigint").alias(name)
    )
