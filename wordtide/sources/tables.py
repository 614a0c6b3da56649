"""Parquet tables of a data folder, bounded or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(
    spark: SparkSession, folder: str, name: str, max_files_per_batch: int | None = None
) -> DataFrame:
    """The table's files as a stream; the schema is the table's own.

    ``max_files_per_batch`` limits a micro-batch's files, if given.

    The braces make the path a glob: a stream takes a plain path for a folder, and the table may be
    a single file.
    """
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.parquet(f"{folder}/{{{name}.parquet}}")
