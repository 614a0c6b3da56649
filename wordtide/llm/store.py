"""Tables written on the way: they cut lineage and survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordtide.streaming.folders import run_folder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    The folder is the one that ``spark.checkpoint.dir`` names. The schema is given to the reader,
    so a table without rows reads back as one.
    """
    spark = df.sparkSession
    path = run_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
