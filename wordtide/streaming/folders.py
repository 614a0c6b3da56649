"""Where streams keep their checkpoints and tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session may go without: it uses its own warehouse folder. On a cluster that folder
    may be another one on every machine, so the setting is required there.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run of a stream. Restarting a stream means passing its folder again."""
    return f"{shared_folder(spark)}/wordtide/{name}-{uuid.uuid4().hex}"
