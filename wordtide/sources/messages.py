"""Keyed messages: rows of (key, value) plus whatever orders them and places them in a batch.

A message source names its structure, ``list`` or ``set``. A list hands over every message in order.
A set hands over each pending value of a key once, in no order: with a batch as the span in which
values are pending, that is a distinct over (batch, key, value).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordtide.fixed import DEFAULT_STRUCTURE, STRUCTURES

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("ts", T.TimestampType()),
    ]
)


def structure_of(options: Mapping[str, str] | None) -> str:
    """The structure named by the ``struct`` option, ``list`` unless given."""
    struct = (options or {}).get("struct", DEFAULT_STRUCTURE)
    if struct not in STRUCTURES:
        raise ValueError(f"unsupported structure {struct!r}: the supported ones are list and set")
    return struct


def keyed_messages(messages: DataFrame, keys: Iterable[str] | None = None) -> DataFrame:
    """Rows with a key and a value, of the given keys only. The key test reaches the file scan."""
    kept = messages.where(F.col("key").isNotNull() & F.col("value").isNotNull())
    if keys is not None:
        kept = kept.where(F.col("key").isin(sorted(keys)))
    return kept


def ingest_list(messages: DataFrame) -> DataFrame:
    """Every message, duplicates included. Order is the ``seq`` column's, not the row order's."""
    return messages


def ingest_set(messages: DataFrame, within: Sequence[str] = ("batch",)) -> DataFrame:
    """Each value of a key once per batch.

    A distinct over exactly these columns: duplicates collapse before the shuffle, and rows are then
    spread by all columns together, so neither a hot key nor a hot value gathers rows in one task.
    """
    return messages.select(*within, "key", "value").distinct()


def pending_set(messages: DataFrame, time: str, span: str, delay: str = "10 minutes") -> DataFrame:
    """Each value of a key once per span of ``time``, over any number of micro-batches: a stream's set ingest.

    A value that is pending already is not taken again; once its span has passed, its state is
    forgotten and the value can come back. State is kept for the spans that the watermark, ``delay``
    behind the newest time, has not passed yet; messages later than that are dropped. It is keyed by
    span, key and value together, so a hot key is spread over tasks. Works on bounded tables as well.
    """
    timed = messages.withWatermark(time, delay) if messages.isStreaming else messages
    within = timed.select(F.window(time, span).alias("pending"), "key", "value")
    return within.dropDuplicates(["pending", "key", "value"])


def ingest(
    messages: DataFrame,
    keys: Iterable[str] | None = None,
    options: Mapping[str, str] | None = None,
    within: Sequence[str] = ("batch",),
) -> DataFrame:
    """Keyed messages taken in as the ``struct`` option says."""
    struct = structure_of(options)
    kept = keyed_messages(messages, keys)
    return ingest_set(kept, within) if struct == "set" else ingest_list(kept)


def read_messages(
    spark: SparkSession,
    path: str,
    keys: Iterable[str] | None = None,
    schema: T.StructType = MESSAGE_SCHEMA,
    file_format: str = "parquet",
) -> DataFrame:
    """A bounded message table."""
    return keyed_messages(spark.read.schema(schema).format(file_format).load(path), keys)


def stream_messages(
    spark: SparkSession,
    path: str,
    keys: Iterable[str] | None = None,
    schema: T.StructType = MESSAGE_SCHEMA,
    file_format: str = "parquet",
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """The same messages as a stream: files are taken up as they arrive in the folder.

    Replayable, so with a checkpoint nothing is lost or taken twice over a restart. For set ingest
    call ``ingest_set`` inside the batch function, where the micro-batch is the span.
    ``max_files_per_batch`` limits a micro-batch's files, if given; with sets, it moves the span.
    """
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return keyed_messages(reader.load(path), keys)
