"""How the tables of a data folder stand for texts, messages and timed words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.fixed import BATCH_SECONDS
from wordtide.operators import batch_of, distinct_words, interval_number, tokenize
from wordtide.sources import keyed_messages, stream_table, table

ORIGIN = "2024-01-01 00:00:00"
ORIGIN_EPOCH = 1_704_067_200  # the same, in seconds since 1970-01-01 UTC
DOCS_PER_BATCH = BATCH_SECONDS  # one document arrives per second
CONVERSATIONS_PER_BATCH = 10
EVENT_BATCH_SECONDS = 300
MESSAGE_KEYS = ("user", "assistant")
TURNS_PER_CONVERSATION = 1 << 24  # room for turns in a message's arrival number


def doc_batch() -> F.Column:
    return batch_of(F.col("doc_id"), DOCS_PER_BATCH).alias("batch")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text)."""
    return table(spark, folder, "documents").select("doc_id", "text")


def words(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, pos, word)."""
    return tokenize(documents(spark, folder))


def batched_words(spark: SparkSession, folder: str, blanks: bool = False) -> DataFrame:
    """(doc_id, batch, pos, word); with ``blanks``, a null word for a text that has none."""
    docs = documents(spark, folder).select("doc_id", doc_batch(), "text")
    return tokenize(docs, blanks=blanks)


def batched_values(spark: SparkSession, folder: str) -> DataFrame:
    """Words as pending messages (batch, key, value) of the document's language, for set ingest."""
    return value_messages(table(spark, folder, "documents"))


def value_messages(docs: DataFrame) -> DataFrame:
    cut = distinct_words(docs.select(doc_batch(), F.col("lang").alias("key"), "text"))
    return keyed_messages(cut.select("batch", "key", F.col("word").alias("value")))


def raw_order() -> F.Column:
    """Order of a word within its batch: document, then position."""
    place = F.pmod("doc_id", F.lit(DOCS_PER_BATCH)) * F.lit(1 << 32)
    return (place + F.col("pos")).alias("seq")


def conversation_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as messages (batch, key, seq, value), keyed by role."""
    return turn_messages(table(spark, folder, "conversations"))


def turn_messages(turns: DataFrame) -> DataFrame:
    return turns.select(
        batch_of(F.col("conv_id"), CONVERSATIONS_PER_BATCH).alias("batch"),
        F.col("role").alias("key"),
        (F.col("conv_id") * F.lit(TURNS_PER_CONVERSATION) + F.col("turn")).alias("seq"),
        F.col("text").alias("value"),
    )


def event_words(events: DataFrame) -> DataFrame:
    """Event types as timed words (batch, word), in five-minute batches."""
    return events.select(
        interval_number(F.col("ts"), EVENT_BATCH_SECONDS, ORIGIN).alias("batch"),
        F.col("event_type").alias("word"),
    )


def doc_batch_time() -> F.Column:
    """End of a document batch's interval."""
    return F.timestamp_seconds(F.lit(ORIGIN_EPOCH) + batch_end())


def published_batch_time() -> F.Column:
    """The same, of a published batch."""
    return F.timestamp_seconds(F.lit(ORIGIN_EPOCH) + batch_end("batch_id"))


def batch_end(batch: str = "batch") -> F.Column:
    """End of a batch's interval in seconds from the origin."""
    return F.lit(BATCH_SECONDS) * F.col(batch) + F.lit(BATCH_SECONDS)


def document_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The documents table as a stream."""
    return stream_table(spark, folder, "documents")


def batched_word_stream(spark: SparkSession, folder: str, blanks: bool = False) -> DataFrame:
    """(doc_id, batch, pos, word, seq) as a stream."""
    docs = document_stream(spark, folder).select("doc_id", doc_batch(), "text")
    return tokenize(docs, blanks=blanks).withColumn("seq", raw_order())
