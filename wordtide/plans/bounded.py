"""Queries over bounded tables. Each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide import operators as op
from wordtide import sources
from wordtide import streaming as st
from wordtide.fixed import CHANNELS, RAW_MESSAGES
from wordtide.plans import bindings as b
from wordtide.sources import ingest, table

METRIC_CHANNELS = [c for c in CHANNELS if c != RAW_MESSAGES]
UNSUBSCRIBED = "debug-messages"

Query = Callable[[SparkSession, str], DataFrame]

BOUNDED: dict[str, Query] = {}


def query(function: Query) -> Query:
    BOUNDED[function.__name__] = function
    return function


# --- words ---------------------------------------------------------------------------------


@query
def tokenize_words(spark: SparkSession, folder: str) -> DataFrame:
    return b.words(spark, folder)


@query
def classify_words(spark: SparkSession, folder: str) -> DataFrame:
    return op.classify(b.words(spark, folder))


@query
def filter_long(spark: SparkSession, folder: str) -> DataFrame:
    return op.long_words(b.words(spark, folder))


@query
def filter_short(spark: SparkSession, folder: str) -> DataFrame:
    return op.short_words(b.words(spark, folder))


@query
def filter_long_positive(spark: SparkSession, folder: str) -> DataFrame:
    return op.long_positive_words(b.words(spark, folder))


@query
def filter_long_negative(spark: SparkSession, folder: str) -> DataFrame:
    return op.long_negative_words(b.words(spark, folder))


@query
def corpus_words(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, behind its id, as lines of text files in the order of ids; the words of those files."""
    run = st.run_folder(spark, "corpus")
    line = F.concat_ws(" ", "doc_id", "text").alias("value")
    b.documents(spark, folder).orderBy("doc_id").select(line).write.text(f"{run}/texts")
    return sources.corpus_words(spark, f"{run}/texts", f"{run}/cut").select("seq", "word")


# --- metrics -------------------------------------------------------------------------------


@query
def branch_counts(spark: SparkSession, folder: str) -> DataFrame:
    return op.branch_counts(b.words(spark, folder))


@query
def flow_transitions(spark: SparkSession, folder: str) -> DataFrame:
    return op.flow_transitions(b.words(spark, folder))


@query
def flow_transitions_by_batch(spark: SparkSession, folder: str) -> DataFrame:
    return op.flow_transitions(b.batched_words(spark, folder), ["batch"])


@query
def summary_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return op.summary_metrics(b.words(spark, folder))


@query
def summary_metrics_by_batch(spark: SparkSession, folder: str) -> DataFrame:
    metrics = op.summary_metrics(b.batched_words(spark, folder), ["batch"])
    return metrics.withColumn("batch_end_s", b.batch_end())


@query
def detail_counts(spark: SparkSession, folder: str) -> DataFrame:
    return op.detail_counts(b.words(spark, folder))


@query
def detail_counts_by_batch(spark: SparkSession, folder: str) -> DataFrame:
    return op.detail_counts(b.batched_words(spark, folder), ["batch"])


# --- ingest --------------------------------------------------------------------------------


@query
def keyed_messages(spark: SparkSession, folder: str) -> DataFrame:
    messages = b.conversation_messages(spark, folder)
    return sources.keyed_messages(messages, b.MESSAGE_KEYS).select("key", "seq", "value")


@query
def list_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return ingest(b.conversation_messages(spark, folder), options={"struct": "list"})


@query
def set_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return ingest(b.batched_values(spark, folder), options={"struct": "set"})


@query
def round_robin_drain(spark: SparkSession, folder: str) -> DataFrame:
    messages = sources.keyed_messages(b.conversation_messages(spark, folder))
    return op.round_robin_drain(messages.drop("value"))


# --- idle batches --------------------------------------------------------------------------


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return op.with_heartbeats(b.event_words(table(spark, folder, "events")))


@query
def zero_filled_transitions(spark: SparkSession, folder: str) -> DataFrame:
    return op.flow_transitions(_events(spark, folder), ["batch"]).withColumnRenamed(
        "batch", "batch_no"
    )


@query
def zero_filled_summary(spark: SparkSession, folder: str) -> DataFrame:
    return op.summary_metrics(_events(spark, folder), ["batch"]).withColumnRenamed(
        "batch", "batch_no"
    )


@query
def zero_filled_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    time = F.timestamp_seconds(
        F.lit(b.ORIGIN_EPOCH) + (F.col("batch") + 1) * F.lit(b.EVENT_BATCH_SECONDS)
    )
    envelopes = op.channel_envelopes(_events(spark, folder), ["batch"], time)
    return _integer_channels(envelopes).withColumnRenamed("batch", "batch_no")


# --- channels ------------------------------------------------------------------------------


def document_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    words = b.batched_words(spark, folder, blanks=True)
    return op.channel_envelopes(words, ["batch"], b.doc_batch_time())


def _integer_channels(envelopes: DataFrame) -> DataFrame:
    """Transitions and details: summaries hold a double, whose digits are an engine's own."""
    return op.subscribe(envelopes, ["stream-transitions", "detail-metrics"])


@query
def channel_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    return _integer_channels(document_envelopes(spark, folder))


@query
def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    words = b.batched_words(spark, folder).withColumn("seq", b.raw_order())
    return op.raw_messages(words, "batch", "seq")


@query
def channel_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """Published messages that reach the subscribers of each channel; one more channel has no subscriber.

    Texts are read and cut once: the raw channel is written first, and metrics come from what was written.
    """
    run = st.run_folder(spark, "fanout")
    raw, told = f"{run}/raw", f"{run}/metrics"
    words = b.batched_words(spark, folder, blanks=True)
    words.select("batch", F.lit(RAW_MESSAGES).alias("channel"), F.col("word").alias("message")).write.parquet(raw)
    written = spark.read.parquet(raw).select("batch", F.col("message").alias("word"))
    metrics = op.channel_envelopes(written, ["batch"], b.doc_batch_time())
    twice = F.when(F.col("channel") == METRIC_CHANNELS[0], F.lit(UNSUBSCRIBED))
    to = F.explode(F.array_compact(F.array("channel", twice))).alias("channel")
    metrics.select("batch", to, "message").write.parquet(told)
    published = spark.read.parquet(raw, told).where("message IS NOT NULL")  # without heartbeats
    return op.channel_totals(op.subscribe(published))


@query
def parse_transitions(spark: SparkSession, folder: str) -> DataFrame:
    return op.parse_transitions(document_envelopes(spark, folder), ["batch"])


@query
def parse_summaries(spark: SparkSession, folder: str) -> DataFrame:
    parsed = op.parse_summaries(document_envelopes(spark, folder), ["batch"])
    return parsed.withColumn(
        "batch_end_s", F.unix_seconds("batch_time") - F.lit(b.ORIGIN_EPOCH)
    ).drop("batch_time")


@query
def parse_details(spark: SparkSession, folder: str) -> DataFrame:
    return op.parse_details(document_envelopes(spark, folder), ["batch"])


# --- dashboard -----------------------------------------------------------------------------


def _latest_words(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    latest = op.latest_batch(docs, "doc_id", b.DOCS_PER_BATCH).select(b.doc_batch(), "text")
    words = op.tokenize(latest).select("batch", "word")
    return words.unionByName(op.beat_per_row(latest))


@query
def dashboard_summary(spark: SparkSession, folder: str) -> DataFrame:
    return op.summary_cards(_latest_words(spark, folder))


@query
def dashboard_flow(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    latest = op.latest_interval(events, "ts", b.EVENT_BATCH_SECONDS, b.ORIGIN)
    return op.flow_rows(b.event_words(latest))


@query
def dashboard_detail_top10(spark: SparkSession, folder: str) -> DataFrame:
    return op.detail_list(_latest_words(spark, folder))


@query
def dashboard_recent15(spark: SparkSession, folder: str) -> DataFrame:
    return op.recent_words(table(spark, folder, "documents"), "doc_id")


@query
def operational_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = op.operational_metrics(b.batched_words(spark, folder))
    return metrics.withColumn("batch_end_s", b.batch_end())


def _planted(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of all document batches; those of every seventh batch are cut off, of every eleventh gone."""
    whole, batch = document_envelopes(spark, folder), F.col("batch")
    broken = F.when(batch % 7 == 0, F.expr("substring(message, 1, length(message) - 1)")).when(batch % 11 == 0, F.lit("")).otherwise(F.col("message"))
    return whole.withColumn("message", broken)


@query
def rejected_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The dead-letter table of all three metric channels."""
    planted = _planted(spark, folder)
    parts = [op.parsed_or_rejected(planted, c).where("reason IS NOT NULL").select("batch", "channel", "reason") for c in METRIC_CHANNELS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def accepted_details(spark: SparkSession, folder: str) -> DataFrame:
    """The typed rows beside it."""
    typed = op.parsed_or_rejected(_planted(spark, folder), "detail-metrics").where("reason IS NULL")
    rows = typed.select("batch", F.explode("payload").alias("detail"))
    return rows.select("batch", F.col("detail.wordLength").alias("word_length"), F.col("detail.count").alias("cnt"))
