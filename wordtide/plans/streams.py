"""Queries over tables that were written first: by a stream, or as published messages.

A stream runs over everything there is now. What it leaves behind equals the bounded twin, whatever
way the table's files fall into micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide import operators as op
from wordtide import streaming as st
from wordtide.fixed import DETAIL_METRICS, RAW_MESSAGES, STREAM_TRANSITIONS, SUMMARY_METRICS
from wordtide.plans import bindings as b
from wordtide.plans.bounded import Query
from wordtide.sources import keyed_messages, pending_set, stream_table

METRIC_CHANNELS = [STREAM_TRANSITIONS, SUMMARY_METRICS, DETAIL_METRICS]
STREAMS: dict[str, Query] = {}


def query(function: Query) -> Query:
    STREAMS[function.__name__] = function
    return function


def _profiles(words: DataFrame, name: str) -> DataFrame:
    """Run a stream of batched words to its end; the profiles it kept."""
    spark = words.sparkSession
    folder = st.run_folder(spark, name)
    kept = st.profile_table(f"{folder}/profiles", "batch bigint")
    st.finish(st.start(words, st.keep_profiles(kept, ["batch"]), f"{folder}/checkpoint"))
    return kept.read(spark)


@query
def stream_transitions_available_now(spark: SparkSession, folder: str) -> DataFrame:
    profiles = _profiles(b.batched_word_stream(spark, folder), "transitions")
    return op.flow_transitions(profiles, ["batch"])


@query
def stream_summary_available_now(spark: SparkSession, folder: str) -> DataFrame:
    profiles = _profiles(b.batched_word_stream(spark, folder), "summary")
    return op.summary_metrics(profiles, ["batch"]).withColumn("batch_end_s", b.batch_end())


@query
def stream_detail_available_now(spark: SparkSession, folder: str) -> DataFrame:
    profiles = _profiles(b.batched_word_stream(spark, folder), "details")
    return op.detail_counts(profiles, ["batch"])


@query
def stream_envelopes_available_now(spark: SparkSession, folder: str) -> DataFrame:
    profiles = _profiles(b.batched_word_stream(spark, folder, blanks=True), "envelopes")
    envelopes = op.channel_envelopes(profiles, ["batch"], b.doc_batch_time())
    return op.subscribe(envelopes, ["stream-transitions", "detail-metrics"])


@query
def stream_zero_filled_available_now(spark: SparkSession, folder: str) -> DataFrame:
    profiles = _profiles(b.event_words(stream_table(spark, folder, "events")), "zero-filled")
    filled = op.profile_with_heartbeats(profiles)
    return op.flow_transitions(filled, ["batch"]).withColumnRenamed("batch", "batch_no")


@query
def stream_drain_available_now(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns through a stream, then drained: the places are those of the whole batch."""
    run = st.run_folder(spark, "drain")
    kept = st.EpochTable(f"{run}/turns", "batch bigint, key string, seq bigint")
    turns = b.turn_messages(stream_table(spark, folder, "conversations")).drop("value")
    st.finish(st.start(turns.where("key IS NOT NULL"), st.keep_rows(kept), f"{run}/checkpoint"))
    return op.round_robin_drain(kept.read(spark).drop("epoch"))


@query
def stream_set_ingest_available_now(spark: SparkSession, folder: str) -> DataFrame:
    run = st.run_folder(spark, "sets")
    kept = st.EpochTable(f"{run}/sets", "batch bigint, key string, value string")
    messages = b.value_messages(b.document_stream(spark, folder))
    # each text has dropped its own repetitions; one distinct over all is the only shuffle
    st.finish(st.start(messages, st.keep_rows(kept), f"{run}/checkpoint"))
    return kept.read(spark).select("batch", "key", "value").distinct()


def _channels(spark: SparkSession, folder: str, name: str) -> st.ChannelTable:
    """Run the full stream: every micro-batch published to all channels."""
    run = st.run_folder(spark, name)
    channels = st.ChannelTable(f"{run}/channels")
    words = b.batched_word_stream(spark, folder).select("word", "seq")
    st.finish(st.start(words, st.publish_channels(channels), f"{run}/checkpoint"))
    return channels


@query
def stream_channels_available_now(spark: SparkSession, folder: str) -> DataFrame:
    """Flow graph of all that was published: subscribed to, parsed, summed over micro-batches."""
    published = _channels(spark, folder, "channels").read(spark, ["stream-transitions"])
    edges = op.parse_transitions(published, ["batch_id"])
    return edges.groupBy("edge_no", "from_node", "to_node").agg(F.sum("cnt").alias("cnt"))


@query
def stream_channel_details_available_now(spark: SparkSession, folder: str) -> DataFrame:
    """Length histogram of all that was published, the same way."""
    published = _channels(spark, folder, "channel-details").read(spark, ["detail-metrics"])
    details = op.parse_details(published, ["batch_id"])
    return details.groupBy("word_length").agg(F.sum("cnt").alias("cnt"))


@query
def stream_fanout_available_now(spark: SparkSession, folder: str) -> DataFrame:
    """Words as a live subscriber of three channels gets them: raw, summed up, and in the flow."""
    channels = _channels(spark, folder, "fanout")
    got = st.EpochTable(f"{channels.path}-got", "n_raw bigint, n_summed bigint, n_flow bigint")

    def deliver(messages: DataFrame, epoch: int) -> None:
        raw = op.subscribe(messages, [RAW_MESSAGES]).select(F.lit(1).alias("n_raw"))
        summed = op.parse_summaries(messages).select(F.col("total_words").alias("n_summed"))
        first = op.parse_transitions(messages).where("edge_no <= 2")
        flow = first.select(F.col("cnt").alias("n_flow"))
        every = raw.unionByName(summed, True).unionByName(flow, True)
        got.write(every.agg(*(F.sum(c).alias(c) for c in every.columns)), epoch)

    named = [RAW_MESSAGES, SUMMARY_METRICS, STREAM_TRANSITIONS]
    told = f"{channels.path}-subscriber"
    st.finish(st.subscribe_live(spark, channels, deliver, told, named))
    return got.read(spark).agg(*(F.sum(c).alias(c) for c in ("n_raw", "n_summed", "n_flow")))


@query
def stream_raw_messages_available_now(spark: SparkSession, folder: str) -> DataFrame:
    run = st.run_folder(spark, "raw")
    words = b.batched_word_stream(spark, folder)
    st.finish(st.publish_raw(words, f"{run}/raw", f"{run}/checkpoint", "batch", "seq"))
    schema = "channel string, batch bigint, seq bigint, message string"
    return spark.read.schema(schema).parquet(f"{run}/raw")


def _published(spark: SparkSession, folder: str, name: str) -> st.ChannelTable:
    """All document batches, published to a channel table at once."""
    channels = st.ChannelTable(f"{st.run_folder(spark, name)}/channels")
    words = b.batched_words(spark, folder, blanks=True).withColumn("seq", b.raw_order())
    channels.publish_batches(words.select("batch", "seq", "word"), "batch", b.published_batch_time())
    return channels


@query
def published_summary(spark: SparkSession, folder: str) -> DataFrame:
    channels = _published(spark, folder, "published-summary")
    return op.published_summary(channels.latest(spark), newest=channels.newest(spark)).drop("batch_time")


@query
def published_flow(spark: SparkSession, folder: str) -> DataFrame:
    channels = _published(spark, folder, "published-flow")
    return op.published_flow(channels.latest(spark), newest=channels.newest(spark))


@query
def published_detail_top10(spark: SparkSession, folder: str) -> DataFrame:
    channels = _published(spark, folder, "published-details")
    return op.published_details(channels.latest(spark), newest=channels.newest(spark))


@query
def published_recent15(spark: SparkSession, folder: str) -> DataFrame:
    """The newest words out of the summaries that were published beside the metrics."""
    return op.published_recent(_published(spark, folder, "published-recent").recent(spark))


def _latest(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Metric messages of all document batches through a stream whose state is the latest of each."""
    channels = _published(spark, folder, name)
    kept = st.EpochTable(f"{channels.path}-latest", "channel string, batch_id bigint, message string")
    latest = st.latest_values(channels.subscription(spark, METRIC_CHANNELS))
    st.finish(st.start(latest, st.keep_rows(kept), f"{channels.path}-checkpoint", mode="update"))
    return st.current_values(kept.read(spark))


@query
def stream_latest_summary_available_now(spark: SparkSession, folder: str) -> DataFrame:
    return op.published_summary(_latest(spark, folder, "latest-summary")).drop("batch_time")


@query
def stream_latest_flow_available_now(spark: SparkSession, folder: str) -> DataFrame:
    return op.published_flow(_latest(spark, folder, "latest-flow"))


@query
def stream_pending_set_available_now(spark: SparkSession, folder: str) -> DataFrame:
    """Users of each kind of event, once an hour."""
    events = stream_table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("key"), F.col("user_id").cast("string").alias("value")
    )
    run = st.run_folder(spark, "pending")
    kept = st.EpochTable(f"{run}/sets", "hour bigint, key string, value string")
    taken = pending_set(keyed_messages(events), "ts", "1 hour")
    hour = (F.unix_timestamp("pending.start") / 3600).cast("bigint").alias("hour")
    st.finish(st.start(taken.select(hour, "key", "value"), st.keep_rows(kept), f"{run}/checkpoint"))
    return kept.read(spark).drop("epoch")


@query
def stream_drain_rounds_available_now(spark: SparkSession, folder: str) -> DataFrame:
    """Rounds over all conversations together, drained file by file in a stream that carries on."""
    run = st.run_folder(spark, "rounds")
    turns = b.conversation_messages(spark, folder).where("key IS NOT NULL").select("key", "seq")
    first, last = turns.agg(F.min("seq"), F.max("seq")).first()
    cuts = [first + (last - first) * i // 4 for i in range(4)] + [last + 1]
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):  # four files, one after the other
        part = turns.where(F.col("seq").between(low, high - 1)).coalesce(1)
        part.write.mode("append").parquet(f"{run}/turns")
    stream = spark.readStream.schema(turns.schema).option("maxFilesPerTrigger", 1).parquet(f"{run}/turns")
    rows = st.EpochTable(f"{run}/rows", "key string, seq bigint, round bigint")
    taken = st.EpochTable(f"{run}/taken", "key string, n_taken bigint")
    st.finish(st.start(stream, st.keep_drained(rows, taken), f"{run}/checkpoint"))
    return rows.read(spark).drop("epoch")


@query
def stream_progress_available_now(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of all micro-batches of a stream, as its listener noted them down."""
    run = st.run_folder(spark, "progress")
    kept = st.EpochTable(f"{run}/events", "event_id bigint")
    with st.ProgressLog(spark, f"{run}/progress") as log:
        events = stream_table(spark, folder, "events").select("event_id")
        query = st.finish(st.start(events, st.keep_rows(kept), f"{run}/checkpoint"))
        log.wait(query)
    noted = log.read().agg(F.sum("n_messages").alias("n_messages"))
    return noted.crossJoin(kept.read(spark).agg(F.count("*").alias("n_written")))
