"""Streams over words: what each micro-batch does, and how a stream is started."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from wordtide.fixed import BATCH_SECONDS, CHANNELS, RAW_MESSAGES
from wordtide.operators import length_profile, raw_messages, round_robin_drain
from wordtide.sources import ingest_set
from wordtide.streaming.tables import ChannelTable, EpochTable

BatchFunction = Callable[[DataFrame, int], None]


def publish_channels(table: ChannelTable) -> BatchFunction:
    """Publish every micro-batch, as a batch of its own, to all channels."""
    return table.publish


def keep_profiles(table: EpochTable, by: Sequence[str]) -> BatchFunction:
    """Keep the length profile of every micro-batch by the given batch columns.

    A batch may be spread over micro-batches in any way: profiles add up, so metrics over the table
    equal those over all words. There is no state store, no watermark and no unfinished last window.
    """

    def keep(words: DataFrame, epoch: int) -> None:
        table.write(length_profile(words, by), epoch)

    return keep


def keep_sets(table: EpochTable, within: Sequence[str] = ("batch",)) -> BatchFunction:
    """Set ingest of every micro-batch. A batch over several needs ``distinct`` when read."""

    def keep(messages: DataFrame, epoch: int) -> None:
        table.write(ingest_set(messages, within), epoch)

    return keep


def keep_rows(table: EpochTable) -> BatchFunction:
    """Keep the rows of every micro-batch as they come."""
    return table.write


def keep_drained(rows: EpochTable, taken: EpochTable, within: Sequence[str] = ()) -> BatchFunction:
    """Round-robin drain that goes on from one micro-batch to the next.

    ``rows`` gets the messages with their rounds. ``taken`` carries how many messages of each key
    were drained so far, one row a key and micro-batch, and every micro-batch starts from the row of
    the one before it. So rounds equal those of a drain of all messages together, if messages of a
    key arrive in the order of ``seq``; keys may turn up late.
    """
    group = [*within, "key"]

    def drain(messages: DataFrame, epoch: int) -> None:
        spark = messages.sparkSession
        before = taken.read(spark).where(F.col("epoch") == epoch - 1).select(*group, "n_taken")
        drained = round_robin_drain(messages, within)
        ahead = [(drained[c].eqNullSafe(before[c])) for c in group]
        placed = drained.join(before, ahead, "left").select(
            *(drained[c] for c in messages.columns), (drained["round"] + F.coalesce("n_taken", F.lit(0))).alias("round")
        )
        rows.write(placed, epoch)
        counted = messages.groupBy(*group).agg(F.count("*").alias("n_taken"))
        taken.write(before.unionByName(counted).groupBy(*group).agg(F.sum("n_taken").alias("n_taken")), epoch)

    return drain


def latest_values(messages: DataFrame) -> DataFrame:
    """(channel, batch_id, message): the newest message of each metric channel, as a stream's state.

    Run in update mode with ``keep_rows``, it hands on the channels that changed. The state is one
    row a channel.
    """
    newest = F.struct("batch_id", "message")
    metrics = messages.where(F.col("channel") != RAW_MESSAGES)
    latest = metrics.groupBy("channel").agg(F.max_by(newest, "batch_id").alias("latest"))
    return latest.select("channel", "latest.batch_id", "latest.message")


def current_values(kept: DataFrame) -> DataFrame:
    """What the updates in an epoch table amount to: each channel's row of its last epoch."""
    latest = kept.groupBy("channel").agg(F.max_by(F.struct("batch_id", "message"), "epoch").alias("latest"))
    return latest.select("channel", "latest.batch_id", "latest.message")


def _triggered(writer: DataStreamWriter, checkpoint: str, follow: bool) -> DataStreamWriter:
    writer = writer.option("checkpointLocation", checkpoint)
    if follow:
        return writer.trigger(processingTime=f"{BATCH_SECONDS} seconds")
    return writer.trigger(availableNow=True)


def start(
    stream: DataFrame,
    batch_function: BatchFunction,
    checkpoint: str,
    follow: bool = False,
    mode: str = "append",
) -> StreamingQuery:
    """Start a stream: over what is there now, or (``follow``) every interval until it is stopped.

    ``checkpoint`` is the stream's identity: started again with it, the stream goes on behind the
    last finished micro-batch.
    """
    writer = stream.writeStream.outputMode(mode).foreachBatch(batch_function)
    return _triggered(writer, checkpoint, follow).start()


def subscribe_live(
    spark: SparkSession,
    table: ChannelTable,
    deliver: BatchFunction,
    checkpoint: str,
    channels: Iterable[str] = CHANNELS,
    follow: bool = False,
) -> StreamingQuery:
    """Hand the messages of the named channels to a subscriber, batch by batch as they are published.

    A commit is delivered once and whole, so a batch that is published again after a failure is not
    delivered again. A subscriber may start before anything is published; one with its own
    checkpoint goes on where it stopped; any number of them read the same table. A delivery reads the
    new folders alone. ``deliver`` may be called again with the same number after a failure of its
    own, over the same messages.
    """
    return start(table.subscription(spark, channels), deliver, checkpoint, follow)


def publish_raw(
    words: DataFrame, path: str, checkpoint: str, *keep: str, follow: bool = False
) -> StreamingQuery:
    """The raw channel alone, straight to files; the file sink's log makes it exactly-once."""
    writer = raw_messages(words, *keep).writeStream.format("parquet").option("path", path)
    return _triggered(writer, checkpoint, follow).start()


def echo(stream: DataFrame, checkpoint: str, follow: bool = False) -> StreamingQuery:
    """Print each micro-batch's first rows to the console."""
    return _triggered(stream.writeStream.format("console"), checkpoint, follow).start()


def echo_metrics(messages: DataFrame, epoch: int) -> None:
    """Print the metric messages of the delivered batches in full: three for each."""
    metrics = messages.where(F.col("channel") != RAW_MESSAGES)
    for row in metrics.orderBy("batch_id", "channel").toLocalIterator():
        print(f"{row['batch_id']} {row['channel']} {row['message']}")


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a stream over what is there now; its error, if any, is raised here."""
    query.awaitTermination()
    return query
