"""The job: keyed messages in, words classified and counted every interval, channels out.

    python -m wordtide.app run  --messages DIR --channels DIR --checkpoint DIR
                                [--keys words,...] [--struct list|set] [--once] [--echo]
    python -m wordtide.app feed --corpus FILE --messages DIR [--key words]
    python -m wordtide.app show --channels DIR

``run`` follows the folder of message files and publishes every micro-batch, idle ones included.
With ``--echo`` the metric messages are printed as they are published, with ``--once`` at the end.
``feed`` appends the words of a text to that folder. ``show`` prints the dashboard views.
"""

from __future__ import annotations

import argparse
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wordtide import fixed
from wordtide import operators as op
from wordtide import sources as src
from wordtide import streaming as st


def in_arrival_order(messages: DataFrame, struct: str, keys: Sequence[str]) -> DataFrame:
    """Messages taken in, with ``seq`` as their place in the micro-batch.

    A list is drained in rounds that take a message of each key in turn. A set has no order of its
    own; its values get one that a repeated batch has again.
    """
    if struct == "set":
        taken = src.ingest_set(messages, within=())
        return taken.withColumn("seq", F.shiftrightunsigned(F.xxhash64("key", "value"), 1))
    turn = F.array_position(F.array(*map(F.lit, sorted(keys))), F.col("key"))
    drained = op.round_robin_drain(messages, within=())
    place = (F.col("round") - 1) * F.lit(len(keys)) + turn - 1
    return drained.withColumn("seq", place.cast("bigint")).drop("round")


def publish_messages(
    channels: st.ChannelTable,
    options: Mapping[str, str] | None = None,
    keys: Iterable[str] = ("words",),
) -> st.BatchFunction:
    """Take in a micro-batch of messages as the ``struct`` option says, and publish its values."""
    struct, named = src.structure_of(options), list(keys)

    def publish(messages: DataFrame, batch_id: int) -> None:
        taken = in_arrival_order(messages, struct, named)
        channels.publish(taken.withColumnRenamed("value", "word"), batch_id)

    return publish


def run_job(
    spark: SparkSession,
    messages: str,
    channels: str,
    checkpoint: str,
    keys: Iterable[str] = ("words",),
    options: Mapping[str, str] | None = None,
    follow: bool = True,
) -> StreamingQuery:
    """Start the job; ``follow=False`` processes what is there now and ends."""
    keys = list(keys)
    publish = publish_messages(st.ChannelTable(channels), options, keys)
    stream = src.stream_messages(spark, messages, keys)
    if follow:
        stream = src.heartbeat_stream(stream)
    return st.start(stream, publish, checkpoint, follow)


def feed(spark: SparkSession, corpus: str, messages: str, key: str = "words") -> None:
    """Append the words of a text file, or of a folder of them, to a folder of messages."""
    first, work = src.next_number(spark, messages, key), st.run_folder(spark, "corpus")
    words = src.corpus_messages(spark, corpus, key, first, work=work)
    words.withColumn("ts", F.current_timestamp()).write.mode("append").parquet(messages)


def progress_log(spark: SparkSession, channels: str) -> st.ProgressLog:
    """Where a job on these channels notes its micro-batches down."""
    return st.ProgressLog(spark, f"{channels.rstrip('/')}/progress")


def dashboard(spark: SparkSession, channels: str) -> dict[str, DataFrame]:
    """The dashboard's views of a channel table, by title."""
    table = st.ChannelTable(channels)
    published, newest = table.latest(spark), table.newest(spark)
    return {
        fixed.SUMMARY_TITLE: op.published_summary(published, newest=newest),
        fixed.FLOW_TITLE: op.published_flow(published, newest=newest),
        fixed.DETAIL_TITLE: op.published_details(published, newest=newest),
        fixed.RAW_TITLE: op.published_recent(table.recent(spark), "batch_id"),
        fixed.OPERATION_TITLE: op.published_operation(published, newest=newest),
        fixed.PROGRESS_TITLE: st.velocity(progress_log(spark, channels).read())
        .orderBy(F.col("time").desc())
        .limit(fixed.RECENT_ROWS),
    }


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="wordtide", description="Text metrics of streams.")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run")
    run.add_argument("--messages", required=True)
    run.add_argument("--channels", required=True)
    run.add_argument("--checkpoint", required=True)
    run.add_argument("--keys", default="words")
    run.add_argument("--struct", default="list")
    run.add_argument("--once", action="store_true")
    run.add_argument("--echo", action="store_true")
    load = commands.add_parser("feed")
    load.add_argument("--corpus", required=True)
    load.add_argument("--messages", required=True)
    load.add_argument("--key", default="words")
    show = commands.add_parser("show")
    show.add_argument("--channels", required=True)
    given = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("wordtide").getOrCreate()
    if given.command == "run":
        with progress_log(spark, given.channels) as progress:
            query = run_job(
                spark,
                given.messages,
                given.channels,
                given.checkpoint,
                given.keys.split(","),
                {"struct": given.struct},
                follow=not given.once,
            )
            if given.once:
                st.finish(query)
            if given.echo:
                table = st.ChannelTable(given.channels)
                told = f"{given.checkpoint.rstrip('/')}-echo"
                echo = st.subscribe_live(spark, table, st.echo_metrics, told, follow=not given.once)
                if given.once:
                    st.finish(echo)
            st.finish(query)
            progress.wait(query)
    elif given.command == "feed":
        feed(spark, given.corpus, given.messages, given.key)
    else:
        for title, view in dashboard(spark, given.channels).items():
            print(title)
            view.show(truncate=False)


if __name__ == "__main__":
    main()
