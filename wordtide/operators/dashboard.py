"""Dashboard views over batches of words or metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wordtide.fixed import (
    BATCH_SECONDS,
    DETAIL_METRICS,
    DETAIL_ROWS,
    RAW_MESSAGES,
    RECENT_ROWS,
    STREAM_TRANSITIONS,
    SUMMARY_METRICS,
)
from wordtide.functions import floor_at_one, hundredths, two_decimals
from wordtide.operators.batches import interval_number, interval_start
from wordtide.operators.channels import (
    parse_details,
    parse_summaries,
    parse_transitions,
    subscribe,
)
from wordtide.operators.metrics import (
    detail_counts,
    flow_transitions,
    measure,
    summary_totals,
)
from wordtide.operators.words import tokenize


def latest_batch(rows: DataFrame, number: str, per_batch: int = 1) -> DataFrame:
    """Rows of the newest batch, where a batch is ``per_batch`` consecutive values of ``number``.

    The start of the batch is a scalar subquery over ``number`` alone, and the filter compares the
    bare column with it: the file scan gets the value pushed down and skips older row groups.
    """
    newest = F.max(number)
    start = rows.agg((newest - F.pmod(newest, F.lit(per_batch))).alias("start"))
    return rows.where(F.col(number) >= start.scalar())


def latest_interval(
    rows: DataFrame, time: str, seconds: int, origin: str = "1970-01-01 00:00:00"
) -> DataFrame:
    """The same for batches that are ``seconds`` of a TIMESTAMP_NTZ column."""
    newest = interval_number(F.max(time), seconds, origin)
    start = rows.agg(interval_start(newest, seconds, origin).alias("start"))
    return rows.where(F.col(time) >= start.scalar())


def summary_cards(rows: DataFrame, batch: str = "batch") -> DataFrame:
    """The three cards of one batch; the average as a count of hundredths, and as it is shown."""
    totals = measure(rows).groupBy(F.col(batch).alias("last_batch")).agg(*summary_totals())
    return _cards(totals, "last_batch")


def _cards(totals: DataFrame, *keep: Column | str) -> DataFrame:
    average = hundredths(F.col("total_chars"), F.col("total_words"))
    return totals.select(
        "total_words",
        "total_chars",
        average.alias("avg_hundredths"),
        two_decimals(average).alias("avg_shown"),
        *keep,
    )


def flow_rows(rows: DataFrame) -> DataFrame:
    """Flow diagram of one batch as (From, To, Weight)."""
    return _flow_view(flow_transitions(rows))


def _flow_view(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.col("from_node").alias("From"),
        F.col("to_node").alias("To"),
        floor_at_one(F.col("cnt")).alias("Weight"),
    )


def detail_list(rows: DataFrame, limit: int = DETAIL_ROWS) -> DataFrame:
    """The shortest lengths of one batch's histogram."""
    return _detail_view(detail_counts(rows), limit)


def _detail_view(counts: DataFrame, limit: int) -> DataFrame:
    view = counts.select(F.col("word_length").alias("wordLength"), "cnt")
    return view.orderBy("wordLength").limit(limit)


def recent_words(
    texts: DataFrame, number: str, text: str = "text", limit: int = RECENT_ROWS
) -> DataFrame:
    """The newest ``limit`` words as (rank, word), newest first.

    ``number`` is the unique arrival number of the texts. Texts whose number lies close to the
    greatest are cut into words; the filter on ``number`` lets the file scan skip older row groups. If
    too few words come out, the range is widened sixteenfold, until it covers all numbers. Rows
    without a number have no place in the order and are left out.
    """
    numbered = texts.where(F.col(number).isNotNull()).select(number, text)
    oldest, latest = numbered.agg(F.min(number), F.max(number)).first()
    width = limit
    while True:
        every = latest is None or latest - width <= oldest
        part = numbered if every else numbered.where(F.col(number) > F.lit(latest - width))
        newest = tokenize(part, text).orderBy(F.col(number).desc(), F.col("pos").desc())
        newest = newest.limit(limit)
        if every or newest.count() == limit:
            return _ranked(newest, number, "pos", "word")
        width *= 16


def _ranked(newest: DataFrame, *columns: str) -> DataFrame:
    """(rank, word) of the few rows that a top-k left over: as many as fit one array."""
    entries = F.sort_array(F.collect_list(F.struct(*columns)), asc=False)
    return (
        newest.agg(entries.alias("newest"))
        .select(F.posexplode("newest").alias("at", "entry"))
        .select((F.col("at") + 1).alias("rank"), F.col("entry.word").alias("word"))
    )


def operational_metrics(
    rows: DataFrame, by: Sequence[str] = ("batch",), seconds: int = BATCH_SECONDS
) -> DataFrame:
    """Messages, rate and interval of each batch."""
    totals = measure(rows).groupBy(*by).agg(F.sum("n_words").alias("n_messages"))
    return totals.select(*by, "n_messages", *_rate(seconds))


def _rate(seconds: int) -> list[Column]:
    return [
        (F.col("n_messages") / F.lit(float(seconds))).alias("msgs_per_s"),
        F.lit(seconds * 1000).alias("interval_ms"),
    ]


def latest_messages(
    messages: DataFrame, channel: str, batch: str = "batch_id", newest: int | None = None
) -> DataFrame:
    """Messages of a channel in its newest batch.

    ``newest``: the number of that batch, if known (``ChannelTable.newest``); then only its folder
    of a channel table is read. Without it the batch numbers of the channel are read first.
    """
    of_channel = subscribe(messages, [channel])
    if newest is not None:
        return of_channel.where(F.col(batch) == F.lit(newest))
    found = of_channel.agg(F.max(batch).alias("newest"))
    return of_channel.where(F.col(batch) == found.scalar())


def published_summary(
    messages: DataFrame, batch: str = "batch_id", newest: int | None = None
) -> DataFrame:
    """``summary_cards`` of the newest summary message, with the time it carries."""
    latest = parse_summaries(latest_messages(messages, SUMMARY_METRICS, batch, newest), [batch])
    return _cards(latest, F.col(batch).alias("last_batch"), "batch_time")


def published_operation(
    messages: DataFrame,
    batch: str = "batch_id",
    newest: int | None = None,
    seconds: int = BATCH_SECONDS,
) -> DataFrame:
    """Messages, rate, interval and time of the newest batch, out of its summary message."""
    latest = parse_summaries(latest_messages(messages, SUMMARY_METRICS, batch, newest), [batch])
    return latest.select(
        F.col(batch).alias("last_batch"), F.col("total_words").alias("n_messages"), "batch_time"
    ).select("last_batch", "n_messages", *_rate(seconds), "batch_time")


def published_flow(
    messages: DataFrame, batch: str = "batch_id", newest: int | None = None
) -> DataFrame:
    """``flow_rows`` of the newest transitions message."""
    latest = latest_messages(messages, STREAM_TRANSITIONS, batch, newest)
    return _flow_view(parse_transitions(latest))


def published_details(
    messages: DataFrame,
    batch: str = "batch_id",
    newest: int | None = None,
    limit: int = DETAIL_ROWS,
) -> DataFrame:
    """``detail_list`` of the newest details message."""
    latest = latest_messages(messages, DETAIL_METRICS, batch, newest)
    return _detail_view(parse_details(latest), limit)


def published_recent(
    messages: DataFrame, batch: str = "batch_id", limit: int = RECENT_ROWS
) -> DataFrame:
    """The newest raw messages as (rank, word), newest first, by batch, ``seq`` and word.

    A top-k over the raw messages given; ``ChannelTable.recent`` gives the few that can count.
    """
    newest = (
        subscribe(messages, [RAW_MESSAGES])
        .select(F.col(batch).alias("at_batch"), "seq", F.col("message").alias("word"))
        .orderBy(F.col("at_batch").desc(), F.col("seq").desc(), F.col("word").desc())
        .limit(limit)
    )
    return _ranked(newest, "at_batch", "seq", "word")


def progress_view(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """A running query's recent micro-batches, out of its own progress reports."""
    rows = [
        (
            int(p["batchId"]),
            p["timestamp"],
            int(p["numInputRows"]),
            float(p.get("inputRowsPerSecond") or 0.0),
            int(p["durationMs"].get("triggerExecution", 0)),
        )
        for p in query.recentProgress
    ]
    return spark.createDataFrame(
        rows,
        "batch bigint, time string, n_messages bigint, msgs_per_s double, duration_ms bigint",
    )
