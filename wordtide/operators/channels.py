"""Channels: metrics as JSON messages, and messages back as metrics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.fixed import (
    CHANNELS,
    DETAIL_METRICS,
    DETAILS_PAYLOAD,
    FLOW_EDGES,
    RAW_MESSAGES,
    STREAM_TRANSITIONS,
    SUMMARY_METRICS,
    SUMMARY_PAYLOAD,
    TRANSITIONS_PAYLOAD,
)
from wordtide.functions import average
from wordtide.operators.metrics import branch_totals, length_profile, summary_totals

UTC = {"timeZone": "UTC"}
STRICT = {"mode": "FAILFAST"}  # a malformed message is an error, not an absent one
# Each metric channel's payload, and whether it is an array.
PAYLOADS = {
    STREAM_TRANSITIONS: (TRANSITIONS_PAYLOAD, True),
    SUMMARY_METRICS: (SUMMARY_PAYLOAD, False),
    DETAIL_METRICS: (DETAILS_PAYLOAD, True),
}


def channel_envelopes(
    rows: DataFrame, by: Sequence[str] = (), batch_time: Column | None = None
) -> DataFrame:
    """(channel, message) rows of each batch: one of transitions, one summary, one of details.

    One pass: words are summed to a length profile, and the profile of a batch, a handful of rows,
    gives all three messages. ``batch_time`` is the summary's time; the processing time by default.
    """
    details = F.sort_array(
        F.collect_list(
            F.when(
                F.col("word_length").isNotNull(),
                F.struct(
                    F.col("word_length").alias("wordLength"), F.col("n_words").alias("count")
                ),
            )
        )
    )
    batches = (
        length_profile(rows, by)
        .groupBy(*by)
        .agg(*branch_totals(), *summary_totals(), details.alias("details"))
    )
    transitions = F.array(
        *[
            F.struct(
                F.lit(origin).alias("from"), F.lit(target).alias("to"), F.col(n).alias("count")
            )
            for origin, target, n in FLOW_EDGES
        ]
    )
    time = F.current_timestamp() if batch_time is None else batch_time
    summary = F.struct(
        F.col("total_words").alias("totalWords"),
        F.col("total_chars").alias("totalCharacters"),
        average(F.col("total_chars"), F.col("total_words")).alias("avgCharsPerWord"),
        time.alias("lastRDDTime"),
    )
    messages = [
        (STREAM_TRANSITIONS, F.to_json(transitions)),
        (SUMMARY_METRICS, F.to_json(summary, UTC)),
        (DETAIL_METRICS, F.to_json("details")),
    ]
    return batches.select(
        *by,
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("channel"), m.alias("message")) for c, m in messages]
            )
        ),
    )


def raw_messages(words: DataFrame, *keep: str) -> DataFrame:
    """Every word as a message of the raw channel, with the ``keep`` columns. Narrow."""
    return words.where(F.col("word").isNotNull()).select(
        F.lit(RAW_MESSAGES).alias("channel"), *keep, F.col("word").alias("message")
    )


def subscribe(messages: DataFrame, channels: Iterable[str] = CHANNELS) -> DataFrame:
    """Messages of the named channels, unchanged. On a channel table this prunes folders."""
    return messages.where(F.col("channel").isin(list(channels)))


def channel_totals(messages: DataFrame) -> DataFrame:
    """Messages per channel."""
    return messages.groupBy("channel").agg(F.count("*").alias("n_messages"))


def parse_transitions(messages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Flow edges out of transition messages."""
    payload = F.from_json("message", TRANSITIONS_PAYLOAD, STRICT)
    return (
        subscribe(messages, [STREAM_TRANSITIONS])
        .select(*by, F.posexplode_outer(payload).alias("at", "edge"))
        .where(F.col("at").isNotNull())
        .select(
            *by,
            (F.col("at") + 1).alias("edge_no"),
            F.col("edge.from").alias("from_node"),
            F.col("edge.to").alias("to_node"),
            F.col("edge.count").alias("cnt"),
        )
    )


def parse_summaries(messages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Typed columns out of summary messages."""
    payload = F.from_json("message", SUMMARY_PAYLOAD, {**UTC, **STRICT}).alias("summary")
    return (
        subscribe(messages, [SUMMARY_METRICS])
        .select(*by, payload)
        .select(
            *by,
            F.col("summary.totalWords").alias("total_words"),
            F.col("summary.totalCharacters").alias("total_chars"),
            F.col("summary.avgCharsPerWord").alias("avg_chars_per_word"),
            F.col("summary.lastRDDTime").alias("batch_time"),
        )
    )


def parsed_or_rejected(messages: DataFrame, channel: str) -> DataFrame:
    """Messages of a metric channel, each with its ``payload`` or else a ``reason`` why it has none.

    Reasons: ``malformed`` (not the JSON of the channel's payload), ``incomplete`` (a field is absent,
    null or of another type), ``empty`` (no message). Nothing is dropped and nothing raises: split on
    ``reason IS NULL`` into typed rows and a dead-letter table. The strict parsers serve channels whose
    messages are the job's own.
    """
    payload, array = PAYLOADS[channel]
    text = F.trim("message")
    whole = F.from_json(F.concat(F.lit('{"v":'), text, F.lit(', "_end":true}')), f"v {payload.simpleString()}, _end boolean, _bad string", {**UTC, "columnNameOfCorruptRecord": "_bad"})
    required = "forall(v, x -> x IS NOT NULL AND {})" if array else "{}"
    item = payload.elementType if array else payload
    present = " AND ".join(f"{'x' if array else 'v'}.{name} IS NOT NULL" for name in item.names)
    reason = (
        F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "empty")
        .when(F.col("_whole").isNull() | F.col("_whole._bad").isNotNull() | F.col("_whole._end").isNull() | F.col("v").isNull(), "malformed")
        .when(~F.coalesce(F.expr(required.format(present)), F.lit(False)), "incomplete")
    )
    parsed = subscribe(messages, [channel]).withColumn("_whole", whole).withColumn("v", F.col("_whole.v")).withColumn("reason", reason)
    return parsed.withColumn("payload", F.when(F.col("reason").isNull(), F.col("v"))).drop("_whole", "v")


def parse_details(messages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Histogram rows out of detail messages; an empty histogram has none."""
    payload = F.from_json("message", DETAILS_PAYLOAD, STRICT)
    return (
        subscribe(messages, [DETAIL_METRICS])
        .select(*by, F.explode_outer(payload).alias("detail"))
        .where(F.col("detail").isNotNull())
        .select(
            *by,
            F.col("detail.wordLength").alias("word_length"),
            F.col("detail.count").alias("cnt"),
        )
    )
