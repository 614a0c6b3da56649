from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from wordtide import operators as op

def time():
    return F.timestamp_seconds(F.lit(1_704_067_203))


def by_channel(df):
    return {r["channel"]: r["message"] for r in df.collect()}


def test_payload_texts(spark, words):
    got = by_channel(op.channel_envelopes(words("abcd", "oval", "is"), batch_time=time()))
    assert got == {
        "stream-transitions": (
            '[{"from":"Source Stream","to":"Long Words","count":2},'
            '{"from":"Source Stream","to":"Short Words","count":1},'
            '{"from":"Long Words","to":"Positive Sentiment","count":1},'
            '{"from":"Long Words","to":"Negative Sentiment","count":1},'
            '{"from":"Short Words","to":"Persisted in Database","count":1},'
            '{"from":"Positive Sentiment","to":"Persisted in Database","count":1},'
            '{"from":"Negative Sentiment","to":"Persisted in Database","count":1}]'
        ),
        "summary-metrics": (
            '{"totalWords":3,"totalCharacters":10,"avgCharsPerWord":3.3333333333333335,'
            '"lastRDDTime":"2024-01-01T00:00:03.000Z"}'
        ),
        "detail-metrics": '[{"wordLength":2,"count":1},{"wordLength":4,"count":2}]',
    }


def test_idle_batch_texts(spark, words):
    got = by_channel(op.channel_envelopes(words("x").where("false"), batch_time=time()))
    assert got["detail-metrics"] == "[]"
    assert got["stream-transitions"].count('"count":0') == 7
    assert got["summary-metrics"].startswith(
        '{"totalWords":0,"totalCharacters":0,"avgCharsPerWord":0.0,'
    )


def test_messages_parse_back(spark, words, rows):
    df = op.with_heartbeats(words((1, "abcd"), (1, "oval"), (1, "is"), (3, "")))
    messages = op.channel_envelopes(df, ["batch"], time())
    assert messages.count() == 9
    assert rows(op.parse_transitions(messages, ["batch"])) == rows(
        op.flow_transitions(df, ["batch"])
    )
    assert rows(op.parse_details(messages, ["batch"])) == rows(op.detail_counts(df, ["batch"]))
    parsed = op.parse_summaries(messages, ["batch"])
    assert rows(parsed.drop("batch_time")) == rows(op.summary_metrics(df, ["batch"]))
    times = {r["batch_time"].astimezone(timezone.utc) for r in parsed.collect()}
    assert times == {datetime(2024, 1, 1, 0, 0, 3, tzinfo=timezone.utc)}


def test_messages_parse_back_from_text(spark, words, rows, tmp_path):
    """Through a table, so that no optimizer rule can cancel writing against parsing."""
    df = words((1, "abcd"), (2, "is"))
    path = str(tmp_path / "messages")
    op.channel_envelopes(df, ["batch"], time()).write.parquet(path)
    messages = spark.read.parquet(path)
    assert rows(op.parse_transitions(messages, ["batch"])) == rows(
        op.flow_transitions(df, ["batch"])
    )
    assert rows(op.parse_details(messages, ["batch"])) == rows(op.detail_counts(df, ["batch"]))


def test_raw_messages_and_subscription(spark, words, rows):
    raw = op.raw_messages(words((1, "a"), (1, None), (2, "")), "batch")
    assert rows(raw) == [("raw-messages", 1, "a"), ("raw-messages", 2, "")]
    other = raw.unionByName(raw.withColumn("channel", F.lit("spam")))
    assert rows(op.channel_totals(op.subscribe(other))) == [("raw-messages", 2)]
    assert op.subscribe(other, ["summary-metrics"]).count() == 0


@pytest.mark.parametrize(
    "parse, channel",
    [
        (op.parse_transitions, "stream-transitions"),
        (op.parse_summaries, "summary-metrics"),
        (op.parse_details, "detail-metrics"),
    ],
)
def test_malformed_messages_are_errors(spark, parse, channel):
    broken = spark.createDataFrame([(channel, "{broken")], "channel string, message string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        parse(broken).collect()


def test_texts_without_words_leave_their_batch(spark, rows):
    texts = spark.createDataFrame(
        [(1, "one"), (2, " \t"), (3, None), (4, "")], "batch bigint, text string"
    )
    words = op.tokenize(texts, blanks=True)
    envelopes = op.channel_envelopes(words, ["batch"], time())
    assert rows(op.parse_summaries(envelopes, ["batch"]), "batch", "total_words") == [
        (1, 1), (2, 0), (3, 0), (4, 1),
    ]
    assert op.tokenize(texts).count() == 2
