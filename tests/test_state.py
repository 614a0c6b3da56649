"""What streams carry from one micro-batch to the next, and what becomes of broken messages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wordtide import operators as op
from wordtide import sources as src
from wordtide import streaming as st


def run(stream, function, checkpoint, mode="append"):
    return st.finish(st.start(stream, function, str(checkpoint), mode=mode))


def test_pending_values_are_delivered_once_and_can_come_back(spark, tmp_path, rows):
    schema = "ts timestamp, key string, value string"
    kept = st.EpochTable(str(tmp_path / "kept"), "start string, key string, value string")
    arrivals = [
        [("2024-01-01 00:00:00", "k", "a"), ("2024-01-01 00:00:09", "k", "a"), ("2024-01-01 00:00:01", "j", "a")],
        [("2024-01-01 00:00:30", "k", "a"), ("2024-01-01 00:00:31", "k", "b"), (None, "k", "c")],
        [("2024-01-01 00:01:10", "k", "a"), ("2024-01-01 00:01:11", "k", "a")],
    ]
    every = []
    for part in arrivals:
        new = spark.createDataFrame([(t, k, v) for t, k, v in part], "t string, key string, value string")
        new.select(F.col("t").cast("timestamp").alias("ts"), "key", "value").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        every += [(t[:16], k, v) for t, k, v in part if t]
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        pending = src.pending_set(stream, "ts", "1 minute", "5 minutes")
        run(pending.select(F.date_format("pending.start", "yyyy-MM-dd HH:mm").alias("start"), "key", "value"), st.keep_rows(kept), tmp_path / "ck")
    assert rows(kept.read(spark), "start", "key", "value") == sorted(set(every), key=repr)
    bounded = src.pending_set(spark.read.schema(schema).parquet(str(tmp_path / "in")), "ts", "1 minute")
    assert bounded.count() == len(set(every))


def test_rounds_go_on_over_files_and_keys_may_come_late(spark, tmp_path, rows):
    messages = "key string, seq bigint"
    files = [[("a", i) for i in range(5)] + [(None, 0)], [("a", i) for i in range(5, 7)], [("b", 1), ("a", 9), ("b", 4), (None, 7)], [("b", 8)]]
    taken = st.EpochTable(str(tmp_path / "taken"), "key string, n_taken bigint")
    got = st.EpochTable(str(tmp_path / "rows"), f"{messages}, round bigint")
    for part in files:
        spark.createDataFrame(part, messages).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(messages).parquet(str(tmp_path / "in"))
        run(stream, st.keep_drained(got, taken), tmp_path / "ck")
    whole = op.round_robin_drain(spark.createDataFrame(sum(files, []), messages), within=())
    assert rows(got.read(spark), "key", "seq", "round") == rows(whole, "key", "seq", "round")
    again = spark.createDataFrame(files[2], messages)
    st.keep_drained(got, taken)(again, 2)  # a micro-batch that runs again
    assert rows(got.read(spark), "key", "seq", "round") == rows(whole, "key", "seq", "round")


def test_latest_values_follow_the_newest_batch(spark, words, tmp_path, rows):
    table = st.ChannelTable(str(tmp_path / "channels"))
    kept = st.EpochTable(str(tmp_path / "latest"), "channel string, batch_id bigint, message string")
    for batch, new in enumerate((["one", "three"], [], ["zebra"])):
        table.publish(words(*new) if new else words("x").where("false"), batch)
        run(st.latest_values(table.subscription(spark)), st.keep_rows(kept), tmp_path / "ck", "update")
        latest = st.current_values(kept.read(spark))
        assert rows(latest, "batch_id") == [(batch,)] * 3
        assert rows(op.published_summary(latest).drop("batch_time")) == rows(
            op.published_summary(table.latest(spark), newest=batch).drop("batch_time")
        )
    assert kept.read(spark).count() == 9


SUMMARY = '{"totalWords":2,"totalCharacters":9,"avgCharsPerWord":4.5,"lastRDDTime":"2024-01-01T00:00:00.000Z"}'


@pytest.mark.parametrize(
    ("channel", "message", "reason"),
    [
        ("summary-metrics", SUMMARY, None),
        ("summary-metrics", SUMMARY[:-1], "malformed"),
        ("summary-metrics", SUMMARY + "}", "malformed"),
        ("summary-metrics", SUMMARY.replace('"totalWords":2,', ""), "incomplete"),
        ("summary-metrics", "null", "malformed"),
        ("summary-metrics", None, "empty"),
        ("summary-metrics", " ", "empty"),
        ("detail-metrics", "[]", None),
        ("detail-metrics", '[{"wordLength":1,"count":2}]', None),
        ("detail-metrics", '[{"wordLength":1}]', "incomplete"),
        ("detail-metrics", '[{"wordLength":1,"count":2}', "malformed"),
        ("stream-transitions", '[{"from":"a","to":"b","count":1}, null]', "incomplete"),
    ],
)
def test_reasons_of_rejected_messages(spark, channel, message, reason):
    rows = [(channel, message), ("raw-messages", "word")]
    (got,) = op.parsed_or_rejected(spark.createDataFrame(rows, "channel string, message string"), channel).collect()
    assert got.reason == reason and (got.payload is None) == (reason is not None) and got.message == message


def test_progress_is_noted_for_every_micro_batch(spark, tmp_path, rows):
    kept = st.EpochTable(str(tmp_path / "kept"), "n bigint")
    with st.ProgressLog(spark, str(tmp_path / "progress")) as log:
        assert log.read().count() == 0
        for n in (3, 5):  # the query is started again
            spark.range(n).toDF("n").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema("n bigint").parquet(str(tmp_path / "in"))
            log.wait(run(stream, st.keep_rows(kept), tmp_path / "ck"))
    noted = log.read()
    assert rows(noted, "batch", "n_messages") == [(0, 3), (1, 5)]
    assert noted.select("query").distinct().count() == 1
    shown = st.velocity(noted, 0).collect()
    assert all(r.lag_ms == r.duration_ms > 0 and r.interval_ms == 0 and r.msgs_per_s > 0 for r in shown)
