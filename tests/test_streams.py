from __future__ import annotations

import os
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from wordtide import operators as op
from wordtide import sources as src
from wordtide import streaming as st
from wordtide.operators import batches, tokenize

TEXTS = [f"{'w' * (i % 7)}ord number {i} isn't Zeta oval of {i * i}" for i in range(40)] + [" ", ""]
SCHEMA = "doc_id bigint, text string"


@pytest.fixture
def arrivals(spark, tmp_path):
    """A folder that files arrive in, and the texts that have arrived so far."""

    class Arrivals:
        path = str(tmp_path / "in")
        so_far = []

        def add(self, texts):
            start = len(self.so_far)
            new = [(start + i, t) for i, t in enumerate(texts)]
            self.so_far = self.so_far + new
            spark.createDataFrame(new, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

        def bounded(self):
            return cut(spark.createDataFrame(self.so_far, SCHEMA))

        def stream(self):
            reader = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
            return cut(reader.parquet(self.path))

    return Arrivals()


def cut(docs):
    # batches of three documents, so that batches straddle files
    return tokenize(
        docs.select("doc_id", batches.batch_of(F.col("doc_id"), 3).alias("batch"), "text")
    )


def test_profiles_over_micro_batches_equal_the_bounded_metrics(spark, arrivals, tmp_path, rows):
    kept = st.profile_table(str(tmp_path / "profiles"), "batch bigint")
    for texts in (TEXTS[:10], TEXTS[10:11], TEXTS[11:40], TEXTS[40:]):
        arrivals.add(texts)
    st.finish(
        st.start(arrivals.stream(), st.keep_profiles(kept, ["batch"]), str(tmp_path / "ck"))
    )
    stored = kept.read(spark)
    assert stored.select("epoch").distinct().count() == 4
    for metric in (op.flow_transitions, op.summary_metrics, op.detail_counts):
        assert rows(metric(stored, ["batch"])) == rows(metric(arrivals.bounded(), ["batch"]))
        assert rows(metric(stored)) == rows(metric(arrivals.bounded()))


def test_restart_loses_and_repeats_nothing(spark, arrivals, tmp_path, rows):
    kept = st.profile_table(str(tmp_path / "profiles"), "batch bigint")
    batch = st.keep_profiles(kept, ["batch"])
    checkpoint = str(tmp_path / "ck")
    arrivals.add(TEXTS[:5])
    st.finish(st.start(arrivals.stream(), batch, checkpoint))
    arrivals.add(TEXTS[5:9])

    def fails_after_writing(words, epoch):
        batch(words, epoch)
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        st.finish(st.start(arrivals.stream(), fails_after_writing, checkpoint))
    st.finish(st.start(arrivals.stream(), batch, checkpoint))  # the lost batch again
    st.finish(st.start(arrivals.stream(), batch, checkpoint))  # nothing new
    stored = kept.read(spark)
    assert stored.select("epoch").distinct().count() == 2
    assert rows(op.flow_transitions(stored)) == rows(op.flow_transitions(arrivals.bounded()))


def test_table_that_nothing_was_written_to_is_empty(spark, tmp_path, rows):
    kept = st.profile_table(str(tmp_path / "none"), "batch bigint")
    assert kept.read(spark).count() == 0
    assert rows(op.summary_metrics(kept.read(spark))) == [(0, 0, 0.0)]
    assert st.ChannelTable(str(tmp_path / "none")).read(spark).count() == 0


def test_channels_publish_each_micro_batch(spark, arrivals, tmp_path, rows):
    channels = st.ChannelTable(str(tmp_path / "channels"))
    arrivals.add(TEXTS[:6])
    arrivals.add(TEXTS[6:10])
    stream = arrivals.stream().withColumn("seq", F.col("doc_id") * 100 + F.col("pos"))
    st.finish(st.start(stream, st.publish_channels(channels), str(tmp_path / "ck")))
    published = channels.read(spark)
    per_channel = published.groupBy("batch_id", "channel").count()
    assert {(r[0], r[1]) for r in per_channel.collect()} == {
        (b, c)
        for b in (0, 1)
        for c in ("stream-transitions", "summary-metrics", "detail-metrics", "raw-messages")
    }
    bounded = arrivals.bounded()
    raw = channels.read(spark, ["raw-messages"])
    expected = bounded.select((F.col("doc_id") * 100 + F.col("pos")).alias("seq"), "word")
    assert rows(raw, "seq", "message") == rows(expected)
    in_batch = F.when(F.col("doc_id") < 6, 0).otherwise(1).alias("batch_id")
    epochs = bounded.select(in_batch, "word")
    assert rows(op.parse_transitions(published, ["batch_id"])) == rows(
        op.flow_transitions(epochs, ["batch_id"])
    )
    assert rows(op.parse_details(published, ["batch_id"])) == rows(
        op.detail_counts(epochs, ["batch_id"])
    )
    assert rows(op.parse_summaries(published, ["batch_id"]).drop("batch_time")) == rows(
        op.summary_metrics(epochs, ["batch_id"])
    )


def test_publishing_again_replaces(spark, words, tmp_path, rows):
    channels = st.ChannelTable(str(tmp_path / "channels"))
    channels.publish(words("one", "three"), 4)
    channels.publish(words("seventy"), 5)
    before = rows(channels.read(spark).where("channel != 'summary-metrics'"))
    channels.publish(words("one", "three"), 4)
    assert rows(channels.read(spark).where("channel != 'summary-metrics'")) == before
    assert channels.read(spark, ["summary-metrics"]).count() == 2


def test_idle_micro_batch_is_published(spark, words, tmp_path, rows):
    channels = st.ChannelTable(str(tmp_path / "channels"))
    channels.publish(words("x").where("false"), 0)
    published = channels.read(spark)
    assert rows(op.channel_totals(published)) == [
        ("detail-metrics", 1), ("stream-transitions", 1), ("summary-metrics", 1),
    ]
    assert rows(op.parse_summaries(published).drop("batch_time")) == [(0, 0, 0.0)]
    assert op.parse_transitions(published).agg(F.max("cnt")).first()[0] == 0


def test_heartbeat_keeps_an_idle_stream_publishing(spark, arrivals, tmp_path):
    channels = st.ChannelTable(str(tmp_path / "channels"))
    arrivals.add(["hello oval world"])
    words = arrivals.stream().select("word")
    query = st.start(
        src.heartbeat_stream(words), st.publish_channels(channels), str(tmp_path / "ck"),
        follow=True,
    )
    try:
        deadline = time.time() + 60
        summaries = []
        while time.time() < deadline and len(summaries) < 3:
            time.sleep(1)
            found = op.parse_summaries(channels.read(spark, ["summary-metrics"]), ["batch_id"])
            summaries = sorted(tuple(r)[:3] for r in found.collect())
        progress = op.progress_view(spark, query).collect()
    finally:
        query.stop()
    assert len(summaries) >= 3
    assert sum(n for _, n, _ in summaries) == 3  # the three words, once
    assert (0, 0) in [s[1:] for s in summaries]  # and idle batches besides
    assert len(progress) >= 2 and all(r["duration_ms"] > 0 for r in progress[:2])


def test_ticks(spark, tmp_path):
    query = (
        src.ticks(spark, 5).writeStream.format("memory").queryName("ticks")
        .option("checkpointLocation", str(tmp_path / "ck")).start()
    )
    try:
        deadline = time.time() + 30
        while time.time() < deadline and spark.table("ticks").count() < 5:
            time.sleep(0.5)
    finally:
        query.stop()
    got = [r["tick"] for r in spark.table("ticks").orderBy("tick").collect()]
    assert len(got) >= 5 and got == list(range(len(got)))


def test_raw_channel_alone(spark, arrivals, tmp_path, rows):
    arrivals.add(TEXTS[:3])
    arrivals.add(TEXTS[3:8])
    out = str(tmp_path / "raw")
    for _ in range(2):
        st.finish(
            st.publish_raw(arrivals.stream(), out, str(tmp_path / "ck"), "doc_id", "pos")
        )
    expected = arrivals.bounded().select(F.lit("raw-messages"), "doc_id", "pos", "word")
    assert rows(spark.read.parquet(out)) == rows(expected)


def test_sets_over_micro_batches(spark, arrivals, tmp_path, rows):
    kept = st.EpochTable(str(tmp_path / "sets"), "batch bigint, key string, value string")
    arrivals.add(TEXTS[:4])
    arrivals.add(TEXTS[4:12])

    def messages(words):
        return words.select("batch", F.lit("k").alias("key"), F.col("word").alias("value"))

    st.finish(
        st.start(messages(arrivals.stream()), st.keep_sets(kept), str(tmp_path / "ck"))
    )
    merged = kept.read(spark).select("batch", "key", "value").distinct()
    assert rows(merged) == rows(messages(arrivals.bounded()).distinct())


def test_folders(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert st.shared_folder(spark) == shared
    first, second = st.run_folder(spark, "x"), st.run_folder(spark, "x")
    assert first.startswith(f"{shared}/wordtide/x-") and first != second


def test_a_cluster_must_name_its_shared_folder():
    def session(master, **conf):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default="warehouse": conf.get("folder", default)),
            sparkContext=SimpleNamespace(master=master),
        )

    assert st.shared_folder(session("yarn", folder="s3://bucket/tmp/")) == "s3://bucket/tmp"
    assert st.shared_folder(session("local[2]")) == "warehouse"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        st.shared_folder(session("yarn"))


def test_a_batch_published_again_is_delivered_once(spark, words, tmp_path):
    table = st.ChannelTable(str(tmp_path / "channels"))
    got = []

    def deliver(messages, epoch):
        got.extend((r["batch_id"], r["message"]) for r in messages.collect())

    def listen():
        query = st.subscribe_live(spark, table, deliver, str(tmp_path / "ck"), ["raw-messages"])
        st.finish(query)

    table.publish(words("one"), 0)
    table.publish(words("two"), 1)
    listen()
    table.publish(words("two"), 1)  # again after a failure
    table.publish(words("three"), 2)
    listen()
    assert sorted(got) == [(0, "one"), (1, "two"), (2, "three")]
