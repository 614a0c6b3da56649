"""The commit log, merging and retention of a channel table, and subscriptions to it."""

from __future__ import annotations

import os
import time

from wordtide import operators as op
from wordtide import streaming as st
from wordtide.streaming import log as log_module
from wordtide.streaming.log import CommitLog, Folder, Manifest


def files_below(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_ten_thousand_batches_leave_few_folders():
    seen, names = Manifest(), set()
    for batch in range(10_000):
        seen = seen.with_commit(Folder(f"b{batch}", batch, batch, 7, 7), batch)
        names.add(f"b{batch}")
        while old := seen.due():
            merged = Folder(f"m{old[0].first}-{old[-1].last}", old[0].first, old[-1].last, sum(f.n_raw for f in old), 15, old[0].tier + 1)
            seen = seen.with_merged(old, merged)
            names.add(merged.name)
        names -= set(seen.expired())
        seen = seen.without_expired()
        assert len(names) < 80  # of two folders each
    assert Manifest.from_json(seen.to_json()) == seen
    covered = [c for f in seen.folders for c in range(f.first, f.last + 1)]
    assert covered == list(range(10_000)) and len(seen.folders) < 40
    assert sum(f.n_raw for f in seen.folders) == 70_000
    assert {f.name for f in seen.folders} <= names
    assert [f.name for f in seen.after(9_995, 9_997)] == [f.name for f in seen.folders if f.first <= 9_996 and f.last >= 9_995]


def test_a_version_is_taken_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.latest() == Manifest()
    first, second = (Manifest().with_commit(Folder(n, 0, 0, 1, 1), 5) for n in ("a", "b"))
    assert log.put(first, "x") and not log.put(second, "y")
    assert log.latest() == first
    assert not [f for f in os.listdir(tmp_path / "log") if f.endswith("tmp")]


def test_what_was_not_committed_is_not_seen(spark, words, tmp_path, monkeypatch):
    table = st.ChannelTable(str(tmp_path / "channels"))
    table.publish(words("one"), 0)

    def lost(self, manifest, token):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(CommitLog, "put", lost)
        try:
            table.publish(words("two", "three"), 1)
        except OSError:
            pass
    assert table.newest(spark) == 0 and table.read(spark).count() == 4
    table.publish(words("two"), 1)
    table.publish(words("other"), 1)  # published already
    raw = table.read(spark, ["raw-messages"])
    assert sorted((r.batch_id, r.message) for r in raw.collect()) == [(0, "one"), (1, "two")]


def test_merging_keeps_every_message_and_the_newest_words(spark, words, tmp_path, monkeypatch):
    monkeypatch.setattr(log_module, "MERGE", 4)
    monkeypatch.setattr(log_module, "GRACE", 3)
    table, n = st.ChannelTable(str(tmp_path / "channels")), 11
    for batch in range(n):
        table.publish(words(f"w{batch:02d}", "tail") if batch % 3 else words("x").where("false"), batch)
    log = CommitLog(spark, f"{table.path}/log").latest()
    assert [f.tier for f in log.folders] == [1, 1, 0, 0, 0] and log.commits == n
    every = table.read(spark)
    raw = sorted((r.batch_id, r.message) for r in op.subscribe(every, ["raw-messages"]).collect())
    assert raw == sorted((i, w) for i in range(n) if i % 3 for w in (f"w{i:02d}", "tail"))
    totals = sorted((r.batch_id, r.total_words) for r in op.parse_summaries(every, ["batch_id"]).collect())
    assert totals == [(i, 2 if i % 3 else 0) for i in range(n)]
    recent = [r.word for r in op.published_recent(table.recent(spark)).orderBy("rank").collect()]
    assert recent == [w for i in reversed(range(n)) if i % 3 for w in (f"w{i:02d}", "tail")][:15]
    assert table.recent(spark).count() <= 45
    kept = st.ChannelTable(table.path, keep=4)
    kept.publish(words("end"), n)
    assert min(r.batch_id for r in kept.read(spark).collect()) == 8
    for batch in range(n + 1, n + 5):
        kept.publish(words("more"), batch)
    live = {f.name for f in CommitLog(spark, f"{table.path}/log").latest().folders}
    assert len([d for d in os.listdir(table.path) if d != "log"]) <= len(live) + 6


def test_a_subscriber_may_start_first_and_reads_new_files_alone(spark, words, tmp_path):
    table, got, read = st.ChannelTable(str(tmp_path / "channels")), [], []

    def deliver(messages, epoch):
        read.append(sorted({p.split("/channels/")[1].split("/")[0][:10] for p in inputs()}))
        got.extend((r.batch_id, r.message) for r in messages.collect())

    from wordtide.streaming import subscription

    def inputs():
        return opened

    opened = []
    stream = subscription.ChannelStream({"path": table.path, "log": f"{table.path}/log", "channels": "raw-messages"})
    assert stream.latestOffset() == {"commits": 0} and [p.path for p in stream.partitions({"commits": 0}, {"commits": 0})] == [""]

    def listen():
        st.finish(st.subscribe_live(spark, table, deliver, str(tmp_path / "ck"), ["raw-messages"]))

    listen()
    assert got == []
    for batch in range(12):
        table.publish(words(f"w{batch}"), batch)
    listen()
    assert sorted(got) == sorted((i, f"w{i}") for i in range(12))
    table.publish(words("late"), 12)
    new = stream.partitions({"commits": 12}, {"commits": 13})
    assert {p.path.split("/raw/")[0].split("/")[-1][:10] for p in new} == {"0000000012"}
    listen()
    assert sorted(got)[-1] == (12, "late") and len(got) == 13


def test_metrics_are_echoed_while_the_job_follows(spark, words, tmp_path):
    table, got = st.ChannelTable(str(tmp_path / "channels")), []
    query = st.subscribe_live(
        spark, table, lambda m, e: got.extend(r.channel for r in m.collect()), str(tmp_path / "ck"), ["summary-metrics"], follow=True
    )
    try:
        table.publish(words("one"), 0)
        deadline = time.time() + 60
        while time.time() < deadline and not got:
            time.sleep(0.5)
    finally:
        query.stop()
    assert got == ["summary-metrics"]
