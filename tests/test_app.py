from __future__ import annotations

from wordtide import app
from wordtide import operators as op
from wordtide import streaming as st

TEXT = "\nThe oval zebra isn't the oval, the ZEBRA: it is an aardvark.\n"
WORDS = ["", "the", "oval", "zebra", "isnt", "the", "oval", "the", "zebra"] + [
    "it", "is", "an", "aardvark",
]


def run(spark, tmp_path, struct):
    corpus = tmp_path / "corpus.txt"
    corpus.write_text(TEXT)
    messages, channels = str(tmp_path / "messages"), str(tmp_path / "channels")
    app.feed(spark, str(corpus), messages)
    app.feed(spark, str(corpus), messages, key="other")
    query = app.run_job(
        spark, messages, channels, str(tmp_path / "ck"), options={"struct": struct}, follow=False
    )
    st.finish(query)
    return channels


def test_list_job(spark, tmp_path, rows):
    channels = run(spark, tmp_path, "list")
    raw = st.ChannelTable(channels).read(spark, ["raw-messages"])
    assert [r["message"] for r in raw.orderBy("seq").collect()] == WORDS
    views = app.dashboard(spark, channels)
    (summary,) = views["Latest batch"].collect()
    chars = sum(map(len, WORDS))
    assert (summary["total_words"], summary["total_chars"], summary["last_batch"]) == (13, chars, 0)
    flow = {(r["From"], r["To"]): r["Weight"] for r in views["Word flow"].collect()}
    assert flow["Source Stream", "Long Words"] == 6
    assert flow["Long Words", "Positive Sentiment"] == 4
    assert [tuple(r) for r in views["Shortest words by length"].collect()] == [
        (0, 1), (2, 3), (3, 3), (4, 3), (5, 2), (8, 1),
    ]
    recent = [r["word"] for r in views["Newest words"].orderBy("rank").collect()]
    assert recent == WORDS[::-1]


def test_set_job(spark, tmp_path, rows):
    channels = run(spark, tmp_path, "set")
    published = st.ChannelTable(channels).read(spark)
    raw = op.subscribe(published, ["raw-messages"])
    assert sorted(r["message"] for r in raw.collect()) == sorted(set(WORDS))
    assert rows(op.parse_summaries(published), "total_words") == [(len(set(WORDS)),)]


def test_dashboard_follows_the_newest_batch(spark, words, tmp_path, rows):
    channels = st.ChannelTable(str(tmp_path / "channels"))
    channels.publish(words("oval", "zebra"), 0)
    channels.publish(words("x").where("false"), 1)
    views = app.dashboard(spark, channels.path)
    assert rows(views["Latest batch"], "total_words", "last_batch") == [(0, 1)]
    assert rows(views["Word flow"].selectExpr("max(Weight)")) == [(1,)]
    assert views["Shortest words by length"].count() == 0
    assert views["Newest words"].count() == 2  # an idle batch pushes nothing off the list


def test_commands(spark, tmp_path, capsys):
    (tmp_path / "c.txt").write_text(TEXT)
    messages, channels = str(tmp_path / "m"), str(tmp_path / "out")
    app.main(["feed", "--corpus", str(tmp_path / "c.txt"), "--messages", messages])
    app.main(
        ["run", "--messages", messages, "--channels", channels, "--checkpoint",
         str(tmp_path / "ck"), "--struct", "set", "--once", "--echo"]
    )
    app.main(["show", "--channels", channels])
    shown = capsys.readouterr().out
    assert '0 summary-metrics {"totalWords":' in shown
    assert "Latest batch" in shown and "aardvark" in shown
    noted = app.dashboard(spark, channels)["Micro-batches"].where("n_messages > 0").collect()
    assert len({r["query"] for r in noted}) == 2  # the job and the echo
    stream = spark.readStream.schema("key string, value string, seq bigint").parquet(messages)
    st.finish(st.echo(stream, str(tmp_path / "ck2")))


def test_lists_are_drained_in_rounds_and_sets_in_a_stable_order(spark):
    rows = [("b", "b1", 5), ("a", "a1", 5), ("a", "a2", 6), ("a", "a2", 9), (None, None, None)]
    messages = spark.createDataFrame(rows, "key string, value string, seq bigint")
    keys = ["b", "a"]
    drained = app.in_arrival_order(messages, "list", keys).where("value is not null").orderBy("seq")
    assert [(r["seq"], r["value"]) for r in drained.collect()] == [
        (0, "a1"), (1, "b1"), (2, "a2"), (4, "a2"),
    ]
    order = lambda: [
        r["value"] for r in app.in_arrival_order(messages, "set", keys).orderBy("seq").collect()
    ]
    assert order() == order() and sorted(filter(None, order())) == ["a1", "a2", "b1"]


def test_operation_view(spark, words, tmp_path, rows):
    channels = st.ChannelTable(str(tmp_path / "channels"))
    assert channels.newest(spark) is None
    channels.publish(words("oval", "zebra", "a"), 4)
    assert channels.newest(spark) == 4
    (row,) = app.dashboard(spark, channels.path)["Operation"].collect()
    assert tuple(row)[:4] == (4, 3, 1.0, 3000) and row["batch_time"] is not None
    (cards,) = app.dashboard(spark, channels.path)["Latest batch"].collect()
    assert (cards["avg_hundredths"], cards["avg_shown"]) == (333, "3.33")
