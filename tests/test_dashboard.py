from __future__ import annotations

import random

from pyspark.sql import functions as F

from wordtide import operators as op


def test_summary_cards(spark, words, rows):
    df = words((7, "abcd"), (7, "is"), (7, "a"))
    assert rows(op.summary_cards(df)) == [(3, 7, 233, "2.33", 7)]
    assert rows(op.summary_cards(words((8, None)))) == [(0, 0, 0, "0.00", 8)]


def test_flow_rows_floor_zero_weights(spark, words):
    flow = op.flow_rows(words("oval", "oval"))
    assert flow.columns == ["From", "To", "Weight"]
    weights = {(r["From"], r["To"]): r["Weight"] for r in flow.collect()}
    assert weights["Source Stream", "Long Words"] == 2
    assert weights["Source Stream", "Short Words"] == 1
    assert weights["Long Words", "Negative Sentiment"] == 1


def test_detail_list_is_the_ten_shortest(spark, words):
    df = words(*["x" * n for n in range(14, -1, -1)], "xx")
    assert [tuple(r) for r in op.detail_list(df).collect()] == [
        (n, 2 if n == 2 else 1) for n in range(10)
    ]


def test_latest_batch(spark, rows):
    df = spark.range(11).withColumnRenamed("id", "n")
    assert rows(op.latest_batch(df, "n", 3)) == [(10,), (9,)]
    assert rows(op.latest_batch(df, "n")) == [(10,)]


def test_latest_interval(spark, rows):
    times = ["2024-01-01 00:00:59", "2024-01-01 00:05:00", "2024-01-01 00:09:59.9"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("ts"), "t"
    )
    assert rows(op.latest_interval(df, "ts", 300), "t") == [(times[1],), (times[2],)]


def test_recent_words(spark):
    from tests.test_functions import cut

    pick = random.Random(3)
    texts = [
        (i, pick.choice(["", " ", "\t\n", "a", " b c ", "d e f g", "!", "x y"])) for i in range(60)
    ]
    df = spark.createDataFrame(texts, "n bigint, body string").repartition(5)
    expected = [w for _, t in reversed(texts) for w in reversed(cut(t))]
    for limit in (1, 15, 1000):
        got = op.recent_words(df, "n", "body", limit).orderBy("rank").collect()
        assert [r["rank"] for r in got] == list(range(1, len(got) + 1))
        assert [r["word"] for r in got] == expected[:limit]


def test_recent_words_of_nothing(spark):
    df = spark.createDataFrame([(1, " ")], "n bigint, text string")
    assert op.recent_words(df, "n").count() == 0
