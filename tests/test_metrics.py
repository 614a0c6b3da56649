from __future__ import annotations

import random

from pyspark.sql import functions as F

from wordtide import operators as op

BATCH = ["", "abc", "abcd", "oval", "zebra", "the", "1234"]


def edges(df, *by):
    return [
        tuple(r)
        for r in df.orderBy(*by, "edge_no").select(*by, "from_node", "to_node", "cnt").collect()
    ]


def test_flow_graph(spark, words):
    assert edges(op.flow_transitions(words(*BATCH))) == [
        ("Source Stream", "Long Words", 4),
        ("Source Stream", "Short Words", 3),
        ("Long Words", "Positive Sentiment", 2),
        ("Long Words", "Negative Sentiment", 2),
        ("Short Words", "Persisted in Database", 3),
        ("Positive Sentiment", "Persisted in Database", 2),
        ("Negative Sentiment", "Persisted in Database", 2),
    ]


def test_summary_and_details(spark, words, rows):
    df = words(*BATCH)
    assert rows(op.summary_metrics(df)) == [(7, 23, 23 / 7)]
    assert rows(op.detail_counts(df)) == [(0, 1), (3, 2), (4, 3), (5, 1)]


def test_no_words_give_zeros(spark, words, rows):
    none = words("x").where("false")
    assert [e[2] for e in edges(op.flow_transitions(none))] == [0] * 7
    assert rows(op.summary_metrics(none)) == [(0, 0, 0.0)]
    assert rows(op.detail_counts(none)) == []


def test_heartbeat_counts_as_no_word(spark, words, rows):
    df = words((1, "abcd"), (1, None), (2, None))
    assert rows(op.summary_metrics(df, ["batch"])) == [(1, 1, 4, 4.0), (2, 0, 0, 0.0)]
    assert rows(op.branch_counts(df, ["batch"])) == [(1, 1, 0, 0, 1), (2, 0, 0, 0, 0)]
    assert rows(op.detail_counts(df, ["batch"])) == [(1, 4, 1)]
    assert rows(op.operational_metrics(df)) == [(1, 1, 1 / 3.0, 3000), (2, 0, 0.0, 3000)]


def many(spark, n=4000, seed=5):
    """Words of 20 batches; batch 0 holds a third of them."""
    pick = random.Random(seed)
    letters = "abcmnopz19"
    return spark.createDataFrame(
        [
            (
                0 if i % 3 == 0 else pick.randrange(20),
                "".join(pick.choice(letters) for _ in range(pick.randrange(12))),
            )
            for i in range(n)
        ],
        "batch bigint, word string",
    )


def test_flow_invariants(spark):
    flow = op.flow_transitions(many(spark), ["batch"])
    wide = flow.groupBy("batch").pivot("edge_no", list(range(1, 8))).agg(F.first("cnt")).collect()
    counted = many(spark).groupBy("batch").agg(F.count("*").alias("n"))
    totals = {r["batch"]: r["n"] for r in counted.collect()}
    assert len(wide) == 20
    for r in wide:
        e = {i: r[str(i)] for i in range(1, 8)}
        assert e[1] + e[2] == totals[r["batch"]]
        assert e[3] + e[4] == e[1]
        assert (e[5], e[6], e[7]) == (e[2], e[3], e[4])


def test_metrics_of_profiles_equal_metrics_of_words(spark, rows):
    df = many(spark)
    parts = [df.where(F.pmod(F.hash("word"), F.lit(3)) == i) for i in range(3)]
    merged = op.length_profile(parts[0], ["batch"])
    for part in parts[1:]:
        merged = merged.unionByName(op.length_profile(part, ["batch"]))
    for metric in (op.flow_transitions, op.summary_metrics, op.detail_counts, op.branch_counts):
        assert rows(metric(merged, ["batch"])) == rows(metric(df, ["batch"]))
        assert rows(metric(merged)) == rows(metric(df))
    again = op.length_profile(merged, ["batch"])
    assert rows(op.flow_transitions(again)) == rows(op.flow_transitions(df))


def test_counts_beyond_32_bits(spark, rows):
    profile = spark.createDataFrame(
        [(1_000, 3_000_000_000, 0)], "word_length int, n_words bigint, n_positive bigint"
    )
    assert rows(op.summary_metrics(profile)) == [(3_000_000_000, 3_000_000_000_000, 1000.0)]
