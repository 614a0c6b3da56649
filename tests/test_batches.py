from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wordtide import operators as op

TIMES = [
    ("2024-01-01 00:00:00", 0),
    ("2024-01-01 00:04:59.999999", 0),
    ("2024-01-01 00:05:00", 1),
    ("2024-03-10 02:30:00", 19902),  # does not exist in New York
    ("2024-03-31 02:30:00", 25950),  # does not exist in Berlin
    ("2024-10-27 02:30:00", 86430),  # exists twice in Berlin
    ("2023-12-31 23:59:59.5", -1),
    ("2023-12-31 23:55:00", -1),
    ("2023-12-31 23:54:59.9", -2),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Berlin", "Asia/Kathmandu"])
def test_interval_numbers_do_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t, _ in TIMES], "t string")
        ts = F.col("t").cast("timestamp_ntz")
        number = op.interval_number(ts, 300, "2024-01-01 00:00:00")
        start = op.interval_start(number, 300, "2024-01-01 00:00:00")
        got = df.select(
            number.alias("n"), (ts >= start).alias("ge"),
            (ts < start + F.expr("INTERVAL 300 SECONDS")).alias("lt"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r["n"] for r in got] == [n for _, n in TIMES]
    assert all(r["ge"] and r["lt"] for r in got)


@pytest.mark.parametrize("first,last", [(0, 0), (-3, 4), (65_530, 65_540), (-70_000, 140_000)])
def test_every_batch(spark, first, last):
    ends = spark.createDataFrame([(first,), (last,)], "batch bigint")
    stats = op.every_batch(ends).agg(
        F.count("*"), F.countDistinct("batch"), F.min("batch"), F.max("batch")
    )
    n = last - first + 1
    assert tuple(stats.first()) == (n, n, first, last)


def test_every_batch_of_nothing(spark):
    assert op.every_batch(spark.createDataFrame([], "batch bigint")).count() == 0


def test_idle_batches_report_zeros(spark, words, rows):
    df = op.with_heartbeats(words((3, "abcd"), (6, "oval"), (6, "is")))
    assert rows(op.summary_metrics(df, ["batch"])) == [
        (3, 1, 4, 4.0), (4, 0, 0, 0.0), (5, 0, 0, 0.0), (6, 2, 6, 3.0),
    ]
    flow = op.flow_transitions(df, ["batch"])
    assert flow.count() == 4 * 7
    assert flow.where("batch in (4, 5)").agg(F.max("cnt")).first()[0] == 0
    profile = op.length_profile(words((3, "abcd"), (6, "oval"), (6, "is")), ["batch"])
    filled = op.profile_with_heartbeats(profile)
    assert rows(op.flow_transitions(filled, ["batch"])) == rows(flow)


def test_span_of_the_source_rows(spark, words, rows):
    span = spark.createDataFrame([(1,), (4,)], "batch bigint")
    df = op.with_heartbeats(words((2, "abcd")), span=span)
    assert rows(op.summary_metrics(df, ["batch"]).select("batch", "total_words")) == [
        (1, 0), (2, 1), (3, 0), (4, 0),
    ]
