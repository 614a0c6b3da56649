from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wordtide import operators as op
from wordtide import sources as src


@pytest.fixture
def messages(spark):
    return spark.createDataFrame(
        [
            (0, "a", 1, "x"), (0, "a", 2, "x"), (0, "b", 3, "x"), (0, "b", 4, None),
            (1, "a", 5, "x"), (1, "c", 6, "y"), (1, None, 7, "z"),
        ],
        "batch bigint, key string, seq bigint, value string",
    )


def test_structure_option():
    assert src.structure_of(None) == "list"
    assert src.structure_of({}) == "list"
    assert src.structure_of({"struct": "set", "timeout": "0"}) == "set"
    with pytest.raises(ValueError, match="list and set"):
        src.structure_of({"struct": "hash"})


def test_unsupported_structure_is_refused_by_ingest(messages):
    with pytest.raises(ValueError):
        src.ingest(messages, options={"struct": "stream"})


def test_keys_and_nulls(messages, rows):
    assert rows(src.keyed_messages(messages, {"a", "zz"}), "seq") == [(1,), (2,), (5,)]
    assert rows(src.keyed_messages(messages), "seq") == [(1,), (2,), (3,), (5,), (6,)]
    assert src.keyed_messages(messages, []).count() == 0


def test_list_keeps_duplicates_set_does_not(messages, rows):
    assert rows(src.ingest(messages), "seq") == [(1,), (2,), (3,), (5,), (6,)]
    assert rows(src.ingest(messages, options={"struct": "set"})) == [
        (0, "a", "x"), (0, "b", "x"), (1, "a", "x"), (1, "c", "y"),
    ]


def drained(rows_in):
    """Rounds by definition: the n-th message of a key comes in round n."""
    groups = defaultdict(list)
    for batch, key, seq in rows_in:
        groups[batch, key].append(seq)
    return sorted(
        (b, k, s, n)
        for (b, k), seqs in groups.items()
        for n, s in enumerate(sorted(seqs), start=1)
    )


@pytest.mark.parametrize("bits", [16, 22, 32])
def test_round_robin_equals_definition(spark, rows, bits):
    pick = random.Random(bits)
    data = set()
    for i in range(600):
        # a third of all rows in one group, sequence numbers dense, sparse, huge and negative
        batch, key = (0, "hot") if i % 3 == 0 else (pick.randrange(3), pick.choice("abc"))
        seq = pick.choice(
            [
                i,
                pick.randrange(1 << 20),
                pick.randrange(1 << 40),
                pick.randrange(-(1 << 62), 1 << 62),
            ]
        )
        data.add((batch, key, seq))
    df = spark.createDataFrame(sorted(data), "batch bigint, key string, seq bigint")
    got = op.round_robin_drain(df, slice_bits=bits)
    assert got.columns == ["batch", "key", "seq", "round"]
    assert [tuple(r) for r in got.orderBy("batch", "key", "seq").collect()] == drained(data)


def test_round_robin_keeps_the_payload_and_interleaves(spark, messages):
    drained_rows = op.round_robin_drain(src.keyed_messages(messages))
    got = drained_rows.orderBy("batch", "round", "key").select("key", "seq", "value").collect()
    assert [tuple(r) for r in got] == [
        ("a", 1, "x"), ("b", 3, "x"), ("a", 2, "x"), ("a", 5, "x"), ("c", 6, "y"),
    ]


def test_windows_of_the_drain_are_bounded(messages):
    """Rows and slices are numbered inside a slice; only the coarsest slices inside a group."""
    plan = op.round_robin_drain(messages)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line.split("], [")[1] for line in plan.split("\n") if "Window [" in line]
    assert len(windows) == 3
    assert sum("_slice" in w for w in windows) == 1
    assert sum("_around" in w for w in windows) == 1


def test_read_and_stream_messages(spark, messages, tmp_path, rows):
    path = str(tmp_path / "messages")
    messages.select("key", "value", "seq", F.lit(None).cast("timestamp").alias("ts")).write.parquet(
        path
    )
    assert rows(src.read_messages(spark, path, {"a"}), "seq") == [(1,), (2,), (5,)]
    stream = src.stream_messages(spark, path, {"a"})
    assert stream.isStreaming
    query = (
        stream.writeStream.format("memory").queryName("keyed").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "ck")).start()
    )
    query.awaitTermination()
    assert rows(spark.table("keyed"), "seq") == [(1,), (2,), (5,)]


def test_drain_keeps_rows_with_nulls(spark, rows):
    given = [(1, "a", 3), (1, "a", None), (1, "a", None), (None, "a", 3), (1, None, 7), (1, None, 2)]
    frame = spark.createDataFrame(given, "batch bigint, key string, seq bigint")
    assert rows(op.round_robin_drain(frame, slice_bits=2)) == sorted(
        [
            (1, "a", 3, 1), (1, "a", None, 2), (1, "a", None, 3),
            (None, "a", 3, 1), (1, None, 2, 1), (1, None, 7, 2),
        ],
        key=repr,
    )
