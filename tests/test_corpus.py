from __future__ import annotations

import os
from collections import Counter
from contextlib import contextmanager

import pytest

from tests.test_functions import cut
from wordtide import operators as op
from wordtide import sources as src

SAMPLE = os.path.join(os.path.dirname(__file__), "sample.txt")


def test_files_are_read_whole(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\nOne two,\nTHREE \n")
    (tmp_path / "b.txt").write_text("four")
    texts = src.read_corpus(spark, str(tmp_path))
    assert texts.count() == 2
    got = sorted(r["word"] for r in op.tokenize(texts).collect())
    assert got == ["", "four", "one", "three", "two"]


def totals(words):
    """Branches, histogram and summary of a list of words, in plain Python."""
    long = [w for w in words if len(w) > 3]
    positive = [w for w in long if ord(w[0]) > 110]
    branches = (len(long), len(words) - len(long), len(positive), len(long) - len(positive))
    chars = sum(map(len, words))
    return branches, sorted(Counter(map(len, words)).items(), key=repr), (len(words), chars)


def check(rows, words, expected):
    branches, lengths, summary = totals(expected)
    assert rows(op.branch_counts(words)) == [branches]
    assert rows(op.detail_counts(words)) == lengths
    assert rows(op.summary_metrics(words), "total_words", "total_chars") == [summary]


def test_every_word(spark, rows):
    with open(SAMPLE, encoding="utf-8") as file:
        expected = cut(file.read())
    assert len(expected) == 98 and expected[0] == ""
    check(rows, op.tokenize(src.read_corpus(spark, SAMPLE)), expected)


def test_distinct_words(spark, rows):
    with open(SAMPLE, encoding="utf-8") as file:
        expected = sorted(set(cut(file.read())))
    words = op.tokenize(src.read_corpus(spark, SAMPLE)).selectExpr("'words' key", "word value")
    check(rows, src.ingest_set(words, within=()).withColumnRenamed("value", "word"), expected)


def test_numbers_are_unique_over_files_and_feeds(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.txt").write_text("three four")
    (tmp_path / "in" / "a.txt").write_text("one two")
    (tmp_path / "in" / "blank.txt").write_text(" ")
    folder = str(tmp_path / "messages")
    for first in (0, 4):
        assert src.next_number(spark, folder, "words") == first
        work = str(tmp_path / f"work{first}")
        messages = src.corpus_messages(spark, str(tmp_path / "in"), "words", first, work=work)
        messages.selectExpr("*", "current_timestamp() ts").write.mode("append").parquet(folder)
    got = spark.read.parquet(folder).orderBy("seq").collect()
    assert [(r["seq"], r["value"]) for r in got] == list(enumerate(["one", "two", "three", "four"] * 2))


@contextmanager
def ranges_of(spark, n_bytes):
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(n_bytes))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def numbered(words):
    got = words.orderBy("seq").collect()
    assert [r["seq"] for r in got] == list(range(len(got)))
    return [r["word"] for r in got]


@pytest.mark.parametrize("n_bytes", [60, 1 << 20])
def test_words_of_ranges_are_those_of_the_whole_text(spark, rows, tmp_path, n_bytes):
    with open(SAMPLE, encoding="utf-8") as file:
        text = file.read()
    with ranges_of(spark, n_bytes):
        words = src.corpus_words(spark, SAMPLE, str(tmp_path / "work"))
        assert numbered(words) == cut(text)
        check(rows, words, cut(text))
        blocks = spark.read.parquet(str(tmp_path / "work" / "blocks")).count()
    assert blocks == 1 if n_bytes > len(text) else blocks > 5


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    lines = [f"line {i}, of\t{'w' * (i % 90)} it's" for i in range(20_000)]
    (tmp_path / "large.txt").write_text("\n" + "\r\n".join(lines))
    with ranges_of(spark, 1 << 16):
        words = src.corpus_words(spark, str(tmp_path / "large.txt"), str(tmp_path / "work"))
        assert numbered(words) == cut("\n" + "\n".join(lines))
    written = spark.read.parquet(str(tmp_path / "work" / "lines"))
    per_range = [r["n"] for r in written.groupBy("block").agg({"*": "count"}).toDF("block", "n").collect()]
    assert len(per_range) > 10 and max(per_range) < 4_000


TEXTS = [
    "", " ", "\n", "!!", "!!\n", "\n!!", "! !", "a", " a", "a ", "\na", "a\n", "-\na", "-a", "- a", ". . .\n\n b\r\nc d",
    "\n\n", "\u00e9\u00e8", "\u00e9\nx", "x\x0by\x0cz", "one\rtwo", "A" * 50 + " b",
]


@pytest.mark.parametrize("n_bytes", [16, 1 << 20])
def test_words_of_files_follow_each_other_in_the_order_of_names(spark, tmp_path, n_bytes):
    (tmp_path / "in").mkdir()
    for i, text in enumerate(TEXTS):
        (tmp_path / "in" / f"{i:03}.txt").write_bytes(text.encode())
    with ranges_of(spark, n_bytes):
        words = src.corpus_words(spark, str(tmp_path / "in"), str(tmp_path / "work"))
        assert numbered(words) == [w for text in TEXTS if text for w in cut(text)]
        assert words.columns == ["file", "seq", "word"]


def test_files_without_words(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "empty.txt").write_text("")
    (tmp_path / "in" / "blank.txt").write_text(" \n\t\n")
    assert src.corpus_words(spark, str(tmp_path / "in"), str(tmp_path / "work")).count() == 0
