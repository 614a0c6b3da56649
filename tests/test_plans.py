"""Properties of the physical plans that the design relies on."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wordtide import operators as op
from wordtide.plans import BOUNDED
from wordtide.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def folder(spark, tmp_path):
    """Tables of several row groups each, in arrival order."""
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.lit("word oval"), F.sha2(F.col("id").cast("string"), 512)).alias("text"),
        F.when(F.col("id") % 3 == 0, "en").otherwise("de").alias("lang"),
    )
    docs.coalesce(1).write.option("parquet.block.size", 64 * 1024).parquet(
        str(tmp_path / "documents.parquet")
    )
    events = spark.range(3000).select(
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id)").alias("ts"),
        F.lit("click").alias("event_type"),
    )
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    turns = spark.range(300).select(
        F.col("id").alias("conv_id"), F.lit(0).cast("bigint").alias("turn"),
        F.lit("user").alias("role"), F.lit("hi").alias("text"),
    )
    turns.write.parquet(str(tmp_path / "conversations.parquet"))
    return str(tmp_path)


def test_no_query_leaves_the_jvm(spark, folder):
    for name, query in BOUNDED.items():
        text = plan(query(spark, folder))
        assert "Python" not in text and "Pandas" not in text, name
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_words_are_cut_once_per_text(spark, folder):
    text = plan(BOUNDED["flow_transitions"](spark, folder))
    assert text.count("regexp_replace") == 1
    assert text.count("Exchange") == 1
    assert "ReadSchema: struct<text:string>" in text


def test_projections_do_not_shuffle(spark, folder):
    for name in ("tokenize_words", "classify_words", "filter_long", "raw_messages", "list_ingest"):
        assert "Exchange" not in plan(BOUNDED[name](spark, folder)), name


def test_key_filter_is_pushed_down(spark, folder):
    text = plan(BOUNDED["keyed_messages"](spark, folder))
    assert "In(role, [assistant,user])" in text


def scanned_rows(df, column):
    """Rows that came out of the scan which reads ``column``, after running ``df``."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan()
    found = []

    def visit(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return visit(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return visit(node.plan())
        output = node.simpleString(50).split("]")[0]
        if node.nodeName().startswith("Scan parquet") and column in output:
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(final)
    return found


def test_latest_batch_skips_older_row_groups(spark, folder):
    docs = tables.table(spark, folder, "documents")
    latest = op.latest_batch(docs, "doc_id", 3).select("doc_id", "text")
    (read,) = scanned_rows(latest, "text")
    assert latest.count() == 3
    assert read < 1500


def test_heartbeats_add_one_pass_over_the_time_column(spark, folder):
    text = plan(BOUNDED["zero_filled_transitions"](spark, folder))
    assert text.count("FileScan") == 2
    assert text.count("ReadSchema: struct<ts:timestamp_ntz>") == 1
    assert "Join" not in text


def test_newest_words_are_found_without_older_texts(spark, folder):
    docs = tables.table(spark, folder, "documents")
    newest = op.recent_words(docs, "doc_id")
    (read,) = scanned_rows(newest, "text")
    assert newest.count() == 15 and read < 1500


def test_newest_words_behind_many_blank_texts(spark):
    texts = spark.range(1000).selectExpr("id as n", "if(id < 3, concat('w', id), ' ') as text")
    got = [r["word"] for r in op.recent_words(texts, "n").orderBy("rank").collect()]
    assert got == ["w2", "w1", "w0"]


def test_fan_out_reads_texts_once(spark, folder):
    assert plan(BOUNDED["channel_fanout"](spark, folder)).count("FileScan") == 1
