"""Metrics of a batch of words: branch counts, flow graph, summary, length histogram.

Every metric takes ``rows`` and a list of batch columns ``by``; an empty list makes the whole input
one batch. ``rows`` is either words, or *measured* rows, which carry

    word_length   length shared by the words of the row (null for none)
    n_words       how many words the row stands for
    n_positive    how many of them are long and positive

A word is a measured row of weight one, and ``length_profile`` sums measured rows into fewer ones.
So profiles of parts of a batch merge into the profile of the batch, in any order and grouping, and
a metric over a profile equals the metric over its words. That is what lets one pass over the words
feed all metrics, and a stream keep mergeable parts in place of state.

A row with a null word is a heartbeat: it counts as no word, but its batch shows up with zeros.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.fixed import FLOW_EDGES, LONG_WORD_OVER
from wordtide.functions import average, is_long_positive

MEASURES = ("word_length", "n_words", "n_positive")


def measure(rows: DataFrame) -> DataFrame:
    """Words as measured rows; rows that are measured already stay as they are."""
    if set(MEASURES) <= set(rows.columns):
        return rows
    word = F.col("word")
    return rows.withColumns(
        {
            "word_length": F.length(word),
            "n_words": F.when(word.isNotNull(), F.lit(1)).otherwise(F.lit(0)),
            "n_positive": F.when(is_long_positive(word), F.lit(1)).otherwise(F.lit(0)),
        }
    )


def length_profile(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Measured rows, one per batch and word length.

    The partial aggregation leaves a task at most one row per (batch, length) it has seen, so a
    batch that holds most of all words is as small in the shuffle as any other.
    """
    return (
        measure(rows)
        .groupBy(*by, "word_length")
        .agg(F.sum("n_words").alias("n_words"), F.sum("n_positive").alias("n_positive"))
    )


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0).cast("bigint"))


def branch_totals() -> list[Column]:
    """Aggregates over measured rows, one per branch of the flow graph."""
    long = F.col("word_length") > LONG_WORD_OVER
    short = F.col("word_length") <= LONG_WORD_OVER
    n, positive = F.col("n_words"), F.col("n_positive")
    return [
        _total(F.when(long, n)).alias("n_long"),
        _total(F.when(short, n)).alias("n_short"),
        _total(positive).alias("n_long_pos"),
        _total(F.when(long, n - positive)).alias("n_long_neg"),
    ]


def summary_totals() -> list[Column]:
    """Aggregates over measured rows: words and characters."""
    return [
        _total(F.col("n_words")).alias("total_words"),
        _total(F.col("word_length") * F.col("n_words").cast("bigint")).alias("total_chars"),
    ]


def branch_counts(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Long, short, long positive and long negative words: one pass, one shuffle of counts."""
    return measure(rows).groupBy(*by).agg(*branch_totals())


def flow_edges(branches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The seven weighted edges of each row of branch counts."""
    edges = [
        F.struct(
            F.lit(no).alias("edge_no"),
            F.lit(origin).alias("from_node"),
            F.lit(target).alias("to_node"),
            F.col(weight).alias("cnt"),
        )
        for no, (origin, target, weight) in enumerate(FLOW_EDGES, start=1)
    ]
    return branches.select(*by, F.inline(F.array(*edges)))


def flow_transitions(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Flow graph of each batch, seven edges in fixed order (``edge_no``)."""
    return flow_edges(branch_counts(rows, by), by)


def summary_metrics(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Words, characters and characters per word of each batch."""
    totals = measure(rows).groupBy(*by).agg(*summary_totals())
    return totals.withColumn(
        "avg_chars_per_word", average(F.col("total_chars"), F.col("total_words"))
    )


def detail_counts(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Length histogram of each batch. Only lengths that occur have a row."""
    return (
        length_profile(rows, by)
        .where(F.col("word_length").isNotNull())
        .select(*by, "word_length", F.col("n_words").alias("cnt"))
    )
