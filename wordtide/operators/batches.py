"""Batches of a bounded table: fixed intervals, and the intervals in which nothing arrived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.functions import floor_quotient, whole_quotient

BATCHES_PER_BLOCK = 65_536


def interval_number(time: Column, seconds: int, origin: str = "1970-01-01 00:00:00") -> Column:
    """Number of the ``seconds``-long interval, counted from ``origin``, that holds ``time``.

    ``time`` is a TIMESTAMP_NTZ.
    """
    elapsed = _whole_seconds(time) - _whole_seconds(F.lit(origin).cast("timestamp_ntz"))
    return floor_quotient(elapsed, F.lit(seconds))


def interval_start(
    number: Column, seconds: int, origin: str = "1970-01-01 00:00:00"
) -> Column:
    """First moment of an interval, as a TIMESTAMP_NTZ."""
    offset = F.make_dt_interval(secs=number * F.lit(seconds))
    return F.lit(origin).cast("timestamp_ntz") + offset


def _whole_seconds(time: Column) -> Column:
    """Seconds since year 1, rounded down.

    Year 1 because casts round towards zero. A difference of two times without zone is an interval;
    a cast to TIMESTAMP or ``timestamp_diff`` would bring in the session time zone.
    """
    year_one = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    return (time - year_one).cast("interval second").cast("bigint")


def beat_per_row(rows: DataFrame, batch: str = "batch") -> DataFrame:
    """A heartbeat per row: makes the rows' own batches show up, even if no word is in them."""
    return rows.select(batch, F.lit(None).cast("string").alias("word"))


def every_batch(rows: DataFrame, batch: str = "batch") -> DataFrame:
    """All batch numbers from the first to the last of ``rows``, those without rows included.

    Made from the two end points in two steps, numbers of blocks and then the numbers of each block,
    so that a long time span is spread over tasks and never one array in one row.
    """
    ends = rows.agg(F.min(batch).alias("first"), F.max(batch).alias("last"))
    per_block = F.lit(BATCHES_PER_BLOCK).cast("bigint")
    first_block = floor_quotient(F.col("first"), per_block)
    last_block = floor_quotient(F.col("last"), per_block)
    blocks = ends.where(F.col("first").isNotNull()).select(
        "first", "last", F.explode(F.sequence(first_block, last_block)).alias("block")
    )
    start = F.col("block") * per_block
    numbers = F.sequence(
        F.greatest("first", start), F.least("last", start + per_block - F.lit(1))
    )
    return blocks.repartition("block").select(F.explode(numbers).alias(batch))


def heartbeats(rows: DataFrame, batch: str = "batch") -> DataFrame:
    """A row with a null word for every batch number between the first and the last."""
    return every_batch(rows, batch).withColumn("word", F.lit(None).cast("string"))


def with_heartbeats(
    words: DataFrame, batch: str = "batch", span: DataFrame | None = None
) -> DataFrame:
    """Words and heartbeats together: metrics by ``batch`` then report idle batches with zeros.

    A union in front of the metric's own aggregation, not a join behind it: no shuffle is added.
    ``span`` holds the batch numbers to cover, those of the words by default; give the table the
    words were cut from, so that finding its end points does not cut it again.
    """
    idle = heartbeats(words if span is None else span, batch)
    return words.select(batch, "word").unionByName(idle)


def profile_with_heartbeats(profile: DataFrame, batch: str = "batch") -> DataFrame:
    """The same for measured rows."""
    idle = every_batch(profile, batch).select(
        batch,
        F.lit(None).cast("int").alias("word_length"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.lit(0).cast("bigint").alias("n_positive"),
    )
    return profile.select(batch, "word_length", "n_words", "n_positive").unionByName(idle)


def batch_of(number: Column, per_batch: int) -> Column:
    """Batch of an arrival number, ``per_batch`` arrivals to a batch."""
    return whole_quotient(number, F.lit(per_batch))
