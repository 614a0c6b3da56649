"""Round-robin drain: every round takes the next message of each key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLICE_BITS = 22


def round_robin_drain(
    messages: DataFrame,
    within: Sequence[str] = ("batch",),
    key: str = "key",
    seq: str = "seq",
    slice_bits: int = SLICE_BITS,
) -> DataFrame:
    """Adds ``round``, the place of a message among those of its key and batch (from 1).

    The drain order of a batch is (round, key). ``seq`` is a BIGINT that is unique within a key and
    batch. A null key or batch is one like any other; messages without ``seq`` come last in theirs.

    A plain ``row_number`` over (batch, key) sorts a group in one task, however large. Here a group
    is cut into slices of ``2 ** slice_bits`` consecutive ``seq`` values: rows are numbered inside
    their slice, and start where the slices before it end. Slice sizes are summed the same way, over
    slices of slices, until 64 bits are used up; so no window ever sees more than
    ``2 ** slice_bits`` rows, by construction and for any distribution of keys.
    """
    group = [*within, key]
    shifts = range(slice_bits, 64, slice_bits)
    last = F.lit((1 << (63 - slice_bits)) - 1).cast("bigint")  # the slice of the largest numbers
    sliced = messages.withColumn("_slice", F.coalesce(F.shiftright(seq, slice_bits), last))

    # sizes[i]: number of messages per slice of level i, from fine to coarse
    sizes = [sliced.groupBy(*group, "_slice").agg(F.count("*").alias("_size"))]
    for _ in shifts[1:]:
        coarser = F.shiftright("_slice", slice_bits)
        sizes.append(
            sizes[-1]
            .select(*group, coarser.alias("_slice"), "_size")
            .groupBy(*group, "_slice")
            .agg(F.sum("_size").alias("_size"))
        )

    def starts_below(above: DataFrame, level: DataFrame) -> DataFrame:
        """Starts of a level's slices: start of the slice around them, plus sizes before them."""
        around = F.shiftright("_slice", slice_bits).alias("_around")
        before = _sum_before(W.partitionBy(*group, "_around").orderBy("_slice"))
        local = level.select("*", around).select(*group, "_around", "_slice", before.alias("_in"))
        outer = above.select(*group, F.col("_slice").alias("_around"), F.col("_start"))
        return _joined(local, outer, group, "_around").select(
            *group, "_slice", (F.col("_start") + F.col("_in")).alias("_start")
        )

    top = sizes[-1].select(
        *group, "_slice", _sum_before(W.partitionBy(*group).orderBy("_slice")).alias("_start")
    )
    starts = reduce(starts_below, reversed(sizes[:-1]), top)

    place = F.row_number().over(W.partitionBy(*group, "_slice").orderBy(F.asc_nulls_last(seq)))
    placed = _joined(sliced.withColumn("_place", place), starts, group, "_slice")
    round_ = (F.col("_start") + F.col("_place")).alias("round")
    return placed.select(*messages.columns, round_)


def _joined(left: DataFrame, right: DataFrame, group: Sequence[str], level: str) -> DataFrame:
    """An inner join by group, where nulls are equal, and by a slice."""
    other = {name: f"_other{i}" for i, name in enumerate([*group, level])}
    right = right.withColumnsRenamed(other)
    same = [F.col(c).eqNullSafe(F.col(other[c])) for c in group]
    same.append(F.col(level) == F.col(other[level]))
    return left.join(right, reduce(lambda a, b: a & b, same)).drop(*other.values())


def _sum_before(window: W) -> F.Column:
    frame = window.rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum("_size").over(frame), F.lit(0).cast("bigint"))
