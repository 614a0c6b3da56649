"""Near duplicates: many universal hash minima, bands, verification on full sets, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.llm import text as tx
from wordtide.llm.components import components
from wordtide.llm.store import written

WORDS = 5
HASHES = 240
# Bands are cut so that a pair at the threshold shares no band with at most this probability, and
# the cut on the estimated similarity lies this many standard deviations below the threshold.
MISS = 1e-8
DEVIATIONS = 5.0
# Members of a bucket that one task compares with as many others.
BLOCK = 1024

_rng = np.random.Generator(np.random.PCG64(20240607))
_A = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)

SKETCH = "n bigint, d1 bigint, d2 bigint, bands array<bigint>, minima binary"


def band_rows(percent: int) -> int:
    """Minima of one band: the most that keep the chance of a missed pair at ``MISS``."""
    t = percent / 100
    fit = [r for r in range(1, HASHES + 1) if HASHES % r == 0 and (1 - t**r) ** (HASHES // r) <= MISS]
    return max(fit, default=1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of five words.

    A text of fewer words has one shingle of all of them; a text without words has none.
    """
    starts, ends, bounds = tx.word_spans(data, offsets)
    words = tx.span_hashes(data, starts, ends)
    grams = tx.mix(tx.gram_hashes(words, WORDS))
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        if high - low >= WORDS:
            yield np.unique(grams[low : high - WORDS + 1])
        elif high > low:
            yield tx.mix(tx.gram_hashes(words[low:high], int(high - low)))
        else:
            yield np.zeros(0, np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each universal hash a * x + b over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(least, (_A[:, None] * x[None, i : i + 512] + _B[:, None]).min(axis=1), out=least)
    return least


def _sketch(rows: int):
    band = np.arange(HASHES // rows, dtype=np.uint64)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            n, d1, d2, keys, least = [], [], [], [], []
            for _, _, data, offsets in tx.blocks(column):
                for s in shingle_sets(tx.ascii_lower(data), offsets):
                    n.append(len(s))
                    d1.append(int(s.sum().view(np.int64)) if len(s) else 0)
                    d2.append(int(tx.mix(s ^ np.uint64(0xA5A5)).sum().view(np.int64)) if len(s) else 0)
                    if not len(s):
                        keys.append([])
                        least.append(b"")
                        continue
                    m = minima(s)
                    key = band.copy()
                    for j in range(rows):
                        key = tx.mix(key * np.uint64(0x9E3779B97F4A7C15) + m[j::rows].astype(np.uint64))
                    keys.append(key.view(np.int64))
                    least.append(_short(m).tobytes())
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(least, pa.binary())],
                ["n", "d1", "d2", "bands", "minima"],
            )

    return run


def _short(m: np.ndarray) -> np.ndarray:
    """16 bits of each minimum."""
    return ((m * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def _sets(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in columns:
        parts = []
        for _, _, data, offsets in tx.blocks(column):
            parts += [s.view(np.int64) for s in shingle_sets(tx.ascii_lower(data), offsets)]
        yield pa.array(parts, pa.list_(pa.int64()))


def _agreement(one: pa.Array, other: pa.Array) -> pa.Array:
    """The share of equal minima: an estimate of the similarity of two sets."""
    a = np.frombuffer(b"".join(one.to_pylist()), np.uint16).reshape(-1, HASHES)
    b = np.frombuffer(b"".join(other.to_pylist()), np.uint16).reshape(-1, HASHES)
    return pa.array((a == b).mean(axis=1), pa.float64())


def _least_agreement(percent: int) -> float:
    t = percent / 100
    return t - DEVIATIONS * (t * (1 - t) / HASHES) ** 0.5


def _find(parent: dict[int, int], x: int) -> int:
    while (up := parent.setdefault(x, x)) != x:
        parent[x] = parent[up]
        x = up
    return x


def _compare(percent: int, rows: int):
    """Links between the components that meet in a block of a bucket, as a forest.

    A block comes as a run of rows. Every pair of a minor member and any member of another component
    is looked at in the first band that the two share.
    """
    cut = _least_agreement(percent)
    names = ("band", "node", "component", "side", "n", "minima")

    def links(block: list[tuple]) -> Iterator[tuple[int, int]]:
        block = list({(r[1], r[3]): r for r in block}.values())
        parent: dict[int, int] = {}
        band = block[0][0]
        minor = [r for r in block if r[3] > 0]
        every = [r for r in block if r[3] != 1]
        if not minor or not every:
            return
        m = np.frombuffer(b"".join(r[5] for r in every), np.uint16).reshape(-1, HASHES)
        sizes = np.array([r[4] for r in every])
        roots = np.array([r[2] for r in every])
        for x in minor:
            fits = np.flatnonzero((roots != x[2]) & (100 * np.minimum(sizes, x[4]) >= percent * np.maximum(sizes, x[4])))
            if not len(fits):
                continue
            same = m[fits] == np.frombuffer(x[5], np.uint16)
            first = same.reshape(len(fits), -1, rows).all(axis=2).argmax(axis=1)
            for i in fits[(first == band) & (same.mean(axis=1) >= cut)]:
                y = every[i]
                p, q = _find(parent, x[2]), _find(parent, y[2])
                if p == q:
                    continue
                shared = len(np.intersect1d(x[6], y[6], assume_unique=True))
                if 100 * shared >= percent * (x[4] + y[4] - shared):
                    parent[max(p, q)] = min(p, q)
                    yield x[1], y[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at = [], None
        def out(found):
            found = list(found)
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("key", "p", "q")), strict=True))
            columns = [batch.column(c).to_pylist() for c in names]
            sets = batch.column("shingles")
            values, ends = sets.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sets.value_lengths().to_numpy())))
            for i, key in enumerate(keys):
                if key != at:
                    if block:
                        yield out(links(block))
                    block, at = [], key
                block.append((*(c[i] for c in columns), values[ends[i] : ends[i + 1]].copy()))
            tx.release()
        if block:
            yield out(links(block))

    return run


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, one row per row of ``docs``.

    Documents are linked if 100 * |A and B| >= ``percent`` * |A or B| for their sets of distinct
    shingles of five words, words being runs of anything but ``[\\x20\\x09-\\x0D]`` with A-Z
    lower-cased. A text of fewer words has one shingle of all of them; without words (null, empty,
    white space) the set is empty and the document is linked with nothing. component_id is the
    smallest doc_id reachable over links, the document's own included; kept says whether it is its
    own. Shingles are compared as 64-bit hashes.

    Rows that share a doc_id are one document and keep or go together. A row with a null doc_id is
    linked with nothing: its component_id is null, and it is kept.

    1. Each text gets a sketch: size, a digest of its set, 240 minima, and a key for each band.
    2. Equal sets are one class, whose smallest doc_id stands for it from here on.
    3. In each bucket of a band, the smallest member is the hub. Members that agree with it on
       enough minima are verified on full sets. Components of these links shrink large groups.
    4. A bucket that still holds several components is cut into blocks, and members outside its
       largest component are compared with all members of other components: first by size and
       minima, then on full sets. No pair is written down unless it is a link between components.
    """
    rows = band_rows(percent)
    sketch = F.arrow_udf(_sketch(rows), SKETCH)
    sketches = written(
        docs.select("doc_id", sketch(F.col("text")).alias("s")).select("doc_id", "s.*"), "sketches"
    )
    classes = sketches.filter("n > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("node"))
    nodes = written(classes, "classes")
    whole = nodes.select("node", "d1", "d2").join(
        sketches.select(F.col("doc_id").alias("node"), "d1", "d2", "n", "bands", "minima"), ["node", "d1", "d2"]
    )

    banded = whole.select("node", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top")).filter("hub < top")
    members = written(banded.join(shared.select("key", "hub"), "key"), "members")

    involved = members.select("node").distinct()
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(involved, "node", "left_semi")
    sets = written(
        texts.select("node", F.arrow_udf(_sets, "array<bigint>")(F.col("text")).alias("shingles")), "sets"
    ).dropDuplicates(["node"])
    minima_of = whole.select("node", "n", "minima")

    pairs = members.filter("node != hub").select("hub", "node").distinct()
    agreement = F.arrow_udf(_agreement, "double")
    likely = (
        pairs.join(minima_of.select("node", "minima"), "node")
        .join(minima_of.select(F.col("node").alias("hub"), F.col("minima").alias("hub_minima")), "hub")
        .filter(agreement("minima", "hub_minima") >= _least_agreement(percent))
        .select("hub", "node")
    )
    held = likely.join(sets, "node").join(
        sets.select(F.col("node").alias("hub"), F.col("shingles").alias("hub_shingles")), "hub"
    )
    both = F.size(F.array_intersect("shingles", "hub_shingles"))
    linked = held.filter(100 * both >= percent * (F.size("shingles") + F.size("hub_shingles") - both))
    first = written(linked.select(F.col("hub").alias("a"), F.col("node").alias("b")), "hub-links")
    tied = written(components(first), "hub-components")

    rest = written(_mixed(members, tied), "mixed")
    blocks = _blocks(rest).join(minima_of, "node").join(sets, "node")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    more = (
        blocks.repartition(parts, "key", "p", "q").sortWithinPartitions("key", "p", "q")
        .mapInArrow(_compare(percent, rows), "a bigint, b bigint")
    )
    every = first.unionByName(written(more, "block-links"))
    final = written(components(every), "components")
    placed = nodes.join(final, "node", "left").select(
        "d1", "d2", "n", F.coalesce("component", "node").alias("component")
    )
    out = sketches.select("doc_id", "n", "d1", "d2").join(placed, ["d1", "d2", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _mixed(members: DataFrame, tied: DataFrame) -> DataFrame:
    """Members, without hubs, of the buckets in which they still belong to several components."""
    placed = members.filter("node != hub").join(tied, "node", "left").select(
        "band", "key", "node", F.coalesce("component", "node").alias("component")
    )
    several = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    return placed.join(several.select("key"), "key", "left_semi")


def _blocks(mixed: DataFrame) -> DataFrame:
    """(key, p, q, band, node, component, side): block p of the minor members against block q of all.

    side: 0 for a member among all, 1 among the minor ones, 2 both, where a bucket is one block.
    """
    sizes = mixed.groupBy("key", "component").agg(F.count("node").alias("c"))
    per_key = sizes.groupBy("key").agg(
        F.sum("c").alias("total"), F.max(F.struct("c", "component")).alias("largest")
    ).select(
        "key", F.col("largest.component").alias("major"),
        F.ceil(F.col("total") / BLOCK).alias("nq"), F.ceil((F.col("total") - F.col("largest.c")) / BLOCK).alias("np"),
    )
    held = mixed.join(per_key, "key").withColumn("minor", F.col("component") != F.col("major"))
    one = (F.col("np") == 1) & (F.col("nq") == 1)
    h = F.xxhash64("node")
    as_all = held.filter(~(one & F.col("minor"))).select(
        "key", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("np") - 1)).alias("p"), F.pmod(h, F.col("nq")).alias("q"),
        "band", "node", "component", F.lit(0).alias("side"),
    )
    as_minor = held.filter("minor").select(
        "key", F.pmod(h, F.col("np")).alias("p"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("nq") - 1)).alias("q"),
        "band", "node", "component", F.when(one, 2).otherwise(1).alias("side"),
    )
    return as_all.unionByName(as_minor)
