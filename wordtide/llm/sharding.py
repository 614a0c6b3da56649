"""Shards of equal size that keep linked documents together, by balanced label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordtide.llm.store import written

# Rounds of propagation at most; they end earlier when no document moves.
ROUNDS = 24
# Movers between two shards are accepted or refused in so many bundles for each size class of their group.
BUNDLES = 32
# Shards may pass their share by one part in so many while labels move; what is over is released in the end.
SLACK = 8
# Documents above this share of a shard are placed one by one; there are fewer of them than shards times this.
LARGE = 1000
# Rows of a slice in which running sums are taken.
SLICE_ROWS = 50_000


def _nodes(docs: DataFrame) -> DataFrame:
    """(row, doc_id, size, text_crc32, link): one row per row of ``docs``, without its text; row is unique."""
    data = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", (F.octet_length(data) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"), F.md5(data).alias("link"),
    )


def _slices(rows: int) -> int:
    return max(8, -(-rows // SLICE_ROWS))


def _running(df: DataFrame, value, n_slices: int, by: list[str], name: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows ahead in the same ``by``, as ``name``.

    Rows are ordered by slice, place and row. A window holds one slice, and the sums of slices are
    one row for each, so no task sees all rows.
    """
    df = df.withColumn("slice", F.pmod(F.xxhash64("place"), F.lit(n_slices))).withColumn("value", value)
    sums = df.groupBy(*by, "slice").agg(F.sum("value").alias("in_slice"))
    ahead = Window.partitionBy(*by).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*by, "slice", F.coalesce(F.sum("in_slice").over(ahead), F.lit(0)).alias("ahead"))
    inner = Window.partitionBy("slice", *by).orderBy("place", "row").rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("inner", F.coalesce(F.sum("value").over(inner), F.lit(0)))
    return df.join(sums, ["slice", *by]).withColumn(name, F.col("ahead") + F.col("inner")).drop("slice", "value", "ahead", "inner")


def _votes(nodes: DataFrame, closed: list[int], share: int) -> DataFrame:
    """(link, dest, best_n, weight): where most of a link's documents are, leaving out full shards.

    Documents are counted by link and shard in each task first, so a link of any size reaches the
    shuffle as a few rows a task. Of equal counts the smallest shard wins.
    """
    tally = nodes.groupBy("link", "shard").agg(F.count("row").alias("n"), F.sum("size").alias("bytes"))
    open_ = ~F.col("shard").isin(closed) if closed else F.lit(True)
    best = tally.groupBy("link").agg(
        F.max(F.when(open_, F.struct("n", (-F.col("shard")).alias("less")))).alias("best"), F.sum("bytes").alias("weight"),
        F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("held"),  # at most one entry a shard
    )
    return best.filter("best IS NOT NULL AND size(held) > 1").select(
        "link", (-F.col("best.less")).alias("dest"), F.col("best.n").alias("best_n"), "held", (F.col("weight") > share).alias("huge"),
        F.floor(F.log2(F.col("weight").cast("double"))).cast("int").alias("scale"),
    )


def _moves(nodes: DataFrame, closed: list[int], share: int) -> DataFrame:
    """``nodes`` with dest (null: stays), scale and bundle of the move.

    A document wants to go where more of its link are than at its own shard. A link moves from a
    shard as one bundle, unless it is too large for one shard; then its rows spread over bundles.
    """
    voted = nodes.join(_votes(nodes, closed, share), "link", "left")
    own = F.element_at("held", F.col("shard"))
    gains = (F.col("best_n") > own) | ((F.col("best_n") == own) & (F.col("dest") < F.col("shard")))
    bundle = F.pmod(F.when(F.col("huge"), F.xxhash64("row")).otherwise(F.xxhash64("link")), F.lit(BUNDLES))
    return voted.select(*nodes.columns, F.when(gains, F.col("dest")).alias("dest"), "scale", bundle.alias("bundle"))


def _accepted(wanted: list, loads: list[int], quota: int) -> list[tuple[int, int, int, int]]:
    """(shard, dest, scale, bundle) of the bundles that find room: those of small links first.

    ``wanted`` has at most a row for each pair of shards, scale and bundle.
    """
    wanted, taken = sorted(tuple(w) for w in wanted), []
    wanted.sort(key=lambda w: w[2:4])
    while True:
        left = []
        for shard, dest, scale, bundle, size in wanted:
            if loads[dest] + size <= quota:
                loads[dest] += size
                loads[shard] -= size
                taken.append((shard, dest, scale, bundle))
            else:
                left.append((shard, dest, scale, bundle, size))
        if len(left) == len(wanted):
            return taken
        wanted = left


def propagate(linked: DataFrame, shards: int, quota: int, rounds: int = ROUNDS) -> DataFrame:
    """``linked`` with ``shard``: links drawn together, no shard above ``quota`` bytes that was not so at first.

    ``linked``: row, size, link and more. Shards start by hash of the row. Each round joins documents
    with the votes of their link; bundles of movers are accepted as far as quotas allow, and the
    driver sees sums of bundles alone. Shards without room are left out of the next round's votes, so
    a link larger than a shard fills one after the other. Each round is written to the shared folder.
    """
    spark = linked.sparkSession
    nodes = linked.withColumn("shard", F.pmod(F.xxhash64("row", F.lit("shard")), F.lit(shards)).cast("int"))
    columns, closed = nodes.columns, []
    for _ in range(rounds):
        moves = written(_moves(nodes, closed, quota // 8), "shard-moves")
        loads = [0] * shards
        for shard, size in moves.groupBy("shard").agg(F.sum("size")).collect():
            loads[shard] = size
        wanted = moves.filter("dest IS NOT NULL").groupBy("shard", "dest", "scale", "bundle").agg(F.sum("size")).collect()
        taken = _accepted(wanted, loads, quota)
        full = {i for i in range(shards) if loads[i] + max(1, quota // 256) > quota}
        if taken:
            went = spark.createDataFrame(taken, "shard int, dest int, scale int, bundle long").withColumn("went", F.lit(True))
            moved = F.when(F.col("went"), F.col("dest")).otherwise(F.col("shard"))
            nodes = moves.join(went, ["shard", "dest", "scale", "bundle"], "left").withColumn("shard", moved).select(columns)
        else:
            nodes = moves.select(columns)
            full |= {w[1] for w in wanted} | set(closed)
            if not wanted or len(full) == shards:
                break
        closed = sorted(full) if len(full) < shards else []
    return nodes


def _deal_large(large: list, rooms: list[int]) -> list[tuple[int, int]]:
    """(row, shard) of the large documents, the largest first, each to the shard with the most room."""
    dealt = []
    for row, size in sorted(large, key=lambda x: (-x[1], x[0])):
        i = max(range(len(rooms)), key=lambda j: (rooms[j], -j))
        rooms[i] -= size
        dealt.append((row, i))
    return dealt


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per row of ``docs`` (doc_id, text).

    Size is the UTF-8 bytes of the text plus one; a null text counts as an empty one. The law is
    ``bytes``: the sizes of shards are equal but for about one small document, or for what documents
    larger than a shard's share force. Documents of equal text are linked, and are in one shard unless it has
    no room for all of them. Slots count from 0 in each shard without gaps; grown_shard is null.

    Linked documents take their shards by ``propagate`` under quotas; the others fill what room is
    left. The quota has some slack, so that documents can change places; what is over the share of a
    shard after that is released, link by link. Released documents above a thousandth of a share are placed one by one, largest first; there are
    fewer than a thousand times ``shards`` of them. Running sums put all others in order into the gaps.

    Repeated rows, null and repeated ids are documents like others. No rows give no rows. Only doc_id
    and text are read. No text is shuffled: a document travels as its digest.
    """
    spark = docs.sparkSession
    nodes = written(_nodes(docs.select("doc_id", "text")), "shard-nodes")
    rows, total = nodes.agg(F.count("row"), F.coalesce(F.sum("size"), F.lit(0))).first()
    n_slices, share = _slices(rows), -(-total // shards)
    copies = nodes.groupBy("link").agg(F.count("row").alias("copies")).filter("copies > 1")
    # A link keeps its documents in one place of every order, unless it would make a slice too large.
    place = F.when(F.col("copies") * 8 <= SLICE_ROWS, F.xxhash64("link")).otherwise(F.xxhash64("row"))
    linked = written(nodes.join(copies, "link").withColumn("place", place).drop("copies"), "shard-linked")
    placed = written(propagate(linked, shards, share + share // SLACK), "shard-linked")
    order = _running(placed, F.col("size"), n_slices, ["shard"], "ahead_in_shard")
    order = written(order.withColumn("stays", F.col("ahead_in_shard") + F.col("size") <= share).drop("ahead_in_shard"), "shard-order")
    stay = order.filter("stays").drop("stays")
    rooms = [share] * shards
    for shard, size in stay.groupBy("shard").agg(F.sum("size")).collect():
        rooms[shard] -= size
    single = nodes.join(copies, "link", "left_anti").withColumn("place", F.xxhash64("row"))
    free = written(single.unionByName(order.filter("NOT stays").select(single.columns)), "shard-free")
    large = free.filter(F.col("size") * LARGE > share)
    dealt = _deal_large([tuple(r) for r in large.select("row", "size").collect()], rooms)
    large = large.join(spark.createDataFrame(dealt, "row long, shard int"), "row")
    # The gaps stand one behind the other; a document goes where its middle falls.
    ends, end = [], 0
    for room in rooms:
        end += max(0, room)
        ends.append(end)
    small = _running(free.filter(F.col("size") * LARGE <= share), F.col("size"), n_slices, [], "begin")
    middle = F.col("begin") * 2 + F.col("size")
    gap = F.lit(max((i for i, room in enumerate(rooms) if room > 0), default=0))
    for i in reversed(range(shards)):
        if rooms[i] > 0:
            gap = F.when(middle < 2 * ends[i], F.lit(i)).otherwise(gap)
    small = small.withColumn("shard", gap.cast("int"))
    columns = ["row", "place", "doc_id", "size", "text_crc32", "shard"]
    all_ = written(stay.select(columns).unionByName(large.select(columns)).unionByName(small.select(columns)), "shards")
    slots = _running(all_, F.lit(1), n_slices, ["shard"], "slot")
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
