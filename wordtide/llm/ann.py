"""Approximate nearest neighbours: a small-world graph for each shard, and the shards' results merged."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordtide.llm import graphs
from wordtide.llm.store import written

INDEX = "dim int, scale int, shard int, ids binary, firsts binary, vectors binary, order binary, sizes binary, links binary"


def sound(vector: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _scale(vector: str):
    """The power of two nearest to a vector's length, without squares that overflow."""
    largest = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + (x / largest) * (x / largest))
    return F.round(F.log2(largest) + F.log2(squares) / 2).cast("int")


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _rows(part: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) sorted by id; of rows with the same id, the largest vector."""
    ids = part.column("vec_id").to_numpy()
    vectors = _matrix(part.column("vector"), dim)
    sort = np.lexsort((*vectors.T[::-1], ids))
    ids, vectors = ids[sort], vectors[sort]
    last = np.append(ids[1:] != ids[:-1], True) if len(ids) else np.zeros(0, bool)
    return ids[last], vectors[last]


def _build(key: tuple, part: pa.Table) -> pa.Table:
    dim, scale, shard = (k.as_py() for k in key)
    ids, vectors = _rows(part, dim)
    # equal vectors are one node, with its ids in order
    distinct, node = np.unique(vectors, axis=0, return_inverse=True)
    node = node.reshape(-1)
    sort = np.argsort(node, kind="stable")
    firsts = np.searchsorted(node[sort], np.arange(len(distinct) + 1))
    graph = graphs.build(np.ldexp(distinct, -scale))
    sizes = np.array([len(x) for x in graph.layers], np.int64)
    links = np.concatenate([x.ravel() for x in graph.layers])
    row = [dim, scale, shard, ids[sort].astype(np.int64), firsts.astype(np.int64), distinct, graph.order.astype(np.int64), sizes, links]
    names = ["dim", "scale", "shard", "ids", "firsts", "vectors", "order", "sizes", "links"]
    arrays = [pa.array([x], pa.int32()) if i < 3 else pa.array([x.tobytes()], pa.binary()) for i, x in enumerate(row)]
    return pa.Table.from_arrays(arrays, names)


def _graph(row: dict) -> graphs.Graph:
    sizes, links = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["links"], np.int32)
    layers, at = [], 0
    for k, size in enumerate(sizes):
        width = graphs.LINKS * (1 if k else 2)
        layers.append(links[at : at + size * width].reshape(size, width))
        at += size * width
    return graphs.Graph(np.frombuffer(row["order"], np.int64), layers)


def _searcher(k: int, beam: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(key: tuple, queries: pa.Table, index: pa.Table) -> pa.Table:
        if not queries.num_rows or not index.num_rows:
            return schema.empty_table()
        dim = key[0].as_py()
        row = index.to_pylist()[0]
        members, firsts = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["firsts"], np.int64)
        vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, dim)
        asked, wanted = _rows(queries, dim)
        largest = np.abs(wanted).max(axis=1, keepdims=True)  # a query's own length does not change its ranking
        found = graphs.search(_graph(row), np.ldexp(vectors, -row["scale"]), wanted / largest, max(beam, k + 1))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for q, own, nodes in zip(asked, wanted, found, strict=True):
            nodes = nodes[nodes >= 0]
            scores = (vectors[nodes] * own).sum(axis=1)
            # of each node only its smallest ids can be among the best, one more for the query itself
            parts = [members[firsts[n] : min(firsts[n + 1], firsts[n] + k + 1)] for n in nodes]
            ids, score = np.concatenate(parts), np.repeat(scores, [len(p) for p in parts])
            other = ids != q
            ids, score = ids[other], score[other]
            best = np.lexsort((ids, -score))[:k]
            out.append((np.full(len(best), q), ids[best], score[best]))
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], schema=schema)

    return search


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, beam: int = 200,
    rows_per_shard: int = 16_384, queries_per_block: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the ``k`` vectors of largest inner product found.

    ``vectors`` and ``queries``: vec_id, vector (an array of numbers). A query's own vec_id is no
    candidate for it. score is the inner product in double precision on the vectors as given; rank
    counts from 1, ties go to the smaller vec_id. A query with fewer candidates gets all of them.

    A vector that is null, empty, zero, or holds null or non-finite components takes no part, nor
    does a row with a null vec_id. Vectors meet those of their own length alone. Of rows with the
    same vec_id, the vector that is largest, component by component, counts.

    Vectors are grouped by length, to the nearest power of two, and within that dealt by a hash of
    vec_id into shards of about ``rows_per_shard``. One task turns a shard into a graph, with its
    vectors scaled to about unit length, so very long or short vectors neither overflow nor hide
    the differences of others. Equal vectors are one node of it, so copies do not crowd the links out.
    Every block of queries then meets every shard once; a shard gives at most ``k`` rows for each
    query, and those are ranked. More vectors mean more shards: larger ones cost memory of a task
    (about 900 bytes for a vector of 64 components) and save searches.
    """
    parts = written(
        vectors.filter(sound(F.col("vector")) & F.col("vec_id").isNotNull()).select(
            F.size("vector").alias("dim"), "vec_id", F.col("vector").cast("array<double>").alias("vector")
        ).withColumn("scale", _scale("vector")),
        "vectors",
    )
    shards = parts.groupBy("dim", "scale").agg(F.ceil(F.count("*") / rows_per_shard).cast("int").alias("shards"))
    dealt = parts.join(shards, ["dim", "scale"]).select(
        "dim", "scale", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int").alias("shard"), "vec_id", "vector"
    )
    # a number of partitions that is given is not merged, so graphs are built side by side
    graphs_wanted = shards.agg(F.sum("shards")).first()[0] or 1
    key = ["dim", "scale", "shard"]
    index = written(dealt.repartition(graphs_wanted, *key).groupBy(*key).applyInArrow(_build, INDEX), "index")

    asked = queries.filter(sound(F.col("vector")) & F.col("vec_id").isNotNull()).select(
        F.size("vector").alias("dim"), "vec_id", F.col("vector").cast("array<double>").alias("vector")
    )
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / queries_per_block).cast("int").alias("blocks"))
    sizes = shards.join(blocks, "dim")
    one = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(sizes, "dim").select(
        "dim", "scale", one("shards").alias("shard"), F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"), "vec_id", "vector"
    )
    right = index.join(blocks, "dim").withColumn("block", one("blocks")).drop("blocks")
    keys = [*key, "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _searcher(k, beam), "query_id bigint, vec_id bigint, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
