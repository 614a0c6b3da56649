"""A hierarchical navigable small-world graph over the vectors of one shard, as flat neighbour arrays.

Vectors get one more component that makes all of them equally long. The nearest vector is then the
one of the largest inner product, and queries, whose extra component is 0, rank vectors by their
inner product alone. All steps work on many nodes or queries at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LINKS = 16  # of a node in each layer; twice as many in the lowest
BEAM_BUILD = 80
WIDTH = 4  # candidates expanded at once
BATCH = 1024
_BRUTE = 256


@dataclass
class Graph:
    """Nodes come highest layer first, so a layer is a prefix of the nodes."""

    order: np.ndarray  # the vector of each node
    layers: list[np.ndarray]  # lowest first: neighbours of each node of the layer, -1 where free


def lengthened(vectors: np.ndarray) -> np.ndarray:
    """The vectors with the component that gives all the greatest length there is."""
    squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
    extra = np.sqrt(np.maximum(squares.max(initial=0.0) - squares, 0.0))
    return np.concatenate([vectors, extra[:, None]], axis=1).astype(np.float32)


def beam(
    points: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, similarities) of the ``size`` best nodes found for each query, best first, -1 where none.

    ``entry``: nodes to start from, a row for each query. In each step every query expands its best
    candidates; it ends when all that it holds are expanded.
    """
    n, rows = len(links), len(queries)
    seen = np.zeros((rows, n), bool)
    every = np.arange(rows)
    held = np.full((rows, size), -1, np.int64)
    likeness = np.full((rows, size), -np.inf, np.float32)
    done = np.ones((rows, size), bool)
    e = entry.shape[1]
    held[:, :e], done[:, :e] = entry, entry < 0
    likeness[:, :e] = np.where(entry >= 0, np.einsum("qed,qd->qe", points[np.maximum(entry, 0)], queries), -np.inf)
    seen[every[:, None], np.maximum(entry, 0)] = True
    active = every
    while len(active):
        open_ = np.where(done[active], -np.inf, likeness[active])
        pick = np.argpartition(-open_, min(WIDTH, size) - 1, axis=1)[:, :WIDTH]
        real = np.take_along_axis(open_, pick, axis=1) > -np.inf
        going = real.any(axis=1)
        active, pick, real = active[going], pick[going], real[going]
        if not len(active):
            break
        done[active[:, None], pick] = True
        near = links[np.where(real, held[active[:, None], pick], 0)]
        near = np.where(real[:, :, None], near, -1).reshape(len(active), -1)
        near = np.where((near >= 0) & ~seen[active[:, None], near], near, -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        there, column = np.nonzero(near >= 0)
        nodes = near[there, column]
        seen[active[there], nodes] = True
        found = np.full(near.shape, -np.inf, np.float32)
        found[there, column] = np.einsum("md,md->m", points[nodes], queries[active[there]])
        both = np.concatenate([likeness[active], found], axis=1)
        best = np.argpartition(-both, size - 1, axis=1)[:, :size]
        likeness[active] = np.take_along_axis(both, best, axis=1)
        held[active] = np.take_along_axis(np.concatenate([held[active], near], axis=1), best, axis=1)
        fresh = np.concatenate([done[active], near < 0], axis=1)
        done[active] = np.take_along_axis(fresh, best, axis=1)
    sort = np.argsort(-likeness, axis=1, kind="stable")
    return np.take_along_axis(held, sort, axis=1), np.take_along_axis(likeness, sort, axis=1)


def _select(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of each node's candidates: those nearer to it than to one chosen before, then the nearest rest."""
    safe = np.maximum(candidates, 0)
    own = np.where(candidates >= 0, np.einsum("ncd,nd->nc", points[safe], points[nodes]), -np.inf)
    sort = np.argsort(-own, axis=1, kind="stable")
    candidates, own = np.take_along_axis(candidates, sort, axis=1), np.take_along_axis(own, sort, axis=1)
    twice = np.zeros(candidates.shape, bool)
    twice[:, 1:] = candidates[:, 1:] == candidates[:, :-1]
    valid = (candidates >= 0) & ~twice
    vectors = points[np.maximum(candidates, 0)]
    between = np.matmul(vectors, vectors.transpose(0, 2, 1))
    covered = np.full(candidates.shape, -np.inf, np.float32)
    chosen, count = np.zeros(candidates.shape, bool), np.zeros(len(nodes), np.int64)
    for k in range(candidates.shape[1]):
        take = valid[:, k] & (covered[:, k] < own[:, k]) & (count < most)
        chosen[:, k] = take
        count += take
        covered[take] = np.maximum(covered[take], between[take, k])
    rank = np.where(chosen, 0, np.where(valid, 1, 2))
    best = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(rank, best, axis=1) < 2, np.take_along_axis(candidates, best, axis=1), -1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out


def _link(points: np.ndarray, links: np.ndarray, nodes: np.ndarray, candidates: np.ndarray) -> None:
    """Give the nodes their neighbours, and those the way back."""
    most = links.shape[1]
    half = max(1, most // 2)
    for low in range(0, len(nodes), 512):
        part = slice(low, low + 512)
        links[nodes[part], :half] = _select(points, nodes[part], candidates[part], half)
    source = np.repeat(nodes, half)
    target = links[nodes, :half].ravel()
    source, target = source[target >= 0], target[target >= 0]
    likeness = np.einsum("md,md->m", points[source], points[target])
    sort = np.lexsort((-likeness, target))
    source, target = source[sort], target[sort]
    ends, first = np.unique(target, return_index=True)
    rank = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
    near = rank < most
    back = np.full((len(ends), most), -1, np.int64)
    back[np.searchsorted(ends, target[near]), rank[near]] = source[near]
    for low in range(0, len(ends), 512):
        part = ends[low : low + 512]
        links[part] = _select(points, part, np.concatenate([links[part], back[low : low + 512]], axis=1), most)


def _top(likeness: np.ndarray, most: int, first: int) -> np.ndarray:
    best = np.argpartition(-likeness, min(most, likeness.shape[1]) - 1, axis=1)[:, :most]
    return np.where(np.take_along_axis(likeness, best, axis=1) > -np.inf, best + first, -1)


def build(vectors: np.ndarray, seed: int = 7) -> Graph:
    """The graph of distinct vectors. Layers are drawn from a seed; the same vectors give the same graph."""
    n = len(vectors)
    drawn = -np.log(1 - np.random.Generator(np.random.PCG64(seed)).random(n)) / np.log(LINKS)
    level = drawn.astype(np.int64)
    order = np.lexsort((np.arange(n), -level))
    points = lengthened(vectors[order])
    layers: list[np.ndarray] = []
    for k in range(int(level.max(initial=0)), -1, -1):
        size = int((level >= k).sum())
        links = np.full((size, LINKS * (1 if k else 2)), -1, np.int64)
        begun = min(size, _BRUTE)
        alike = points[:begun] @ points[:begun].T
        np.fill_diagonal(alike, -np.inf)
        if begun > 1:
            _link(points, links, np.arange(begun), _top(alike, BEAM_BUILD, 0))
        while begun < size:
            nodes = np.arange(begun, min(size, begun + min(BATCH, max(64, begun // 4))))
            upper = layers if layers and len(layers[-1]) <= begun else []
            entry = _descend(points, upper, points[nodes])
            found, _ = beam(points, links[:begun], points[nodes], entry, BEAM_BUILD)
            alike = points[nodes] @ points[nodes].T
            np.fill_diagonal(alike, -np.inf)
            _link(points, links, nodes, np.concatenate([found, _top(alike, LINKS, begun)], axis=1))
            begun = int(nodes[-1]) + 1
        layers.append(links)
    return Graph(order, [x.astype(np.int32) for x in layers[::-1]])


def _descend(points: np.ndarray, upper: list[np.ndarray], queries: np.ndarray) -> np.ndarray:
    """Where to enter the layer below ``upper``, which come highest first: the best nodes found above."""
    entry = np.zeros((len(queries), 1), np.int64)
    for links in upper:
        size = min(8, len(links))
        entry, _ = beam(points, links, queries, entry[:, :size], size)
    return entry


def search(graph: Graph, vectors: np.ndarray, queries: np.ndarray, size: int) -> np.ndarray:
    """Vectors (not nodes) found for each query, -1 where fewer."""
    points = lengthened(vectors[graph.order])
    wide = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
    size = min(size, len(points))
    out = np.full((len(queries), size), -1, np.int64)
    for low in range(0, len(queries), BATCH):
        part = wide[low : low + BATCH]
        entry = _descend(points, graph.layers[:0:-1], part)[:, :size]
        found, _ = beam(points, graph.layers[0], part, entry, size)
        out[low : low + BATCH] = np.where(found >= 0, graph.order[np.maximum(found, 0)], -1)
    return out
