"""Benchmark decontamination: q-gram lemma over diagonal bands, verified by banded alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.llm import text as tx

Q = 10
WINDOW = 96
# Edits allowed in a window, as a share of its length.
BUDGET = 1 / 16
# Characters of windows that one index holds; a larger benchmark is searched in several passes.
INDEX_CHARS = 8_000_000
_FILTER_BITS = 24


def plain(text: Column) -> Column:
    """Lower-cased letters and digits; all between them is one space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def budget(length: int) -> int:
    """Edits allowed in a window: its share, but no more than leave one q-gram that must match."""
    return max(0, min(int(BUDGET * length), (length - Q) // Q))


def windows(text: str) -> list[tuple[int, str]]:
    """(place, characters) of half-overlapping windows that cover a passage; a short one is a single window."""
    if len(text) <= WINDOW:
        return [(0, text)]
    last = len(text) - WINDOW
    return [(i, text[i : i + WINDOW]) for i in sorted({*range(0, last, WINDOW // 2), last})]


class Index:
    """The q-grams of all windows: sorted hashes, and for each its windows and places in them."""

    def __init__(self, parts: list[tuple[int, str]]) -> None:
        self.items = np.array([i for i, _ in parts], np.int64)
        self.units = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for _, t in parts]
        self.lengths = np.array([len(u) for u in self.units], np.int64)
        self.budgets = np.array([budget(n) for n in self.lengths], np.int64)
        self.needed = self.lengths - Q + 1 - Q * self.budgets
        grams = [tx.gram_hashes(u, Q) for u in self.units]
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        window = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        sort = np.argsort(hashes, kind="stable")
        self.keys, first = np.unique(hashes[sort], return_index=True)
        self.first = np.append(first, len(sort))
        self.window, self.place = window[sort], place[sort]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self._slot(self.keys)] = True
        self.least_needed = int(self.needed.min()) if len(parts) else 1
        self.reach = int((self.lengths + self.budgets).max()) if len(parts) else 1

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def hits(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in the text, keys) of the q-grams that the index holds, in places dense enough."""
        hashes = tx.gram_hashes(units, Q)
        at = np.flatnonzero(self.filter[self._slot(hashes)])
        at = at[self._dense(at)]
        if not len(at):
            return at, at
        key = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        real = self.keys[key] == hashes[at]
        at, key = at[real], key[real]
        dense = self._dense(at)
        return at[dense], key[dense]

    def _dense(self, at: np.ndarray) -> np.ndarray:
        """Whether a hit has, in some region of a window's reach around it, as many hits as any window needs."""
        k = self.least_needed
        if len(at) < k:
            return np.zeros(len(at), bool)
        close = at[k - 1 :] - at[: len(at) - k + 1] < self.reach
        runs = np.zeros(len(at) + 1, np.int64)
        begin = np.flatnonzero(close)
        np.add.at(runs, begin, 1)
        np.add.at(runs, begin + k, -1)
        return np.cumsum(runs[:-1]) > 0


def candidates(index: Index, at: np.ndarray, key: np.ndarray) -> set[tuple[int, int]]:
    """(window, band): diagonal bands that hold enough q-grams of a window.

    A match within e edits strays at most e diagonals, so it lies in one of the bands of 2e + 2
    diagonals that overlap by half.
    """
    found: set[tuple[int, int]] = set()
    count = index.first[key + 1] - index.first[key]
    step = 1 << 20  # pairs of a hit and a place in a window, looked at together
    ends = np.cumsum(count)
    low = 0
    carried: dict[tuple[int, int], int] = {}
    while low < len(at):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + step, "right")))
        c = count[low:high]
        entry = np.repeat(index.first[key[low:high]] - np.concatenate(([0], np.cumsum(c)[:-1])), c) + np.arange(int(c.sum()))
        window = index.window[entry]
        diagonal = np.repeat(at[low:high], c) - index.place[entry]
        band = np.floor_divide(diagonal, index.budgets[window] + 1)
        # each hit of the text counts once for a band of a window
        hit = np.repeat(np.arange(low, high), c)
        for shift in (0, 1):
            rows = np.unique(np.stack([window, band - shift, hit]), axis=1)
            pairs, n = np.unique(rows[:2], axis=1, return_counts=True)
            for w, b, m in zip(*pairs.tolist(), n.tolist(), strict=True):
                carried[w, b] = carried.get((w, b), 0) + m
        low = high
    for (w, b), m in carried.items():
        if m >= index.needed[w]:
            found.add((w, b))
    return found


def aligned(window: np.ndarray, text: np.ndarray, low: int, width: int) -> tuple[int, int]:
    """(edits, end) of the best match of a window that begins on diagonals low .. low + width - 1.

    Only cells on diagonals low - e .. low + width - 1 + e matter, which is what ``width`` covers.
    """
    far = len(window) + 1
    diagonals = low + np.arange(width)
    row = np.where((diagonals >= 0) & (diagonals <= len(text)), 0, far)
    steps = np.arange(width)
    for i, unit in enumerate(window):
        at = diagonals + i
        inside = (at >= 0) & (at < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[at[inside]] == unit
        fresh = np.where(inside, row + ~same, far)  # the window's unit against the text's
        fresh[:-1] = np.minimum(fresh[:-1], row[1:] + 1)  # left out of the text
        valid = (at + 1 >= 0) & (at + 1 <= len(text))
        fresh = np.where(valid, fresh, far)
        row = np.minimum.accumulate(fresh - steps) + steps  # more in the text
        row = np.where(valid, row, far)
    best = int(row.argmin())
    return int(row[best]), int(diagonals[best] + len(window))


def matches(index: Index, units: np.ndarray) -> list[tuple[int, int, int]]:
    """(item, end in the text, edits) of the best match of each benchmark item that has one."""
    at, key = index.hits(units)
    if not len(at):
        return []
    best: dict[int, tuple[int, int]] = {}
    for w, b in sorted(candidates(index, at, key)):
        e = int(index.budgets[w])
        item = int(index.items[w])
        if item in best and best[item][0] == 0:
            continue
        edits, end = aligned(index.units[w], units, b * (e + 1) - e, 4 * e + 2)
        if edits <= e and (item not in best or (edits, end) < best[item]):
            best[item] = (edits, end)
    return [(item, end, edits) for item, (edits, end) in sorted(best.items())]


def _finder(shared):
    def find(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index: Index = shared.value
        for column in columns:
            out = []
            for _, _, data, offsets in tx.blocks(column):
                heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
                units = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
                for low, high in zip(heads[:-1], heads[1:], strict=True):
                    found = matches(index, units[low:high])
                    out.append([{"item_id": i, "end": e, "edits": k} for i, e, k in found])
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())]))
            yield pa.array(out, kind)

    return F.arrow_udf(find, "array<struct<item_id: bigint, end: bigint, edits: int>>")


def find_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with an array column ``leaks`` of (item_id, end, edits), the best match of each item.

    ``benchmark``: item_id, text. Both texts are compared as lower-cased letters and digits with
    single spaces. An item is cut into windows of 96 characters that overlap by half; an item below
    that is one window. A document holds an item if a region of its text is within the edit budget
    of one of its windows: a sixteenth of the window's length. end is where the region ends, counted in
    the characters compared.

    A window with e edits shares at least length - q + 1 - q * e of its q-grams with the region,
    within a band of diagonals (q = 10). Bands with as many are aligned within the band. Whole texts
    are searched; none is cut.

    A null or empty text, or an item of fewer than 10 compared characters, matches nothing. Rows
    with a null item_id are left out. Repeated items count once; repeated documents one by one.
    The benchmark is read in parts of at most ``INDEX_CHARS`` characters of windows, each of which
    goes to the tasks as one index; a benchmark item that is longer than that is a part of its own.
    """
    spark = docs.sparkSession
    items = benchmark.filter("item_id IS NOT NULL").select("item_id", plain(F.col("text")).alias("plain")).distinct()
    items = items.filter(F.char_length("plain") >= Q)
    total = items.agg(F.sum(2 * F.char_length("plain"))).first()[0] or 0
    parts = -(-total // INDEX_CHARS)
    leaks: list[Column] = []
    compared = plain(F.col("text"))
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "plain"), F.lit(parts)) == part).collect()
        cut = sorted((r["item_id"], w) for r in rows for _, w in windows(r["plain"]))
        leaks.append(_finder(spark.sparkContext.broadcast(Index(cut)))(compared))
    empty = F.array().cast("array<struct<item_id: bigint, end: bigint, edits: int>>")
    return docs.withColumn("leaks", F.concat(*leaks) if leaks else empty)
