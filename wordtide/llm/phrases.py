"""Phrase collocations: runs of words counted in a burst trie, spilled as sorted runs, merged by prefix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordtide.llm.store import written
from wordtide.llm.text import ascii_lower, blocks, flat, mix, release, span_hashes, spans

LONGEST = 4
# Bits of a word's number within a task. A trie starts anew before it runs out of numbers.
WORD_BITS = 21
# Phrases in a container that make it burst, into so many containers at most.
BURST, FAN_OUT = 1 << 16, 16
# A trie is spilled once it holds so many phrases, or has read so many bytes of text.
ENTRIES, SPILL_BYTES = 1 << 20, 1 << 26
# Parts of the prefixes at least, and for each task that merges; parts that share one prefix of two words.
LEAST_PARTS, PARTS_PER_TASK, SALTS = 1024, 4, 16
# Trie nodes that a merging task decodes at once.
MERGE_NODES = 1 << 20

_MASK = (1 << WORD_BITS) - 1
_U = np.uint64
_K = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0x27D4EB2F165667C5)]
_KIND = np.zeros(256, np.uint8)  # 0: of a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?\n\x0b\x0c\r"]] = 2


class Container:
    """A hash table of (prefix, rest) keys and their counts, as flat arrays; whole arrays are added at once."""

    def __init__(self) -> None:
        self.size, self.fixed = 0, False
        self._allot(1 << 10)

    def _allot(self, slots: int) -> None:
        self.prefix, self.rest = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
        self.count = np.zeros(slots, np.int64)

    def items(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        used = np.flatnonzero(self.count)
        return self.prefix[used], self.rest[used], self.count[used]

    def add(self, prefix: np.ndarray, rest: np.ndarray, count: np.ndarray | None = None) -> None:
        if 2 * (self.size + len(prefix)) > len(self.count):
            held, slots = self.items(), len(self.count)
            while slots < 2 * (self.size + len(prefix)):
                slots *= 2
            self._allot(slots)
            self._put(*held)
        self._put(prefix, rest, np.ones(len(prefix), np.int64) if count is None else count)
        self.size = int(np.count_nonzero(self.count))

    def _put(self, prefix: np.ndarray, rest: np.ndarray, count: np.ndarray) -> None:
        mask = len(self.count) - 1
        slot = (mix(prefix.view(_U) * _K[0] ^ rest.view(_U) * _K[1]) & _U(mask)).astype(np.int64)
        while len(slot):
            free = self.count[slot] == 0
            self.prefix[slot[free]], self.rest[slot[free]] = prefix[free], rest[free]  # of several, the last has the slot
            own = (self.prefix[slot] == prefix) & (self.rest[slot] == rest)
            np.add.at(self.count, slot[own], count[own])
            left = ~own
            slot, prefix, rest, count = (slot[left] + 1) & mask, prefix[left], rest[left], count[left]


class Trie:
    """Phrases of one to four words and their counts, by language.

    The upper two levels, words one and two, are the trie; below them lie hash containers, each with
    the phrases of a range of prefixes. A container that grows too large bursts into several, at
    first words if it holds several of them, else at second words. One that holds a single prefix of
    two words stays whole.
    """

    def __init__(self) -> None:
        self.words, self.names, self.langs = {}, [b""], {}
        self.bounds, self.containers = np.array([0], np.int64), [Container()]
        self.bytes = 0

    def numbers(self, words: pa.Array) -> np.ndarray:
        coded = words.dictionary_encode()
        fresh = [self.words.setdefault(w, len(self.words) + 1) for w in coded.dictionary.to_pylist()]
        if len(self.words) >= len(self.names):
            self.names.extend(list(self.words)[len(self.names) - 1 :])
        return np.array(fresh, np.int64)[coded.indices.to_numpy(zero_copy_only=False)]

    def size(self) -> int:
        return sum(c.size for c in self.containers)

    def add(self, lang: np.ndarray, word: np.ndarray, piece: np.ndarray) -> None:
        """All phrases within pieces, of words in reading order."""
        following = []
        for k in range(1, LONGEST):
            there = np.zeros(len(word), np.int64)
            same = piece[k:] == piece[:-k]
            there[: len(word) - k][same] = word[k:][same]
            following.append(there)
        prefix, rest = [], []
        first = (lang << WORD_BITS | word) << WORD_BITS
        for k in range(LONGEST):
            here = np.ones(len(word), bool) if k == 0 else following[k - 1] > 0
            prefix.append(first[here] | (following[0][here] if k else 0))
            rest.append((following[1][here] if k > 1 else 0) << WORD_BITS | (following[2][here] if k > 2 else np.zeros(int(here.sum()), np.int64)))
        self._add(np.concatenate(prefix), np.concatenate(rest))

    def _add(self, prefix: np.ndarray, rest: np.ndarray) -> None:
        at = np.searchsorted(self.bounds, prefix, "right") - 1
        order = np.argsort(at.astype(np.uint16) if len(self.bounds) < 1 << 16 else at, kind="stable")
        prefix, rest = prefix[order], rest[order]
        ends = np.searchsorted(at[order], np.arange(len(self.bounds) + 1))
        for i in np.flatnonzero(np.diff(ends)):
            self.containers[i].add(prefix[ends[i] : ends[i + 1]], rest[ends[i] : ends[i + 1]])
        for i in reversed([i for i, c in enumerate(self.containers) if c.size > BURST and not c.fixed]):
            self._burst(i)

    def _burst(self, i: int) -> None:
        prefix, rest, count = self.containers[i].items()
        order = np.argsort(prefix)
        prefix, rest, count = prefix[order], rest[order], count[order]
        cuts, last = [], int(prefix[0])
        for p in prefix[np.arange(1, FAN_OUT) * len(prefix) // FAN_OUT].tolist():
            p = p & ~_MASK if p & ~_MASK > last else p  # at a first word, unless it is still the same
            if p > last:
                cuts.append(p)
                last = p
        if not cuts:
            self.containers[i].fixed = True
            return
        ends = [0, *np.searchsorted(prefix, cuts).tolist(), len(prefix)]
        parts = []
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            parts.append(Container())
            parts[-1].add(prefix[a:b], rest[a:b], count[a:b])
        self.containers[i : i + 1] = parts
        self.bounds = np.insert(self.bounds, i + 1, cuts)

    def runs(self, parts: int) -> Iterator[pa.RecordBatch]:
        """All subtrees as sorted runs, one for each language and part: see ``RUN``."""
        names = pa.array([w + b" " for w in self.names], pa.large_binary())
        rank = np.zeros(len(names), np.int64)
        rank[pc.sort_indices(pa.array(self.names, pa.large_binary())).to_numpy()] = np.arange(len(names))  # no word comes first
        sizes = np.array([len(w) for w in self.names])
        ends = np.cumsum(sizes)
        hashes = np.zeros(len(names), _U)
        hashes[1:] = span_hashes(np.frombuffer(b"".join(self.names), np.uint8), ends[1:] - sizes[1:], ends[1:])
        prefix, rest, count = (np.concatenate(x) for x in zip(*(c.items() for c in self.containers), strict=True))
        of_lang = prefix >> 2 * WORD_BITS
        for lang, number in self.langs.items():
            mine = of_lang == number
            if mine.any():
                yield from _runs(lang, prefix[mine], rest[mine], count[mine], names, rank, hashes, parts)


# ``nodes``: compressed, the words of a subtree joined by spaces, their depths, and their counts.
RUN = "part int, lang string, n_nodes int, n_bytes int, nodes binary"
_CODEC = pa.Codec("zstd", compression_level=1)


def _runs(lang, prefix, rest, count, names, rank, hashes, parts) -> Iterator[pa.RecordBatch]:
    words = [prefix >> WORD_BITS & _MASK, prefix & _MASK, rest >> WORD_BITS, rest & _MASK]
    second, third = hashes[words[1]], mix(hashes[words[2]]) % _U(SALTS)
    second = np.where(words[2] > 0, second, mix(second) % _U(SALTS))
    key = hashes[words[0]] * _K[0] + second * _K[1] + third * _K[2]
    part = (mix(key) % _U(parts)).astype(np.int64)
    ranks = [rank[w] for w in words]
    order = np.lexsort((ranks[2] << WORD_BITS | ranks[3], ranks[0] << WORD_BITS | ranks[1], part))
    part, count, words = part[order], count[order], [w[order] for w in words]
    depth = sum((w > 0).astype(np.int64) for w in words)
    # A phrase shares its path with the one before it up to the first word that differs.
    new = np.ones(len(part), bool)
    new[1:] = part[1:] != part[:-1]
    shared, agree = np.zeros(len(part), np.int64), ~new
    for w in words:
        agree[1:] &= w[1:] == w[:-1]
        agree &= w > 0
        shared += agree
    nodes = depth - shared
    at = np.repeat(np.arange(len(part)), nodes)
    begin = np.concatenate(([0], np.cumsum(nodes)))
    level = np.arange(len(at)) - begin[at] + shared[at]
    counts = np.where(level + 1 == depth[at], count[at], 0)
    word = np.choose(level, [w[at] for w in words])
    cuts = np.flatnonzero(new)
    edges = np.concatenate((begin[cuts], [len(at)]))
    text, places = flat_binary(names.take(pa.array(word)))
    depths, counts = level.astype(np.uint8), counts.astype("<i4").view(np.uint8)
    packed = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        raw = b"".join((text[places[a] : places[b]], depths[a:b], counts[4 * a : 4 * b]))
        packed.append((len(raw), _CODEC.compress(raw, asbytes=True)))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(part[cuts], pa.int32()), pa.array([lang] * len(cuts), pa.string()), pa.array(np.diff(edges), pa.int32()),
            pa.array([n for n, _ in packed], pa.int32()), pa.array([x for _, x in packed], pa.binary()),
        ],
        names=["part", "lang", "n_nodes", "n_bytes", "nodes"],
    )


def _slices(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(texts ahead, bytes, offsets): the block itself, or a long text cut between pieces."""
    if len(data) <= 2 * size:
        yield 0, data, offsets
        return
    first = 0
    for i in range(len(offsets) - 1):
        low, high = int(offsets[i]), int(offsets[i + 1])
        if high - low > 2 * size:
            ends = low + 1 + np.flatnonzero(_KIND[data[low:high]] == 2)
            if first < i:
                yield first, data[offsets[first] : low], offsets[first : i + 1] - offsets[first]
            while low < high:
                j = int(np.searchsorted(ends, low + size))
                end = int(ends[j]) if j < len(ends) else high
                yield i, data[low:end], np.array([0, end - low])
                low = end
            first = i + 1
    if first < len(offsets) - 1:
        yield first, data[offsets[first] :], offsets[first:] - offsets[first]


def count_runs(texts: DataFrame, parts: int) -> DataFrame:
    """Runs of the phrases of ``texts`` (lang, text), as ``RUN``: part, lang, and a subtree in reading order.

    A node is a word, its depth, and the count of the phrase that ends there, 0 if it is only passed.
    A phrase's part comes from its first two words, and from a salt of its third, so no prefix is
    all in one part.
    """

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for low, high, block, block_offsets in blocks(batch.column(1)):
                for ahead, data, offsets in _slices(block, block_offsets, 1 << 20):
                    kind = _KIND[data]
                    starts, ends, before = spans(kind == 0, offsets)
                    if not len(starts):
                        continue
                    numbers = [trie.langs.setdefault(x, len(trie.langs)) for x in langs[low + ahead : low + ahead + len(offsets) - 1]]
                    texts_of = np.repeat(np.arange(len(numbers)), np.diff(before))
                    piece = np.cumsum(kind == 2)[starts] + texts_of * (len(data) + 1)
                    packed = ascii_lower(data[kind == 0])
                    bounds = np.concatenate(([0], np.cumsum(ends - starts)))
                    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(packed)])
                    trie.add(np.array(numbers)[texts_of], trie.numbers(words), piece)
                    trie.bytes += len(data)
                    if trie.size() > ENTRIES or trie.bytes > SPILL_BYTES or max(len(trie.words), len(trie.langs)) > _MASK // 2:
                        yield from trie.runs(parts)
                        trie = Trie()
        if trie.words:
            yield from trie.runs(parts)
        release()

    return texts.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(spill, RUN)


def _grouped(keys: list[np.ndarray], count: np.ndarray) -> list[np.ndarray]:
    """Equal keys as one row, with the sum of their counts. Rows are sorted by a hash, or by the keys if hashes clash."""
    order = np.argsort(mix(keys[0].view(_U) * _K[2] + keys[1].view(_U) * _K[0] ^ mix(keys[2].view(_U) * _K[1])))
    while len(order):
        sorted_ = [k[order] for k in keys]
        new = np.ones(len(order), bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in sorted_], axis=0)
        hashes = mix(sorted_[0].view(_U) * _K[2] + sorted_[1].view(_U) * _K[0] ^ mix(sorted_[2].view(_U) * _K[1]))
        if np.any(new[1:] & (hashes[1:] == hashes[:-1])):
            exact = np.lexsort(keys)
            if not np.array_equal(exact, order):
                order = exact
                continue
        at = np.flatnonzero(new)
        return [*(k[at] for k in sorted_), np.add.reduceat(count[order], at)]
    return [*keys, count]


class Merger:
    """The counts of one part, from runs of any number of tasks. What it keeps grows with distinct phrases alone."""

    def __init__(self) -> None:
        self.names, self.words, self.langs, self.held = None, None, {}, None

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """Numbers from 1 of the words; those of the first runs are in the order of their dictionary."""
        coded = words.dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False)
        if self.names is None:
            self.names = coded.dictionary
            return at.astype(np.int64) + 1
        if self.words is None:
            self.words = {w: i for i, w in enumerate(self.names.to_pylist(), 1)}
        known = np.array([self.words.setdefault(w, len(self.words) + 1) for w in coded.dictionary.to_pylist()], np.int64)
        return known[at]

    def add(self, rows: pa.RecordBatch) -> None:
        langs, sizes, raw = rows.column(1), rows.column(2).to_pylist(), []
        for n, size, nodes in zip(sizes, rows.column(3).to_pylist(), rows.column(4), strict=True):
            data = _CODEC.decompress(nodes.as_buffer(), size, asbytes=True)
            raw.append((data[: -5 * n - 1], data[-5 * n : -4 * n], data[-4 * n :]))
        words, depths, counts = zip(*raw, strict=True)
        level, count = np.frombuffer(b"".join(depths), np.uint8), np.frombuffer(b"".join(counts), "<i4").astype(np.int64)
        joined = pa.array([b" ".join(words)], pa.large_binary()).cast(pa.large_string())
        word = self._numbers(pc.split_pattern(joined, " ").flatten())
        place = np.arange(len(word))
        path = []
        for k in range(LONGEST):
            last = np.maximum.accumulate(np.where(level == k, place, 0))
            path.append(np.where(level >= k, word[last], 0))
        lang = np.repeat(np.array([self.langs.setdefault(x, len(self.langs)) for x in langs.to_pylist()], np.int64), sizes)
        used = count > 0
        fresh = [lang[used], (path[0] << 32 | path[1])[used], (path[2] << 32 | path[3])[used], count[used]]
        if self.held is not None:
            fresh = [np.concatenate(x) for x in zip(self.held, fresh, strict=True)]
        self.held = _grouped(fresh[:3], fresh[3])

    def rows(self, least: int) -> pa.RecordBatch:
        """(lang, phrase, size, f) of phrases with ``least`` occurrences; with size 0, those of all words."""
        lang, a, b, n = self.held
        single = (a & 0xFFFFFFFF) == 0
        totals = np.zeros(len(self.langs), np.int64)
        np.add.at(totals, lang[single], n[single])
        enough = n >= least
        ids = np.stack([a[enough] >> 32, a[enough] & 0xFFFFFFFF, b[enough] >> 32, b[enough] & 0xFFFFFFFF], axis=1)
        names = self.names if self.words is None else pa.array(list(self.words), pa.large_string())
        used, at = np.unique(ids, return_inverse=True)
        texts = dict(enumerate(names.take(pa.array(used[used > 0] - 1)).to_pylist(), int(len(used) > 0 and used[0] == 0)))
        phrases = [" ".join(texts[j] for i, j in zip(row, places, strict=True) if i) for row, places in zip(ids.tolist(), at.reshape(ids.shape).tolist(), strict=True)]
        langs = list(self.langs)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([langs[i] for i in lang[enough].tolist()] + langs, pa.string()),
                pa.array(phrases + [None] * len(langs), pa.string()),
                pa.array(np.concatenate(((ids > 0).sum(axis=1), np.zeros(len(langs), np.int64))), pa.int32()),
                pa.array(np.concatenate((n[enough], totals)), pa.int64()),
            ],
            names=["lang", "phrase", "size", "f"],
        )


def flat_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return flat(pa.Array.from_buffers(pa.large_string(), len(column), column.buffers(), offset=column.offset))


def merge_runs(runs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, size, f): phrases with at least ``least`` occurrences, from all runs of their part.

    With a null phrase and size 0, f is a number of word occurrences; these add up by language.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, at = None, None
        for batch in batches:
            part = batch.column(0).to_numpy()
            nodes = np.cumsum(batch.column(2).to_numpy())
            low = 0
            while low < len(part):
                if part[low] != at:
                    if merger:
                        yield merger.rows(least)
                    merger, at = Merger(), part[low]
                high = int(np.searchsorted(part, at, "right"))
                full = int(np.searchsorted(nodes, (nodes[low - 1] if low else 0) + MERGE_NODES, "right"))
                high = min(high, max(low + 1, full))
                merger.add(batch.slice(low, high - low))
                low = high
        if merger:
            yield merger.rows(least)
        release()

    return runs.repartition("part").sortWithinPartitions("part").mapInArrow(merge, "lang string, phrase string, size int, f bigint")


def _scored(counted: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score): candidates by their lowest-scoring cut."""
    known = counted.select("lang", "phrase", "f")
    cut = counted.filter("size > 1").select(
        "lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("w"), F.explode(F.expr("sequence(1, size - 1)")).alias("k")
    )
    cut = cut.select(
        "lang", "phrase", "size", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("first"),
        F.expr("array_join(slice(w, k + 1, size), ' ')").alias("last"),
    )
    cut = cut.join(known.toDF("lang", "first", "l"), ["lang", "first"]).join(known.toDF("lang", "last", "r"), ["lang", "last"])
    # Products and sums may pass 64 bits; the quotient is at most a million.
    score = F.expr("CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0)) div (CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0)))")
    lowest = cut.withColumn("score", score).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    return lowest.select("lang", "phrase", "size", "a", "m.l", "m.r", "m.score")


def _held_inside(counted: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the largest f of longer candidates that hold the phrase."""
    long = counted.filter("size > 2").select("lang", "f", "size", F.split("phrase", " ").alias("w"))
    within = long.select("lang", "f", "size", "w", F.explode(F.expr("sequence(2, size - 1)")).alias("k"))
    within = within.select("lang", "f", "w", "k", F.explode(F.expr("sequence(1, size - k + 1)")).alias("at"))
    phrase = F.expr("array_join(slice(w, at, k), ' ')")
    return within.groupBy("lang", phrase.alias("phrase")).agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, least: int = 30, covered: int = 80, top: int = 2000) -> DataFrame:
    r"""lang, rank, phrase, a, l, r, n, score: each language's first ``top`` collocations. ``docs``: lang, text.

    Texts, with A-Z lower-cased, are split at ``[.,;:!?\x0A-\x0D]`` into pieces and those into words
    ``[^\x20\x09]+``. n counts a language's word occurrences, f(phrase) all occurrences of a phrase
    within pieces. Candidates are phrases of 2 to 4 words with a = f >= ``least``. A cut after k words
    has l = f(first part), r = f(rest), and scores floor(2000000 a / (l + r)); the lowest-scoring cut
    counts, of equal ones the shortest first part. A candidate goes if a longer one holds it with
    100 f(longer) >= ``covered`` a. Order: score and a descending, phrase ascending by UTF-8 bytes.

    A null lang is ``und``; a null or empty text has no words. Repeated rows count each time. Other
    columns are not read. Without candidates there are no rows. Texts may be of any length: a long
    one is counted piece by piece.

    Tasks count into a burst trie and spill it as sorted runs when it is full; what meets in the
    shuffle is one run of a task for each part of the prefixes, and a part is merged at a time. All
    words of a phrase are compared as they are, not by hashes. The parts of a phrase with a >=
    ``least`` are at least as frequent, so joins from there on hold frequent phrases alone.
    """
    spark = docs.sparkSession
    parts = max(LEAST_PARTS, PARTS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions")))
    counted = written(merge_runs(count_runs(docs.select("lang", "text"), parts), least), "phrases")
    words = counted.filter("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    counted = counted.filter("size > 0")
    kept = (
        _scored(counted)
        .join(_held_inside(counted), ["lang", "phrase"], "left")
        .filter(f"longer IS NULL OR CAST(100 AS DECIMAL(3, 0)) * CAST(longer AS DECIMAL(19, 0)) < {int(covered)} * CAST(a AS DECIMAL(19, 0))")
    )
    # A language may have most of the phrases: the first of each share of them, then the first of those.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = Window.partitionBy("lang", "share").orderBy(*order)
    best = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(share)).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(words, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
