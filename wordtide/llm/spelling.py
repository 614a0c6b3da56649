"""Spelling variants: words one edit apart, found by walking a distributed trie level by level."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.llm.store import written
from wordtide.llm.text import ascii_lower, blocks, mix, spans

# Words of up to this many code points walk the trie; a longer one would need a level for each.
TRIE_CHARS = 64
FORWARD, BACKWARD = ">", "<"

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_U32 = np.uint32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=_U32)
    for _ in range(8):
        table = np.where(table & _U32(1), (table >> _U32(1)) ^ _U32(0xEDB88320), table >> _U32(1))
    return table


_CRC = _crc_table()


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of A-Z, a-z and U+00C0 to U+00FF, which UTF-8 writes as C3 and one more byte."""
    lead = data == 0xC3
    inside = _ASCII_LETTER[data] | lead
    inside[1:] |= lead[:-1]
    return inside


def crc32_after(states: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of each span, carried on from the crc32 of what stands before it. Byte by byte, all spans at once."""
    out = np.zeros(len(starts), np.int64)
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    long = int(np.searchsorted(-sizes[order], -TRIE_CHARS * 2))
    for i in order[:long]:
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(states[i]))
    order = order[long:]
    state, begin, size = ~states[order].astype(_U32), starts[order], sizes[order]
    for j in range(int(size[0]) if len(size) else 0):
        m = int(np.searchsorted(-size, -j))  # sizes above j
        state[:m] = _CRC[(state[:m] ^ data[begin[:m] + j]) & _U32(0xFF)] ^ (state[:m] >> _U32(8))
    out[order] = ~state
    return out


def noised_words(data: np.ndarray, offsets: np.ndarray, ids: list[str], min_chars: int, one_in: int) -> tuple[pa.Array, pa.Array]:
    """(words, occurrences) of a block of texts; of one run in ``one_in``, by its crc32, a letter is gone."""
    data = ascii_lower(data)
    starts, ends, before = spans(_letters(data), offsets)
    first = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = first[ends] - first[starts]
    doc = np.repeat(np.arange(len(ids)), np.diff(before))
    enough = chars >= min_chars
    starts, ends, chars, doc = starts[enough], ends[enough], chars[enough], doc[enough]
    states = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.int64)
    crc = crc32_after(states[doc], data, starts, ends)
    cut = crc % one_in == 0
    shorter = []
    for i in np.flatnonzero(cut & (chars > min_chars)):
        word, k = data[starts[i] : ends[i]].tobytes().decode(), int(crc[i] % chars[i])
        shorter.append(word[:k] + word[k + 1 :])
    starts, ends = starts[~cut], ends[~cut]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] = 1
    inside[ends] -= 1
    packed = data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
    bounds = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    whole = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(packed))
    counted = pc.value_counts(pa.concat_arrays([whole, pa.array(shorter, pa.large_string())]))
    return counted.field(0).cast(pa.string()), counted.field(1)


def words_of(docs: DataFrame, min_chars: int = 7, min_count: int = 2, one_in: int = 31) -> DataFrame:
    r"""(word, n): the words of all texts and their occurrences. ``docs``: doc_id, text.

    A run is a maximal run of ``[A-Za-zÀ-ÿ]``, A-Z lower-cased. Where ``one_in`` divides the
    crc32 of ``<doc_id>:<run>``, the code point at crc32 mod length is deleted. What has ``min_chars``
    code points and ``min_count`` occurrences then is a word. Blocks of texts count ahead of the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for low, high, data, offsets in blocks(batch.column(1)):
                words, n = noised_words(data, offsets, ids[low:high], min_chars, one_in)
                yield pa.RecordBatch.from_arrays([words, n], ["word", "n"])

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    parts = texts.mapInArrow(count, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _directed(words: DataFrame) -> DataFrame:
    """Each word forwards and backwards: (side, s, size, low). Edits at positions from ``low`` on belong to a side.

    The two sides share the positions of a word between them, so an edit is only ever tried in the
    half of a trie far from its root, where nodes have few children.
    """
    size = F.char_length("word")
    half = F.floor(size / 2).cast("int")
    both = F.array(
        F.struct(F.lit(FORWARD).alias("side"), F.col("word").alias("s"), size.alias("size"), half.alias("low")),
        F.struct(F.lit(BACKWARD).alias("side"), F.reverse("word").alias("s"), size.alias("size"), (size - half).alias("low")),
    )
    return words.select(F.explode(both).alias("d")).select("d.*")


def _upto(s: str, n: str) -> Column:
    return F.expr(f"substring({s}, 1, {n})")


def edge_table(directed: DataFrame) -> DataFrame:
    """(child, ends): each trie node that a walk can enter, and whether a word ends there.

    A node is its path: the side, then the letters from the root. An edge (parent, letter) is named
    by the child it leads to.
    """
    depths = directed.select("side", "s", "size", F.explode(F.expr("sequence(size div 2, size)")).alias("depth"))
    path = F.concat("side", _upto("s", "depth"))
    return depths.groupBy(path.alias("child")).agg(F.bool_or(F.col("depth") == F.col("size")).alias("ends"))


def _substitutes(edges: DataFrame) -> DataFrame:
    """(node, next, exits): the letters that lead from ``node`` to one that goes on with ``next``.

    ``next`` is empty for letters that end a word; ``ends`` says whether a word ends after ``next``.
    A node has no more exits than the alphabet has letters.
    """
    last = F.expr("substring(child, -1, 1)")
    inner = edges.filter(F.char_length("child") >= 3).select(
        F.expr("substring(child, 1, char_length(child) - 2)").alias("node"), last.alias("next"),
        F.expr("substring(child, -2, 1)").alias("letter"), "ends",
    )
    final = edges.filter("ends").select(
        F.expr("substring(child, 1, char_length(child) - 1)").alias("node"), F.lit("").alias("next"), last.alias("letter"), "ends"
    )
    return inner.unionByName(final).groupBy("node", "next").agg(F.collect_list(F.struct("letter", "ends")).alias("exits"))


def _first_states(directed: DataFrame, edges: DataFrame) -> DataFrame:
    """(side, s, size, position, child, ends): the states one step after their edit, inside the trie.

    A replacement works both ways, so it is tried towards the larger letter alone.
    """
    at = directed.select("side", "s", "size", F.explode(F.expr("sequence(low, size - 1)")).alias("at"))
    at = at.select(
        "side", "s", "size", F.expr("least(at + 2, size)").alias("position"), F.concat("side", _upto("s", "at")).alias("node"),
        F.expr("substring(s, at + 1, 1)").alias("here"), F.expr("substring(s, at + 2, 1)").alias("next"),
    )
    state = ["side", "s", "size", "position", "child", "ends"]
    deleted = at.filter("here != next").select(  # of equal letters in a row, the last one
        "side", "s", "size", "position", F.concat("node", "next").alias("child")
    )
    replaced = (
        at.join(_substitutes(edges), ["node", "next"])
        .withColumn("exit", F.explode(F.expr("filter(exits, x -> x.letter > here)")))
        .withColumn("child", F.concat("node", "exit.letter", "next"))
        .withColumn("ends", F.col("exit.ends"))
    )
    return deleted.join(edges, "child").select(state).unionByName(replaced.select(state))


def _walk(words: DataFrame) -> DataFrame:
    """(word, near): of each pair at least one order; a pair can come more than once."""
    directed = _directed(words)
    edges = written(edge_table(directed), "trie-edges")
    entered, found = written(_first_states(directed, edges), "trie-frontier"), []
    while True:
        found.append(entered.filter("ends AND position = size").select("side", "s", F.expr("substring(child, 2)").alias("t")))
        going = entered.filter("position < size")
        if going.isEmpty():
            break
        frontier = going.select(
            "side", "s", "size", F.expr("position + 1").alias("position"),
            F.concat("child", F.expr("substring(s, position + 1, 1)")).alias("child"),
        )
        entered = written(frontier.join(edges, "child"), "trie-frontier")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    forth = lambda c: F.when(F.col("side") == FORWARD, F.col(c)).otherwise(F.reverse(c))
    return out.select(forth("s").alias("word"), forth("t").alias("near"))


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _cut_hashes(word: str) -> np.ndarray:
    """A hash of the word without each of its code points in turn, then of the whole word."""
    codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    powers = np.full(len(codes), _BASE, np.uint64)
    powers[0] = 1
    before = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * np.multiply.accumulate(powers), dtype=np.uint64)))
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    return mix(np.concatenate((before[:-1] + (before[-1] - before[1:]) * inverse, before[-1:])))


def _long_pairs(words: DataFrame) -> DataFrame:
    """(word, near) for long words: words that agree without one code point, compared whole.

    Words that share a hash at a place differ in that code point alone, so no more of them meet than
    the alphabet has letters. A word's hashes travel without the word.
    """

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = _cut_hashes(word)
                n = len(hashes)
                places = np.arange(n)
                places[-1] = -1
                columns = [pa.array([key] * n), pa.array(hashes.view(np.int64)), pa.array(places), pa.array(np.full(n, n - 1))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "hash", "place", "size"])

    named = words.select("word", F.md5(F.col("word").cast("binary")).alias("key"))
    rows = written(named.mapInArrow(cuts, "key string, hash bigint, place bigint, size bigint"), "long-words")
    a, b = rows.filter("place >= 0"), rows.toDF("key2", "hash2", "place2", "size2")
    same = a.join(b, [F.col("hash") == F.col("hash2"), F.col("place") == F.col("place2"), F.col("size") == F.col("size2"), F.col("key") != F.col("key2")])
    less = a.join(b.filter("place2 = -1"), [F.col("hash") == F.col("hash2"), F.col("size") == F.col("size2") + 1])
    keys = same.select("key", "key2").unionByName(less.select("key", "key2")).distinct()
    pairs = keys.join(named, "key").join(named.select(F.col("word").alias("near"), F.col("key").alias("key2")), "key2")
    return pairs.filter(F.levenshtein("word", "near", 1) == 1).select("word", "near")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near): every ordered pair of distinct words of ``word`` that one edit parts.

    An edit inserts, deletes or replaces one code point. States (word, position, node, edits) walk a
    trie of all words, forwards and backwards, in joins with the table of its edges: one join a
    level. A word's own path needs no walk, so states start where their edit was made, and end when
    the word is used up at a node that ends another one. The tables of every level are in the shared
    folder. Words of over TRIE_CHARS code points, or just as many, are also compared through hashes
    without each of their code points, since a trie would need a level for each; whole words decide.
    """
    words = words.select("word").filter("char_length(word) > 1").distinct()
    pairs = _walk(words.filter(F.char_length("word") <= TRIE_CHARS))
    pairs = pairs.unionByName(_long_pairs(words.filter(F.char_length("word") >= TRIE_CHARS)))
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct()


def variants(words: DataFrame, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``words`` (word, n; words distinct).

    A word's form is its near word of the largest n (ties: the smallest in code-point order), if that
    is ``times`` the word's n or more; else null. A word's root is where its forms lead to in the end,
    itself if it has none. Since n grows along forms, they have no circles and are few: roots are
    found by joins that double the way each time, until no row changes. Null words count for nothing.
    """
    words = words.select("word", "n").filter("word IS NOT NULL")
    pairs = neighbours(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = pairs.groupBy("word").agg(F.count("near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    fits = -F.col("best.less") >= F.lit(times) * F.col("n")
    judged = words.join(best, "word", "left").select(
        "word", F.when(fits, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fits, -F.col("best.less")).alias("form_n"),
    )
    judged = written(judged, "variants")
    roots = written(judged.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, min_chars: int = 7, min_count: int = 2, one_in: int = 31, times: int = 10) -> DataFrame:
    """``variants`` of the ``words_of`` all texts: word, form, root, n, n_near, form_n.

    A null text has no words, and neither has an empty one. A null doc_id is written as an empty
    string ahead of the colon. Repeated rows count each time. Texts and words may be of any length.
    Only doc_id and text are read; a table without rows, or without words, gives no rows.
    """
    return variants(written(words_of(docs, min_chars, min_count, one_in), "words"), times)
