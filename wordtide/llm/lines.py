"""Line dedup over all documents, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.llm.store import written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\x0b\x0c\r"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else. A text of one byte per character takes the fast path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER)
    )


def _digest(*columns: Column) -> list[Column]:
    """128 bits of the columns, as two longs. The salt stands ahead: behind, it would be a function of the first long."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(7), *columns)]


def _numbered_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, r1, r2, pos, k1, k2) of the lines that are long enough to be judged.

    r is the row's digest (of doc_id and text), k the digest of the line's key.
    """
    key = F.trim(F.col("line"), F.lit(SPACE))
    lines = docs.select("doc_id", *_row(), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    long_keys = lines.select("doc_id", "r1", "r2", "pos", ascii_lower(key).alias("key")).filter(
        F.char_length("key") >= min_chars
    )
    k1, k2 = _digest(F.col("key"))
    return long_keys.select("doc_id", "r1", "r2", "pos", k1.alias("k1"), k2.alias("k2"))


def _row() -> list[Column]:
    r1, r2 = _digest(F.col("doc_id"), F.col("text"))
    return [r1.alias("r1"), r2.alias("r2")]


def repeated_keys(lines: DataFrame, min_docs: int) -> DataFrame:
    """(k1, k2, keeper) of keys in at least ``min_docs`` documents; keeper is the largest doc_id.

    The lines are grouped by key and document first, so a key that a third of all documents holds is
    spread over tasks, and then reaches the second shuffle as one count of each task.
    """
    once = lines.groupBy("k1", "k2", "doc_id").agg(F.lit(1).alias("one"))
    counted = once.groupBy("k1", "k2").agg(F.count("doc_id").alias("docs"), F.max("doc_id").alias("keeper"))
    return counted.filter(F.col("docs") >= min_docs).select("k1", "k2", "keeper")


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    r"""``docs`` with repeated lines dropped from ``text``; adds n_lines and n_dropped (longs).

    Texts are split at \n. A line's key is the line stripped of ``[\x20\x09-\x0D]`` at both ends,
    with A-Z lower-cased. A key of at least ``min_chars`` code points that is found in at least
    ``min_docs`` documents loses all its lines except in the largest doc_id that holds it. Other
    lines stay as they were, in order, joined by \n. All other columns are kept.

    A null or empty text is one empty line, and comes out as an empty text. Rows with a null doc_id
    count as no document, and lose every line of a key that is over the threshold. Rows that share a
    doc_id are one document. Repeated rows are treated alike and stay repeated.

    Two passes over the texts. The first writes the digests of all keys to the shared folder; keys
    are counted, and the places of dropped lines found, from those alone. In the second the texts
    meet their own dropped places, and are shuffled whole, once.
    """
    given = docs.columns
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    lines = written(_numbered_lines(docs.select("doc_id", "text"), min_chars), "lines")
    repeated = written(repeated_keys(lines, min_docs), "repeated-keys")
    places = (
        lines.join(repeated, ["k1", "k2"])
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("r1", "r2")
        .agg(F.collect_set("pos").alias("dropped"))
    )
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in given]).alias("row"), *_row())
    held = packed.join(places, ["r1", "r2"], "left")
    text, dropped = F.col("row.text"), F.coalesce("dropped", F.array().cast("array<int>"))
    cut = held.select("row", dropped.alias("dropped"), F.split(text, "\n", -1).alias("lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    rest = F.when(F.size("dropped") == 0, text).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col("lines"), i)), "\n")
    )
    return cut.select(
        *[rest.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in given],
        F.size("lines").cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"),
    )
