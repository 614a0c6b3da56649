"""Texts to words, and the word filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.functions import (
    has_words,
    is_long,
    is_long_negative,
    is_long_positive,
    is_short,
    word_array,
)


def tokenize(texts: DataFrame, text: str = "text", blanks: bool = False) -> DataFrame:
    """One row per word: ``pos`` (from 0) and ``word`` in place of the text column.

    With ``blanks``, a text without words (a null one too) leaves one row with a null word, which
    every metric takes for a heartbeat of the text's batch.

    Narrow: no shuffle, and one evaluation of the regular expressions per text. The outer form of
    the explode is deliberate. For the inner form Catalyst infers a size filter over the generator's
    input; no text gets to the explode with an empty array, so the filter could only cost.
    """
    words = word_array(F.col(text))
    if blanks:
        return _explode(texts, F.when(has_words(F.col(text)), words), text)
    return _explode(texts.where(has_words(F.col(text))), words, text)


def distinct_words(texts: DataFrame, text: str = "text") -> DataFrame:
    """Each word of a text once, as ``word``; still one row per text and word, without a shuffle.

    Ahead of a distinct over many texts, this leaves its hash tables about half of the rows.
    """
    words = F.array_distinct(word_array(F.col(text)))
    return _explode(texts.where(has_words(F.col(text))), words, text).drop("pos")


def _explode(texts: DataFrame, words: Column, text: str) -> DataFrame:
    keep = [c for c in texts.columns if c != text]
    cut = texts.select(*keep, F.posexplode_outer(words).alias("pos", "word"))
    # gaps are cut as runs, so an empty word after the first one is the trailing gap
    return cut.where((F.coalesce("pos", F.lit(0)) == 0) | (F.col("word") != ""))


def classify(words: DataFrame) -> DataFrame:
    """Adds ``is_long`` and ``is_positive``; a short word is never asked for its sentiment."""
    word = F.col("word")
    return words.withColumns({"is_long": is_long(word), "is_positive": is_long_positive(word)})


def long_words(words: DataFrame) -> DataFrame:
    return words.where(is_long(F.col("word")))


def short_words(words: DataFrame) -> DataFrame:
    """The complement of the long words, the empty word included."""
    return words.where(is_short(F.col("word")))


def long_positive_words(words: DataFrame) -> DataFrame:
    return words.where(is_long_positive(F.col("word")))


def long_negative_words(words: DataFrame) -> DataFrame:
    return words.where(is_long_negative(F.col("word")))
