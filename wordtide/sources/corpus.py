"""Text corpora: whole texts, one row per file, or the words of files of any size, numbered."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wordtide.functions import strip_punctuation, word_array
from wordtide.functions.text import WHITESPACE
from wordtide.sources.messages import read_messages

_BLOCK = ["file", "block"]


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``text`` of every file under ``path``, whole, since a leading gap is a word of its own.

    Files are spread over tasks; a single file must fit one row (2 GB). ``corpus_words`` takes files
    of any size.
    """
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "text")


def corpus_words(spark: SparkSession, path: str, work: str) -> DataFrame:
    """The words of all files under ``path`` as (file, seq, word), in the order of files and text.

    ``seq`` counts from 0 without gaps over all files, and the words are those of ``tokenize`` over
    whole texts. A file may have any size: it is read in byte ranges of at most
    ``spark.sql.files.maxPartitionBytes``, each by a task of its own. A line belongs to the range it
    begins in, and no word spans lines, so none is cut in two. Only a single line must fit one row.

    Every text is read and cut once, into a table in ``work``, a new folder that all executors share
    and that must outlive the result. Places are then added up in two steps: words per range, whose
    running sums are taken in sorted parts, and lines within their range, which is the largest group
    that a task sorts. Empty files and files of white space have no words; one of nothing but
    punctuation, without a line's end, has one empty word.
    """
    _cut_lines(spark, path).write.parquet(f"{work}/lines")
    lines = spark.read.parquet(f"{work}/lines")

    in_block = W.partitionBy(*_BLOCK).orderBy("line")
    placed = lines.withColumns(
        {"before": _before("n", in_block), "first": F.row_number().over(in_block) == 1}
    ).join(_block_starts(spark, lines, work), _BLOCK)
    empty_first = F.col("gap_word") & F.col("first")
    words = F.when(empty_first, F.concat(F.array(F.lit("")), "words")).otherwise(F.col("words"))
    moved = (F.col("gap_word") & ~F.col("first")).cast("bigint")  # behind the empty first word
    at = (F.col("start") + F.col("before") + moved).alias("at")
    return placed.select("file", at, F.posexplode(words).alias("pos", "word")).select(
        "file", (F.col("at") + F.col("pos")).alias("seq"), "word"
    )


def _cut_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as (file, block, line, words, gap, n); ``line`` grows within a range.

    ``gap``: the line starts with white space once stripped; its end counts. A line that is its whole
    file, without an end, can be an empty word; else empty words are gaps at a line's ends.
    """
    found = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("text"),
        (F.octet_length("value") == F.col("_metadata.file_size")).alias("whole"),
    )
    stripped = strip_punctuation(F.col("text"))
    words = F.array_remove(word_array(F.col("text")), "")
    cut = found.select(
        *_BLOCK,
        "line",
        F.when(F.col("whole") & (stripped == ""), F.array(F.lit(""))).otherwise(words).alias("words"),
        F.when(stripped == "", ~F.col("whole"))
        .otherwise(stripped.rlike(f"^[{WHITESPACE}]"))
        .alias("gap"),
    )
    return cut.withColumn("n", F.size("words").cast("bigint"))


def _block_starts(spark: SparkSession, lines: DataFrame, work: str) -> DataFrame:
    """(file, block, start, gap_word): words ahead of a range, and whether an empty word opens it.

    One row per range. They are sorted into parts and written; the parts' sums are added up first,
    then the ranges within their part.
    """
    blocks = lines.groupBy(*_BLOCK).agg(
        F.sum("n").alias("n_words"), F.min_by("gap", "line").alias("gap")
    )
    in_file = F.sum("n_words").over(W.partitionBy("file"))
    opens = (F.col("block") == 0) & F.col("gap") & (in_file > 0)
    counted = blocks.withColumn("gap_word", opens).select(
        *_BLOCK, "gap_word", (F.col("n_words") + F.col("gap_word").cast("bigint")).alias("n")
    )
    parts = counted.repartitionByRange(*_BLOCK).withColumn("part", F.spark_partition_id())
    parts.write.parquet(f"{work}/blocks")
    sorted_blocks = spark.read.parquet(f"{work}/blocks")
    # one row per part, of which there are as many as shuffle partitions at most
    sums = sorted_blocks.groupBy("part").agg(F.sum("n").alias("n"))
    starts = sums.select("part", _before("n", W.orderBy("part")).alias("part_start"))
    inside = _before("n", W.partitionBy("part").orderBy(*_BLOCK))
    return sorted_blocks.withColumn("inside", inside).join(starts, "part").select(
        *_BLOCK, "gap_word", (F.col("part_start") + F.col("inside")).alias("start")
    )


def _before(column: str, window: W) -> Column:
    frame = window.rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(frame), F.lit(0).cast("bigint"))


def corpus_messages(
    spark: SparkSession, path: str, key: str = "words", first: int = 0, *, work: str
) -> DataFrame:
    """The words of a corpus as messages (key, value, seq), file after file, in the order of the text.

    ``seq`` counts from ``first`` over all files. Appended to the folder of a message stream, they
    feed it. ``work`` is a new folder, as in ``corpus_words``.
    """
    return corpus_words(spark, path, work).select(
        F.lit(key).alias("key"),
        F.col("word").alias("value"),
        (F.col("seq") + F.lit(first)).cast("bigint").alias("seq"),
    )


def next_number(spark: SparkSession, messages: str, key: str) -> int:
    """The ``seq`` after the last one of a key in a folder of messages; 0 where there is no folder."""
    try:
        found = read_messages(spark, messages, [key])
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    last = found.agg(F.max("seq")).first()[0]
    return 0 if last is None else last + 1
