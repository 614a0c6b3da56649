"""A training corpus from raw documents, stage by stage, each written before the next reads it.

Every stage works on all rows its predecessor kept. Columns that a stage does not know pass through
it packed away, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.llm import decontaminate, lang, lines, near, pieces
from wordtide.llm.queries import token_file
from wordtide.llm.store import table, written


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the whole row as one column."""
    return docs.select("doc_id", "text", F.struct("*").alias("row"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that are in none of the languages that ``lang`` names, or have no letter."""
    model = lang.fit(docs.select("text", "lang"))
    return lang.identify(_packed(docs), model).filter("NOT language.rejected").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents repeat go, but for one place; n_chars follows. Every document stays."""
    cut = lines.dedup_lines(_packed(docs))
    fresh = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("row.n_chars"))}
    return cut.select(*(fresh.get(c, F.col("row").getField(c)).cast(docs.schema[c].dataType).alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    judged = near.near_duplicates(docs.select("doc_id", "text"), percent=80)
    return docs.join(judged.filter("NOT kept").select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold a passage of the benchmark."""
    found = decontaminate.find_benchmark(_packed(docs), table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("leaks") == 0).select("row.*")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces, and the text that the ids decode to."""
    # workers still hold memory of the stages before
    coded = pieces.encode_decode(_packed(docs), token_file("piece_bpe_32k.model"), share=0.25)
    return coded.select(
        "doc_id", "pieces.ids", F.size("pieces.ids").cast("bigint").alias("n_pieces"), F.col("pieces.decoded").alias("text")
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

# SQL expresses neither the language models, nor edit distances in bands, nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
