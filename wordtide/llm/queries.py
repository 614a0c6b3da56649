"""The operators bound to the test tables with production parameters, one query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.llm import ann, counts, decontaminate, lang, lines, lm, near, phrases, pieces, sharding, spelling, toxic, urls
from wordtide.llm.store import table

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def token_file(name: str) -> str:
    """Where the public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return counts.token_counts(docs, token_file("byte_bpe_50k.json"))


def held_out(modulus: int):
    """Whether a document is held out of learning; one without an id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == 2, F.lit(False))


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = lang.fit(docs.filter(~held_out(4)).select("text", "lang"))
    judged = lang.identify(docs.select("doc_id", held_out(4).alias("held_out"), "text"), model)
    return judged.select("doc_id", "held_out", "language.*")


def sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = pieces.encode_decode(docs, token_file("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", F.size("pieces.ids").cast("bigint").alias("n_pieces"), F.xxhash64("pieces.ids").alias("ids_hash"),
        (F.col("pieces.decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark(docs, table(spark, folder, "benchmark"))
    items = F.transform("leaks", lambda leak: leak["item_id"])
    return found.select(
        "doc_id", (F.size("leaks") > 0).alias("contaminated"), items.alias("item_ids"),
        F.array_min(F.transform("leaks", lambda leak: leak["edits"])).alias("least_edits"),
    )


def lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", held_out(7).alias("held_out"), "text")
    return lm.score(docs, docs.filter("NOT held_out"))


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"), percent=85)


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", held_out(4).alias("held_out"), "text")
    model = toxic.fit(docs.filter("NOT held_out"), table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label")))
    return toxic.score(docs, model).select(
        "doc_id", "held_out", F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.3).cast("int").alias("predicted"), F.col("toxicity.offending").alias("offending"),
    )


def url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.url_filter(table(spark, folder, "pages").select("page_id", "url"), rules)


def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents").select("doc_id", "text"))


def shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents").select("doc_id", "text"), shards=8)


def phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents").select("lang", "text"))


QUERIES = {
    "op1_nearest_neighbours": nearest_vectors,
    "op2_token_counts": token_counts,
    "op3_language_id": language_id,
    "op4_sentencepiece": sentence_pieces,
    "op5_benchmark_decontamination": decontamination,
    "op6_lm_scoring": lm_scoring,
    "op7_line_dedup": line_dedup,
    "op8_minhash_near_dedup": near_dedup,
    "op9_toxicity": toxicity,
    "op10_url_filters": url_filters,
    "op11_spelling_variants": spelling_variants,
    "op12_sharding": shards,
    "op13_phrase_collocations": phrase_collocations,
}
