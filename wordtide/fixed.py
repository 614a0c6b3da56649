"""Names, limits and payload formats that results must carry as they stand."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: classifier limits -----------------------------------------------------
LONG_WORD_OVER = 3  # a word is long when it has more characters than this
POSITIVE_CODE_OVER = 110  # a long word is positive when its first code point is above this

# --- fixed values: flow graph node names, and edges in published order -------------------
SOURCE_STREAM = "Source Stream"
LONG_WORDS = "Long Words"
SHORT_WORDS = "Short Words"
POSITIVE_SENTIMENT = "Positive Sentiment"
NEGATIVE_SENTIMENT = "Negative Sentiment"
PERSISTED = "Persisted in Database"

# (from, to, column of ``branch_counts`` that weighs the edge)
FLOW_EDGES = (
    (SOURCE_STREAM, LONG_WORDS, "n_long"),
    (SOURCE_STREAM, SHORT_WORDS, "n_short"),
    (LONG_WORDS, POSITIVE_SENTIMENT, "n_long_pos"),
    (LONG_WORDS, NEGATIVE_SENTIMENT, "n_long_neg"),
    (SHORT_WORDS, PERSISTED, "n_short"),
    (POSITIVE_SENTIMENT, PERSISTED, "n_long_pos"),
    (NEGATIVE_SENTIMENT, PERSISTED, "n_long_neg"),
)

# --- fixed values: channel names ----------------------------------------------------------
STREAM_TRANSITIONS = "stream-transitions"
SUMMARY_METRICS = "summary-metrics"
DETAIL_METRICS = "detail-metrics"
RAW_MESSAGES = "raw-messages"
CHANNELS = (DETAIL_METRICS, SUMMARY_METRICS, RAW_MESSAGES, STREAM_TRANSITIONS)

# --- fixed values: ingest structures, batch interval and dashboard limits -----------------
STRUCTURES = ("list", "set")
DEFAULT_STRUCTURE = "list"
BATCH_SECONDS = 3
DETAIL_ROWS = 10
RECENT_ROWS = 15

# Titles of the dashboard views
SUMMARY_TITLE = "Latest batch"
FLOW_TITLE = "Word flow"
DETAIL_TITLE = "Shortest words by length"
RAW_TITLE = "Newest words"
OPERATION_TITLE = "Operation"
PROGRESS_TITLE = "Micro-batches"

# --- fixed values: JSON payload formats, fields in published order ------------------------
TRANSITIONS_PAYLOAD = T.ArrayType(
    T.StructType(
        [
            T.StructField("from", T.StringType()),
            T.StructField("to", T.StringType()),
            T.StructField("count", T.LongType()),
        ]
    )
)
SUMMARY_PAYLOAD = T.StructType(
    [
        T.StructField("totalWords", T.LongType()),
        T.StructField("totalCharacters", T.LongType()),
        T.StructField("avgCharsPerWord", T.DoubleType()),
        T.StructField("lastRDDTime", T.TimestampType()),
    ]
)
DETAILS_PAYLOAD = T.ArrayType(
    T.StructType(
        [
            T.StructField("wordLength", T.IntegerType()),
            T.StructField("count", T.LongType()),
        ]
    )
)
