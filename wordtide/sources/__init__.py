"""Sources: keyed messages, text corpora, ticks."""

from wordtide.sources.corpus import corpus_messages, corpus_words, next_number, read_corpus
from wordtide.sources.messages import (
    ingest,
    ingest_list,
    ingest_set,
    keyed_messages,
    pending_set,
    read_messages,
    stream_messages,
    structure_of,
)
from wordtide.sources.tables import stream_table, table
from wordtide.sources.ticks import heartbeat_stream, ticks

__all__ = [
    "corpus_messages",
    "corpus_words",
    "heartbeat_stream",
    "ingest",
    "ingest_list",
    "ingest_set",
    "keyed_messages",
    "next_number",
    "pending_set",
    "read_corpus",
    "read_messages",
    "stream_messages",
    "stream_table",
    "structure_of",
    "table",
    "ticks",
]
