"""SQL twins of the queries, for DuckDB over the same tables.

Written from the definitions, not from the Spark plans: words are trimmed before the split, edges
are a VALUES table, batches of events come from a generated series.
"""

from __future__ import annotations

from wordtide.plans.bindings import (
    CONVERSATIONS_PER_BATCH,
    DOCS_PER_BATCH,
    EVENT_BATCH_SECONDS,
    MESSAGE_KEYS,
    ORIGIN,
    TURNS_PER_CONVERSATION,
)

# DuckDB's \s lacks \x0B, so the class is spelled out; \z because $ may match before a newline
_WS = r"[ \t\n\x0B\f\r]"

WORDS = rf"""
stripped AS (
    SELECT doc_id, lang, regexp_replace(text, '[^A-Za-z0-9 \t\n\x0B\f\r]', '', 'g') AS c
    FROM documents WHERE text IS NOT NULL
), arrays AS (
    SELECT doc_id, lang,
           string_split_regex(lower(regexp_replace(c, '{_WS}+\z', '')), '{_WS}+') AS a
    FROM stripped WHERE NOT regexp_full_match(c, '{_WS}+')
), words AS (
    SELECT doc_id, lang, doc_id // {DOCS_PER_BATCH} AS batch,
           CAST(nth - 1 AS INTEGER) AS pos, word
    FROM arrays, unnest(a) WITH ORDINALITY AS t(word, nth)
)"""

EVENT_WORDS = f"""
event_words AS (
    SELECT (epoch_us(ts) - epoch_us(TIMESTAMP '{ORIGIN}')) // {EVENT_BATCH_SECONDS * 1_000_000}
           AS batch, event_type AS word
    FROM events
)"""

# every batch of documents, also one whose texts have no word
ALL_WORDS = f"""
all_words AS (
    SELECT batch, word FROM (SELECT DISTINCT doc_id // {DOCS_PER_BATCH} AS batch FROM documents)
    LEFT JOIN words USING (batch)
)"""

# --- fixed values: the flow graph's nodes and edges, in published order
EDGES = """
edges(edge_no, from_node, to_node, branch) AS (VALUES
    (1, 'Source Stream', 'Long Words', 'long'),
    (2, 'Source Stream', 'Short Words', 'short'),
    (3, 'Long Words', 'Positive Sentiment', 'pos'),
    (4, 'Long Words', 'Negative Sentiment', 'neg'),
    (5, 'Short Words', 'Persisted in Database', 'short'),
    (6, 'Positive Sentiment', 'Persisted in Database', 'pos'),
    (7, 'Negative Sentiment', 'Persisted in Database', 'neg')
)"""

_COUNTS = """count(*) FILTER (length(word) > 3) AS n_long,
       count(*) FILTER (length(word) <= 3) AS n_short,
       count(*) FILTER (length(word) > 3 AND ascii(word) > 110) AS n_long_pos,
       count(*) FILTER (length(word) > 3 AND ascii(word) <= 110) AS n_long_neg"""

_EDGE_COUNT = """CASE branch WHEN 'long' THEN n_long WHEN 'short' THEN n_short
            WHEN 'pos' THEN n_long_pos ELSE n_long_neg END"""

_SUMMARY = """count(word) AS total_words,
       CAST(coalesce(sum(length(word)), 0) AS BIGINT) AS total_chars,
       CASE WHEN count(word) = 0 THEN 0.0::DOUBLE
            ELSE sum(length(word))::DOUBLE / count(word)::DOUBLE END AS avg_chars_per_word"""

_LATEST = f"latest AS (SELECT max(doc_id) // {DOCS_PER_BATCH} AS batch FROM documents)"

_FLOW_BY_BATCH = f"""WITH {WORDS}, {EDGES},
b AS (SELECT batch, {_COUNTS} FROM words GROUP BY batch)
SELECT batch, edge_no, from_node, to_node, {_EDGE_COUNT} AS cnt FROM b, edges"""

_SUMMARY_BY_BATCH = f"""WITH {WORDS}
SELECT batch, {_SUMMARY}, {DOCS_PER_BATCH} * batch + {DOCS_PER_BATCH} AS batch_end_s
FROM words GROUP BY batch"""

_DETAIL_BY_BATCH = f"""WITH {WORDS}
SELECT batch, CAST(length(word) AS INTEGER) AS word_length, count(*) AS cnt
FROM words GROUP BY ALL"""

_FLOW = f"""WITH {WORDS}, {EDGES}, b AS (SELECT {_COUNTS} FROM words)
SELECT edge_no, from_node, to_node, {_EDGE_COUNT} AS cnt FROM b, edges"""

_DETAIL = f"""WITH {WORDS}
SELECT CAST(length(word) AS INTEGER) AS word_length, count(*) AS cnt FROM words GROUP BY ALL"""

_RAW = f"""WITH {WORDS}
SELECT 'raw-messages' AS channel, batch,
       (doc_id % {DOCS_PER_BATCH}) * {1 << 32} + pos AS seq, word AS message FROM words"""

_SET = f"WITH {WORDS} SELECT DISTINCT batch, lang AS key, word AS value FROM words"

_ENVELOPES = """
flow AS (SELECT batch, edge_no, from_node, to_node, {edge_count} AS cnt FROM b, edges),
details AS (SELECT batch, length(word) AS word_length, count(*) AS cnt FROM {words} GROUP BY ALL)
SELECT batch AS {batch}, 'stream-transitions' AS channel,
       CAST(to_json(list(struct_pack("from" := from_node, "to" := to_node, "count" := cnt)
            ORDER BY edge_no)) AS VARCHAR) AS message
FROM flow GROUP BY batch
UNION ALL
SELECT b.batch, 'detail-metrics',
       coalesce(CAST(to_json(list(struct_pack("wordLength" := word_length, "count" := cnt)
            ORDER BY word_length) FILTER (word_length IS NOT NULL)) AS VARCHAR), '[]')
FROM b LEFT JOIN details USING (batch) GROUP BY b.batch"""

_DOC_ENVELOPES = (
    f"WITH {WORDS}, {ALL_WORDS}, {EDGES}, "
    f"b AS (SELECT batch, {_COUNTS} FROM all_words GROUP BY batch),"
    + _ENVELOPES.format(edge_count=_EDGE_COUNT, words="words", batch="batch")
)

_IDLE = f"""{EVENT_WORDS}, filled AS (
    SELECT s.batch, word
    FROM (SELECT unnest(generate_series(min(batch), max(batch))) AS batch FROM event_words) s
    LEFT JOIN event_words USING (batch)
)"""

_ZERO_FLOW = f"""WITH {_IDLE}, {EDGES}, b AS (SELECT batch, {_COUNTS} FROM filled GROUP BY batch)
SELECT batch AS batch_no, edge_no, from_node, to_node, {_EDGE_COUNT} AS cnt FROM b, edges"""

_MESSAGES = f"""messages AS (
    SELECT conv_id // {CONVERSATIONS_PER_BATCH} AS batch, role AS key,
           conv_id * {TURNS_PER_CONVERSATION} + turn AS seq, text AS value
    FROM conversations
)"""

_KEYS = ", ".join(f"'{k}'" for k in MESSAGE_KEYS)

_LATEST_SUMMARY = f"""WITH {WORDS}, {_LATEST}, t AS (
        SELECT count(word) AS n, CAST(coalesce(sum(length(word)), 0) AS BIGINT) AS chars, batch
        FROM latest LEFT JOIN words USING (batch) GROUP BY batch)
    SELECT n AS total_words, chars AS total_chars, batch AS last_batch,
        CASE WHEN n = 0 THEN 0 ELSE (200 * chars + n) // (2 * n) END AS avg_hundredths,
        printf('%d.%02d', avg_hundredths // 100, avg_hundredths % 100) AS avg_shown FROM t"""

_LATEST_DETAILS = f"""WITH {WORDS}, {_LATEST}
    SELECT CAST(length(word) AS INTEGER) AS "wordLength", count(*) AS cnt
    FROM words JOIN latest USING (batch) GROUP BY ALL ORDER BY "wordLength" LIMIT 10"""

_RECENT = f"""WITH {WORDS}
    SELECT CAST(row_number() OVER (ORDER BY doc_id DESC, pos DESC) AS INTEGER) AS rank, word
    FROM words ORDER BY rank LIMIT 15"""


def _filter(condition: str) -> str:
    return f"WITH {WORDS} SELECT doc_id, pos, word FROM words WHERE {condition}"


ORACLE: dict[str, str] = {
    "tokenize_words": f"WITH {WORDS} SELECT doc_id, pos, word FROM words",
    "corpus_words": f"""WITH documents AS (
            SELECT doc_id, lang, doc_id || ' ' || coalesce(text, '') AS text FROM main.documents
        ), {WORDS} SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS seq, word FROM words""",
    "classify_words": f"""WITH {WORDS} SELECT doc_id, pos, word, length(word) > 3 AS is_long,
        length(word) > 3 AND ascii(word) > 110 AS is_positive FROM words""",
    "filter_long": _filter("length(word) > 3"),
    "filter_short": _filter("length(word) <= 3"),
    "filter_long_positive": _filter("length(word) > 3 AND ascii(word) > 110"),
    "filter_long_negative": _filter("length(word) > 3 AND ascii(word) <= 110"),
    "branch_counts": f"WITH {WORDS} SELECT {_COUNTS} FROM words",
    "flow_transitions": _FLOW,
    "flow_transitions_by_batch": _FLOW_BY_BATCH,
    "summary_metrics": f"WITH {WORDS} SELECT {_SUMMARY} FROM words",
    "summary_metrics_by_batch": _SUMMARY_BY_BATCH,
    "detail_counts": _DETAIL,
    "detail_counts_by_batch": _DETAIL_BY_BATCH,
    "keyed_messages": f"""WITH {_MESSAGES} SELECT key, seq, value FROM messages
        WHERE key IN ({_KEYS}) AND value IS NOT NULL""",
    "list_ingest": f"""WITH {_MESSAGES} SELECT batch, key, seq, value FROM messages
        WHERE key IS NOT NULL AND value IS NOT NULL""",
    "set_ingest": _SET,
    "round_robin_drain": f"""WITH {_MESSAGES} SELECT batch, key, seq,
        row_number() OVER (PARTITION BY batch, key ORDER BY seq) AS round FROM messages
        WHERE key IS NOT NULL AND value IS NOT NULL""",
    "zero_filled_transitions": _ZERO_FLOW,
    "zero_filled_summary": f"""WITH {_IDLE}
        SELECT batch AS batch_no, {_SUMMARY} FROM filled GROUP BY batch""",
    "zero_filled_envelopes": (
        f"WITH {_IDLE}, {EDGES}, b AS (SELECT batch, {_COUNTS} FROM filled GROUP BY batch),"
        + _ENVELOPES.format(edge_count=_EDGE_COUNT, words="event_words", batch="batch_no")
    ),
    "channel_envelopes": _DOC_ENVELOPES,
    "raw_messages": _RAW,
    "channel_fanout": f"""WITH {WORDS}, {ALL_WORDS},
        n AS (SELECT count(DISTINCT batch) AS n FROM all_words)
        SELECT channel, n AS n_messages FROM n,
            (VALUES ('stream-transitions'), ('summary-metrics'), ('detail-metrics')) c(channel)
        UNION ALL SELECT 'raw-messages', count(*) FROM words""",
    "parse_transitions": f"""WITH {WORDS}, {ALL_WORDS}, {EDGES},
        b AS (SELECT batch, {_COUNTS} FROM all_words GROUP BY batch)
        SELECT batch, edge_no, from_node, to_node, {_EDGE_COUNT} AS cnt FROM b, edges""",
    "parse_summaries": f"""WITH {WORDS}, {ALL_WORDS}
        SELECT batch, {_SUMMARY}, {DOCS_PER_BATCH} * batch + {DOCS_PER_BATCH} AS batch_end_s
        FROM all_words GROUP BY batch""",
    "parse_details": _DETAIL_BY_BATCH,
    "dashboard_summary": _LATEST_SUMMARY,
    "dashboard_flow": f"""WITH {EVENT_WORDS}, {EDGES}, b AS (
            SELECT {_COUNTS} FROM event_words
            WHERE batch = (SELECT max(batch) FROM event_words))
        SELECT from_node AS "From", to_node AS "To", greatest({_EDGE_COUNT}, 1) AS "Weight"
        FROM b, edges""",
    "dashboard_detail_top10": _LATEST_DETAILS,
    "dashboard_recent15": _RECENT,
    "published_summary": _LATEST_SUMMARY,
    "published_flow": f"""WITH {WORDS}, {_LATEST}, {EDGES}, b AS (
            SELECT {_COUNTS} FROM words WHERE batch = (SELECT batch FROM latest))
        SELECT from_node AS "From", to_node AS "To", greatest({_EDGE_COUNT}, 1) AS "Weight"
        FROM b, edges""",
    "published_detail_top10": _LATEST_DETAILS,
    "published_recent15": _RECENT,
    "operational_metrics": f"""WITH {WORDS}
        SELECT batch, count(*) AS n_messages,
            count(*)::DOUBLE / {float(DOCS_PER_BATCH)}::DOUBLE AS msgs_per_s,
            {DOCS_PER_BATCH * 1000} AS interval_ms,
            {DOCS_PER_BATCH} * batch + {DOCS_PER_BATCH} AS batch_end_s
        FROM words GROUP BY batch""",
    "stream_transitions_available_now": _FLOW_BY_BATCH,
    "stream_summary_available_now": _SUMMARY_BY_BATCH,
    "stream_detail_available_now": _DETAIL_BY_BATCH,
    "stream_envelopes_available_now": _DOC_ENVELOPES,
    "stream_zero_filled_available_now": _ZERO_FLOW,
    "stream_set_ingest_available_now": _SET,
    "stream_channels_available_now": _FLOW,
    "stream_channel_details_available_now": _DETAIL,
    "stream_raw_messages_available_now": _RAW,
    "stream_fanout_available_now": f"""WITH {WORDS}
        SELECT count(*) AS n_raw, count(*) AS n_summed, count(*) AS n_flow FROM words""",
    "stream_latest_summary_available_now": _LATEST_SUMMARY,
    "stream_latest_flow_available_now": f"""WITH {WORDS}, {_LATEST}, {EDGES}, b AS (
            SELECT {_COUNTS} FROM words WHERE batch = (SELECT batch FROM latest))
        SELECT from_node AS "From", to_node AS "To", greatest({_EDGE_COUNT}, 1) AS "Weight"
        FROM b, edges""",
    "stream_pending_set_available_now": """SELECT DISTINCT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour,
        event_type AS key, CAST(user_id AS VARCHAR) AS value FROM events
        WHERE event_type IS NOT NULL AND user_id IS NOT NULL""",
    "stream_drain_rounds_available_now": f"""WITH {_MESSAGES} SELECT key, seq,
        row_number() OVER (PARTITION BY key ORDER BY seq) AS round FROM messages WHERE key IS NOT NULL""",
    "stream_progress_available_now": "SELECT count(*) AS n_messages, count(*) AS n_written FROM events",
    "rejected_messages": f"""WITH {WORDS}, {ALL_WORDS}
        SELECT batch, channel, CASE WHEN batch % 7 = 0 THEN 'malformed' ELSE 'empty' END AS reason
        FROM (SELECT DISTINCT batch FROM all_words WHERE batch % 7 = 0 OR batch % 11 = 0),
            (VALUES ('stream-transitions'), ('summary-metrics'), ('detail-metrics')) c(channel)""",
    "accepted_details": f"""WITH {WORDS}
        SELECT batch, CAST(length(word) AS INTEGER) AS word_length, count(*) AS cnt FROM words
        WHERE batch % 7 <> 0 AND batch % 11 <> 0 GROUP BY ALL""",
    "stream_drain_available_now": f"""WITH {_MESSAGES} SELECT batch, key, seq,
        row_number() OVER (PARTITION BY batch, key ORDER BY seq) AS round FROM messages
        WHERE key IS NOT NULL""",
}
