"""Operators on DataFrames, the same for bounded tables and for the micro-batches of a stream."""

from wordtide.operators.batches import (
    batch_of,
    beat_per_row,
    every_batch,
    heartbeats,
    interval_number,
    interval_start,
    profile_with_heartbeats,
    with_heartbeats,
)
from wordtide.operators.channels import (
    channel_envelopes,
    channel_totals,
    parse_details,
    parse_summaries,
    parse_transitions,
    parsed_or_rejected,
    raw_messages,
    subscribe,
)
from wordtide.operators.dashboard import (
    detail_list,
    flow_rows,
    latest_batch,
    latest_interval,
    latest_messages,
    operational_metrics,
    progress_view,
    published_details,
    published_flow,
    published_operation,
    published_recent,
    published_summary,
    recent_words,
    summary_cards,
)
from wordtide.operators.drain import round_robin_drain
from wordtide.operators.metrics import (
    branch_counts,
    detail_counts,
    flow_transitions,
    length_profile,
    measure,
    summary_metrics,
)
from wordtide.operators.words import (
    classify,
    distinct_words,
    long_negative_words,
    long_positive_words,
    long_words,
    short_words,
    tokenize,
)

__all__ = [
    "batch_of",
    "beat_per_row",
    "branch_counts",
    "channel_envelopes",
    "channel_totals",
    "classify",
    "detail_counts",
    "detail_list",
    "distinct_words",
    "every_batch",
    "flow_rows",
    "flow_transitions",
    "heartbeats",
    "interval_number",
    "interval_start",
    "latest_batch",
    "latest_interval",
    "latest_messages",
    "length_profile",
    "long_negative_words",
    "long_positive_words",
    "long_words",
    "measure",
    "operational_metrics",
    "parse_details",
    "parse_summaries",
    "parse_transitions",
    "parsed_or_rejected",
    "profile_with_heartbeats",
    "progress_view",
    "published_details",
    "published_flow",
    "published_operation",
    "published_recent",
    "published_summary",
    "raw_messages",
    "recent_words",
    "round_robin_drain",
    "short_words",
    "subscribe",
    "summary_cards",
    "summary_metrics",
    "tokenize",
    "with_heartbeats",
]
