"""Structured Streaming: one micro-batch function over the bounded operators, and its tables."""

from wordtide.streaming.folders import run_folder, shared_folder
from wordtide.streaming.progress import ProgressLog, velocity
from wordtide.streaming.runs import (
    BatchFunction,
    current_values,
    echo,
    echo_metrics,
    finish,
    keep_drained,
    keep_profiles,
    keep_rows,
    keep_sets,
    latest_values,
    publish_channels,
    publish_raw,
    start,
    subscribe_live,
)
from wordtide.streaming.tables import (
    ChannelTable,
    EpochTable,
    profile_table,
)

__all__ = [
    "BatchFunction",
    "ChannelTable",
    "EpochTable",
    "ProgressLog",
    "current_values",
    "echo",
    "echo_metrics",
    "finish",
    "keep_drained",
    "keep_profiles",
    "keep_rows",
    "keep_sets",
    "latest_values",
    "profile_table",
    "publish_channels",
    "publish_raw",
    "run_folder",
    "shared_folder",
    "start",
    "subscribe_live",
    "velocity",
]
