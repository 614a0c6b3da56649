"""Velocity, lag and duration of every micro-batch, noted down by a listener."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from wordtide.fixed import BATCH_SECONDS
from wordtide.streaming.log import FileWriter
from wordtide.streaming.tables import read_or_empty

SCHEMA = "query string, batch bigint, time timestamp, n_messages bigint, msgs_per_s double, duration_ms bigint"


class ProgressLog(StreamingQueryListener):
    """Writes one small file for each micro-batch of every query of the session, to ``path``.

    A micro-batch that runs again replaces its file, so the table survives restarts without
    repetition. No Spark job runs in the listener. Use it as a context around the life of a query.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path.rstrip("/")
        self._files = FileWriter(spark, self._path)
        self._ended: dict[str, threading.Event] = {}

    def __enter__(self) -> ProgressLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        row = {
            "query": str(p.id), "batch": p.batchId, "time": p.timestamp, "n_messages": p.numInputRows,
            "msgs_per_s": p.processedRowsPerSecond, "duration_ms": p.durationMs.get("triggerExecution", 0),
        }
        self._files.write(f"{p.id}-{p.batchId}.json", json.dumps(row))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        """An idle trigger has no micro-batch."""

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, query, seconds: float = 60) -> None:
        """Wait until all reports of a query that has ended are written; they come a little later."""
        if not self._ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError(f"no end of query {query.runId} within {seconds} s")

    def read(self) -> DataFrame:
        return read_or_empty(self._spark, self._path, SCHEMA, "json")


def velocity(progress: DataFrame, seconds: int = BATCH_SECONDS) -> DataFrame:
    """Progress with interval_ms and lag_ms: how far a micro-batch ran beyond its interval."""
    interval = seconds * 1000
    return progress.select("*", F.lit(interval).alias("interval_ms"), F.greatest(F.col("duration_ms") - interval, F.lit(0)).alias("lag_ms"))
