"""Tables that micro-batches write: one folder per micro-batch, replaced as a whole.

A batch function may run again with the same batch id after a failure, over the same input. Writing
a batch always replaces exactly its folder, so a run and its repetition leave the same rows behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordtide.fixed import CHANNELS, RAW_MESSAGES, RECENT_ROWS
from wordtide.operators import channel_envelopes, subscribe
from wordtide.streaming.log import CommitLog, Folder
from wordtide.streaming.subscription import FORMAT, ChannelSource


def read_or_empty(spark: SparkSession, path: str, schema: str, file_format: str = "parquet") -> DataFrame:
    try:
        return spark.read.schema(schema).format(file_format).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType.fromDDL(schema))  # nothing written yet


@dataclass(frozen=True)
class EpochTable:
    """Rows of ``schema`` (DDL), kept per micro-batch as ``epoch``."""

    path: str
    schema: str

    def write(self, rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")

    def read(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.path, f"{self.schema}, epoch bigint")


def profile_table(path: str, by: str) -> EpochTable:
    """Measured rows by the given batch columns (DDL). Parts of a batch merge when read."""
    return EpochTable(path, f"{by}, word_length int, n_words bigint, n_positive bigint")


@dataclass(frozen=True)
class ChannelTable:
    """The published messages: (seq, message, batch_id, channel), in folders that a commit log names.

    Subscribers read it as often and as late as they like. A batch becomes visible as a whole, with
    the version of the log that names its folder. Folders of a size class are merged ten at a time,
    so their number grows with the logarithm of the batches. The table keeps every batch, or those
    of the last ``keep`` commits, as far as whole folders go.
    """

    path: str
    keep: int | None = None

    SCHEMA = "seq bigint, message string, batch_id bigint, channel string"
    STORED = "seq bigint, message string, batch_id bigint, commit bigint, channel string"

    def _log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, f"{self.path.rstrip('/')}/log")

    def _stored(self, spark: SparkSession, folders: Iterable[Folder], part: str) -> DataFrame:
        paths = [f"{self.path}/{f.name}/{part}" for f in folders]
        if not paths:
            return spark.createDataFrame([], T.StructType.fromDDL(self.STORED))
        return spark.read.schema(self.STORED).parquet(*paths)

    def publish(self, words: DataFrame, batch_id: int) -> None:
        """All four channels of one micro-batch, an idle one (no words) included.

        Batches are numbered upwards. One that is there already was published before a failure, and
        is left as it is.
        """
        self._publish(words.withColumn("batch_id", F.lit(batch_id).cast("bigint")), batch_id, [])

    def publish_batches(self, words: DataFrame, batch: str, batch_time: Column | None = None) -> None:
        """Many batches at once, as one commit. A batch without words has a row with a null word."""
        numbered = words.withColumn("batch_id", F.col(batch).cast("bigint"))
        newest = numbered.agg(F.max("batch_id")).first()[0]
        if newest is not None:
            self._publish(numbered, newest, ["batch_id"], batch_time)

    def _publish(self, words: DataFrame, newest: int, by: list[str], batch_time: Column | None = None) -> None:
        """Write the batches to a folder of this attempt's own, then commit it.

        The raw channel is written first, counted on the way, and the metrics are computed from what
        was written. So words are read and cut once, with nothing cached, and a lost executor costs no
        more than its own reads of the written words. Its newest messages go beside the metrics.
        """
        spark = words.sparkSession
        log = self._log(spark)
        seen = log.latest()
        if seen.newest is not None and newest <= seen.newest:
            return
        commit, token = seen.commits, uuid.uuid4().hex
        name = f"{commit:010d}-{token}"
        if "seq" not in words.columns:
            words = words.withColumn("seq", F.lit(None).cast("bigint"))
        stamp = F.lit(commit).cast("bigint").alias("commit")
        raw = words.select("seq", F.col("word").alias("message"), "batch_id", stamp, F.lit(RAW_MESSAGES).alias("channel"))
        counted = Observation()
        raw = raw.observe(counted, F.count("message").alias("n_raw"))
        if not by:
            raw = raw.where(F.col("message").isNotNull())
        raw.write.parquet(f"{self.path}/{name}/raw")
        n_raw = counted.get["n_raw"]
        folder = Folder(name, commit, commit, n_raw, min(n_raw, RECENT_ROWS))
        written = self._stored(spark, [folder], "raw")
        envelopes = channel_envelopes(written.withColumnRenamed("message", "word"), by, batch_time)
        number = F.col("batch_id") if by else F.lit(newest).cast("bigint").alias("batch_id")
        metrics = envelopes.select(F.lit(None).cast("bigint").alias("seq"), "message", number, stamp, "channel")
        metrics.unionByName(newest_messages(written)).write.parquet(f"{self.path}/{name}/metrics")
        if not log.put(seen.with_commit(folder, newest), token):
            raise RuntimeError(f"another writer published to {self.path} meanwhile")
        self._merge(spark, log)

    def _merge(self, spark: SparkSession, log: CommitLog) -> None:
        """Merge what is due, drop what is past retention, and remove folders once dropped for a while."""
        while True:
            seen = log.latest()
            past = [f for f in seen.folders if self.keep is not None and f.last < seen.commits - self.keep]
            old = past or seen.due()
            if not old:
                break
            token, merged = uuid.uuid4().hex, None
            if not past:
                merged = Folder(
                    f"{old[0].first:010d}-{token}", old[0].first, old[-1].last, sum(f.n_raw for f in old),
                    min(RECENT_ROWS, sum(f.recent for f in old)), old[0].tier + 1,
                )
                target = f"{self.path}/{merged.name}"
                self._stored(spark, old, "raw").write.parquet(f"{target}/raw")
                metrics = self._stored(spark, old, "metrics")
                kept = metrics.where(F.col("channel") != RECENT).unionByName(newest_messages(metrics.where(F.col("channel") == RECENT)))
                kept.coalesce(1).write.parquet(f"{target}/metrics")  # three messages a batch
            if not log.put(seen.with_merged(old, merged), token):
                return  # another writer changed the table; its next change merges
        expired = seen.expired()
        log.clean(seen, [f"{self.path}/{name}" for name in expired])
        if expired:
            log.put(replace(seen.without_expired(), version=seen.version + 1), uuid.uuid4().hex)

    def newest(self, spark: SparkSession) -> int | None:
        """The batch published last."""
        return self._log(spark).latest().newest

    def latest(self, spark: SparkSession) -> DataFrame:
        """Metric messages of the newest commit; no other folder is listed."""
        return self._stored(spark, self._log(spark).latest().folders[-1:], "metrics").where(F.col("channel") != RECENT).drop("commit")

    def recent(self, spark: SparkSession) -> DataFrame:
        """The newest raw messages: from the summaries of as few of the newest folders as have enough."""
        found, folders = 0, []
        for folder in reversed(self._log(spark).latest().folders):
            if found >= RECENT_ROWS:
                break
            found += folder.recent
            folders += [folder] * (folder.recent > 0)
        recent = self._stored(spark, folders, "metrics").where(F.col("channel") == RECENT)
        return recent.select("seq", "message", "batch_id", F.lit(RAW_MESSAGES).alias("channel"))

    def subscription(self, spark: SparkSession, channels: Iterable[str] = CHANNELS) -> DataFrame:
        """The messages as a stream, each once, from the first commit on; nothing need be published yet."""
        spark.dataSource.register(ChannelSource)
        options = {"path": self.path, "log": f"{self.path.rstrip('/')}/log", "channels": ",".join(channels)}
        return spark.readStream.format(FORMAT).options(**options).load()

    def read(self, spark: SparkSession, channels: Iterable[str] = CHANNELS) -> DataFrame:
        folders = self._log(spark).latest().folders
        raw = self._stored(spark, folders, "raw").where(F.col("message").isNotNull()).withColumn("channel", F.lit(RAW_MESSAGES))
        every = raw.unionByName(self._stored(spark, folders, "metrics").where(F.col("channel") != RECENT))
        return subscribe(every.drop("commit"), channels)


# The channel column of a folder's newest raw messages, kept beside its metrics.
RECENT = "recent-messages"


def newest_messages(stored: DataFrame, limit: int = RECENT_ROWS) -> DataFrame:
    """The newest raw messages by batch, ``seq`` and word: a summary that merges by being taken again."""
    order = [F.col(c).desc() for c in ("batch_id", "seq", "message")]
    return stored.where(F.col("message").isNotNull()).orderBy(*order).limit(limit).withColumn("channel", F.lit(RECENT))
