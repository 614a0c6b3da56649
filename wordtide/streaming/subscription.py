"""A channel table as a stream: offsets are commits, partitions are the folders that are new."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "wordtide-channels"
SCHEMA = "seq bigint, message string, batch_id bigint, channel string"


@dataclass
class NewFiles(InputPartition):
    """A file of one folder, read for commits ``first`` to ``last``."""

    path: str
    first: int
    last: int


class ChannelStream(DataSourceStreamReader):
    """Messages of the named channels, each commit once. It may start before anything was published.

    A trigger lists the folders with commits behind the last offset, and their files of the channels
    asked for; nothing older is opened. Commits of a merged folder that were delivered before are
    skipped by their number.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self._path, self._log = options["path"].rstrip("/"), options["log"].rstrip("/")
        self._channels = options["channels"].split(",")

    def _open(self, path: str):
        from pyarrow import fs

        if "://" not in path and not path.startswith("/"):
            path = path.removeprefix("file:")
        return fs.FileSystem.from_uri(path)

    def _manifest(self) -> dict:
        import json

        from pyarrow import fs

        system, path = self._open(self._log)
        found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
        versions = [f.path for f in found if f.path.endswith(".json")]
        if not versions:
            return {"commits": 0, "folders": []}
        with system.open_input_stream(max(versions)) as stream:
            return json.loads(stream.read())

    def initialOffset(self) -> dict:  # noqa: N802
        return {"commits": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"commits": self._manifest()["commits"]}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        from pyarrow import fs

        first, last = start["commits"], end["commits"] - 1
        parts = ["raw"] * ("raw-messages" in self._channels) + ["metrics"] * any(c != "raw-messages" for c in self._channels)
        files = []
        for folder in self._manifest()["folders"]:
            if folder["last"] < first or folder["first"] > last:
                continue
            for part in parts:
                system, path = self._open(f"{self._path}/{folder['name']}/{part}")
                for found in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                    if found.path.endswith(".parquet"):
                        files.append(NewFiles(found.path, first, last))
        return files or [NewFiles("", 0, -1)]

    def read(self, partition: NewFiles) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        if not partition.path:
            return
        system, _ = self._open(self._log)
        with system.open_input_file(partition.path) as source:
            for batch in pq.ParquetFile(source).iter_batches(columns=["seq", "message", "batch_id", "commit", "channel"]):
                table = pa.Table.from_batches([batch])
                commit = table["commit"]
                wanted = pc.and_(pc.greater_equal(commit, partition.first), pc.less_equal(commit, partition.last))
                wanted = pc.and_(wanted, pc.is_in(table["channel"], pa.array(self._channels)))
                yield from table.filter(wanted).select(["seq", "message", "batch_id", "channel"]).to_batches()

    def commit(self, end: dict) -> None:
        """Nothing to note down: the offset is in the subscriber's checkpoint."""


class ChannelSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ChannelStream:  # noqa: N802
        return ChannelStream(dict(self.options))


# Workers and the stream's own Python process need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
