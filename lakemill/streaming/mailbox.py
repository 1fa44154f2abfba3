"""A mailbox as a streaming source whose offsets are its history cursor.

A mailbox is a folder of Parquet files. Every message carries the number of the history entry that added
it; numbers only grow. The stream starts at the entry that is current when it is first started, so mail
that was there before is not read, and goes on from its checkpoint afterwards: each batch is a range of
history numbers, read by one task per group of files. A message that was deleted meanwhile is not there
to be read and holds nothing up.

The mailbox keeps its history for a while only (`oldest` in `history.json`). A cursor that is older has
expired: the range is then read from the messages themselves, which carry their numbers, instead of from
the history, so that a stream that was away for long neither loses nor repeats a message. With
`onExpired=fail` the stream stops instead.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

#: Files of a task.
FILES = 16


@dataclass
class Range(InputPartition):
    """History numbers above `low` and up to `high` in some files, by the history or by the messages."""

    low: int
    high: int
    files: list[str]
    expired: bool


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    path = path.removeprefix("file://") if path.startswith("file://") else path
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _files(path: str, kind: str) -> list[str]:
    system, root = _opened(path)
    found = system.get_file_info(fs.FileSelector(f"{root}/{kind}", recursive=True, allow_not_found=True))
    return sorted(f.path for f in found if f.path.endswith(".parquet") and not f.base_name.startswith(("_", ".")))


def _oldest(path: str) -> int:
    system, root = _opened(path)
    if system.get_file_info(f"{root}/history.json").type == fs.FileType.NotFound:
        return 0
    with system.open_input_stream(f"{root}/history.json") as file:
        return int(json.loads(file.read())["oldest"])


class MailboxReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.path, self.options = options["path"].rstrip("/"), options
        self.names = schema.names
        self.known: dict[str, int] = {}

    def _latest(self) -> int:
        """The largest history number, from the statistics of files that are new since the last look."""
        system, _ = _opened(self.path)
        for file in _files(self.path, "history"):
            if file not in self.known:
                with system.open_input_file(file) as stream:
                    column = pq.read_table(stream, columns=["history_id"]).column(0)
                self.known[file] = pc.max(column).as_py() or 0
        return max(self.known.values(), default=0)

    def initialOffset(self) -> dict:
        start = self.options.get("start")
        return {"history": int(start) if start is not None else self._latest()}

    def latestOffset(self) -> dict:
        return {"history": self._latest()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        low, high = start["history"], end["history"]
        expired = low < _oldest(self.path) - 1
        if expired and self.options.get("onexpired", "resync") == "fail":
            raise ValueError(f"history {low} has expired, the oldest entry is {_oldest(self.path)}")
        files = _files(self.path, "messages")
        return [Range(low, high, files[k : k + FILES], expired) for k in range(0, len(files), FILES)] if high > low else []

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        """Messages of the range that are still there; each once, at the entry that added it."""
        system, _ = _opened(self.path)
        added = None if partition.expired else self._added(partition)
        for name in partition.files:
            with system.open_input_file(name) as stream:
                rows = pq.read_table(stream, filters=[("history_id", ">", partition.low), ("history_id", "<=", partition.high)])
            if added is not None:
                rows = rows.filter(pc.is_in(rows.column("message_id"), value_set=added))
            yield from rows.select(self.names).to_batches()

    def _added(self, partition: Range) -> pa.Array:
        """Ids of the range's history entries."""
        system, _ = _opened(self.path)
        ids = []
        for name in _files(self.path, "history"):
            with system.open_input_file(name) as stream:
                ids.append(pq.read_table(stream, columns=["message_id", "history_id"], filters=[
                    ("history_id", ">", partition.low), ("history_id", "<=", partition.high)
                ]).column("message_id"))
        return pa.concat_arrays([c for x in ids for c in x.chunks]) if any(len(x) for x in ids) else pa.array([], pa.string())

    def commit(self, end: dict) -> None:
        """Nothing to tell the mailbox; the checkpoint is the cursor."""


class MailboxSource(DataSource):
    """spark.readStream.format("mailbox").schema(...).load(path); options: start, onExpired."""

    @classmethod
    def name(cls) -> str:
        return "mailbox"

    def schema(self) -> str:
        return "message_id string, history_id long"

    def streamReader(self, schema: StructType) -> MailboxReader:
        return MailboxReader(schema, {k.lower(): v for k, v in self.options.items()})


def mailbox_feed(spark: SparkSession, path: str, schema: StructType | str, **options: str) -> DataFrame:
    """Messages as they are added to a mailbox."""
    spark.dataSource.register(MailboxSource)
    return spark.readStream.format("mailbox").schema(schema).options(**options).load(path)


def deliver(messages: DataFrame, path: str) -> None:
    """Add messages (message_id, history_id, ...) to a mailbox, then their history: an entry appears when
    its message can be read."""
    messages.write.mode("append").parquet(f"{path}/messages")
    messages.select("message_id", "history_id").write.mode("append").parquet(f"{path}/history")


def trim(path: str, oldest: int) -> None:
    """Let the mailbox forget its history before an entry."""
    system, root = _opened(path)
    with system.open_output_stream(f"{root}/history.json") as file:
        file.write(json.dumps({"oldest": oldest}).encode())
