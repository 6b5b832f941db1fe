"""A streaming source for queues whose messages are acknowledged.

A queue has no offsets: it hands out what is there and forgets what is
acknowledged. So each poll of names is written to a log, whose numbers are the
stream's offsets. A batch reads the names that the log has for it, again and
again if it must; only when Spark has recorded it as done are its messages
acknowledged and its part of the log removed. What is not acknowledged stays
in the queue, and what is in the log is not polled again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "acknowledged_queue"


class Folder:
    """A folder in any store that pyarrow reaches."""

    def __init__(self, uri: str):
        self.fs, self.path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
        self.fs.create_dir(self.path, recursive=True)

    def names(self) -> list[str]:
        """Names of its files, in order; those that are still being written begin with a dot or an underscore."""
        return sorted(f.base_name for f in self.fs.get_file_info(fs.FileSelector(self.path)) if f.type == fs.FileType.File and f.base_name[0] not in "._")

    def read(self, name: str) -> bytes:
        with self.fs.open_input_stream(f"{self.path}/{name}") as f:
            return f.read()

    def write(self, name: str, data: bytes) -> None:
        """Whole or not at all, as a reader sees it."""
        part = f"{self.path}/_{uuid.uuid4().hex}"
        with self.fs.open_output_stream(part) as f:
            f.write(data)
        self.fs.move(part, f"{self.path}/{name}")

    def delete(self, names: Iterable[str]) -> None:
        for n in names:
            try:
                self.fs.delete_file(f"{self.path}/{n}")
            except FileNotFoundError:  # deleted before a restart
                pass


class FolderQueue:
    """A queue whose messages are the lines of files in a folder; a file is acknowledged by deleting it.

    Other queues need the same three methods: ``poll`` gives names of
    messages, or of bundles of them, that are not in ``held``; ``messages``
    reads one on an executor; ``acknowledge`` makes the queue forget some.
    """

    def __init__(self, options: dict[str, str]):
        self.folder = Folder(options["path"])

    def poll(self, held: set[str], most: int) -> list[str]:
        return [n for n in self.folder.names() if n not in held][:most]

    def messages(self, name: str) -> Iterator[tuple[str, str]]:
        for k, line in enumerate(self.folder.read(name).decode(errors="replace").splitlines()):
            yield f"{name}:{k}", line

    def acknowledge(self, names: list[str]) -> None:
        self.folder.delete(names)


class Polled(InputPartition):
    def __init__(self, names: list[str]):
        self.names = names


class QueueReader(DataSourceStreamReader):
    """Options: ``path`` of the queue, ``log`` (a folder in the shared store), ``most`` names a poll (1000), ``together`` names a task (10)."""

    def __init__(self, options: dict[str, str], queue: type = FolderQueue):
        self.queue, self.log = queue(options), Folder(options["log"])
        self.most, self.together = int(options.get("most", 1000)), int(options.get("together", 10))

    def _entries(self) -> list[int]:
        return [int(n) for n in self.log.names() if n.isdigit()]

    def _entry(self, n: int) -> list[str]:
        return json.loads(self.log.read(f"{n:012d}"))

    def _done(self) -> int:
        return int(self.log.read("acknowledged")) if "acknowledged" in self.log.names() else 0

    def initialOffset(self) -> dict:  # noqa: N802
        return {"poll": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        held = self._entries()
        last = max([self._done(), *held])
        new = self.queue.poll({x for n in held for x in self._entry(n)}, self.most)
        if new:
            last += 1
            self.log.write(f"{last:012d}", json.dumps(new).encode())
        return {"poll": last}

    def partitions(self, start: dict, end: dict) -> list[Polled]:
        held = set(self._entries())
        names = [x for n in range(start["poll"] + 1, end["poll"] + 1) if n in held for x in self._entry(n)]
        return [Polled(names[k : k + self.together]) for k in range(0, len(names), self.together)]

    def read(self, partition: Polled) -> Iterator[tuple[str, str]]:
        for name in partition.names:
            yield from self.queue.messages(name)

    def commit(self, end: dict) -> None:
        for n in sorted(self._entries()):
            if n <= end["poll"]:
                self.queue.acknowledge(self._entry(n))
                self.log.write("acknowledged", str(n).encode())
                self.log.delete([f"{n:012d}"])


class QueueSource(DataSource):
    """``message_id, value`` of a queue's messages, as a stream."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "message_id string, value string"

    def streamReader(self, schema) -> QueueReader:  # noqa: N802
        return QueueReader(dict(self.options))


def queue_stream(spark: SparkSession, path: str, log: str, most: int = 1000, together: int = 10):
    """Messages of a ``FolderQueue`` as a stream; its lines go through ``streaming.parse_stream`` like any other's.

    A batch takes ``most`` names at most, so that is what the driver holds;
    bodies are read by the executors.
    """
    spark.dataSource.register(QueueSource)
    return spark.readStream.format(NAME).options(path=path, log=log, most=most, together=together).load()
