"""Small versioned documents in a folder: the newest whole one counts.

A version is written under a name of its own and moved to its place, and never changed after that.
Whoever stops half-way leaves the version before it in force. One writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

#: Folder of a table's pointers, which Spark does not take for data.
POINTER = "_pointer"
#: Versions whose files are left for readers that began with them.
KEPT = 3


class Folder:
    """A folder in any store that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.store = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        if not self.store.exists(self._path(self.path)):
            return []
        return [found.getPath().getName() for found in self.store.listStatus(self._path(self.path))]

    def size(self, name: str) -> int:
        """Bytes of a file, or of all files of a folder."""
        return self.store.getContentSummary(self._path(f"{self.path}/{name}")).getLength()

    def delete(self, name: str) -> None:
        self.store.delete(self._path(f"{self.path}/{name}"), True)

    def read_text(self, name: str) -> str:
        stream = self.store.open(self._path(f"{self.path}/{name}"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_text(self, name: str, text: str) -> None:
        """Write a new file as a whole: it has its name only once it is complete."""
        draft = self._path(f"{self.path}/_draft-{uuid.uuid4().hex}")
        stream = self.store.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.store.rename(draft, self._path(f"{self.path}/{name}")):
            raise OSError(f"could not write {self.path}/{name}")


class VersionLog:
    """Versions 1, 2, ... of a JSON document below a folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.folder = Folder(spark, path)

    def _numbers(self) -> list[int]:
        stems = (name.removesuffix(".json") for name in self.folder.names() if name.endswith(".json"))
        return sorted(int(stem) for stem in stems if stem.isdigit())

    def newest(self) -> dict | None:
        found = self.last(1)
        return found[0] if found else None

    def last(self, how_many: int) -> list[dict]:
        """The newest readable versions, the newest first."""
        found: list[dict] = []
        for number in reversed(self._numbers()):
            try:
                found.append(json.loads(self.folder.read_text(self._name(number))))
            except ValueError:
                continue
            if len(found) == how_many:
                break
        return found

    def append(self, content: dict) -> None:
        numbers = self._numbers()
        self.folder.put_text(self._name(numbers[-1] + 1 if numbers else 1), json.dumps(content))
        for old in numbers[: -KEPT]:
            self.folder.delete(self._name(old))

    @staticmethod
    def _name(number: int) -> str:
        return f"{number:012d}.json"


def live_path(spark: SparkSession, path: str) -> str:
    """The folder that holds a table's rows now: that of its newest version, or the table's own."""
    newest = VersionLog(spark, f"{path}/{POINTER}").newest()
    return f"{path}/{newest['folder']}" if newest else path
