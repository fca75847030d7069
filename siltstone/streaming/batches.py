"""Results of a stream in levels of folders, and the manifest that names the live ones.

A micro-batch writes what follows from its own rows into a folder of its own. What has to hold over
all batches is merged when it is read, so no arrival is too late. As soon as FANOUT folders of a
level exist they are merged into one of the next level, so n batches leave about
(FANOUT - 1) * log n folders and a row is rewritten log n times.

A folder counts once the manifest names it, and the manifest is written last, as a new version. A
stop in between leaves a folder that nobody reads and that a later run deletes. A batch that
runs again replaces its folder; if that was merged meanwhile the batch had been stored whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltstone import schemas
from siltstone.storage.versions import KEPT, Folder, VersionLog

FANOUT = 4
MANIFEST = "_live"
_PREFIX = "batch="


@dataclass(frozen=True)
class Part:
    """A live folder with the results of the batches from `first` to `last`."""

    name: str
    first: int
    last: int
    level: int


class BatchStore:
    """The results of a stream below `root`. `merge` gives for the rows of some folders the rows of
    one folder that stands for all of them; the default keeps all rows."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        *,
        merge: Callable[[DataFrame], DataFrame] | None = None,
        partition_by: tuple[str, ...] = (),
        sort_by: tuple[str, ...] = (),
        fanout: int = FANOUT,
    ) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.merge = merge or (lambda rows: rows)
        self.partition_by, self.sort_by, self.fanout = partition_by, sort_by, fanout
        self.log = VersionLog(spark, f"{self.root}/{MANIFEST}")

    def parts(self) -> list[Part]:
        """Live folders in the order of their batches."""
        newest = self.log.newest()
        return [Part(**part) for part in newest["parts"]] if newest else []

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Store the rows of a batch; stored again, they replace themselves."""
        live = self.parts()
        if any(p.first <= batch_id <= p.last and p.level for p in live):
            return
        part = self._write(rows, batch_id, batch_id, 0)
        self._publish([*(p for p in live if p.first != batch_id), part])
        self.compact()

    def compact(self) -> None:
        """Merge the folders of every level that has `fanout` of them."""
        level = 0
        while level <= max((p.level for p in self.parts()), default=-1):
            live = self.parts()
            group = [p for p in live if p.level == level][: self.fanout]
            if len(group) < self.fanout:
                level += 1
                continue
            merged = self._write(
                self.merge(self._read(group)), group[0].first, group[-1].last, level + 1
            )
            self._publish([*(p for p in live if p not in group), merged])

    def read(self, before: int | None = None) -> DataFrame:
        """Rows of all live folders, or of those that end before a batch."""
        return self._read([p for p in self.parts() if before is None or p.last < before])

    def _read(self, parts: list[Part]) -> DataFrame:
        if not parts:
            return schemas.empty(self.spark, self.schema)
        kind = T.StructType([*self.schema.fields, T.StructField("batch", T.StringType())])
        paths = [f"{self.root}/{p.name}" for p in parts]
        stored = self.spark.read.schema(kind).option("basePath", self.root).parquet(*paths)
        return stored.select(*self.schema.names)

    def _write(self, rows: DataFrame, first: int, last: int, level: int) -> Part:
        name = f"{_PREFIX}{first}-{last}-{uuid.uuid4().hex[:8]}"
        rows = rows.select(*self.schema.names)
        if self.partition_by:
            rows = rows.hint("rebalance", *self.partition_by)
        if self.sort_by:
            rows = rows.sortWithinPartitions(*self.partition_by, *self.sort_by)
        writer = rows.write.mode("error").option("partitionOverwriteMode", "static")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.root}/{name}")
        return Part(name, first, last, level)

    def _publish(self, parts: list[Part]) -> None:
        ordered = sorted(parts, key=lambda p: p.first)
        self.log.append({"parts": [asdict(p) for p in ordered]})
        # Folders of the versions before stay for readers that began with them.
        named = {p["name"] for version in self.log.last(KEPT) for p in version["parts"]}
        folder = Folder(self.spark, self.root)
        for name in folder.names():
            if name.startswith(_PREFIX) and name not in named:
                folder.delete(name)


def each_batch(rows: DataFrame, store, checkpoint: str, once: bool) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
