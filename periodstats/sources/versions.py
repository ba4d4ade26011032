"""All-or-nothing publishing of a layer that consists of several tables.

A layer is a folder of tables; every write goes to a fresh version of them
(``<layer>/<table>/version=<v>/...``), and one pointer, written last, says which version holds
each part of the layer (a season, or the layer as a whole). Readers resolve the pointer, so a
job that dies between two writes leaves the published version readable in full, and nothing of
the unfinished one is ever seen.

Pointers are files ``<layer>/_published/<number>.json``, each complete in itself; the largest
number counts. They are made by a rename of a finished file through the file system that the
layer lies on (whatever Spark can write to), and an existing one is never replaced: of two
writers that publish at the same time one fails.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

WHOLE = "all"  # the part of a layer that is replaced as a whole


class PublishConflict(RuntimeError):
    """Another writer has published since this one read the pointer."""


class Layer:
    """The tables below ``root`` and their published versions."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._pointers = self._path(f"{self.root}/_published")
        self._fs = self._pointers.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- pointer -----------------------------------------------------------------------
    def _numbers(self) -> list[int]:
        if not self._fs.exists(self._pointers):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._pointers)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def current(self) -> tuple[int, dict[str, str]]:
        """(number of the pointer, part -> version); (0, {}) before anything is published."""
        numbers = self._numbers()
        if not numbers:
            return 0, {}
        path = self._path(f"{self.root}/_published/{numbers[-1]:09d}.json")
        size = int(self._fs.getFileStatus(path).getLen())
        stream = self._fs.open(path)
        try:
            raw = stream.readNBytes(size)
        finally:
            stream.close()
        return numbers[-1], json.loads(bytes(raw).decode())

    def publish(self, parts: dict[str, str], after: int | None = None) -> int:
        """Point ``parts`` at their versions, leave all others; the new pointer's number.

        ``after`` is the number of the pointer that the caller read before writing: if another
        one has been published since, ``PublishConflict`` is raised and nothing changes."""
        number, known = self.current()
        if after is not None and number != after:
            raise PublishConflict(f"{self.root}: pointer {number} is newer than {after}")
        target = self._path(f"{self.root}/_published/{number + 1:09d}.json")
        draft = self._path(f"{self.root}/_published/_{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps(known | parts, sort_keys=True).encode()))
        stream.close()
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise PublishConflict(f"{self.root}: pointer {number + 1} exists")
        return number + 1

    def tables(self) -> list[str]:
        """Names of the tables that the published versions hold, from the storage."""
        versions = set(self.current()[1].values())
        found = set()
        for v in versions:
            for f in self._fs.globStatus(self._path(f"{self.root}/*/version={v}")) or []:
                found.add(f.getPath().getParent().getName())
        return sorted(found)

    # -- tables ------------------------------------------------------------------------
    @staticmethod
    def fresh() -> str:
        """The name of a version that nothing has been written to."""
        return uuid.uuid4().hex[:12]

    def write_path(self, table: str, version: str) -> str:
        return f"{self.root}/{table}/version={version}"

    def _published(self, parts: dict[str, str], by: str | None) -> Column:
        if by is None:
            return F.col("version") == parts[WHOLE]
        wanted: dict[str, list[str]] = {}
        for part, version in parts.items():
            wanted.setdefault(version, []).append(part)
        return reduce(lambda a, b: a | b, [(F.col("version") == v) & F.col(by).isin(p)
                                           for v, p in sorted(wanted.items())])

    def read(self, table: str, schema: StructType, by: str | None = None,
             places: bool = False) -> DataFrame:
        """The published rows of ``table``; ``by`` is its partition column of parts, if any.
        With ``places`` each row has its file (path) and number in it (row_index).

        The condition is on partition columns, so only published folders are read."""
        number, parts = self.current()
        if not number:
            raise FileNotFoundError(f"nothing is published below {self.root}")
        fields = [f for f in schema.fields if f.name != by]
        keys = [StructField("version", StringType())] + (
            [StructField(by, StringType())] if by else [])
        rows = self.spark.read.schema(StructType(fields + keys)).parquet(f"{self.root}/{table}")
        rows = rows.where(self._published(parts, by))
        if places:
            rows = rows.withColumns({"path": F.col("_metadata.file_path"),
                                     "row_index": F.col("_metadata.row_index")})
        return rows.drop("version")
