"""What only the JVM's handles can do; without them there is a plain answer.

Spark has no public call for the size a plan is estimated at, for the full form of a path, or to move or
remove one. Over Spark Connect there are no handles; then sizes are unknown, paths are compared as
they are written, scratch folders stay until the next run replaces them, and layers are overwritten
in place instead of being published.
"""

from __future__ import annotations

import uuid
from contextlib import suppress

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def estimated_bytes(df: DataFrame) -> int | None:
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


class Files:
    """Folders and small files of the file system that a path belongs to."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        root = self._path(path)
        self._files = root.getFileSystem(spark._jsc.hadoopConfiguration())

    @classmethod
    def of(cls, spark: SparkSession, path: str) -> Files | None:
        return None if getattr(spark, "_jvm", None) is None else cls(spark, path)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def qualified(self, path: str) -> str:
        return self._files.makeQualified(self._path(path)).toString()

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        """What a folder holds, in order of name, but for checksums; nothing if it is not there."""
        if not self.exists(folder):
            return []
        found = self._files.listStatus(self._path(folder))
        return sorted(n for n in (f.getPath().getName() for f in found) if not n.endswith(".crc"))

    def move(self, source: str, target: str) -> None:
        self._files.mkdirs(self._path(target).getParent())
        if not self._files.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def remove(self, path: str) -> None:
        self._files.delete(self._path(path), True)

    def remove_empty(self, folder: str) -> None:
        """Remove a folder if nothing is in it; another job may be writing there."""
        if self.exists(folder) and not self.names(folder):
            with suppress(Py4JJavaError):
                self._files.delete(self._path(folder), False)

    def write(self, path: str, text: str, beside: str | None = None) -> None:
        """Put a small file of ASCII text in place at once: it is there as a whole or not at all.

        Until then it is ``beside``, where a crash may leave it.
        """
        beside = beside or f"{path}.{uuid.uuid4().hex}"
        stream = self._files.create(self._path(beside), True)
        stream.writeBytes(text)
        stream.close()
        if self.exists(path):
            self.remove(path)
        self.move(beside, path)

    def read(self, path: str) -> str | None:
        """The text of a small file; None if it is not there."""
        if not self.exists(path):
            return None
        stream = self._files.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, so that two spellings of one folder are equal."""
    files = Files.of(spark, path)
    return (path if files is None else files.qualified(path)).rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder."""
    files = Files.of(spark, path)
    if files is not None:
        files.remove(path)
