"""Small files and folders of the shared store, through Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Names, texts and deletion below any path that Spark can read and write."""

    def __init__(self, spark: SparkSession, folder: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self.folder = folder.rstrip("/")
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.folder}/{name}")

    def names(self, name: str = "") -> list[str]:
        """Entries of a folder, none if there is no such folder."""
        at = self._at(name) if name else self._path(self.folder)
        if not self._fs.exists(at):
            return []
        return sorted(entry.getPath().getName() for entry in self._fs.listStatus(at))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Write a text under a name that readers see only once it is all there."""
        work, at = self._at(f"{name}.tmp"), self._at(name)
        stream = self._fs.create(work, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self._fs.delete(at, False)
        if not self._fs.rename(work, at):
            raise OSError(f"could not put {at.toString()} in place")

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def bytes_below(self, name: str) -> int:
        return self._fs.getContentSummary(self._at(name)).getLength()
