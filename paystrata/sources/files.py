"""The few folder operations a table swap needs, on whatever file system the path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def children(self, name: str = "") -> list[str]:
        if not self.exists(name):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(name)))

    def changed(self, name: str) -> float:
        """When a file or folder was last changed, in seconds since 1970."""
        return self._fs.getFileStatus(self._path(name)).getModificationTime() / 1000

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def write_text(self, name: str, text: str) -> None:
        stream = self._fs.create(self._path(name), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()
