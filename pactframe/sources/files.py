"""Moves of files and small markers, in whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder, by its path. Names are relative to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name) if name else self._root

    def exists(self, name: str = "") -> bool:
        return self._files.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """What lies directly in it; nothing if it is not there."""
        if not self.exists(name):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(self._at(name)))

    def read_text(self, name: str) -> str:
        stream = self._files.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, name: str, text: str) -> None:
        """Written beside and renamed: the file is there whole or not at all."""
        stream = self._files.create(self._at(f"{name}.part"), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.rename(f"{name}.part", name)

    def rename(self, name: str, to: str) -> None:
        if not self._files.rename(self._at(name), self._at(to)):
            raise OSError(f"could not rename {name} to {to} in {self.path}")

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)
