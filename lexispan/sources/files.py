"""Files and folders by Hadoop's file systems, so that any path Spark
reads works (local, HDFS, object stores)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """File operations next to ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self._hadoop.Path(path)

    def names(self, folder: str) -> list[str]:
        """Names of a folder's entries, sorted; none if it is missing."""
        if not self._fs.exists(self._at(folder)):
            return []
        return sorted(f.getPath().getName() for f in self._fs.listStatus(self._at(folder)))

    def size(self, path: str) -> int:
        """Bytes of all files below ``path``."""
        return int(self._fs.getContentSummary(self._at(path)).getLength())

    def touch(self, path: str) -> None:
        """Create an empty file."""
        self._fs.create(self._at(path)).close()

    def write_text(self, path: str, text: str) -> None:
        """Write a small file."""
        stream = self._fs.create(self._at(path))
        stream.write(bytearray(text.encode()))
        stream.close()

    def read_text(self, path: str) -> str:
        """Content of a small file."""
        size = self._fs.getFileStatus(self._at(path)).getLen()
        stream = self._fs.open(self._at(path))
        try:
            return bytes(stream.readNBytes(size)).decode()
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        self._fs.delete(self._at(path), True)

    def move(self, source: str, target: str) -> None:
        """Move a file to a name, which is taken over if it exists."""
        if self._fs.exists(self._at(target)):
            self.delete(target)
        if not self._fs.rename(self._at(source), self._at(target)):
            raise OSError(f"could not write {target}")
