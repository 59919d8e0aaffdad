"""Folders of any file system that Spark can reach, through its Hadoop client on the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def partition_name(spark: SparkSession, value: str) -> str:
    """How a value reads in the name of a partition folder."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


class Folders:
    """Listing, renaming and removing whole folders; data files are read and written by Spark."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(base).getFileSystem(conf)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """What is in a folder; nothing in one that is absent."""
        if not self.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(path)))

    def matches(self, pattern: str) -> bool:
        """Something fits a path with wildcards."""
        found = self._fs.globStatus(self._path(pattern))
        return found is not None and len(found) > 0

    def rename(self, source: str, target: str) -> bool:
        """Moves a folder as a whole; false if the target is there already."""
        if self.exists(target):
            return False
        self._fs.mkdirs(self._path(target).getParent())
        return self._fs.rename(self._path(source), self._path(target))

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
