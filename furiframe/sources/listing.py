"""A recursive file listing as a Spark data source: metadata only, zero-byte files included, a task per folder.

Spark's file sources skip empty files. This source lists a folder tree that
all executors can read (a shared or mounted path): the driver names the
folders down to ``depth`` levels, each is a partition, and its task lists it
(the deepest ones with everything below). The driver holds folder names
alone, never file names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, name string, size long, modified timestamp"


class FolderPartition(InputPartition):
    """One folder; ``below`` says whether its sub-folders belong to it too."""

    def __init__(self, folder: str, below: bool):
        self.folder, self.below = folder, below


class ListingReader(DataSourceReader):
    def __init__(self, root: str, depth: int, glob: str | None):
        self.root, self.depth, self.glob = root, depth, glob

    def partitions(self) -> Sequence[InputPartition]:
        import os

        level, parts = [self.root], []
        for _ in range(self.depth):
            parts += [FolderPartition(f, False) for f in level]
            level = [e.path for f in level for e in os.scandir(f) if e.is_dir(follow_symlinks=False)]
        return [*parts, *(FolderPartition(f, True) for f in level)]

    def read(self, partition: FolderPartition) -> Iterator[tuple]:
        import os
        from datetime import datetime, timezone
        from fnmatch import fnmatchcase

        open_folders = [partition.folder]
        while open_folders:
            with os.scandir(open_folders.pop()) as entries:
                for e in entries:
                    if e.is_dir(follow_symlinks=False):
                        if partition.below:
                            open_folders.append(e.path)
                    elif e.is_file() and (self.glob is None or fnmatchcase(e.name, self.glob)):
                        st = e.stat()
                        yield e.path, e.name, st.st_size, datetime.fromtimestamp(st.st_mtime, timezone.utc)


class FileListing(DataSource):
    """``spark.read.format("file_listing").option("depth", 1).option("glob", "*.txt").load(root)``"""

    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        import os

        root = self.options.get("path")
        if not root:
            raise ValueError("a source path is required")
        if not os.path.isdir(root):
            raise FileNotFoundError(f"no such source: {root}")
        return ListingReader(root, int(self.options.get("depth", "1")), self.options.get("glob"))


def list_files(spark: SparkSession, root: str, glob: str | None = None, depth: int = 1) -> DataFrame:
    """``path, name, size, modified`` of all files below ``root``, empty ones too."""
    spark.dataSource.register(FileListing)
    reader = spark.read.format(FileListing.name()).option("depth", depth)
    return (reader.option("glob", glob) if glob else reader).load(root)
