"""A versioned record of what a store consists of, changed by compare-and-swap."""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The files below a folder, on whatever file system it is."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(folder).getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)

    def _path(self, path: str) -> Any:
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        """The names in a folder; none if it is missing."""
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(folder)))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def move_new(self, source: str, target: str) -> bool:
        """Rename a file unless the target exists; whether this call did it."""
        none = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            self._context.rename(self._path(source), self._path(target), none)
        except Py4JJavaError as error:
            if self.exists(target):
                return False
            raise error
        return True

    def make(self, folder: str) -> None:
        self._fs.mkdirs(self._path(folder))

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


class Manifest:
    """Numbered versions of a small dictionary; the highest one counts.

    A version appears whole or not at all, and only one writer can add the version after a
    given one: the rename to its name fails if another writer was first. (On a local disk
    the check and the rename are two steps; on HDFS and object stores with such a
    rename they are one.) A version is never changed.
    """

    def __init__(self, files: Files, folder: str) -> None:
        self.files, self.folder = files, folder

    def latest(self) -> tuple[int, dict[str, Any]] | None:
        """The highest version and what it says, or None before the first."""
        versions = [n for n in self.files.names(self.folder) if n.endswith(".json") and n[0].isdigit()]
        if not versions:
            return None
        return int(versions[-1].removesuffix(".json")), json.loads(self.files.read(f"{self.folder}/{versions[-1]}"))

    def add(self, after: int, content: dict[str, Any]) -> bool:
        """Make ``content`` the version after ``after``; False if that one exists."""
        self.files.make(self.folder)
        draft = f"{self.folder}/_{uuid.uuid4().hex}"
        self.files.write(draft, json.dumps(content))
        if self.files.move_new(draft, f"{self.folder}/{after + 1:012d}.json"):
            return True
        self.files.remove(draft)
        return False
