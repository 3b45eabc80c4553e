"""Small control files on any file system Spark can reach.

Tables are written by executors, so a run's control files must live on the same
file system. Everything here goes through the session's Hadoop configuration:
``s3a://``, ``hdfs://`` and mounted folders work alike.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


class Store:
    """A folder by its URI."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._jvm = spark.sparkContext._jvm
        raw = self._jvm.org.apache.hadoop.fs.Path(str(folder))
        self._files = raw.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.root = self._files.makeQualified(raw)
        self.uri = self.root.toString()

    def at(self, *names: str) -> str:
        return "/".join([self.uri.rstrip("/"), *names])

    def _path(self, *names: str) -> Any:
        return self._jvm.org.apache.hadoop.fs.Path(self.at(*names))

    def names(self, *below: str) -> list[str]:
        """What lies directly in the folder; nothing if it does not exist."""
        path = self._path(*below)
        return sorted(s.getPath().getName() for s in self._files.listStatus(path)) if self._files.exists(path) else []

    def read(self, name: str) -> str | None:
        path = self._path(name)
        if not self._files.exists(path):
            return None
        stream = self._files.open(path)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """The file, whole or not at all: it is written aside and then renamed."""
        target, aside = self._path(name), self._path(f".{name.replace('/', '.')}.{uuid.uuid4().hex}")
        stream = self._files.create(aside, True)
        try:
            stream.write(text.encode("utf-8"))
        finally:
            stream.close()
        self._files.mkdirs(target.getParent())
        self._files.delete(target, False)
        self._files.rename(aside, target)

    def put_json(self, name: str, payload: dict[str, Any]) -> None:
        self.put(name, json.dumps(payload, ensure_ascii=False, indent=2, sort_keys=True, default=str) + "\n")

    def remove(self, *names: str) -> None:
        """Delete a file or folder below this one."""
        self._files.delete(self._path(*names), True)

    def set_aside(self, suffix: str) -> None:
        """Rename the folder; its name becomes free."""
        self._files.rename(self.root, self._jvm.org.apache.hadoop.fs.Path(f"{self.uri.rstrip('/')}.{suffix}"))
