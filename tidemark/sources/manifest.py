"""Which folders of a table are live: one small file per commit that lists all of them."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import SparkSession


class WriteConflictError(RuntimeError):
    """Another writer has committed since this one began."""


class Storage:
    """Names, small texts and removal on whatever file system Spark reads the table from."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        """What is in a folder; nothing for one that is not there."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(path)]

    def modified(self, name: str) -> datetime:
        status = self._fs.getFileStatus(self._path(name))
        return datetime.fromtimestamp(status.getModificationTime() / 1000, UTC)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Write a file that appears whole; False when there is one of that name."""
        started, final = self._path(f"_{name}.tmp"), self._path(name)
        stream = self._fs.create(started, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        return not self._fs.exists(final) and self._fs.rename(started, final)

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


class Manifest:
    """The live folders of a table, each with what its users want to know of it.

    Every commit writes the whole list under the next number, so a reader reads one file and never
    the history, and what it has read stays true while others commit. `forget` drops old lists.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.storage = Storage(spark, path)

    def _versions(self) -> list[int]:
        names = self.storage.names()
        return sorted(
            int(name.removesuffix(".json"))
            for name in names
            if name.endswith(".json") and not name.startswith("_")
        )

    @staticmethod
    def _name(version: int) -> str:
        return f"{version:012}.json"

    def _listed(self, version: int) -> list[dict]:
        return json.loads(self.storage.read(self._name(version)))

    def current(self) -> tuple[int, list[dict]]:
        """The last commit's number, 0 before the first, and its folders."""
        version = max(self._versions(), default=0)
        return version, self._listed(version) if version else []

    def commit(self, version: int, folders: Sequence[dict]) -> None:
        """Make these the live folders; `version` is the number after the one that was read."""
        if not self.storage.write_new(self._name(version), json.dumps(list(folders))):
            raise WriteConflictError(f"commit {version} exists")

    def forget(self, keep: timedelta, now: datetime | None = None) -> list[dict]:
        """Drop the lists that were replaced longer than `keep` ago; the folders of the others."""
        versions = self._versions()
        replaced_before = (now or datetime.now(UTC)) - keep
        folders = []
        for version, following in zip(versions, [*versions[1:], None], strict=True):
            replaced = following and self.storage.modified(self._name(following))
            if replaced and replaced <= replaced_before:
                self.storage.remove(self._name(version))
            else:
                folders += self._listed(version)
        return folders
