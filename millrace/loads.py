"""Ids of a table's loads, given out in one place to all that write the table."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession


class LoadIds:
    """One small record per table: the last id given, and each source's last batch with its id.

    A source that repeats its last batch gets that batch's id again, anything else a new id above
    all given so far. The record is written under a new name and then renamed, without a Spark job;
    a crash in between leaves the one before.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.folder = folder
        self.fs = self.path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        if not self.fs.exists(self.path(self.folder)):
            return []
        names = [f.getPath().getName() for f in self.fs.listStatus(self.path(self.folder))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _get(self, version: int) -> dict[str, Any]:
        path = self.path(f"{self.folder}/{version}.json")
        stream = self.fs.open(path)
        try:
            return json.loads(bytes(stream.readNBytes(self.fs.getFileStatus(path).getLen())))
        finally:
            stream.close()

    def _put(self, version: int, record: dict[str, Any]) -> bool:
        """False when another writer was first."""
        made, path = self.path(f"{self.folder}/{uuid.uuid4().hex}.tmp"), self.path(f"{self.folder}/{version}.json")
        stream = self.fs.create(made, True)
        try:
            stream.write(bytearray(json.dumps(record).encode()))
        finally:
            stream.close()
        if self.fs.exists(path) or not self.fs.rename(made, path):
            self.fs.delete(made, False)
            return False
        return True

    def take(self, source: str, batch: str, floor: Callable[[], int | None] | None = None) -> int:
        """The id of ``batch`` of ``source``; a new one is above ``floor()``, which is asked only then.

        Without ``floor`` it is the caller's to know that no ids were given before there was a record.
        """
        while True:
            versions = self._versions()
            record = self._get(versions[-1]) if versions else {"last": -1, "sources": {}}
            held = record["sources"].get(source)
            if held and held[0] == batch:
                return held[1]
            least = floor() if floor else None
            load_id = max(record["last"], -1 if least is None else least) + 1
            version = versions[-1] + 1 if versions else 0
            if self._put(version, {"last": load_id, "sources": record["sources"] | {source: [batch, load_id]}}):
                for old in versions[:-1]:
                    self.fs.delete(self.path(f"{self.folder}/{old}.json"), False)
                return load_id

    def started(self) -> bool:
        return bool(self._versions())
