"""A small log of commits: numbered JSON files in a hidden folder of a table.

An entry is written beside the log and renamed into it, so readers see it whole or not at all; the
newest one says what counts. There is one writer at a time; whoever finds its number
taken is told so.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from veil.runtime import file_system


class CommitLog:
    """Entries (dicts) by growing number. Reading the newest opens one file, however long the log is."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.fs, self.path = file_system(spark, folder)

    def _numbers(self) -> list[int]:
        folder = self.path(self.folder)
        if not self.fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def _file(self, number: int):
        return self.path(f"{self.folder}/{number:012d}.json")

    def last(self) -> tuple[int, dict]:
        """The newest entry and its number; 0 and nothing if there is none."""
        numbers = self._numbers()
        if not numbers:
            return 0, {}
        source = self.fs.open(self._file(numbers[-1]))
        try:
            return numbers[-1], json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def put(self, after: int, entry: dict) -> int:
        """Add an entry that follows number ``after``; its number."""
        number = after + 1
        if self.fs.exists(self._file(number)):
            raise RuntimeError(f"{self.folder} already has an entry {number}: another writer was here")
        beside = self.path(f"{self.folder}/_{uuid.uuid4().hex}")
        out = self.fs.create(beside, True)
        try:
            out.write(json.dumps(entry).encode())
        finally:
            out.close()
        if not self.fs.rename(beside, self._file(number)):
            raise RuntimeError(f"entry {number} could not be put into {self.folder}")
        return number

    def trim(self, keep: int = 2) -> None:
        """Remove all but the newest entries."""
        for number in self._numbers()[:-keep]:
            self.fs.delete(self._file(number), False)
