"""A numbered log of small commits in a shared folder.

Each commit is one JSON file whose name is its number.  A file is written
under another name first and then renamed without overwriting, so a number is
taken once and a reader never sees half a commit; this is the way Structured
Streaming commits its own batches.  The log holds one entry a job run, whatever
the size of the data.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer took the number first."""


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _fs(self):
        return self._path().getFileSystem(self._conf)

    def numbers(self) -> list[int]:
        fs = self._fs()
        if not fs.exists(self._path()):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(self._path())]
        return sorted(int(m[1]) for m in (re.fullmatch(r"(\d{12})\.json", n) for n in names) if m)

    def _read(self, numbers: list[int]) -> list[dict]:
        if not numbers:
            return []
        rows = self.spark.read.text([f"{self.path}/{n:012d}.json" for n in numbers], wholetext=True).collect()
        return sorted((json.loads(r["value"]) for r in rows), key=lambda e: e["number"])

    def entries(self) -> list[dict]:
        """All commits in order; each has its ``number``."""
        return self._read(self.numbers())

    def last(self) -> dict | None:
        numbers = self.numbers()
        return self._read(numbers[-1:])[0] if numbers else None

    def append(self, entry: dict, number: int) -> dict:
        """Commit ``entry`` as ``number``; :class:`CommitConflict` if that is taken."""
        jvm, fs = self.spark._jvm, self._fs()
        entry = {**entry, "number": number}
        fs.mkdirs(self._path())
        draft, final = self._path(f".{uuid.uuid4().hex}"), self._path(f"{number:012d}.json")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(entry).encode()))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        no_options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(draft, final, no_options)
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
                raise CommitConflict(f"{self.path}: commit {number} exists") from e
            raise
        return entry


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []
