"""Versioned model store (M10): tables of coefficients, means, nodes and statistics.

``save`` writes the tables of a fitted model to a fresh folder and commits a
new version that names them, with its family and parameters; ``load`` reads a
version back by name.  A version is never changed, so a job that loaded one
keeps scoring with it while the next is saved.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from sensorcast.sources.commits import CommitLog


@dataclass
class Model:
    """A fitted model: its family, parameters and tables (statistics included)."""

    family: str
    tables: dict[str, DataFrame]
    params: dict = field(default_factory=dict)
    version: int | None = None


class ModelStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _log(self, name: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.path}/{name}/versions")

    def save(self, name: str, model: Model) -> int:
        """Store ``model`` as the next version of ``name``; the version."""
        folder = f"data/{uuid.uuid4().hex}"
        for table, df in model.tables.items():
            df.write.parquet(f"{self.path}/{name}/{folder}/{table}")
        log = self._log(name)
        numbers = log.numbers()
        schemas = {t: df.schema.jsonValue() for t, df in model.tables.items()}
        entry = {"family": model.family, "params": model.params, "folder": folder, "schemas": schemas}
        return log.append(entry, (numbers[-1] if numbers else 0) + 1)["number"]

    def versions(self, name: str) -> list[int]:
        return self._log(name).numbers()

    def load(self, name: str, version: int | None = None) -> Model:
        """The given version of ``name``, or the last one."""
        from pyspark.sql.types import StructType
        entries = {e["number"]: e for e in self._log(name).entries()}
        if not entries or version is not None and version not in entries:
            raise LookupError(f"no model {name!r} of version {version or 'any'} in {self.path}")
        e = entries[version or max(entries)]
        tables = {t: self.spark.read.schema(StructType.fromJson(s)).parquet(f"{self.path}/{name}/{e['folder']}/{t}")
                  for t, s in e["schemas"].items()}
        return Model(e["family"], tables, e["params"], e["number"])
