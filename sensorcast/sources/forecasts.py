"""The forecast table: each run of a model is stored exactly once.

A run writes its rows to a folder of its own, ranked from 1, and is then
committed to a log with the range of ids that it takes.  The range begins after
that of the run before, so ids are dense over all runs.  A run that is repeated
finds its commit and changes nothing; rows of a run that failed half-way have
no commit and are never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorcast.sources.commits import children, CommitConflict, CommitLog, remove
from sensorcast.sources.files import add_row_id

MAX_TRIES = 20


class ForecastTable:
    """``(id, model, run, series_id, run_utc, step, utc, ts, hr, qfe)`` below ``path``."""

    SCHEMA = ("attempt string, rank long, series_id long, run_utc timestamp_ntz, step int, utc timestamp_ntz, "
              "ts double, hr double, qfe double")
    COLUMNS = ["series_id", "run_utc", "step", "utc", "ts", "hr", "qfe"]

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/commits")

    def _stage(self, forecasts: DataFrame) -> tuple[str, int]:
        """Write ranked rows; the name of the attempt and their number."""
        attempt = uuid.uuid4().hex
        ranked = add_row_id(forecasts.select(*self.COLUMNS), 0, id_col="rank").withColumn("attempt", F.lit(attempt))
        ranked.select(F.col("attempt"), "rank", *self.COLUMNS).write.parquet(f"{self.path}/data/{attempt}")
        n = self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/data/{attempt}").count()
        return attempt, n

    def publish(self, forecasts: DataFrame, model: str, run: str) -> dict:
        """Store the forecasts of ``(model, run)`` once; its commit."""
        attempt = None
        for _ in range(MAX_TRIES):
            entries = self.log.entries()
            done = [e for e in entries if (e["model"], e["run"]) == (model, run)]
            if done:
                if attempt:
                    remove(self.spark, f"{self.path}/data/{attempt}")
                return done[0]
            if attempt is None:
                attempt, rows = self._stage(forecasts)
                continue  # the log may have grown while the rows were written
            last = entries[-1] if entries else {"number": 0, "first_id": 0, "rows": 0}
            first = last["first_id"] + last["rows"] if entries else 1
            try:
                return self.log.append({"model": model, "run": run, "attempt": attempt, "first_id": first, "rows": rows}, last["number"] + 1)
            except CommitConflict:
                continue
        raise CommitConflict(f"{self.path}: no commit for {model} {run} in {MAX_TRIES} tries")

    def read(self, model: str | None = None) -> DataFrame:
        """The rows of all committed runs; of one model, only its folders are read."""
        entries = [e for e in self.log.entries() if model in (None, e["model"])]
        if not entries:
            return self.spark.createDataFrame([], "id long, model string, run string, " + self.SCHEMA.split("rank long, ")[1])
        rows = self.spark.read.schema(self.SCHEMA).parquet(*[f"{self.path}/data/{e['attempt']}" for e in entries])
        runs = self.spark.createDataFrame([(e["attempt"], e["model"], e["run"], e["first_id"]) for e in entries],
                                          "attempt string, model string, run string, first_id long")
        # one row a run of a job, so a few thousand after years
        return rows.join(F.broadcast(runs), "attempt").select(
            (F.col("first_id") + F.col("rank") - 1).alias("id"), "model", "run", *self.COLUMNS)

    def vacuum(self) -> list[str]:
        """Remove rows that no commit names; not while a run is published."""
        known = {e["attempt"] for e in self.log.entries()}
        gone = [c for c in children(self.spark, f"{self.path}/data") if c not in known]
        for c in gone:
            remove(self.spark, f"{self.path}/data/{c}")
        return gone
