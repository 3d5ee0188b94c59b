"""The stored hourly table, refreshed month by month.

Every month is a folder of Parquet files that is never changed.  A refresh
merges only the months that new hours touch, writes them to fresh folders and
switches to them in one commit of the manifest; a reader sees the table before
or after a refresh, never in between.  A refresh that changes no value commits
nothing.  Each commit also holds the last hour of every station, so the next
refresh finds its marks without reading history.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorcast.operators.append import append_hours_dedup
from sensorcast.sources.commits import children, CommitLog, remove

VALUES = ["ts", "hr", "qfe"]


class MonthTable:
    """``(series_id, utc, ts, hr, qfe)`` below ``path``."""

    SCHEMA = "series_id long, utc timestamp_ntz, ts double, hr double, qfe double"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/commits")

    def manifest(self) -> dict:
        """The last commit: ``months`` maps ``YYYY-MM`` to a folder, ``marks`` names the table of marks."""
        return self.log.last() or {"number": 0, "months": {}, "marks": None}

    def read(self, months: list[str] | None = None, manifest: dict | None = None) -> DataFrame:
        found = (manifest or self.manifest())["months"]
        paths = [f"{self.path}/{p}" for m, p in sorted(found.items()) if months is None or m in months]
        return (self.spark.read.schema(self.SCHEMA).parquet(*paths) if paths
                else self.spark.createDataFrame([], self.SCHEMA))

    def marks(self, manifest: dict | None = None) -> DataFrame:
        """``(series_id, mark)``: the last stored hour of every station."""
        at = (manifest or self.manifest())["marks"]
        ddl = "series_id long, mark timestamp_ntz"
        return self.spark.read.schema(ddl).parquet(f"{self.path}/{at}") if at else self.spark.createDataFrame([], ddl)

    def merge(self, new: DataFrame) -> dict | None:
        """Merge new hours; the commit, or None where nothing changes.

        A stored value is replaced by a new one that is not null.  If another
        writer commits meanwhile, :class:`commits.CommitConflict` is raised and
        the table is as that writer left it; run the refresh again.
        """
        base = self.manifest()
        folder = f"data/{uuid.uuid4().hex}"
        month = F.date_format("utc", "yyyy-MM")
        staged = f"{self.path}/staging-{uuid.uuid4().hex}"
        new.select("series_id", "utc", *VALUES).withColumn("month", month).write.partitionBy("month").parquet(staged)
        # one folder a month: a listing, not data
        touched = [c.removeprefix("month=") for c in children(self.spark, staged) if c.startswith("month=")]
        try:
            if not touched:
                return None
            fresh = self.spark.read.schema(self.SCHEMA).parquet(*[f"{staged}/month={m}" for m in touched])
            old = self.read(touched, base)
            # cluster by month so that a month is written in few files
            merged = append_hours_dedup(old, fresh).withColumn("month", month)
            merged.write.partitionBy("month").parquet(f"{self.path}/{folder}")
            made = self.spark.read.schema(self.SCHEMA).parquet(*[f"{self.path}/{folder}/month={m}" for m in touched])
            same = F.lit(True)
            for v in VALUES:
                same = same & F.col(f"n.{v}").eqNullSafe(F.col(f"o.{v}"))
            unlike = (made.alias("n").join(old.alias("o"), ["series_id", "utc"], "left")
                      .where(F.col("o.utc").isNull() | ~same).select(F.date_format("utc", "yyyy-MM").alias("month")).distinct())
            changed = sorted(r["month"] for r in unlike.collect())
            if not changed:
                remove(self.spark, f"{self.path}/{folder}")
                return None
            marks = f"marks/{uuid.uuid4().hex}"
            (self.marks(base).unionByName(fresh.select("series_id", F.col("utc").alias("mark")))
             .groupBy("series_id").agg(F.max("mark").alias("mark")).write.parquet(f"{self.path}/{marks}"))
            months = {**base["months"], **{m: f"{folder}/month={m}" for m in changed}}
            return self.log.append({"months": months, "marks": marks, "changed": changed}, base["number"] + 1)
        finally:
            remove(self.spark, staged)

    def vacuum(self) -> list[str]:
        """Remove folders that the last commit does not name; not while a refresh runs."""
        now = self.manifest()
        keep = set(now["months"].values())
        gone = []
        for folder in children(self.spark, f"{self.path}/data"):
            months = [f"data/{folder}/{m}" for m in children(self.spark, f"{self.path}/data/{folder}") if m.startswith("month=")]
            if keep.isdisjoint(months):
                gone.append(f"data/{folder}")
            else:
                gone += [m for m in months if m not in keep]
        gone += [f"marks/{c}" for c in children(self.spark, f"{self.path}/marks") if f"marks/{c}" != now["marks"]]
        gone += [c for c in children(self.spark, self.path) if c.startswith("staging-")]
        for path in gone:
            remove(self.spark, f"{self.path}/{path}")
        return gone
