"""Raw readings in Parquet files with a zone map.

The zone map is a table of one row per file and station: first and last time,
first and last ingest ``ID`` and the number of rows.  It grows with the files;
only files that it does not know are read to extend it.  Scans from a mark and
the scan of the last hours choose their files by it, so a station that lags or
stopped long ago costs its own files and does not open those of the others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ZONES = "file string, series_id long, min_utc timestamp_ntz, max_utc timestamp_ntz, min_id long, max_id long, rows long"


def _plain(path: Column) -> Column:
    """``scheme:/path`` whatever the number of slashes after the scheme."""
    return F.regexp_replace(path, r"^([A-Za-z0-9+.-]+):/+(?=/)", "$1:")


class RawTable:
    """Raw readings below ``path``; ``adapt`` turns the stored schema into
    ``(ID, series_id, utc, ts, hr, qfe)``, for instance ``readings.to_internal``."""

    def __init__(self, spark: SparkSession, path: str, zones_path: str,
                 adapt: Callable[[DataFrame], DataFrame] = lambda df: df, schema: T.StructType | None = None):
        self.spark, self.path, self.zones_path, self.adapt = spark, path, zones_path.rstrip("/"), adapt
        self.schema = schema or spark.read.parquet(path).schema

    def files(self) -> list[str]:
        """The files that are there now, as Spark lists them."""
        return self.spark.read.schema(self.schema).parquet(self.path).inputFiles()

    def _listing(self) -> DataFrame:
        rows = [(f,) for f in self.files()]
        return self.spark.createDataFrame(rows, "path string").select("path", _plain(F.col("path")).alias("file"))

    def _stored_zones(self) -> DataFrame:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.zones_path)
        if not at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
            return self.spark.createDataFrame([], ZONES)
        return self.spark.read.schema(ZONES).parquet(self.zones_path)

    def scan(self, files: list[str] | None = None) -> DataFrame:
        """The given files (all by default) as readings."""
        reader = self.spark.read.schema(self.schema)
        if files is None:
            return self.adapt(reader.parquet(self.path))
        if not files:
            return self.adapt(self.spark.createDataFrame([], self.schema))
        return self.adapt(reader.option("basePath", self.path).parquet(*files))

    def refresh(self) -> int:
        """Add the files that the zone map does not know; their number.

        Only the time, station and ID columns of the new files are read.  A
        repeated or concurrent refresh can only add equal rows.
        """
        new = [r["path"] for r in self._listing().join(self._stored_zones().select("file").distinct(), "file", "left_anti").collect()]
        if new:
            raw = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*new)
            rows = self.adapt(raw).withColumn("_file", _plain(F.input_file_name()))
            (rows.groupBy(F.col("_file").alias("file"), "series_id")
             .agg(F.min("utc").alias("min_utc"), F.max("utc").alias("max_utc"), F.min("ID").alias("min_id"), F.max("ID").alias("max_id"),
                  F.count(F.lit(1)).alias("rows"))
             .write.mode("append").parquet(self.zones_path))
        return len(new)

    def zones(self) -> DataFrame:
        """The zone map of the files that are there now."""
        return self._stored_zones().join(self._listing(), "file").distinct()

    def since(self, marks: DataFrame) -> DataFrame:
        """Rows at or after each station's ``mark`` (``series_id, mark``); a
        station without one is read whole.  Files without such rows are not read."""
        need = self.zones().join(marks, "series_id", "left").where("mark is null or max_utc >= mark")
        low = F.when(F.count_if(F.col("mark").isNull()) == 0, F.min("mark"))
        found = need.groupBy("path").agg(low.alias("low"), F.count_if(F.col("mark").isNull()).alias("new")).collect()  # one row a file
        df = self.scan([r["path"] for r in found])
        if found and not any(r["new"] for r in found):
            df = df.where(F.col("utc") >= F.lit(min(r["low"] for r in found)))
        return df.join(marks, "series_id", "left").where("mark is null or utc >= mark").drop("mark")

    def latest_hours(self, hours: int) -> DataFrame:
        """The rows of each station's last ``hours`` hours, counted back from its own last row."""
        zones = self.zones()
        marks = zones.groupBy("series_id").agg((F.max("max_utc") - F.expr(f"INTERVAL {int(hours)} HOURS")).alias("mark"))
        files = zones.join(marks, "series_id").where("max_utc > mark").select("path").distinct().collect()
        return self.scan([r["path"] for r in files]).join(marks, "series_id").where("utc > mark").drop("mark")

    def latest_n(self, n: int) -> DataFrame:
        """The ``n`` rows of the largest IDs; reads the files that can hold them."""
        per_file = (self.zones().groupBy("path").agg(F.min("min_id").alias("lo"), F.max("max_id").alias("hi"), F.sum("rows").alias("rows"))
                    .collect())  # one row a file
        have, bound = 0, None
        for r in sorted(per_file, key=lambda r: -r["lo"]):
            have, bound = have + r["rows"], r["lo"]
            if have >= n:
                break
        files = [r["path"] for r in per_file if bound is not None and r["hi"] >= bound]
        return self.scan(files).orderBy(F.col("ID").desc()).limit(n)
