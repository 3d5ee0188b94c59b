"""Stand-in inputs built from the driver's test tables.

These functions only reshape ``events`` / ``lineitem`` rows into the schemas
the jobs expect (the mapping of FIXTURES.md section 2); they do none of the
jobs' work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed mapping of event types to the three sensor variables.
EVENT_VARIABLES = {"click": "ts", "view": "hr", "error": "qfe"}

# The hour that separates the "stored" table from the "new" rows.
STORED_BEFORE = "2024-01-20 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _series(kind: str):
    if kind == "mod3":
        return (F.col("user_id") % 3).cast("long")
    if kind == "user":
        return F.col("user_id").cast("long")
    if kind == "one":
        return F.lit(0).cast("long")
    raise ValueError(kind)


def readings(spark: SparkSession, sf_dir: str, series: str = "mod3") -> DataFrame:
    """Raw readings ``(ID, series_id, utc, ts, hr, qfe)`` from ``events``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("ID"), _series(series).alias("series_id"), F.col("ts").alias("utc"),
        *[F.when(F.col("event_type") == t, F.col("value")).alias(v) for t, v in EVENT_VARIABLES.items()])


def events_as_readings(ev: DataFrame) -> DataFrame:
    """Rows of ``events`` in the schema of :func:`readings`."""
    return ev.select(
        F.col("event_id").alias("ID"), _series("mod3").alias("series_id"), F.col("ts").alias("utc"),
        *[F.when(F.col("event_type") == t, F.col("value")).alias(v) for t, v in EVENT_VARIABLES.items()])


def write_day_files(spark: SparkSession, sf_dir: str, path: str, stored: bool) -> str:
    """Append the ``events`` before (``stored``) or from :data:`STORED_BEFORE` on, one folder a day."""
    ev = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit(STORED_BEFORE).cast("timestamp_ntz")
    (ev.where(early if stored else ~early).withColumn("day", F.to_date("ts")).repartition("day")
     .write.mode("append").partitionBy("day").parquet(path))
    return path


def weather_measurement(spark: SparkSession, sf_dir: str, series: str = "mod3") -> DataFrame:
    """Raw readings in the sensor database's own schema and names."""
    r = readings(spark, sf_dir, series)
    dec = "decimal(6,2)"
    return r.select(
        F.col("ID"), F.col("series_id").alias("sensor_id"),
        F.col("ts").cast(dec).alias("AMBIENT_TEMPERATURE"),
        F.col("qfe").cast(dec).alias("AIR_PRESSURE"),
        F.col("hr").cast(dec).alias("HUMIDITY"),
        F.col("utc").alias("CREATED"), F.col("utc").alias("serverDate"))


def official_rows(spark: SparkSession, sf_dir: str, variable: str) -> DataFrame:
    """Rows of one official hourly file before it is written: raw readings of
    one variable, with no series (the official station is one series)."""
    r = readings(spark, sf_dir, "one")
    return r.select("utc", variable).filter(F.col(variable).isNotNull())


def local_and_official(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw readings of the local station (even users) and the official one (odd)."""
    ev = table(spark, sf_dir, "events")
    r = ev.select(
        F.lit(0).cast("long").alias("series_id"), F.col("ts").alias("utc"),
        (F.col("user_id") % 2).alias("_odd"),
        *[F.when(F.col("event_type") == t, F.col("value")).alias(v) for t, v in EVENT_VARIABLES.items()])
    local = r.filter(F.col("_odd") == 0).drop("_odd")
    official = r.filter(F.col("_odd") == 1).drop("_odd")
    return local, official


def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide three-variable table over several years from ``lineitem``:
    ``utc`` = ship date, ``ts`` / ``hr`` / ``qfe`` = quantity / extended price / discount."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.lit(0).cast("long").alias("series_id"), F.col("l_shipdate").cast("timestamp_ntz").alias("utc"),
                     F.col("l_quantity").alias("ts"), F.col("l_extendedprice").alias("hr"),
                     F.col("l_discount").alias("qfe"))
