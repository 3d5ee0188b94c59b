"""Raw sensor readings: schema, names, scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorcast.functions.time import parse_timestamp, YMD_HMS

# Schema of the sensor database table (fixed by the source system).
WEATHER_MEASUREMENT = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("sensor_id", T.LongType()),
    T.StructField("AMBIENT_TEMPERATURE", T.DecimalType(6, 2)),
    T.StructField("AIR_PRESSURE", T.DecimalType(6, 2)),
    T.StructField("HUMIDITY", T.DecimalType(6, 2)),
    T.StructField("CREATED", T.TimestampNTZType()),
    T.StructField("serverDate", T.TimestampNTZType()),
])

# Fixed column names: sensor table, stored hourly table, internal.
RAW_TO_INTERNAL = {"AMBIENT_TEMPERATURE": "ts", "HUMIDITY": "hr", "AIR_PRESSURE": "qfe",
                   "serverDate": "utc", "sensor_id": "series_id"}
HOURLY_TO_INTERNAL = {"Ts_Valor": "ts", "HR_Valor": "hr", "QFE_Valor": "qfe"}
INTERNAL_TO_HOURLY = {v: k for k, v in HOURLY_TO_INTERNAL.items()}
INTERNAL_TO_FORECAST = {"ts": "AMBIENT_TEMPERATURE", "hr": "HUMIDITY", "qfe": "AIR_PRESSURE"}


def to_internal(raw: DataFrame) -> DataFrame:
    """Sensor-table names -> ``(ID, series_id, utc, ts, hr, qfe)``, values as double."""
    cols = [F.col("ID")]
    cols.append(F.col("sensor_id").alias("series_id") if "sensor_id" in raw.columns
                else F.lit(0).cast("long").alias("series_id"))
    t = F.col("serverDate")
    if isinstance(raw.schema["serverDate"].dataType, T.StringType):
        t = parse_timestamp(t, YMD_HMS)
    cols.append(t.cast("timestamp_ntz").alias("utc"))
    for raw_name, name in RAW_TO_INTERNAL.items():
        if name in ("ts", "hr", "qfe"):
            cols.append(F.col(raw_name).cast("double").alias(name))
    return raw.select(*cols)


def rename_domain(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by name, never by position."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Full scan of a stored table (S3); projection and filters are pushed by Catalyst."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def scan_jdbc(spark: SparkSession, url: str, table: str, lower: int, upper: int,
              partitions: int, properties: dict | None = None) -> DataFrame:
    """Parallel full scan of the sensor database, split on ``ID`` ranges (S3)."""
    return spark.read.jdbc(url, table, column="ID", lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})


def high_water_mark(stored: DataFrame, time_col: str = "utc"):
    """Last stored time (one scalar; an aggregate, not a scan to the driver)."""
    return stored.agg(F.max(time_col).alias("m")).first()["m"]


def incremental_scan(raw: DataFrame, stored: DataFrame, time_col: str = "utc",
                     keys: list[str] | None = None) -> DataFrame:
    """Rows at or after the stored high-water mark.

    With ``keys`` the mark is per series, so a station that lags behind the
    others loses nothing and a station without stored rows is read whole.
    Without keys the one global mark is a literal filter pushed to the scan;
    that is right for a table of one series only.  An empty stored table
    gives all rows.
    """
    if not keys:
        mark = high_water_mark(stored, time_col)
        return raw if mark is None else raw.filter(F.col(time_col) >= F.lit(mark))
    marks = stored.groupBy(*keys).agg(F.max(time_col).alias("_mark"))
    return (raw.join(marks, keys, "left")
               .filter(F.col("_mark").isNull() | (F.col(time_col) >= F.col("_mark"))).drop("_mark"))


def latest_hours(raw: DataFrame, hours: int, keys: list[str], time_col: str = "utc") -> DataFrame:
    """The rows of the last ``hours`` hours of every series, counted back from
    its own last row.

    The smallest of the marks is also a literal filter, which a partitioned or
    sorted table prunes by.
    """
    marks = raw.groupBy(*keys).agg((F.max(time_col) - F.expr(f"INTERVAL {int(hours)} HOURS")).alias("_mark"))
    low = marks.agg(F.min("_mark").alias("m")).first()["m"]
    if low is None:
        return raw.limit(0)
    return (raw.filter(F.col(time_col) > F.lit(low)).join(marks, keys)
               .filter(F.col(time_col) > F.col("_mark")).drop("_mark"))


def latest_n(raw: DataFrame, n: int, order_col: str = "ID") -> DataFrame:
    """The last ``n`` rows by ``order_col``, in no particular order.

    One bound over all series: for one series, or a preview.

    ``orderBy(desc).limit(n)`` plans as a top-N (``TakeOrderedAndProject``):
    each task keeps n rows, no full sort.
    """
    return raw.orderBy(F.col(order_col).desc()).limit(n)


def filter_after(df: DataFrame, moment: str, time_col: str = "utc") -> DataFrame:
    """Keep rows strictly after ``moment`` (P4); null times drop."""
    return df.filter(F.col(time_col) > F.lit(moment).cast("timestamp_ntz"))


def filter_time_of_day(df: DataFrame, after_seconds: int, time_col: str = "utc") -> DataFrame:
    """Keep rows whose time of day is strictly after ``after_seconds`` (P5)."""
    t = F.col(time_col)
    return df.filter(F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t) > after_seconds)


def parse_report(df: DataFrame, raw_col: str, parsed_col: str) -> DataFrame:
    """Count of values that did not parse (N6): kept, never dropped silently."""
    return df.agg(F.count_if(F.col(raw_col).isNotNull() & F.col(parsed_col).isNull()).alias("unparsed"),
                  F.count(F.lit(1)).alias("rows"))
