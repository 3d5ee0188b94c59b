"""File and table sources/sinks: typed CSV, official ``;`` files, stored
hourly table, forecast table with row ids (S1, S2, S6-S8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorcast.functions.time import DMY_HMS, parse_timestamp
from sensorcast.operators.position import with_position

# Microsecond timestamps survive a CSV round trip with this format.
CSV_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True,
              timestamp_format: str = CSV_TS_FORMAT, mode: str = "overwrite") -> str:
    """Write CSV without an index column (S6, CSV option); one file per task."""
    (df.write.mode(mode).option("header", header).option("sep", sep)
       .option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format)
       .csv(path))
    return path


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   header: bool = True, timestamp_format: str = CSV_TS_FORMAT) -> DataFrame:
    """CSV with header and typed, parsed time columns (S1); no schema inference."""
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format)
            .option("mode", "PERMISSIVE").csv(path))


# Official hourly files: fixed column names.
OFFICIAL_TIME = "momento"
OFFICIAL_VALUES = {"ts": "Ts_Valor", "hr": "HR_Valor", "qfe": "QFE_Valor"}


def write_official_csv(hourly: DataFrame, variable: str, path: str, time_col: str = "utc") -> str:
    """Write one variable as an official file: ``;``, header, day-first ``momento``."""
    out = hourly.select(F.date_format(time_col, DMY_HMS).alias(OFFICIAL_TIME),
                        F.col(variable).alias(OFFICIAL_VALUES[variable]))
    out.write.mode("overwrite").option("header", True).option("sep", ";").csv(path)
    return path


def read_official_csv(spark: SparkSession, path: str, variable: str, time_col: str = "utc") -> DataFrame:
    """Read a ``;`` official file (S2), parse the day-first time.

    Other columns are dropped; unparseable times stay as null ``utc`` rows so
    ``readings.parse_report`` can count them.
    """
    value = OFFICIAL_VALUES[variable]
    schema = T.StructType([T.StructField(OFFICIAL_TIME, T.StringType()),
                           T.StructField(value, T.DoubleType())])
    raw = spark.read.schema(schema).option("header", True).option("sep", ";").csv(path)
    return raw.select(parse_timestamp(OFFICIAL_TIME, DMY_HMS).alias(time_col),
                      F.col(value).alias(variable))


def write_hourly_table(df: DataFrame, path: str, time_col: str = "utc", mode: str = "overwrite") -> str:
    """Stored hourly table as Parquet partitioned by year and month.

    ``partitionOverwriteMode=dynamic`` rewrites only the months present in
    ``df``, so a monthly refresh does not rewrite history.
    """
    out = df.withColumns({"year": F.year(time_col), "month": F.month(time_col)})
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month").parquet(path))
    return path


def read_hourly_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def add_row_id(new: DataFrame, start_after: int | DataFrame = 0,
               order: tuple[str, ...] = ("run_utc", "series_id", "step"),
               id_col: str = "id", bucket_rows: int = 4096) -> DataFrame:
    """Deterministic surrogate key for appended rows.

    id = current max + 1 + rank in ``order``.  Numbered in two levels: inside
    ``(run, series bucket)`` chunks, then offset by the counts of earlier
    chunks, so no single task numbers a whole run.  ``start_after`` is the
    existing max id, or the existing table (its max is aggregated).
    """
    run, series, *rest = order
    chunk = [F.col(run), F.floor(F.col(series) / bucket_rows)]
    numbered = with_position(new.withColumn("_all", F.lit(0)), ["_all"], run, "_rk",
                             tiebreak=[series, *rest], chunk=chunk).drop("_all")
    if isinstance(start_after, DataFrame):
        base = start_after.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_base"))
        from sensorcast.operators.scale import attach_one_row
        numbered = attach_one_row(numbered, base)
        return numbered.withColumn(id_col, F.col("_base") + F.col("_rk") + 1).drop("_base", "_rk")
    return numbered.withColumn(id_col, F.lit(start_after) + F.col("_rk") + 1).drop("_rk")
