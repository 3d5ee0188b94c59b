"""Live-feed versions of the hourly mean and of duplicate removal.

The event time is cast to ``timestamp`` (a watermark is not accepted on
``timestamp_ntz``), late rows are accepted for ``lateness``, and windows are
emitted in append mode once the watermark has passed their end.  State is
bounded by the watermark; the sink is a file table with its own checkpoint,
so a restarted query resumes exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

VALUES = ["ts", "hr", "qfe"]


EVENT_TIME = "_et"


def _with_event_time(readings: DataFrame, time_col: str, lateness: str) -> DataFrame:
    return readings.withColumn(EVENT_TIME, F.col(time_col).cast("timestamp")).withWatermark(EVENT_TIME, lateness)


def stream_hourly_mean(readings: DataFrame, keys: list[str] = ("series_id",), time_col: str = "utc",
                       values: list[str] = VALUES, width: str = "1 hour",
                       lateness: str = "10 minutes") -> DataFrame:
    """Streaming bucketed mean (twin of A1): finished windows only.

    A stream that already has its event time (``stream_dedup(...,
    keep_event_time=True)``) keeps that watermark.
    """
    ev = readings if EVENT_TIME in readings.columns else _with_event_time(readings, time_col, lateness)
    agg = ev.groupBy(*keys, F.window("_et", width).alias("_w")).agg(*[F.avg(v).alias(v) for v in values])
    return agg.select(*keys, F.col("_w.start").cast("timestamp_ntz").alias(time_col), *values)


def stream_dedup(readings: DataFrame, key: str = "ID", time_col: str = "utc",
                 lateness: str = "10 minutes", keep_event_time: bool = False) -> DataFrame:
    """Drop repeated readings of the same ``key`` arriving within ``lateness`` (X2); later ones drop as late."""
    once = _with_event_time(readings, time_col, lateness).dropDuplicatesWithinWatermark([key])
    return once if keep_event_time else once.drop(EVENT_TIME)


def start_to_table(stream: DataFrame, path: str, checkpoint: str, every: str | None = "1 minute") -> StreamingQuery:
    """Start a streaming frame into a Parquet table (append); ``every`` None takes what is there and ends."""
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    return (q.trigger(processingTime=every) if every else q.trigger(availableNow=True)).start()


def run_to_table(spark: SparkSession, stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process all that is available, resuming from the checkpoint, and return the table."""
    start_to_table(stream, path, checkpoint, every=None).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])
