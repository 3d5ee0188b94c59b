"""Regularisation: bucketed means, the gap grid, linear interpolation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorcast.functions.time import epoch_seconds
from sensorcast.operators.position import DEFAULT_BLOCK, carry_across_blocks, with_position
from sensorcast.session import write_and_read

VALUES = ["ts", "hr", "qfe"]
KEYS = ["series_id"]


def resample_mean(df: DataFrame, keys: list[str] = KEYS, time_col: str = "utc",
                  values: list[str] = VALUES, width: str = "1 hour") -> DataFrame:
    """Mean of every value per series and time bucket (A1 hour, A2 minute).

    A bucket exists when any row falls in it; a value with no reading in it
    is null.  Partial aggregation runs before the shuffle, so a hot series
    costs one partial row per bucket and task.
    """
    return (df.groupBy(*keys, F.window(time_col, width).start.alias(time_col))
              .agg(*[F.avg(F.col(v).cast("double")).alias(v) for v in values]))


def hourly_mean(df: DataFrame, keys: list[str] = KEYS, time_col: str = "utc",
                values: list[str] = VALUES) -> DataFrame:
    return resample_mean(df, keys, time_col, values, "1 hour")


def gap_grid(means: DataFrame, keys: list[str] = KEYS, time_col: str = "utc",
             values: list[str] = VALUES, step_seconds: int = 3600,
             block: int = DEFAULT_BLOCK, pos_col: str = "pos", materialize: bool = True) -> DataFrame:
    """Every step from each series' first to last bucket, empty ones null (A3).

    Emits a dense ``pos`` (0-based step index) for the ordered operators.  The
    grid is generated in blocks of ``block`` steps spread over tasks, so a
    long series is not generated by one task.

    The means are used twice (bounds and the join); ``materialize`` writes
    them once as Parquet under ``spark.checkpoint.dir`` so the raw input is
    scanned once, not twice.  They are ``width / raw interval``
    times smaller than the raw rows (720x for 5-second readings and hours).
    """
    if materialize:
        means = write_and_read(means, "bucket-means")
    t = F.col(time_col)
    bounds = means.groupBy(*keys).agg(F.min(t).alias("_lo"), F.max(t).alias("_hi"))
    n = ((epoch_seconds("_hi") - epoch_seconds("_lo")) / step_seconds).cast("long") + 1
    blocks = (bounds.withColumn("_n", n)
                    .withColumn("_blk", F.explode(F.sequence(F.lit(0).cast("long"),
                                                             F.floor((F.col("_n") - 1) / block)))))
    parts = int(means.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks.repartition(parts, *keys, "_blk")
    grid = (blocks.withColumn(pos_col, F.explode(F.sequence(
                F.col("_blk") * block, F.least((F.col("_blk") + 1) * block, F.col("_n")) - 1)))
                  .withColumn(time_col, F.timestamp_add("SECOND", F.col(pos_col) * step_seconds, F.col("_lo")))
                  .select(*keys, time_col, pos_col))
    return grid.join(means.select(*keys, time_col, *values), [*keys, time_col], "left")


def interpolate_linear(df: DataFrame, keys: list[str] = KEYS, values: list[str] = VALUES,
                       time_col: str = "utc", pos_col: str = "pos",
                       block: int = DEFAULT_BLOCK) -> DataFrame:
    """Linear fill of nulls between neighbours in position order.

    Leading nulls stay null; trailing nulls take the last value (pandas
    ``interpolate('linear')``).  Positions are the x axis, which on a gap grid
    equals time.  Runs per position block with a carried summary, so no
    series is sorted in a single task.
    """
    if pos_col not in df.columns:
        df = with_position(df, keys, time_col, pos_col)
    c = carry_across_blocks(df, keys, values, pos_col, block)
    p = F.col(pos_col)
    out = {}
    for v in values:
        pv, pp, nv, np_ = (F.col(f"{v}__{s}") for s in ("pv", "pp", "nv", "np"))
        out[v] = (F.when(F.col(v).isNotNull(), F.col(v))
                   .when(pp.isNull(), F.lit(None).cast("double"))
                   .when(np_.isNull(), pv)
                   .otherwise(pv + (nv - pv) * (p - pp).cast("double") / (np_ - pp).cast("double")))
    drop = [f"{v}__{s}" for v in values for s in ("pv", "pp", "nv", "np")]
    return c.withColumns(out).drop(*drop)


def regularize(readings: DataFrame, keys: list[str] = KEYS, time_col: str = "utc",
               values: list[str] = VALUES, width: str = "1 hour", step_seconds: int = 3600) -> DataFrame:
    """Bucketed mean -> gap grid -> linear interpolation: the hourly table."""
    means = resample_mean(readings, keys, time_col, values, width)
    grid = gap_grid(means, keys, time_col, values, step_seconds)
    return interpolate_linear(grid, keys, values, time_col)
