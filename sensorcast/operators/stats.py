"""Descriptive aggregates: six-number summary, last observation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorcast.operators.quantiles import exact_quantiles

VALUES = ["ts", "hr", "qfe"]


def long_format(df: DataFrame, values: list[str], keys: list[str] | None = None,
                name: str = "variable", value: str = "value") -> DataFrame:
    """Unpivot value columns into ``(keys..., variable, value)`` rows."""
    return df.unpivot(list(keys or []), list(values), name, value)


def summary_stats(df: DataFrame, values: list[str] = VALUES, keys: list[str] | None = None,
                  exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """min, Q1, median, mean, Q3, max and null count per variable (A5, R ``summary``).

    Quartiles are interpolated linearly (R type 7).  ``exact`` selects them by
    rank over range partitions (``operators.quantiles``), so no group is
    gathered in one task; ``exact=False`` uses the mergeable
    ``percentile_approx`` sketch in the same pass as the other figures.
    """
    keys = list(keys or [])
    long = long_format(df, values, keys).withColumn("value", F.col("value").cast("double"))
    by = [*keys, "variable"]
    aggs = [F.min("value").alias("min"), F.avg("value").alias("mean"), F.max("value").alias("max"),
            F.count_if(F.col("value").isNull()).alias("na")]
    if exact:
        out = join_null_safe(long.groupBy(*by).agg(*aggs), exact_quantiles(long, by, [0.25, 0.5, 0.75], name="_q"), by)
    else:
        out = long.groupBy(*by).agg(*aggs, F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy).cast("array<double>").alias("_q"))
    return out.select(*by, "min", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                      "mean", F.col("_q")[2].alias("q3"), "max", "na")


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on ``keys`` where null equals null; the other columns of ``right`` follow."""
    marked = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(marked, on, "left").drop(*[f"_r_{k}" for k in keys])


def last_observation(df: DataFrame, keys: list[str] = ("series_id",), time_col: str = "utc",
                     values: list[str] = VALUES) -> DataFrame:
    """Last time and the values of the last row per series (A7): ``max``/``max_by``."""
    return df.groupBy(*keys).agg(F.max(time_col).alias(time_col),
                                 *[F.max_by(v, F.col(time_col)).alias(v) for v in values])
