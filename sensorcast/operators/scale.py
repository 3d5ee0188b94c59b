"""z-score normalisation with stored statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VALUES = ["ts", "hr", "qfe"]


def column_stats(df: DataFrame, values: list[str] = VALUES, keys: list[str] | None = None) -> DataFrame:
    """Mean and sample standard deviation (ddof 1) per column (A4).

    One row (``keys`` empty) or one row per key; a combinable aggregate.
    """
    aggs = []
    for v in values:
        aggs += [F.avg(v).alias(f"{v}_mean"), F.stddev_samp(v).alias(f"{v}_std")]
    return df.groupBy(*(keys or [])).agg(*aggs)


def _attach(df: DataFrame, stats: DataFrame, keys: list[str] | None) -> DataFrame:
    if keys:
        return df.join(stats, keys)
    return attach_one_row(df, stats)


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Join a global (one-row, by construction) table to every row.

    An equi-join on a constant key with a broadcast hint: the broadcast side is
    a single aggregate row, so its size is bounded whatever the data size.
    """
    left = df.withColumn("_one", F.lit(1))
    right = F.broadcast(one_row.withColumn("_one", F.lit(1)))
    return left.join(right, "_one").drop("_one")


def zscore(df: DataFrame, stats: DataFrame, values: list[str] = VALUES,
           keys: list[str] | None = None) -> DataFrame:
    """``(v - mean) / std`` with the given statistics (Z1 train-part, Z2 whole table).

    ``keys`` joins per-series statistics; without keys the one-row global
    statistics are broadcast.
    """
    out = _attach(df, stats, keys)
    # a constant column has std 0: null, never an error or infinity
    out = out.withColumns({v: F.try_divide(F.col(v) - F.col(f"{v}_mean"), F.col(f"{v}_std")) for v in values})
    return out.drop(*[f"{v}_{s}" for v in values for s in ("mean", "std")])


def zscore_inverse(df: DataFrame, stats: DataFrame, values: list[str] = VALUES,
                   keys: list[str] | None = None) -> DataFrame:
    """``v * std + mean``."""
    out = _attach(df, stats, keys)
    out = out.withColumns({v: F.col(v) * F.col(f"{v}_std") + F.col(f"{v}_mean") for v in values})
    return out.drop(*[f"{v}_{s}" for v in values for s in ("mean", "std")])


def fit_zscore(df: DataFrame, values: list[str] = VALUES, keys: list[str] | None = None,
               split_col: str | None = None, fit_on: str = "train") -> DataFrame:
    """Statistics of the train part (``fit_on='train'``, Z1) or of all rows (``'all'``, Z2)."""
    src = df
    if split_col and fit_on != "all":
        src = df.filter(F.col(split_col) == fit_on)
    return column_stats(src, values, keys)
