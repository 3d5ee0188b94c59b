"""Chronological splits (W5-W7, W11) from dense positions and series lengths.

The cut of a series needs only its length (a combinable aggregate), so no
series is numbered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorcast.operators.position import with_position

KEYS = ["series_id"]


def _with_n(df, keys, time_col, pos_col):
    if pos_col not in df.columns:
        df = with_position(df, keys, time_col, pos_col)
    n = df.groupBy(*keys).agg((F.max(pos_col) + 1).alias("_n"))
    return df.join(n, keys)


def split_train_test(df: DataFrame, frac: float = 0.9, keys: list[str] = KEYS, time_col: str = "utc",
                     pos_col: str = "pos", label: str = "split") -> DataFrame:
    """First ``round(n * frac)`` rows train, the rest test (W5); half-to-even rounding."""
    d = _with_n(df, keys, time_col, pos_col)
    cut = F.bround(F.col("_n") * F.lit(frac), 0)
    return d.withColumn(label, F.when(F.col(pos_col) < cut, "train").otherwise("test")).drop("_n")


def split_train_val_test(df: DataFrame, train: float = 0.8, val: float = 0.95, keys: list[str] = KEYS,
                         time_col: str = "utc", pos_col: str = "pos", label: str = "split") -> DataFrame:
    """Cuts at ``int(n * train)`` and ``int(n * val)``."""
    d = _with_n(df, keys, time_col, pos_col)
    a = F.floor(F.col("_n") * F.lit(train))
    b = F.floor(F.col("_n") * F.lit(val))
    p = F.col(pos_col)
    return d.withColumn(label, F.when(p < a, "train").when(p < b, "val").otherwise("test")).drop("_n")


def split_validation_tail(df: DataFrame, validation: float = 0.15, keys: list[str] = KEYS,
                          time_col: str = "utc", pos_col: str = "pos", label: str = "split",
                          frac: float = 0.9) -> DataFrame:
    """W5 split, then the last ``validation`` share of the train part becomes
    ``val`` (W7; the fit keeps ``floor(n_train * (1 - validation))`` rows)."""
    d = _with_n(df, keys, time_col, pos_col)
    n_train = F.bround(F.col("_n") * F.lit(frac), 0)
    keep = F.floor(n_train * F.lit(1.0 - validation))
    p = F.col(pos_col)
    return d.withColumn(label, F.when(p < keep, "train").when(p < n_train, "val").otherwise("test")).drop("_n")
