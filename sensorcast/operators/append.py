"""Appending new hours to a stored table, previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["series_id"]
VALUES = ["ts", "hr", "qfe"]


def append_hours(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Append rows by column name (U1); columns missing on one side become null."""
    return stored.unionByName(new, allowMissingColumns=True)


def append_hours_dedup(stored: DataFrame, new: DataFrame, keys: list[str] = KEYS,
                       time_col: str = "utc", values: list[str] = VALUES) -> DataFrame:
    """Append, keeping per column the newest value of every ``(keys, time)``.

    The boundary hour fetched again by an ``>=`` high-water mark is rebuilt
    from the new rows instead of duplicated; where the rebuilt hour has no
    value for a column, the stored one stays.  ``max_by`` over a version tag
    is a combinable aggregate: no per-key sort.
    """
    both = (stored.select(*keys, time_col, *values).withColumn("_ver", F.lit(0))
            .unionByName(new.select(*keys, time_col, *values).withColumn("_ver", F.lit(1))))
    newest = [F.max_by(v, F.when(F.col(v).isNotNull(), F.col("_ver"))).alias(v) for v in values]
    return both.groupBy(*keys, time_col).agg(*newest)


def head_preview(df: DataFrame, order: list[str], n: int = 6) -> DataFrame:
    """First ``n`` rows in key order (O2): a top-N, not a full sort."""
    return df.orderBy(*order).limit(n)
