"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def round_even(col, digits: int) -> Column:
    """Round half to even on the binary value (N9): ``rint(x * 10^d) / 10^d``.

    This is numpy's rounding, which the stored tables use: 1.015 (binary
    1.01499...) gives 1.01.  ``bround`` rounds the decimal text instead (1.02).
    """
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def round_columns(df: DataFrame, cols: list[str], digits: int) -> DataFrame:
    return df.withColumns({c: round_even(c, digits) for c in cols})
