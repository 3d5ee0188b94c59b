"""Query registry: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(df: DataFrame) -> DataFrame:
    """Round every floating column to 6 digits (engines differ in the last bits)."""
    return df.withColumns({f.name: F.round(f.name, 6) for f in df.schema.fields
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType))})
