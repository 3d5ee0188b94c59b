"""Joins: three hourly sources, overlay of local on official, future stamps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["series_id"]
VALUES = ["ts", "hr", "qfe"]


def join_sources(frames: list[DataFrame], keys: list[str] = KEYS, time_col: str = "utc") -> DataFrame:
    """Inner equi-join of per-variable hourly frames on ``(keys, time)``.

    Duplicate keys multiply, as in a relational merge.  AQE chooses broadcast
    or sort-merge at run time from the measured sizes.
    """
    return reduce(lambda a, b: a.join(b, [*keys, time_col], "inner"), frames)


def overlay_update(base: DataFrame, overlay: DataFrame, keys: list[str] = KEYS, time_col: str = "utc",
                   values: list[str] = VALUES) -> DataFrame:
    """Replace base values by overlay values where the overlay has one.

    Base keys only (pandas ``update``): a left join and ``coalesce``.
    """
    o = overlay.select(*keys, time_col, *[F.col(v).alias(f"_o_{v}") for v in values])
    out = base.join(o, [*keys, time_col], "left")
    return out.withColumns({v: F.coalesce(F.col(f"_o_{v}"), F.col(v)) for v in values}) \
              .drop(*[f"_o_{v}" for v in values])


def overlay_full(base: DataFrame, overlay: DataFrame, keys: list[str] = KEYS, time_col: str = "utc",
                 values: list[str] = VALUES) -> DataFrame:
    """As ``overlay_update`` but keeping overlay-only keys too (full outer join)."""
    b = base.select(*keys, time_col, *[F.col(v).alias(f"_b_{v}") for v in values])
    o = overlay.select(*keys, time_col, *[F.col(v).alias(f"_o_{v}") for v in values])
    out = b.join(o, [*keys, time_col], "full")
    return out.select(*keys, time_col, *[F.coalesce(F.col(f"_o_{v}"), F.col(f"_b_{v}")).alias(v)
                                         for v in values])


def attach_future_time(preds: DataFrame, grid: DataFrame, keys: list[str] = KEYS,
                       step_col: str = "step") -> DataFrame:
    """Pair predictions with their future times by ``(keys, step)``, never by position."""
    return preds.join(grid, [*keys, step_col], "inner")


def align_actuals(preds: DataFrame, actuals: DataFrame, keys: list[str] = KEYS, time_col: str = "utc",
                  values: list[str] = VALUES, suffix: str = "_pred") -> DataFrame:
    """Predictions (``{v}_pred``) next to the actual values at the same time."""
    a = actuals.select(*keys, time_col, *values)
    return preds.join(a, [*keys, time_col], "inner")
