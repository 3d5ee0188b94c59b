"""Climatology forecaster (M1, M8c): the mean of each calendar moment.

The reference's calendar-only network "maps the best averages to moments of
the year"; here that is the mean per ``(series, month, day, hour)`` with
back-off to ``(month, hour)`` and then ``(hour)`` when a moment was never
observed.  Fitting is three combinable aggregations; forecasting is a left
join of the future grid to each level and a ``coalesce`` - no recursion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["series_id"]
VALUES = ["ts", "hr", "qfe"]

# Fixed back-off order: most specific level first.
LEVELS = [("month", "day", "hour"), ("month", "hour"), ("hour",)]


def _calendar(df: DataFrame, time_col: str) -> DataFrame:
    t = F.col(time_col)
    return df.withColumns({"month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t)})


def climatology_fit(df: DataFrame, keys: list[str] = KEYS, values: list[str] = VALUES,
                    time_col: str = "utc") -> DataFrame:
    """Means per level, stacked: ``(keys, level, month, day, hour, values...)``.

    Columns a level does not use are null.  The table has at most
    366 * 24 + 12 * 24 + 24 rows per series.
    """
    cal = _calendar(df, time_col)
    parts = []
    for i, lv in enumerate(LEVELS):
        g = cal.groupBy(*keys, *lv).agg(*[F.avg(v).alias(v) for v in values])
        for c in ("month", "day", "hour"):
            if c not in lv:
                g = g.withColumn(c, F.lit(None).cast("int"))
        parts.append(g.withColumn("level", F.lit(i)).select(*keys, "level", "month", "day", "hour", *values))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def climatology_forecast(fit: DataFrame, grid: DataFrame, keys: list[str] = KEYS,
                         values: list[str] = VALUES, time_col: str = "utc") -> DataFrame:
    """Score future times (``grid``: keys, step, time) with the most specific level available."""
    g = _calendar(grid, time_col)
    out = g
    for i, lv in enumerate(LEVELS):
        lvl = fit.filter(F.col("level") == i).select(*keys, *lv, *[F.col(v).alias(f"_{i}_{v}") for v in values])
        out = out.join(lvl, [*keys, *lv], "left")
    out = out.withColumns({v: F.coalesce(*[F.col(f"_{i}_{v}") for i in range(len(LEVELS))]) for v in values})
    return out.drop(*[f"_{i}_{v}" for i in range(len(LEVELS)) for v in values], "month", "day", "hour")
