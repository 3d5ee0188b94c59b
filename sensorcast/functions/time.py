"""Time functions: calendar and cyclic features, parsing, stepping, future grids.

All of them work on naive ``timestamp_ntz`` columns and do not depend on the
session time zone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the cyclic encodings: one day and one mean Gregorian year, in seconds.
DAY_SECONDS = 24 * 60 * 60
YEAR_SECONDS = 365.2425 * DAY_SECONDS



def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_seconds(col) -> Column:
    """Whole seconds since 1970-01-01 of a naive timestamp (zone independent)."""
    return F.timestamp_diff("SECOND", _epoch(), _c(col).cast("timestamp_ntz"))


def step_time(col, steps, unit: str = "HOUR") -> Column:
    """``col + steps * unit`` (steps may be a column); the N8 timestamp step."""
    steps = F.lit(steps) if isinstance(steps, int) else _c(steps)
    return F.timestamp_add(unit, steps, _c(col))


def calendar_features(df: DataFrame, time_col: str = "utc", minute: bool = False,
                      year: bool = True) -> DataFrame:
    """hour, day (of month), month, year (and minute) as int columns."""
    t = F.col(time_col)
    cols = {}
    if minute:
        cols["minute"] = F.minute(t)
    cols["hour"] = F.hour(t)
    cols["day"] = F.dayofmonth(t)
    cols["month"] = F.month(t)
    if year:
        cols["year"] = F.year(t)
    return df.withColumns(cols)


def cyclic_features(df: DataFrame, time_col: str = "utc") -> DataFrame:
    """dsin = sin(2*pi*epoch/day), ysin = sin(2*pi*epoch/year)."""
    e = epoch_seconds(time_col).cast("double")
    return df.withColumns({
        "dsin": F.sin(e * (2 * math.pi / DAY_SECONDS)),
        "ysin": F.sin(e * (2 * math.pi / YEAR_SECONDS)),
    })


def cyclic_calendar(df: DataFrame, time_col: str = "utc") -> DataFrame:
    """The proposed encodings sin(hour) and sin(day + month)."""
    t = F.col(time_col)
    return df.withColumns({
        "hour_sin": F.sin(F.hour(t).cast("double")),
        "daymonth_sin": F.sin((F.dayofmonth(t) + F.month(t)).cast("double")),
    })


def time_of_day_split(df: DataFrame, time_col: str = "utc") -> DataFrame:
    """Split a timestamp into seconds-of-day and date."""
    t = F.col(time_col)
    return df.withColumns({
        "time_of_day": (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).cast("int"),
        "date": F.to_date(t),
    })


# Fixed parse formats: year-first (database / ISO) and day-first (official files).
YMD_HMS = "yyyy-MM-dd HH:mm:ss"
DMY_HMS = "dd-MM-yyyy HH:mm:ss"


def parse_timestamp(col, fmt: str = YMD_HMS) -> Column:
    """Parse a string into ``timestamp_ntz``; unparseable values become null.

    Callers count the nulls (see ``sources.readings.parse_report``); rows are
    never dropped silently.
    """
    return F.try_to_timestamp(_c(col), F.lit(fmt)).cast("timestamp_ntz")


def future_grid(last: DataFrame, keys: list[str], time_col: str = "utc", horizon: int = 72,
                first_step: int = 1, unit: str = "HOUR") -> DataFrame:
    """One row per key and step 1..horizon with its future time.

    ``last`` holds one row per key with the last observed time.  ``first_step``
    = 1 starts at the next hour; 0 reproduces stamping from the last observed
    hour.
    """
    return (last.select(*keys, F.col(time_col).alias("_t0"),
                        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
            .withColumn(time_col, step_time("_t0", F.col("step") - 1 + first_step, unit))
            .drop("_t0"))
