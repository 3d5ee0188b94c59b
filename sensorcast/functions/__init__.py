"""Column-level functions (calendar, cyclic encodings, parsing, rounding)."""

from sensorcast.functions.time import (
    calendar_features, cyclic_calendar, cyclic_features, epoch_seconds,
    future_grid, parse_timestamp, time_of_day_split, step_time,
)
from sensorcast.functions.numeric import round_even, round_columns

__all__ = [
    "calendar_features", "cyclic_calendar", "cyclic_features", "epoch_seconds",
    "future_grid", "parse_timestamp", "time_of_day_split", "step_time",
    "round_even", "round_columns",
]
