"""Live roll-out: a forecast for every station as soon as an hour is closed.

Closed hours come from the watermarked hourly mean.  A stateful operator keeps,
for each station, its last 24 hours first in, first out, and the last known
value of each variable before them, so gaps are filled just as the batch job
fills them.  The state of a station is a few hundred numbers, whatever the
length of its history.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

VALUES = ["ts", "hr", "qfe"]
WIDTH = 24
STATE = "n long, last long, window array<double>, carry array<double>, carry_at array<long>"


class HourWindow:
    """The last ``WIDTH`` hours of one station, unfilled, and what was known before them."""

    def __init__(self, n: int = 0, last: int = 0, window=None, carry=None, carry_at=None):
        m = len(VALUES)
        self.n, self.last = n, last
        self.window = np.full((WIDTH, m), np.nan) if window is None else np.array(window, float).reshape(WIDTH, m)
        self.carry = np.full(m, np.nan) if carry is None else np.array(carry, float)
        self.carry_at = np.zeros(m, np.int64) if carry_at is None else np.array(carry_at, np.int64)

    def _push(self, row: np.ndarray) -> None:
        self.last, self.n = self.last + 1, self.n + 1
        known = ~np.isnan(self.window[0])
        self.carry = np.where(known, self.window[0], self.carry)
        self.carry_at = np.where(known, self.last - WIDTH, self.carry_at)
        self.window = np.vstack([self.window[1:], row])  # first in, first out

    def advance(self, hour: int, row: np.ndarray) -> bool:
        """Append a closed hour and the empty ones before it; False for an hour that is already there."""
        if self.n == 0:
            self.last = hour - 1
        if hour <= self.last:
            return False
        empty = np.full(len(VALUES), np.nan)
        gap = hour - self.last - 1
        for _ in range(min(gap, WIDTH)):
            self._push(empty)
        self.n, self.last = self.n + max(0, gap - WIDTH), hour - 1
        self._push(row)
        return True

    def filled(self) -> np.ndarray:
        """The window with linear fill; what was never known stays NaN, the end keeps the last value."""
        hours = np.arange(self.last - WIDTH + 1, self.last + 1)
        out = np.full_like(self.window, np.nan)
        for j in range(len(VALUES)):
            known = ~np.isnan(self.window[:, j])
            x, y = hours[known].astype(float), self.window[known, j]
            if not np.isnan(self.carry[j]):
                x, y = np.r_[self.carry_at[j], x], np.r_[self.carry[j], y]
            if len(x):
                out[:, j] = np.where(hours >= x[0], np.interp(hours, x, y), np.nan)
        return out

    def state(self) -> tuple:
        return (self.n, self.last, self.window.ravel().tolist(), self.carry.tolist(), self.carry_at.tolist())


def live_forecasts(hours: DataFrame, roll: Callable[[np.ndarray, int, dict], np.ndarray], horizon: int = 72,
                   extras: list[str] = ()) -> DataFrame:
    """``(series_id, run_utc, step, utc, ts, hr, qfe)`` for every closed hour of a station that has a full window.

    ``hours`` is a stream of closed hours ``(series_id, utc, ts, hr, qfe,
    extras...)``.  ``roll(window, hour, extras)`` gets the filled window (24 x 3),
    the hour (since 1970) and the extra columns of the newest row, for instance
    coefficients joined from a stored model, and returns ``horizon`` x 3 values.
    """
    schema = T.StructType([T.StructField("series_id", T.LongType()), T.StructField("run_utc", T.TimestampNTZType()),
                           T.StructField("step", T.IntegerType()), T.StructField("utc", T.TimestampNTZType()),
                           *[T.StructField(v, T.DoubleType()) for v in VALUES]])
    columns = list(extras)
    src = hours.select("series_id", F.unix_seconds(F.col("utc").cast("timestamp")).alias("seconds"), *VALUES, *columns)

    def run(key, batches, state):
        rows = pd.concat(list(batches)).sort_values("seconds")
        window = HourWindow(*state.get) if state.exists else HourWindow()
        for row in rows.itertuples(index=False):
            values = np.array([np.nan if getattr(row, v) is None else getattr(row, v) for v in VALUES], float)
            if window.advance(int(row.seconds) // 3600, values) and window.n >= WIDTH:
                out = roll(window.filled(), window.last, {c: getattr(row, c) for c in columns})
                times = pd.to_datetime((window.last + 1 + np.arange(horizon)) * 3600, unit="s")
                yield pd.DataFrame({"series_id": key[0], "run_utc": pd.to_datetime(window.last * 3600, unit="s"),
                                    "step": np.arange(1, horizon + 1, dtype=np.int32), "utc": times,
                                    **{v: pd.Series(out[:, j]).astype(object).where(~np.isnan(out[:, j]), None) for j, v in enumerate(VALUES)}})
        state.update(window.state())
    return src.groupBy("series_id").applyInPandasWithState(
        run, schema, STATE, "append", GroupStateTimeout.NoTimeout)


def ar1_roll(horizon: int = 72) -> Callable[[np.ndarray, int, dict], np.ndarray]:
    """Roll-out of AR(1) from the newest hour, with the coefficients in the extra columns."""
    def roll(window, hour, extra):
        slope = np.array([np.nan if extra[f"{v}_slope"] is None else extra[f"{v}_slope"] for v in VALUES], float)
        intercept = np.array([np.nan if extra[f"{v}_intercept"] is None else extra[f"{v}_intercept"] for v in VALUES], float)
        out, now = np.empty((horizon, len(VALUES))), window[-1]
        for i in range(horizon):
            now = out[i] = intercept + slope * now
        return out
    return roll


AR1_EXTRAS = [f"{v}_{k}" for v in VALUES for k in ("slope", "intercept")]


def window_roll(coef: np.ndarray, mean: np.ndarray, std: np.ndarray, horizon: int = 72) -> Callable[[np.ndarray, int, dict], np.ndarray]:
    """Roll-out of the stored window regression: one set of coefficients and statistics for all stations."""
    from sensorcast.models.families import window_steps

    if coef is None:
        raise ValueError("the window regression has no coefficients: too few windows to fit it")

    def roll(window, hour, extra):
        known = not np.isnan(window).any()
        out = window_steps(np.nan_to_num(window)[None], np.array([hour]), coef, mean, std, horizon)[0]
        return out if known else np.full_like(out, np.nan)
    return roll
