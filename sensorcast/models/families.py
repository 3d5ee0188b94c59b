"""Forecast families with one interface: ``fit(hourly) -> Model`` and
``forecast(model, recent, horizon) -> (series_id, step, utc, ts, hr, qfe)``.

``hourly`` is a regular hourly table with ``pos``; ``recent`` its last hours (at
least 25 for the window families).  A family keeps all it needs in its tables,
normalisation statistics included, so that training and serving use the same
ones.  A series that is too short for a family gets no rows from it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorcast.functions.time import calendar_features, cyclic_features, epoch_seconds, future_grid
from sensorcast.models import ar, climatology, ml
from sensorcast.models.gram import linear_fit
from sensorcast.models.store import Model
from sensorcast.operators import windows as wn
from sensorcast.operators.scale import column_stats, zscore
from sensorcast.operators.stats import last_observation, long_format

KEYS = ["series_id"]
VALUES = ["ts", "hr", "qfe"]
WIDTH = 24


def _grid(recent: DataFrame, horizon: int, first_step: int) -> DataFrame:
    return future_grid(last_observation(recent, values=[]), KEYS, horizon=horizon, first_step=first_step)


def _wide(long: DataFrame) -> DataFrame:
    return long.groupBy(*KEYS, "step", "utc").agg(*[F.max(F.when(F.col("variable") == v, F.col("value"))).alias(v) for v in VALUES])


class Ar1:
    def fit(self, hourly: DataFrame) -> Model:
        return Model("ar1", {"coefficients": ar.ar1_fit(hourly)})

    def forecast(self, model: Model, recent: DataFrame, horizon: int = 72, first_step: int = 1) -> DataFrame:
        return ar.ar1_forecast(model.tables["coefficients"], last_observation(recent), horizon, first_step=first_step)


class Climatology:
    def fit(self, hourly: DataFrame) -> Model:
        return Model("climatology", {"means": climatology.climatology_fit(hourly)})

    def forecast(self, model: Model, recent: DataFrame, horizon: int = 72, first_step: int = 1) -> DataFrame:
        return climatology.climatology_forecast(model.tables["means"], _grid(recent, horizon, first_step))


class ArDiff:
    """AR(p) on first differences; the counterpart of the ARIMA(p,1,0) job."""

    def fit(self, hourly: DataFrame, p: int = WIDTH) -> Model:
        return Model("ar_diff", {"coefficients": ar.ar_diff_fit(hourly, p)}, {"p": p})

    def forecast(self, model: Model, recent: DataFrame, horizon: int = 72, first_step: int = 1) -> DataFrame:
        return _wide(ar.ar_diff_forecast(model.tables["coefficients"], recent, model.params["p"], horizon, first_step=first_step))


class Cyclic:
    """Each variable of each station on the cyclic encodings of day and year, with a constant."""

    def fit(self, hourly: DataFrame) -> Model:
        long = long_format(cyclic_features(hourly).select(*KEYS, *ml.CYCLIC, *VALUES), VALUES, [*KEYS, *ml.CYCLIC])
        return Model("cyclic", {"coefficients": linear_fit(long, [*KEYS, "variable"], ml.CYCLIC, ["value"], intercept=True)})

    def forecast(self, model: Model, recent: DataFrame, horizon: int = 72, first_step: int = 1) -> DataFrame:
        grid = cyclic_features(_grid(recent, horizon, first_step))
        c = F.flatten("coef")
        value = F.element_at(c, 1) * F.col("dsin") + F.element_at(c, 2) * F.col("ysin") + F.element_at(c, 3)
        scored = grid.join(model.tables["coefficients"].where("coef is not null").select(*KEYS, "variable", "coef"), KEYS)
        return _wide(scored.select(*KEYS, "step", "utc", "variable", value.alias("value")))


def _statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and standard deviation of the whole table, one row; a constant column is only centred."""
    stats = column_stats(df, columns)
    return stats.withColumns({f"{c}_std": F.when(F.col(f"{c}_std") > 0, F.col(f"{c}_std")).otherwise(F.lit(1.0)) for c in columns})


def global_numbers(model: Model, columns: list[str]) -> tuple[np.ndarray | None, np.ndarray, np.ndarray]:
    """Coefficients, means and deviations of a global model: one row each, whatever the data."""
    row, stats = model.tables["coefficients"].first(), model.tables["statistics"].first()
    coef = None if row is None or row["coef"] is None else np.array(row["coef"])
    return coef, np.array([stats[f"{c}_mean"] for c in columns], float), np.array([stats[f"{c}_std"] for c in columns], float)


def _windows(recent: DataFrame) -> DataFrame:
    """The last ``WIDTH`` rows of each series as one array, and its last hour."""
    tail = wn.tail_slice(recent, keys=KEYS, last=WIDTH)
    rows = F.sort_array(F.collect_list(F.struct("pos", *[F.col(v).cast("double").alias(v) for v in VALUES])))
    return (tail.groupBy(*KEYS).agg(rows.alias("_rows"), F.max("utc").alias("utc")).where(F.size("_rows") == WIDTH)
            .select(*KEYS, "utc", F.flatten(F.transform("_rows", lambda r: F.array(*[r[v] for v in VALUES]))).alias("x")))


def _rolled(recent: DataFrame, roll, horizon: int, first_step: int) -> DataFrame:
    """``roll(values (n, WIDTH, 3), hours (n,)) -> (n, horizon, 3)`` for batches of series; a null gives null values."""
    state = _windows(recent).withColumn("utc", epoch_seconds("utc"))
    schema = T.StructType([state.schema["series_id"], T.StructField("step", T.IntegerType()), T.StructField("utc", T.TimestampNTZType()),
                           *[T.StructField(v, T.DoubleType()) for v in VALUES]])

    def run(batches):
        for batch in batches:
            if batch.empty:
                continue
            x = np.array([[np.nan if v is None else v for v in r] for r in batch["x"]], float).reshape(len(batch), WIDTH, len(VALUES))
            known = ~np.isnan(x).any(axis=(1, 2))
            hours = batch["utc"].to_numpy() // 3600
            out = roll(np.where(np.isnan(x), 0.0, x), hours)
            for i in range(horizon):
                yield pd.DataFrame({"series_id": batch["series_id"], "step": np.int32(i + 1),
                                    "utc": pd.to_datetime((hours + i + first_step) * 3600, unit="s"),
                                    **{v: pd.Series(out[:, i, j], index=batch.index).astype(object).where(known, None)
                                       for j, v in enumerate(VALUES)}})
    return state.mapInPandas(run, schema)


def _calendar(hours: np.ndarray) -> np.ndarray:
    t = pd.to_datetime(hours * 3600, unit="s")
    return np.column_stack([t.hour, t.day, t.month]).astype(float)


def _cyclic(hours: np.ndarray) -> np.ndarray:
    s = hours * 3600.0
    return np.column_stack([np.sin(s * 2 * np.pi / 86400), np.sin(s * 2 * np.pi / (365.2425 * 86400))])


def window_steps(x: np.ndarray, hours: np.ndarray, coef: np.ndarray, mean: np.ndarray, std: np.ndarray, horizon: int) -> np.ndarray:
    """Roll windows of values (n, WIDTH, 3) that end at ``hours`` out, hour by hour: (n, horizon, 3)."""
    n, m = len(x), len(VALUES)
    cal = np.stack([_calendar(hours - WIDTH + 1 + i) for i in range(WIDTH)], axis=1)
    window = (np.concatenate([x, cal], axis=2) - mean) / std
    out = np.empty((n, horizon, m))
    for i in range(horizon):
        out[:, i] = np.hstack([window.reshape(n, -1), np.ones((n, 1))]) @ coef
        new = np.hstack([out[:, i], (_calendar(hours + i + 1) - mean[m:]) / std[m:]])
        window = np.concatenate([window[:, 1:], new[:, None]], axis=1)  # first in, first out
    return out * std[:m] + mean[:m]


class Window:
    """The next hour from the last 24 hours of values and calendar, normalised
    with the statistics of the whole table; rolled out hour by hour."""

    columns = ml.WINDOW_FEATURES

    def fit(self, hourly: DataFrame) -> Model:
        table = calendar_features(hourly, year=False)
        stats = _statistics(table, self.columns)
        scaled = zscore(table.withColumns({c: F.col(c).cast("double") for c in self.columns}), stats, self.columns)
        w = wn.sliding_windows(scaled, keys=KEYS, features=self.columns, targets=VALUES, length=WIDTH)
        flat = w.withColumn("xflat", wn.flatten_window("x", self.columns)).drop("x")
        return Model("window", {"coefficients": ml.window_regression_fit(flat, WIDTH), "statistics": stats})

    def forecast(self, model: Model, recent: DataFrame, horizon: int = 72, first_step: int = 1) -> DataFrame:
        coef, mean, std = global_numbers(model, self.columns)
        if coef is None:
            return _rolled(recent.limit(0), None, horizon, first_step)

        def roll(x, hours):
            return window_steps(x, hours, coef, mean, std, horizon)
        return _rolled(recent, roll, horizon, first_step)


class MultiHorizon:
    """The next 24 hours from the last 24 in one step, normalised; block after block."""

    columns = ml.S2S_FEATURES

    def fit(self, hourly: DataFrame) -> Model:
        table = cyclic_features(hourly)
        stats = _statistics(table, self.columns)
        scaled = zscore(table, stats, self.columns)
        w = wn.seq2seq_windows(scaled, keys=KEYS, features=self.columns, label_columns=VALUES, input_width=WIDTH, label_width=WIDTH, shift=WIDTH)
        frame = w.select(wn.flatten_window("inputs", self.columns).alias("xflat"), wn.flatten_window("labels", VALUES).alias("yflat"))
        return Model("multihorizon", {"coefficients": ml.direct_multihorizon_fit(frame, WIDTH), "statistics": stats})

    def forecast(self, model: Model, recent: DataFrame, horizon: int = 72, first_step: int = 1) -> DataFrame:
        coef, mean, std = global_numbers(model, self.columns)
        if coef is None:
            return _rolled(recent.limit(0), None, horizon, first_step)

        def roll(x, hours):
            n, m = len(x), len(VALUES)
            values, parts = (x - mean[:m]) / std[:m], []
            for b in range(-(-horizon // WIDTH)):
                times = [(_cyclic(hours + b * WIDTH - WIDTH + 1 + i) - mean[m:]) / std[m:] for i in range(WIDTH)]
                block = np.concatenate([values, np.stack(times, axis=1)], axis=2)
                values = (np.hstack([block.reshape(n, -1), np.ones((n, 1))]) @ coef).reshape(n, WIDTH, m)
                parts.append(values)
            return np.concatenate(parts, axis=1)[:, :horizon] * std[:m] + mean[:m]
        return _rolled(recent, roll, horizon, first_step)


class Forest:
    """One forest per variable; its nodes are a table."""

    def fit(self, hourly: DataFrame, num_trees: int = 100, max_depth: int = 30, seed: int = 42, min_leaf: int = 1) -> Model:
        models = ml.forest_fit(ml.forest_pairs(hourly), num_trees, max_depth, seed, min_leaf)
        return Model("forest", {"nodes": ml.forest_table(models)}, {"num_trees": num_trees, "max_depth": max_depth, "min_leaf": min_leaf})

    def forecast(self, model: Model, recent: DataFrame, horizon: int = 72, first_step: int = 1) -> DataFrame:
        out = ml.rollout_forest(model.tables["nodes"], last_observation(recent), horizon)
        return out if first_step == 1 else out.withColumn("utc", F.timestamp_add("HOUR", F.lit(first_step - 1), F.col("utc")))


FAMILIES = {"ar1": Ar1(), "climatology": Climatology(), "ar_diff": ArDiff(), "cyclic": Cyclic(), "window": Window(),
            "multihorizon": MultiHorizon(), "forest": Forest()}


def forecast(model: Model, recent: DataFrame, horizon: int = 72, first_step: int = 1) -> DataFrame:
    """The forecast of a stored model by its family: ``(series_id, step, utc, ts, hr, qfe)``."""
    out = FAMILIES[model.family].forecast(model, recent, horizon, first_step)
    return out.select("series_id", F.col("step").cast("int").alias("step"), "utc", *VALUES)
