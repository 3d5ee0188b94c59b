"""Global window and multi-horizon least squares against numpy lstsq."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from sensorcast.models import ml

T0 = dt.datetime(2024, 1, 1)


def hourly(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(0, T0 + dt.timedelta(hours=i), i, *map(float, rng.normal(size=3))) for i in range(n)]
    return spark.createDataFrame(rows, "series_id long, utc timestamp_ntz, pos long, ts double, hr double, qfe double")


def test_window_regression_matches_lstsq(spark):
    w = ml.window_frame(hourly(spark, 400), length=4)
    fit = ml.window_regression_fit(w, length=4)
    pdf = w.select("xflat", *[F.col(f"y_{v}") for v in ml.VALUES]).toPandas()
    x = np.hstack([np.vstack(pdf["xflat"].to_numpy()), np.ones((len(pdf), 1))])
    y = pdf[[f"y_{v}" for v in ml.VALUES]].to_numpy()
    ref = np.linalg.lstsq(x, y, rcond=None)[0]
    # month is constant here (collinear with the intercept): coefficients are
    # not unique, fitted values are
    assert np.allclose(x @ np.array(fit.first()["coef"]), x @ ref, atol=1e-4)


def test_direct_multihorizon_matches_lstsq(spark):
    frame = ml.seq2seq_frame(hourly(spark, 200, seed=1), width=3)
    fit = ml.direct_multihorizon_fit(frame, width=3)
    pdf = frame.toPandas()
    x = np.hstack([np.vstack(pdf["xflat"].to_numpy()), np.ones((len(pdf), 1))])
    y = np.vstack(pdf["yflat"].to_numpy())
    # ysin at adjacent hours is nearly one column (ill-conditioned), so the
    # reference is numpy's solve of the same relative-ridge normal equations
    xtx = x.T @ x
    ref = np.linalg.solve(xtx + 1e-6 * np.trace(xtx) / len(xtx) * np.eye(len(xtx)), x.T @ y)
    coef = np.array(fit.first()["coef"])
    assert np.allclose(x @ coef, x @ ref, atol=1e-6)
    pred = ml.direct_multihorizon_predict(fit, frame).toPandas()
    assert np.allclose(np.vstack(pred["pred"].to_numpy()), x @ coef, atol=1e-9)
