"""Hand-made cases (FIXTURES.md section 3) and block-boundary checks."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorcast.functions import time as tf
from sensorcast.functions.numeric import round_even
from sensorcast.models import ar, climatology as cl
from sensorcast.models.gram import linear_fit
from sensorcast.operators import append as ap
from sensorcast.operators import joins as jn
from sensorcast.operators import regularize as rg
from sensorcast.operators import split as sp
from sensorcast.operators import windows as wn
from sensorcast.operators.position import with_position

T0 = dt.datetime(2024, 1, 1)


def hours(n):
    return [T0 + dt.timedelta(hours=i) for i in range(n)]


def frame(spark, values, series=0, col="ts"):
    rows = [(series, t, i, v) for i, (t, v) in enumerate(zip(hours(len(values)), values))]
    return (spark.createDataFrame(rows, f"series_id long, utc timestamp_ntz, pos long, {col} double"))


def col_values(df, col, order="pos"):
    return [r[col] for r in df.orderBy(order).collect()]


def test_interpolation_ends(spark):
    out = rg.interpolate_linear(frame(spark, [None, 1.0, None, 3.0, None]), values=["ts"])
    assert col_values(out, "ts") == [None, 1.0, 2.0, 3.0, 3.0]


def test_all_null_variable(spark):
    out = rg.interpolate_linear(frame(spark, [None, None]), values=["ts"])
    assert col_values(out, "ts") == [None, None]


@pytest.mark.parametrize("block", [3, 4, 7, 1 << 16])
def test_interpolation_matches_pandas_across_blocks(spark, block):
    rng = np.random.default_rng(1)
    vals = rng.normal(size=60)
    vals[rng.random(60) < 0.5] = np.nan
    vals[:3] = np.nan
    vals[-4:] = np.nan
    pyvals = [None if math.isnan(v) else float(v) for v in vals]
    out = rg.interpolate_linear(frame(spark, pyvals), values=["ts"], block=block)
    got = np.array([np.nan if v is None else v for v in col_values(out, "ts")])
    exp = pd.Series(vals).interpolate("linear").to_numpy()
    assert np.allclose(got, exp, equal_nan=True)


def test_grid_fills_missing_hours(spark):
    rows = [(0, T0.replace(minute=10), 1.0), (0, T0.replace(minute=50), 3.0), (0, T0.replace(hour=3), 5.0)]
    raw = spark.createDataFrame(rows, "series_id long, utc timestamp_ntz, ts double")
    grid = rg.gap_grid(rg.hourly_mean(raw, values=["ts"]), values=["ts"], materialize=False)
    got = [(r["utc"].hour, r["pos"], r["ts"]) for r in grid.orderBy("utc").collect()]
    assert got == [(0, 0, 2.0), (1, 1, None), (2, 2, None), (3, 3, 5.0)]


def test_boundary_append_keeps_one_row(spark):
    stored = spark.createDataFrame([(0, T0.replace(hour=23), 1.0, 1.0, 1.0)],
                                   "series_id long, utc timestamp_ntz, ts double, hr double, qfe double")
    new = spark.createDataFrame([(0, T0.replace(hour=23), 2.0, 2.0, 2.0)], stored.schema)
    assert ap.append_hours(stored, new).count() == 2
    out = ap.append_hours_dedup(stored, new).collect()
    assert len(out) == 1 and out[0]["ts"] == 2.0


def test_half_even_rounding(spark):
    r = spark.range(1).select(round_even(F.lit(0.125), 2).alias("a"), round_even(F.lit(2.5), 0).alias("b"),
                              round_even(F.lit(0.5), 0).alias("c"), round_even(F.lit(1.015), 2).alias("d")).first()
    assert (r.a, r.b, r.c) == (0.12, 2.0, 0.0)
    assert r.d == float(np.round(1.015, 2))


def test_split_sizes(spark):
    df = frame(spark, [float(i) for i in range(25)])
    c = {r["split"]: r["count"] for r in sp.split_train_test(df, 0.9).groupBy("split").count().collect()}
    assert c == {"train": 22, "test": 3}
    c3 = {r["split"]: r["count"] for r in sp.split_train_val_test(df).groupBy("split").count().collect()}
    assert c3 == {"train": 20, "val": 3, "test": 2}


def test_window_counts(spark):
    assert wn.sliding_windows(frame(spark, [float(i) for i in range(30)]), features=["ts"], targets=["ts"]).count() == 6
    assert wn.sliding_windows(frame(spark, [float(i) for i in range(24)]), features=["ts"], targets=["ts"]).count() == 0
    assert wn.seq2seq_windows(frame(spark, [float(i) for i in range(50)]), features=["ts"]).count() == 3
    assert wn.seq2seq_windows(frame(spark, [float(i) for i in range(47)]), features=["ts"]).count() == 0


@pytest.mark.parametrize("block", [5, 1 << 16])
def test_sliding_window_content_across_blocks(spark, block):
    n = 40
    w = wn.sliding_windows(frame(spark, [float(i) for i in range(n)]), features=["ts"], targets=["ts"],
                           length=4, block=block)
    rows = w.orderBy("pos").collect()
    assert len(rows) == n - 4
    for r in rows:
        assert [x["ts"] for x in r["x"]] == [float(r["pos"] - k) for k in (4, 3, 2, 1)]
        assert r["y_ts"] == float(r["pos"])


def test_lag_pairs(spark):
    out = wn.lag_supervised(frame(spark, [1.0, 2.0, 3.0, 4.0]), labels=["ts"])
    assert [(r["ts"], r["y_ts"]) for r in out.orderBy("pos").collect()] == [(1.0, 2.0), (2.0, 3.0), (3.0, 4.0)]


def test_difference_inverse_is_identity(spark):
    vals = [float(v) for v in np.cumsum(np.arange(30) % 7 - 3)]
    df = frame(spark, vals)
    d = wn.difference(df, values=["ts"], block=4)
    back = wn.undifference(d.select("series_id", "pos", "d_ts"), df.filter("pos = 0").select("series_id", "ts"),
                           values=["ts"], block=4)
    assert col_values(back, "ts") == vals


def test_with_position_two_level(spark):
    rows = [(0, T0 + dt.timedelta(days=d, hours=h)) for d in range(0, 40, 3) for h in (5, 1)]
    df = spark.createDataFrame(rows, "series_id long, utc timestamp_ntz")
    out = with_position(df, ["series_id"], chunk_seconds=86400 * 4).orderBy("utc").collect()
    assert [r["pos"] for r in out] == list(range(len(rows)))


def test_constant_series_has_no_ar1_forecast(spark):
    df = spark.createDataFrame([(0, t, i, 5.0, 1.0 * i, 2.0 * i) for i, t in enumerate(hours(10))],
                               "series_id long, utc timestamp_ntz, pos long, ts double, hr double, qfe double")
    fit = ar.ar1_fit(df).first()
    assert fit["ts_slope"] is None and fit["reason"] == "no slope: ts"


def test_day_first_parse(spark):
    r = spark.range(1).select(tf.parse_timestamp(F.lit("02-01-2021 00:00:00"), tf.DMY_HMS).alias("t")).first()
    assert r.t == dt.datetime(2021, 1, 2)


def test_join_with_duplicate_keys_multiplies(spark):
    a = spark.createDataFrame([(0, T0, float(i)) for i in range(2)], "series_id long, utc timestamp_ntz, ts double")
    b = spark.createDataFrame([(0, T0, float(i)) for i in range(3)], "series_id long, utc timestamp_ntz, hr double")
    assert jn.join_sources([a, b]).count() == 6


def test_overlay(spark):
    schema = "series_id long, utc timestamp_ntz, ts double"
    base = spark.createDataFrame([(0, T0, 1.0), (0, T0 + dt.timedelta(hours=1), 1.0)], schema)
    over = spark.createDataFrame([(0, T0, None), (0, T0 + dt.timedelta(hours=1), 2.0)], schema)
    assert col_values(jn.overlay_update(base, over, values=["ts"]), "ts", "utc") == [1.0, 2.0]


@pytest.mark.parametrize("first_step,hour", [(1, 6), (0, 5)])
def test_forecast_start(spark, first_step, hour):
    last = spark.createDataFrame([(0, T0.replace(hour=5))], "series_id long, utc timestamp_ntz")
    g = tf.future_grid(last, ["series_id"], horizon=3, first_step=first_step).orderBy("step").first()
    assert g["utc"].hour == hour


def test_daily_cycle_encoding(spark):
    df = spark.createDataFrame([(T0.replace(hour=6),)], "utc timestamp_ntz")
    assert abs(tf.cyclic_features(df).first()["dsin"] - 1.0) < 1e-9


def test_climatology_exact_level(spark):
    rows = [(0, dt.datetime(2023, 3, 4, 5), 10.0), (0, dt.datetime(2022, 3, 4, 5), 20.0),
            (0, dt.datetime(2022, 3, 9, 5), 40.0), (0, dt.datetime(2022, 7, 9, 5), 100.0)]
    df = spark.createDataFrame(rows, "series_id long, utc timestamp_ntz, ts double")
    fit = cl.climatology_fit(df, values=["ts"])
    grid = spark.createDataFrame([(0, 1, dt.datetime(2025, 3, 4, 5)), (0, 2, dt.datetime(2025, 3, 5, 5)),
                                  (0, 3, dt.datetime(2025, 8, 1, 5))], "series_id long, step int, utc timestamp_ntz")
    got = [r["ts"] for r in cl.climatology_forecast(fit, grid, values=["ts"]).orderBy("step").collect()]
    assert got == [15.0, (10 + 20 + 40) / 3, (10 + 20 + 40 + 100) / 4]


def test_gram_fit_matches_lstsq(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 4))
    y = x @ np.array([[1.0, -2.0], [0.5, 0.0], [0.0, 3.0], [2.0, 1.0]]) + rng.normal(scale=0.1, size=(500, 2))
    pdf = pd.DataFrame(np.hstack([x, y]), columns=["a", "b", "c", "d", "y1", "y2"])
    pdf["g"] = np.arange(500) % 2
    df = spark.createDataFrame(pdf).repartition(7)
    fit = linear_fit(df, ["g"], ["a", "b", "c", "d"], ["y1", "y2"], ridge=0.0)
    for r in fit.collect():
        sel = pdf[pdf.g == r["g"]]
        ref = np.linalg.lstsq(sel[["a", "b", "c", "d"]].to_numpy(), sel[["y1", "y2"]].to_numpy(), rcond=None)[0]
        assert np.allclose(np.array(r["coef"]), ref, atol=1e-9)


def test_ar_diff_fit_matches_lstsq(spark):
    rng = np.random.default_rng(5)
    n, p = 200, 3
    lvl = np.cumsum(rng.normal(size=n))
    df = frame(spark, [float(v) for v in lvl])
    fit = ar.ar_diff_fit(df.withColumns({"hr": F.col("ts"), "qfe": F.col("ts")}), p=p, ridge=0.0)
    coef = np.array(fit.filter("variable = 'ts'").first()["coef"])
    d = np.diff(lvl)
    X = np.column_stack([d[p - j - 1:len(d) - j - 1] for j in range(p)])
    ref = np.linalg.lstsq(X, d[p:], rcond=None)[0]
    assert np.allclose(coef, ref, atol=1e-8)
