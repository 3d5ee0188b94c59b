"""ARMA(p,1) on differences against direct loops in numpy."""

import datetime as dt

import numpy as np
import pytest

from sensorcast.models import arma
from sensorcast.operators.affine import affine_across_blocks
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "series_id long, utc timestamp_ntz, pos long, ts double, hr double"


def simulated(n, phi, theta, seed):
    e = np.random.default_rng(seed).normal(size=n)
    d = np.zeros(n)
    for i in range(n):
        d[i] = sum(c * d[i - j] for j, c in enumerate(phi, 1) if i >= j) + e[i] + (theta * e[i - 1] if i else 0.0)
    return np.concatenate([[100.0], 100.0 + np.cumsum(d)])


def residuals(level, coef):
    d, p, e = np.diff(level), len(coef) - 1, {}
    for i in range(p, len(d)):
        e[i + 1] = d[i] - sum(coef[j - 1] * d[i - j] for j in range(1, p + 1)) - coef[-1] * e.get(i, 0.0)
    return e


@pytest.fixture(scope="module")
def frame(spark):
    data = {0: (simulated(2000, [0.6], 0.4, 1), simulated(2000, [0.3], -0.7, 2)),
            1: (simulated(400, [-0.5], 0.5, 3), np.full(401, 7.0))}
    rows = [(s, T0 + dt.timedelta(hours=i), i, float(a[i]), float(b[i])) for s, (a, b) in data.items() for i in range(len(a))]
    rows += [(3, T0 + dt.timedelta(hours=i), i, float(data[1][0][i]) if i != 50 else None, float(data[1][0][i - 9]) if i > 8 else None)
             for i in range(300)]
    rows += [(2, T0 + dt.timedelta(hours=i), i, 1.0 + i * i, None) for i in range(3)]
    return data, spark.createDataFrame(rows, SCHEMA)


def fitted(df, block):
    return {(r.series_id, r.variable): r for r in arma.arma_fit(df, p=1, values=["ts", "hr"], block=block).collect()}


def test_recovers_simulated_models_whatever_the_blocks(frame):
    data, df = frame
    one, many = fitted(df, 1 << 16), fitted(df, 97)
    for key, truth in {(0, "ts"): (0.6, 0.4), (0, "hr"): (0.3, -0.7)}.items():
        assert one[key].converged and np.allclose(one[key].coef, truth, atol=0.08)
    for key, r in one.items():
        assert (r.coef is None) == (many[key].coef is None)
        if r.coef is None:
            assert r.reason
            continue
        assert np.allclose(r.coef, many[key].coef, atol=1e-6) and r.n == many[key].n
        level = data[1][0][:291] if key[0] == 3 else data[key[0]][0 if key[1] == "ts" else 1]
        e = residuals(level, r.coef)
        assert r.n == len(e) and np.isclose(r.sse, sum(v * v for v in e.values()), rtol=1e-9)
        assert np.isclose(r.last_resid, e[max(e)], atol=1e-8)
        for i in (0, 1):  # no neighbour has a smaller sum of squares
            for step in (-2e-3, 2e-3):
                near = np.array(r.coef)
                near[i] += step
                assert sum(v * v for v in residuals(level, near).values()) > r.sse
    assert one[1, "hr"].coef is None and one[2, "ts"].coef is None
    assert one[3, "ts"].reason == "missing values" and one[3, "hr"].coef is not None  # a hole; leading nulls


def test_residuals_and_forecast(frame, spark):
    data, df = frame
    df = df.where("series_id < 3")
    fit = arma.arma_fit(df, p=1, values=["ts", "hr"])
    coef = {(r.series_id, r.variable): r for r in fit.collect() if r.coef is not None}
    got = {}
    for r in arma.arma_residuals(df, fit, p=1, values=["ts", "hr"], block=61).collect():
        got.setdefault((r.series_id, r.variable), {})[r.pos] = r.resid
    assert set(got) == set(coef)
    for key, r in coef.items():
        want = residuals(data[key[0]][0 if key[1] == "ts" else 1], r.coef)
        assert set(want) == set(got[key]) and all(abs(want[i] - got[key][i]) < 1e-8 for i in want)
    steps = {}
    for r in arma.arma_forecast(fit, df, p=1, horizon=5, values=["ts", "hr"]).collect():
        steps[r.series_id, r.variable, r.step] = r.value
    for (s, v), r in coef.items():
        level = data[s][0 if v == "ts" else 1]
        x, d, e = level[-1], level[-1] - level[-2], r.last_resid
        for i in range(1, 6):
            d, e = r.coef[0] * d + r.coef[1] * e, 0.0
            x += d
            assert abs(steps[s, v, i] - x) < 1e-7


def test_affine_scan_with_holes_nulls_and_many_blocks(spark):
    u = {0: [1.0, None, 3.0, -2.0, 0.5, 4.0], 1: [2.0] * 5000, 2: [None]}
    a = {0: 0.5, 1: -0.9, 2: 0.3}
    rows = [(k, 3 * i, a[k], v) for k, vs in u.items() for i, v in enumerate(vs)] + [(3, 0, None, 1.0)]
    df = spark.createDataFrame(rows, "k long, pos long, a double, u double")
    got = {(r.k, r.pos): r.y for r in affine_across_blocks(df, ["k"], F.col("a"), F.col("u"), block=7).collect()}
    assert len(got) == sum(map(len, u.values()))
    for k, vs in u.items():
        y = 0.0
        for i, v in enumerate(vs):
            y = a[k] * y + (v or 0.0)
            assert abs(got[k, 3 * i] - y) < 1e-9
    assert affine_across_blocks(df.limit(0), ["k"], F.col("a"), F.col("u")).count() == 0
