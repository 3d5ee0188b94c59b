"""Exact quantiles, smooth density and mini-batches against numpy and pandas."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorcast.operators import explore as ex
from sensorcast.operators import stats as st
from sensorcast.operators import windows as wn
from sensorcast.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def test_exact_quantiles(spark):
    rng = np.random.default_rng(1)
    groups = {("a", 1): rng.normal(size=3000), ("b", 1): np.repeat(7.5, 2000), ("b", 2): np.r_[np.zeros(900), rng.integers(0, 5, 601)],
              ("c", 1): [3.0], ("c", 2): [1.0, 2.0], (None, 3): rng.normal(size=50)}
    rows = [(k, m, float(v)) for (k, m), vs in groups.items() for v in vs] + [("a", 1, None), ("z", 9, None)]
    df = spark.createDataFrame(rows, "k string, m int, value double").repartition(6)
    got = {(r.k, r.m): r.q for r in exact_quantiles(df, ["k", "m"], PROBS).collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        assert np.allclose(got[g], np.quantile(vs, PROBS), rtol=1e-12, atol=1e-12)
    everything = exact_quantiles(df, [], [0.5]).collect()
    assert np.isclose(everything[0].q[0], np.median(np.concatenate(list(groups.values()))))
    assert exact_quantiles(df.limit(0), ["k"], [0.5]).count() == 0


def test_quantiles_are_spread_over_tasks(spark):
    """One group of many values: the ranked partitions hold a small part of it."""
    df = spark.range(40_000).select(F.lit("one").alias("k"), (F.xxhash64("id") % 1_000_003).cast("double").alias("value"))
    out = exact_quantiles(df, ["k"], [0.5])
    assert "percentile" not in out._jdf.queryExecution().toString()
    assert out.first().q == [df.agg(F.percentile("value", 0.5)).first()[0]]


def test_summary_keeps_all_null_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None)], "ts double, hr double")
    got = {r.variable: r for r in st.summary_stats(df, ["ts", "hr"]).collect()}
    assert (got["ts"].q1, got["ts"].median, got["ts"].q3) == (1.5, 2.0, 3.0)
    assert got["hr"].median is None and got["hr"].na == 3


def test_smooth_density_equals_direct_sum(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=4000), rng.gamma(2.0, size=4000)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0)], "a double, b double").repartition(4)
    got = {(round(r.x_point, 9), round(r.y_point, 9)): r.density for r in ex.smooth_density(df, "a", "b", points=15).collect()}
    h = [1.06 * v.std(ddof=1) * len(v) ** -0.2 for v in (x, y)]
    edges = [(v.min(), v.max()) for v in (x, y)]
    centres = [lo + (np.clip(np.floor((v - lo) * 100 / (hi - lo)), 0, 99) + 0.5) * (hi - lo) / 100 for v, (lo, hi) in zip((x, y), edges)]
    worst = 0.0
    for gx in np.linspace(*edges[0], 15):
        for gy in np.linspace(*edges[1], 15):
            k = lambda u, v: (np.exp(-0.5 * ((gx - u) / h[0]) ** 2 - 0.5 * ((gy - v) / h[1]) ** 2)).mean() / (2 * np.pi * h[0] * h[1])
            assert np.isclose(got[round(gx, 9), round(gy, 9)], k(*centres), rtol=1e-9)  # the binned rows, exactly
            worst = max(worst, abs(k(x, y) - k(*centres)))
    assert len(got) == 225 and worst < 0.02 * max(got.values())  # close to the rows themselves
    assert ex.smooth_density(df.limit(0), "a", "b").count() == 0
    assert ex.smooth_density(df.where("a is null"), "a", "b").count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 31, 32, 33, 100, 257, 5000])
def test_permutation_is_one_to_one(spark, n):
    got = [r[0] for r in spark.range(n).select(wn.permuted(F.col("id"), n)).collect()]
    assert sorted(got) == list(range(n))
    if n == 5000:
        assert abs(np.corrcoef(np.arange(n), got)[0, 1]) < 0.05 and got != [r[0] for r in spark.range(n).select(wn.permuted(F.col("id"), n, 7)).collect()]


def test_shuffled_batches(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("series_id"), F.timestamp_add("HOUR", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("utc"))
    out = wn.shuffled_batches(df)
    rows = out.collect()
    assert len({(r.series_id, r.utc) for r in rows}) == 1000
    assert sorted((r.batch, r.place) for r in rows) == [(i // 32, i % 32) for i in range(1000)]
    assert sorted(map(tuple, wn.shuffled_batches(df.repartition(5)).collect())) == sorted(map(tuple, rows))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert wn.shuffled_batches(df.limit(0)).count() == 0
