"""The forest of several labels against a brute-force tree."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from sensorcast.models import joint_forest as jf

FEATURES, LABELS = ["a", "b"], ["y0", "y1", "y2"]


def table(spark, n=240, parts=3):
    g = np.random.default_rng(5)
    a, b = g.integers(0, 15, n), g.integers(0, 9, n)
    y = np.column_stack([np.sin(a) * 3, (b > 4) * 2.0, a * b / 20.0]) + g.normal(size=(n, 3)) / 4
    rows = [(0 if i % 3 else 1, i, float(a[i]), float(b[i]), *map(float, y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "series_id long, pos long, a double, b double, y0 double, y1 double, y2 double")
    return np.column_stack([a, b]).astype(float), y, df.repartition(parts)


def grown(x, y, w, depth, min_leaf):
    """Leaf means of a tree that tries every cut: a function of a row."""
    mean = (w[:, None] * y).sum(0) / w.sum()
    best = None
    for f in range(x.shape[1]) if depth else ():
        v = np.unique(x[w > 0, f])
        for c in (v[1:] + v[:-1]) / 2:
            left = x[:, f] <= c
            parts = [w * left, w * ~left]
            if min(p.sum() for p in parts) < min_leaf:
                continue
            sse = sum((p[:, None] * (y - (p[:, None] * y).sum(0) / p.sum()) ** 2).sum() for p in parts)
            if best is None or sse < best[0] - 1e-9:
                best = (sse, f, c, parts)
    if best is None:
        return lambda row: mean
    _, f, c, parts = best
    l, r = (grown(x, y, p, depth - 1, min_leaf) for p in parts)
    return lambda row: l(row) if row[f] <= c else r(row)


def test_equals_a_brute_force_tree(spark):
    x, y, df = table(spark)
    nodes = jf.fit(df, FEATURES, LABELS, num_trees=1, max_depth=4, min_leaf=5, bootstrap=False)
    tree = grown(x, y, np.ones(len(x)), 4, 5)
    got = {r.pos: [r.y0_pred, r.y1_pred, r.y2_pred] for r in jf.predict(nodes, df, FEATURES, LABELS, ["pos"]).collect()}
    assert len(got) == len(x) and all(np.allclose(got[i], tree(x[i]), atol=1e-9) for i in got)


def test_bootstrap_does_not_depend_on_partitions_or_passes(spark, monkeypatch):
    x, y, df = table(spark)

    def model(parts):
        nodes = jf.fit(df.repartition(parts), FEATURES, LABELS, num_trees=3, max_depth=3, min_leaf=4)
        return sorted((r.tree, r.id, r.left, r.feature, r.threshold, tuple(np.round(r.value, 9))) for r in nodes.collect())
    one = model(1)
    monkeypatch.setattr(jf, "NODES_PER_PASS", 4)
    assert one == model(7)
    keys = {r.pos: r.k for r in df.select("pos", F.xxhash64("series_id", "pos").alias("k")).collect()}
    key = np.array([keys[i] for i in range(len(x))])
    trees = [grown(x, y, jf.draws(key, t, 42), 3, 4) for t in range(3)]
    forest = jf.arrays(jf.fit(df, FEATURES, LABELS, num_trees=3, max_depth=3, min_leaf=4))
    want = np.mean([[t(r) for r in x] for t in trees], axis=0)
    close = np.isclose(jf.forest_means(forest, x), want, atol=1e-9).all(axis=1)
    assert close.mean() > 0.95  # a cut in a gap of a resampled tree lies elsewhere in the gap
    many = jf.draws(np.arange(200000), 0, 1)
    assert abs(many.mean() - 1) < 0.01 and abs(many.var() - 1) < 0.02


def test_empty_null_and_constant(spark):
    _, _, df = table(spark, 20)
    assert jf.fit(df.limit(0), FEATURES, LABELS).count() == 0
    flat = jf.fit(df.withColumns({"y0": F.lit(1.0), "y1": F.lit(2.0), "y2": F.lit(3.0)}), FEATURES, LABELS, num_trees=2)
    assert [r.value for r in flat.collect()] == [[1.0, 2.0, 3.0]] * 2
    start = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1.0, 2.0, 3.0), (2, dt.datetime(2024, 1, 1), None, 2.0, 3.0)],
                                  "series_id long, utc timestamp_ntz, ts double, hr double, qfe double")
    out = jf.rollout(flat, start, horizon=3).collect()
    assert [(r.series_id, r.step, r.ts, r.hr, r.qfe) for r in out] == [(1, i, 1.0, 2.0, 3.0) for i in (1, 2, 3)]
    assert out[2].utc == dt.datetime(2024, 1, 1, 3)
