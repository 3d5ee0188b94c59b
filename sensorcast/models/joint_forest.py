"""One regression forest for several labels (M5): a split lowers the summed variance of all of them.

Trees grow level by level from histograms.  Each task bins its rows and sums
``(weight, labels, squares)`` per ``(open node, feature, bin)`` with numpy; the
sums are combined by a grouped aggregation, and the best cut of each node is
found by a running sum over the bins.  Rows are never moved or sorted, so a
station with a third of all rows costs no more than any other rows.  A row's
bootstrap count (Poisson, mean 1) comes from a hash of its key and the tree,
so the forest does not depend on the partitioning.

Bounds: at most ``NODES_PER_PASS`` nodes are summed in a pass, a tree has
fewer than ``2 ** (max_depth + 1)`` nodes, and a feature ``max_bins`` bins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorcast.functions.time import calendar_features
from sensorcast.operators import windows as wn
from sensorcast.session import write_and_read

KEYS = ["series_id"]
VALUES = ["ts", "hr", "qfe"]
CALENDAR = ["hour", "day", "month"]
NODES_PER_PASS = 2048
POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1.0, k + 1)) for k in range(12)])


def pairs(df: DataFrame, keys: list[str] = KEYS, split_col: str | None = None, values: list[str] = VALUES,
          year: bool = False) -> tuple[DataFrame, list[str]]:
    """Rows of values and calendar with the next row's values ``y_*``, and the names of the features.

    Pairs are formed before the cut: the pair of the last training row belongs
    to the part of its own row.  Rows with a null are left out.
    """
    features = [*values, *CALENDAR, *(["year"] if year else [])]
    out = wn.lag_supervised(calendar_features(df, year=year), keys=list(keys), labels=values)
    return out.dropna(subset=[*features, *[f"y_{v}" for v in values]]), features


def bin_edges(rows: DataFrame, features: list[str], max_bins: int = 64) -> list[np.ndarray]:
    """Cut points per feature: between neighbouring values when there are at most ``max_bins``, else quantiles."""
    counts = rows.agg(*[F.count_distinct(f).alias(f) for f in features]).first()
    edges = []
    for f in features:
        if counts[f] <= max_bins:
            v = np.array(sorted(float(r[0]) for r in rows.select(f).distinct().limit(max_bins).collect()))
            edges.append((v[1:] + v[:-1]) / 2)
        else:
            at = [i / max_bins for i in range(1, max_bins)]
            v = rows.agg(F.percentile_approx(F.col(f).cast("double"), at, 100 * max_bins)).first()[0]
            edges.append(np.unique(np.array(v, float)))
    return edges


def _bin(feature: str, edges: np.ndarray) -> Column:
    """The number of cut points below the feature."""
    cuts = F.array(*[F.lit(float(c)) for c in edges]).cast("array<double>")
    return F.size(F.filter(cuts, lambda c: F.col(feature).cast("double") > c))


def draws(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Poisson(1) counts of rows in a tree, from a mixed 64-bit hash of row, tree and seed."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.int64).view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (tree + 1) + seed) % 2 ** 64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return np.searchsorted(POISSON, (z >> np.uint64(11)).astype(float) / 2.0 ** 53, side="right").astype(float)


def _leaves(tree: dict, bins: np.ndarray) -> np.ndarray:
    """The node each binned row has reached."""
    feature, cut, left = (np.array(tree[k]) for k in ("feature", "cut", "left"))
    at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while True:
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            return at
        at = np.where(inner, left[at] + (bins[rows, np.maximum(f, 0)] > cut[at]), at)


def _best_cuts(rows: DataFrame, trees: list[dict], work: list[tuple[int, int]], n_features: int, n_bins: int, m: int,
               seed: int, bootstrap: bool, min_leaf: float) -> dict[int, tuple]:
    """The best cut of each open node: slot -> (feature, bin, left sums, right sums); at most ``NODES_PER_PASS`` rows."""
    stats = [f"s{i}" for i in range(m + 1)]  # weight, then label sums
    schema = "slot int, feature int, bin int, " + ", ".join(f"{s} double" for s in stats)
    by_tree: dict[int, dict[int, int]] = {}
    for slot, (tree, node) in enumerate(work):
        by_tree.setdefault(tree, {})[node] = slot
    plan = rows.sparkSession.sparkContext.broadcast(({t: trees[t] for t in by_tree}, by_tree))

    def sums(batches):
        some, wanted = plan.value
        hist = np.zeros((len(work) * n_features * n_bins, m + 1))
        for batch in batches:
            if batch.empty:
                continue
            bins, y = np.stack(batch["bins"].to_numpy()), np.stack(batch["y"].to_numpy())
            keys = batch["row_key"].to_numpy()
            for t, slots in wanted.items():
                table = np.full(len(some[t]["feature"]), -1)
                table[list(slots)] = list(slots.values())
                slot = table[_leaves(some[t], bins)]
                w = draws(keys, t, seed) if bootstrap else np.ones(len(keys))
                use = np.flatnonzero((slot >= 0) & (w > 0))
                wy = np.column_stack([w[use], w[use, None] * y[use]])
                for f in range(n_features):
                    cell = (slot[use] * n_features + f) * n_bins + bins[use, f]
                    low = np.unique(cell, return_inverse=True)
                    for i in range(m + 1):
                        hist[low[0], i] += np.bincount(low[1], wy[:, i], len(low[0]))
        cell = np.flatnonzero(hist[:, 0])
        for part in np.array_split(cell, max(1, len(cell) // 65536)):
            yield pd.DataFrame({"slot": (part // (n_features * n_bins)).astype(np.int32),
                                "feature": (part // n_bins % n_features).astype(np.int32), "bin": (part % n_bins).astype(np.int32),
                                **{s: hist[part, i] for i, s in enumerate(stats)}})

    hist = rows.mapInPandas(sums, schema).groupBy("slot", "feature", "bin").agg(*[F.sum(s).alias(s) for s in stats])
    w = Window.partitionBy("slot", "feature")
    run = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    cum = hist.select("slot", "feature", "bin", *[F.sum(s).over(run).alias(f"l{i}") for i, s in enumerate(stats)],
                      *[F.sum(s).over(w).alias(f"t{i}") for i, s in enumerate(stats)])
    right = [F.col(f"t{i}") - F.col(f"l{i}") for i in range(m + 1)]
    gain = sum((F.col(f"l{i}") ** 2 / F.col("l0") + right[i] ** 2 / right[0] - F.col(f"t{i}") ** 2 / F.col("t0") for i in range(1, m + 1)), F.lit(0.0))
    cuts = cum.where((F.col("l0") >= min_leaf) & (F.col("t0") - F.col("l0") >= min_leaf) & (F.col("t0") > F.col("l0"))).select(
        "slot", "feature", "bin", gain.alias("gain"), F.array(*[F.col(f"l{i}") for i in range(m + 1)]).alias("l"), F.array(*right).alias("r"))
    best = cuts.where("gain > 1e-9").groupBy("slot").agg(
        F.max_by(F.struct("feature", "bin", "l", "r"), F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("b"))
    out = {r.slot: (r.b.feature, r.b.bin, np.array(r.b.l), np.array(r.b.r)) for r in best.collect()}
    plan.unpersist()
    return out


def fit(rows: DataFrame, features: list[str], labels: list[str], num_trees: int = 20, max_depth: int = 8, max_bins: int = 64,
        min_leaf: int = 1, seed: int = 42, bootstrap: bool = True, row_key: list[str] | None = None) -> DataFrame:
    """The forest as a table ``(tree, id, left, feature, threshold, value)``.

    ``left`` is the left child (the right one follows it), -1 in leaves; a row
    goes left when its feature is at most ``threshold``; ``value`` holds one
    mean a label.  ``row_key`` (default: series and position) identifies a row
    for the bootstrap.  Rows with a null feature or label are left out; without
    rows there are no nodes.
    """
    spark, m = rows.sparkSession, len(labels)
    schema = "tree int, id int, left int, feature int, threshold double, value array<double>"
    rows = rows.dropna(subset=[*features, *labels])
    mean = rows.agg(*[F.avg(v) for v in labels]).first()
    if mean[0] is None:
        return spark.createDataFrame([], schema)
    edges = bin_edges(rows, features, max_bins)
    n_bins = max(len(e) for e in edges) + 1
    binned = F.array(*[_bin(f, e) for f, e in zip(features, edges)])
    centred = F.array(*[F.col(v).cast("double") - F.lit(float(a)) for v, a in zip(labels, mean)])
    data = write_and_read(rows.select(F.xxhash64(*(row_key or [*KEYS, "pos"])).alias("row_key"), binned.alias("bins"),
                                      centred.alias("y")), "joint-forest")
    trees = [{"feature": [-1], "cut": [0], "left": [-1], "value": [np.zeros(m)]} for _ in range(num_trees)]
    level = [(t, 0) for t in range(num_trees)]
    for _ in range(max_depth):
        following = []
        for start in range(0, len(level), NODES_PER_PASS):
            work = level[start:start + NODES_PER_PASS]
            cuts = _best_cuts(data, trees, work, len(features), n_bins, m, seed, bootstrap, min_leaf)
            for slot, (f, b, l, r) in sorted(cuts.items()):
                t, node = work[slot]
                tree, child = trees[t], len(trees[t]["feature"])
                tree["feature"][node], tree["cut"][node], tree["left"][node] = f, b, child
                if node == 0:
                    tree["value"][0] = (l + r)[1:] / (l + r)[0]
                for s in (l, r):
                    tree["feature"].append(-1)
                    tree["cut"].append(0)
                    tree["left"].append(-1)
                    tree["value"].append(s[1:] / s[0])
                following += [(t, child), (t, child + 1)]
        level = following
        if not level:
            break
    out = [(t, i, tree["left"][i], f, float(edges[f][tree["cut"][i]]) if f >= 0 else None, (tree["value"][i] + mean).tolist())
           for t, tree in enumerate(trees) for i, f in enumerate(tree["feature"])]
    return write_and_read(spark.createDataFrame(out, schema), "joint-forest-nodes")


# ------------------------------------------------------------------ prediction

def arrays(nodes: DataFrame) -> dict[str, np.ndarray]:
    """The nodes as flat arrays; their number is bounded by ``num_trees * 2 ** (max_depth + 1)``."""
    n = nodes.toPandas().sort_values(["tree", "id"])
    tree = n["tree"].to_numpy()
    root = np.flatnonzero(n["id"].to_numpy() == 0)
    base = root[np.searchsorted(tree[root], tree)] if len(n) else np.zeros(0, int)
    return {"root": root, "left": n["left"].to_numpy() + base, "feature": n["feature"].to_numpy(),
            "threshold": n["threshold"].fillna(0.0).to_numpy(float),
            "value": np.stack(n["value"].to_numpy()) if len(n) else np.zeros((0, 0))}


def forest_means(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Mean over the trees, one column a label."""
    rows, total = np.arange(len(x)), np.zeros((len(x), forest["value"].shape[1]))
    for root in forest["root"]:
        at = np.full(len(x), root)
        while True:
            f = forest["feature"][at]
            inner = f >= 0
            if not inner.any():
                break
            at = np.where(inner, forest["left"][at] + (x[rows, np.maximum(f, 0)] > forest["threshold"][at]), at)
        total += forest["value"][at]
    return total / max(len(forest["root"]), 1)


def predict(nodes: DataFrame, rows: DataFrame, features: list[str], labels: list[str], keep: list[str]) -> DataFrame:
    """``keep`` and one ``<label>_pred`` a label; rows with a null feature and forests without nodes give none."""
    forest = arrays(nodes)
    src = rows.dropna(subset=features).select(*keep, *[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)])
    schema = T.StructType([*src.select(*keep).schema, *[T.StructField(f"{v}_pred", T.DoubleType()) for v in labels]])
    if not len(forest["root"]):
        return rows.sparkSession.createDataFrame([], schema)
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    def score(batches):
        for batch in batches:
            p = forest_means(shared.value, batch[[f"_f{i}" for i in range(len(features))]].to_numpy(float))
            yield batch[keep].assign(**{f"{v}_pred": p[:, i] for i, v in enumerate(labels)})
    return src.mapInPandas(score, schema)


def rollout(nodes: DataFrame, start: DataFrame, horizon: int = 72, values: list[str] = VALUES, keys: list[str] = KEYS,
            time_col: str = "utc", year: bool = False) -> DataFrame:
    """Each start row fed back hour by hour, all series in one pass; start rows with a null give no rows."""
    forest = arrays(nodes)
    state = start.dropna(subset=values).select(*keys, F.col(time_col).cast("timestamp_ntz").alias(time_col),
                                               *[F.col(v).cast("double").alias(v) for v in values])
    schema = T.StructType([*[state.schema[k] for k in keys], T.StructField("step", T.IntegerType()), state.schema[time_col],
                           *[T.StructField(v, T.DoubleType()) for v in values]])
    if not len(forest["root"]):
        return start.sparkSession.createDataFrame([], schema)
    shared = start.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        for batch in batches:
            now, x = batch[time_col], batch[values].to_numpy(dtype=float)
            for i in range(1, horizon + 1):
                calendar = [now.dt.hour, now.dt.day, now.dt.month, *([now.dt.year] if year else [])]
                x = forest_means(shared.value, np.column_stack([x, *calendar]).astype(float))
                now = now + pd.Timedelta(hours=1)
                yield batch[keys].assign(step=np.int32(i), **{time_col: now}, **{v: x[:, j] for j, v in enumerate(values)})
    return state.mapInPandas(run, schema)
