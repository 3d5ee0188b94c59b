"""Global models fitted on all series together, and MLlib models.

* ``cyclic_regression`` (M2): MLlib ``LinearRegression`` of each variable on
  the cyclic encodings, one model per variable.
* ``window_regression`` (M6): the 24 x 6 window (values + calendar) flattened
  to 144 features -> the three next values; one multi-output least squares
  from summed Gram entries (``models.gram``).
* ``direct_multihorizon`` (M7): 24 rows x 5 columns -> the next 24 rows x 3
  values in one solve (121 x 72 normal equations); ``rollout_block`` (M8b)
  applies it block after block.
* ``forest`` (M5): MLlib ``RandomForestRegressor``, one per label (MLlib is
  single-output), and its hour-by-hour roll-out in one pass.
* ``PipelineModel`` save/load and ``predict_batch_udf`` scoring (M9, M10).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import predict_batch_udf
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorcast.functions.time import calendar_features, cyclic_features, step_time
from sensorcast.models.gram import linear_fit
from sensorcast.operators import windows as wn
from sensorcast.operators.position import DEFAULT_BLOCK
from sensorcast.operators.scale import attach_one_row
from sensorcast.session import scratch_path, write_and_read

KEYS = ["series_id"]
VALUES = ["ts", "hr", "qfe"]
CAL = ["hour", "day", "month"]
CYCLIC = ["dsin", "ysin"]


def dot(coef_rows: Column, x: Column) -> Column:
    """``x @ W`` for W given as ``array<array<double>>`` (row i = feature i): one value per output."""
    m = F.size(F.element_at(coef_rows, 1))
    return F.transform(F.sequence(F.lit(1), m), lambda j: F.aggregate(
        F.zip_with(x, coef_rows, lambda xi, wi: xi * F.element_at(wi, j)), F.lit(0.0), lambda a, b: a + b))


# ------------------------------------------------------------------ M2

def cyclic_regression_fit(df: DataFrame, values: list[str] = VALUES, time_col: str = "utc") -> dict:
    """One MLlib linear model per variable on ``dsin, ysin`` (exact normal-equation solver)."""
    feats = VectorAssembler(inputCols=CYCLIC, outputCol="features")
    data = feats.transform(cyclic_features(df, time_col))
    return {v: LinearRegression(featuresCol="features", labelCol=v, predictionCol=f"{v}_pred",
                                solver="normal", regParam=0.0).fit(data.filter(F.col(v).isNotNull()))
            for v in values}


def cyclic_regression_predict(models: dict, grid: DataFrame, time_col: str = "utc") -> DataFrame:
    out = VectorAssembler(inputCols=CYCLIC, outputCol="features").transform(cyclic_features(grid, time_col))
    for m in models.values():
        out = m.transform(out)
    return out.drop("features")


# ------------------------------------------------------------------ M6

WINDOW_FEATURES = VALUES + CAL


def window_frame(df: DataFrame, keys: list[str] = KEYS, length: int = 24, split_col: str | None = None) -> DataFrame:
    """Flat 24 x 6 windows and the next values (windows built per split part)."""
    part = [*keys, split_col] if split_col else list(keys)
    h = calendar_features(df, year=False)
    w = wn.sliding_windows(h, keys=part, features=WINDOW_FEATURES, targets=VALUES, length=length)
    return w.withColumn("xflat", wn.flatten_window("x", WINDOW_FEATURES)).drop("x")


def window_regression_fit(windows: DataFrame, length: int = 24, ridge: float = 1e-6) -> DataFrame:
    """One multi-output least-squares model on all series (global, one row)."""
    k = length * len(WINDOW_FEATURES)
    xcols = [f"x{i}" for i in range(k)]
    flat = windows.select(*[F.col("xflat")[i].alias(xcols[i]) for i in range(k)],
                          *[F.col(f"y_{v}") for v in VALUES])
    return linear_fit(flat, [], xcols, [f"y_{v}" for v in VALUES], ridge=ridge, intercept=True)


def window_regression_predict(fit: DataFrame, windows: DataFrame) -> DataFrame:
    x = F.concat(F.col("xflat"), F.array(F.lit(1.0)))
    out = attach_one_row(windows, fit.select("coef")).withColumn("_p", dot(F.col("coef"), x))
    return out.select(*[c for c in windows.columns if c != "xflat"],
                      *[F.col("_p")[i].alias(f"{v}_pred") for i, v in enumerate(VALUES)])


# ------------------------------------------------------------------ M7, M8b

S2S_FEATURES = VALUES + CYCLIC


def seq2seq_frame(df: DataFrame, keys: list[str] = KEYS, width: int = 24) -> DataFrame:
    h = cyclic_features(df)
    w = wn.seq2seq_windows(h, keys=keys, features=S2S_FEATURES, label_columns=VALUES,
                           input_width=width, label_width=width, shift=width)
    return w.select(*keys, "utc", "pos", wn.flatten_window("inputs", S2S_FEATURES).alias("xflat"),
                    wn.flatten_window("labels", VALUES).alias("yflat"))


def direct_multihorizon_fit(frame: DataFrame, width: int = 24, ridge: float = 1e-6) -> DataFrame:
    k, m = width * len(S2S_FEATURES), width * len(VALUES)
    xcols, ycols = [f"x{i}" for i in range(k)], [f"y{j}" for j in range(m)]
    flat = frame.select(*[F.col("xflat")[i].alias(xcols[i]) for i in range(k)],
                        *[F.col("yflat")[j].alias(ycols[j]) for j in range(m)])
    return linear_fit(flat, [], xcols, ycols, ridge=ridge, intercept=True)


def direct_multihorizon_predict(fit: DataFrame, frame: DataFrame) -> DataFrame:
    x = F.concat(F.col("xflat"), F.array(F.lit(1.0)))
    return attach_one_row(frame, fit.select("coef")).withColumn("pred", dot(F.col("coef"), x)).drop("coef")


def rollout_block(fit: DataFrame, history: DataFrame, keys: list[str] = KEYS, width: int = 24,
                  blocks: int = 3, time_col: str = "utc") -> DataFrame:
    """Apply the width -> width model ``blocks`` times, feeding each predicted block
    (with the cyclic encodings of its future hours) back as the next input."""
    last = wn.tail_slice(history, keys=keys, last=width)
    last = cyclic_features(last)
    state = last.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("pos", *S2S_FEATURES))).alias("_rows"),
        F.max(time_col).alias("_t0"))
    state = state.select(*keys, "_t0", F.flatten(F.transform("_rows", lambda r: F.array(
        *[r[f] for f in S2S_FEATURES]))).alias("xflat"))
    out = []
    day, year = 2 * np.pi / 86400, 2 * np.pi / (365.2425 * 86400)
    for b in range(blocks):
        pred = direct_multihorizon_predict(fit, state)
        rows = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.struct(
            (i + 1 + b * width).alias("step"),
            *[F.element_at("pred", i * len(VALUES) + j + 1).alias(v) for j, v in enumerate(VALUES)]))
        pred = pred.withColumn("_rows", rows)
        out.append(pred.select(*keys, "_t0", F.inline("_rows")))
        # next input: predicted values + encodings of their times
        t = lambda i: F.unix_seconds(step_time("_t0", i + 1 + b * width).cast("timestamp")).cast("double")
        nxt = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.array(
            *[F.element_at("pred", i * len(VALUES) + j + 1) for j in range(len(VALUES))],
            F.sin(t(i) * day), F.sin(t(i) * year))))
        state = write_and_read(pred.select(*keys, "_t0", nxt.alias("xflat")), "block-state")
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res.select(*keys, "step", step_time("_t0", F.col("step")).alias(time_col), *VALUES)


# ------------------------------------------------------------------ M5 forest

FOREST_FEATURES = VALUES + CAL
# rows that go down the trees of a forest at a time: a few arrays of rows x trees
ROWS_DOWN = 4096


def forest_pairs(df: DataFrame, keys: list[str] = KEYS, split_col: str | None = None) -> DataFrame:
    part = [*keys, split_col] if split_col else list(keys)
    pairs = wn.lag_supervised(calendar_features(df, year=False), keys=part, labels=VALUES).dropna(
        subset=FOREST_FEATURES + [f"y_{v}" for v in VALUES])
    return VectorAssembler(inputCols=FOREST_FEATURES, outputCol="features").transform(pairs)


def forest_fit(pairs: DataFrame, num_trees: int = 100, max_depth: int = 30, seed: int = 42, min_leaf: int = 1) -> dict:
    """One forest per label (MLlib forests are single-output; the split choice
    therefore differs from a joint multi-output forest).  Rows are repartitioned
    by station and position block and sorted first, so the fit does not depend
    on input partitioning and a long station is spread over tasks.  A forest
    has at most ``2 * rows / min_leaf`` nodes a tree."""
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    data = (pairs.repartition(parts, "series_id", F.floor(F.col("pos") / DEFAULT_BLOCK))
            .sortWithinPartitions("series_id", "pos"))
    # the three fits read one written copy of the pairs, not the pipeline three times
    data = write_and_read(data, "forest-pairs")
    return {v: RandomForestRegressor(featuresCol="features", labelCol=f"y_{v}", predictionCol=f"{v}_pred",
                                     numTrees=num_trees, maxDepth=max_depth, featureSubsetStrategy="all",
                                     minInstancesPerNode=min_leaf, maxMemoryInMB=1024, seed=seed).fit(data) for v in VALUES}


def forest_predict(models: dict, pairs: DataFrame) -> DataFrame:
    out = pairs
    for m in models.values():
        out = m.transform(out)
    return out


NODE_COLUMNS = ["tree", "id", "prediction", "left", "right", "feature", "threshold"]


def forest_table(models: dict) -> DataFrame:
    """The nodes of the forests as a table ``(variable, tree, id, prediction, left, right, feature, threshold)``,
    read from their saved form; a leaf has no children (-1)."""
    spark = SparkSession.active()
    out = None
    for v, model in models.items():
        path = scratch_path(spark, "forest")
        save_model(model, path)
        part = spark.read.parquet(f"{path}/data").select(
            F.lit(v).alias("variable"), F.col("treeID").alias("tree"), "nodeData.id", "nodeData.prediction",
            F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
            F.col("nodeData.split.featureIndex").alias("feature"),
            F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"))
        out = part if out is None else out.unionByName(part)
    return out


def forest_arrays(nodes: DataFrame) -> dict[str, dict[str, np.ndarray]]:
    """Per variable the nodes as flat arrays (leaves have feature -1)."""
    out = {}
    for v, n in nodes.toPandas().groupby("variable"):
        n = n.sort_values(["tree", "id"])
        trees = n["tree"].to_numpy()
        first = np.searchsorted(trees, np.arange(trees.max() + 1))
        base = first[trees]
        leaf = n["left"].to_numpy() < 0
        out[v] = {"root": first, "prediction": n["prediction"].to_numpy(),
                  "feature": np.where(leaf, -1, n["feature"].to_numpy()).astype(np.int32),
                  "threshold": n["threshold"].fillna(0.0).to_numpy(dtype=float),
                  "left": n["left"].to_numpy() + base, "right": n["right"].to_numpy() + base}
    return out


def forest_nodes(model) -> dict[str, np.ndarray]:
    """The nodes of one fitted forest as flat arrays."""
    return forest_arrays(forest_table({"v": model}))["v"]


def forest_values(nodes: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Mean over the trees for every row of ``x``: all rows go down all trees together, level by level."""
    out = np.zeros(len(x))
    for start in range(0, len(x), ROWS_DOWN):
        part = x[start:start + ROWS_DOWN]
        rows = np.arange(len(part))
        at = np.repeat(nodes["root"][:, None], len(part), axis=1)
        while True:
            f = nodes["feature"][at]
            inner = f >= 0
            if not inner.any():
                break
            down = np.where(part[rows, f] <= nodes["threshold"][at], nodes["left"][at], nodes["right"][at])
            at = np.where(inner, down, at)
        for tree in nodes["prediction"][at]:  # tree after tree, the order in which MLlib adds
            out[start:start + ROWS_DOWN] += tree
    return out / len(nodes["root"])


def rollout_forest(models: dict | DataFrame, start: DataFrame, horizon: int = 72, keys: list[str] = KEYS,
                   time_col: str = "utc") -> DataFrame:
    """Hour-by-hour roll-out of the forests for all series, in one pass.

    Each task takes batches of start rows (one row per series) through all
    ``horizon`` steps.  ``models`` are fitted forests or their
    :func:`forest_table`.  The forests are sent to each executor once, as arrays
    of about 40 bytes a node; MLlib sends them for every ``transform``.  A
    series whose start row has a null gets null values.
    """
    arrays = forest_arrays(models if isinstance(models, DataFrame) else forest_table({v: models[v] for v in VALUES}))
    shared = start.sparkSession.sparkContext.broadcast(arrays)
    state = start.select(*keys, F.col(time_col).cast("timestamp_ntz").alias(time_col), *[F.col(v).cast("double") for v in VALUES])
    schema = T.StructType([*[state.schema[k] for k in keys], T.StructField("step", T.IntegerType()),
                           state.schema[time_col], *[T.StructField(v, T.DoubleType()) for v in VALUES]])

    def run(batches):
        for batch in batches:
            now, x = batch[time_col], batch[VALUES].to_numpy(dtype=float)
            known = ~np.isnan(x).any(axis=1)
            for i in range(1, horizon + 1):
                full = np.column_stack([x, now.dt.hour, now.dt.day, now.dt.month])
                x = np.column_stack([forest_values(shared.value[v], full) for v in VALUES])
                x[~known] = np.nan
                now = now + pd.Timedelta(hours=1)
                yield batch[keys].assign(step=np.int32(i), **{time_col: now}, **{
                    v: pd.Series(x[:, j], index=batch.index).astype(object).where(known, None) for j, v in enumerate(VALUES)})
    return state.mapInPandas(run, schema)


# ------------------------------------------------------------------ M9, M10

def linear_pipeline_fit(pairs: DataFrame, label: str) -> PipelineModel:
    return Pipeline(stages=[
        VectorAssembler(inputCols=FOREST_FEATURES, outputCol="features"),
        LinearRegression(featuresCol="features", labelCol=label, predictionCol=f"{label}_pred",
                         solver="normal")]).fit(pairs)


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def coefficient_batch_udf(coef: list[list[float]]):
    """``predict_batch_udf`` scoring of a user-supplied numpy model (here a
    linear map with intercept): Arrow batches, no per-row Python."""
    w = np.asarray(coef, dtype=np.float64)

    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            return np.hstack([x, np.ones((x.shape[0], 1))]) @ w
        return predict

    return predict_batch_udf(make, return_type=T.ArrayType(T.DoubleType()), batch_size=4096,
                             input_tensor_shapes=[[w.shape[0] - 1]])

