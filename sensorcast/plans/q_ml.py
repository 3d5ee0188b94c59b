"""Queries: global linear and MLlib models.

No SQL twin: DuckDB has no multiple regression or forest, so these are
rows-checked by the driver and tested against numpy in ``tests/``.
"""

from pyspark.sql import functions as F

from sensorcast.functions import time as tf
from sensorcast.models import joint_forest as jf
from sensorcast.models import ml
from sensorcast.operators import regularize as rg
from sensorcast.operators import split as sp
from sensorcast.operators import stats as st
from sensorcast.plans.registry import r6, register
from sensorcast.session import scratch_path
from sensorcast.sources import testdata as td

V = ["ts", "hr", "qfe"]


def hourly_table(spark, sf_dir):
    return rg.regularize(td.readings(spark, sf_dir))


@register("cyclic_regression_forecast")
def cyclic_regression_forecast(spark, sf_dir):
    h = hourly_table(spark, sf_dir)
    models = ml.cyclic_regression_fit(h)
    grid = tf.future_grid(st.last_observation(h, values=[]), ["series_id"], horizon=72)
    return r6(ml.cyclic_regression_predict(models, grid).select("series_id", "step", "utc",
                                                               *[f"{v}_pred" for v in V]))


def _windows(spark, sf_dir):
    s = sp.split_train_test(hourly_table(spark, sf_dir), 0.9)
    return ml.window_frame(s, split_col="split")


@register("window_regression")
def window_regression(spark, sf_dir):
    w = _windows(spark, sf_dir)
    fit = ml.window_regression_fit(w.filter(F.col("split") == "train"))
    pred = ml.window_regression_predict(fit, w.filter(F.col("split") == "test"))
    return r6(pred.select("series_id", "utc", *[f"y_{v}" for v in V], *[f"{v}_pred" for v in V]))


@register("direct_multihorizon")
def direct_multihorizon(spark, sf_dir):
    s = sp.split_train_test(hourly_table(spark, sf_dir), 0.9)
    frame = ml.seq2seq_frame(s, keys=["series_id", "split"])
    fit = ml.direct_multihorizon_fit(frame.filter(F.col("split") == "train"))
    pred = ml.direct_multihorizon_predict(fit, frame.filter(F.col("split") == "test"))
    z = pred.select("series_id", "utc", F.posexplode(F.arrays_zip("pred", "yflat")).alias("k", "z"))
    return z.select("series_id", "utc", "k", F.round(F.col("z.pred"), 6).alias("pred"),
                    F.round(F.col("z.yflat"), 6).alias("actual"))


@register("rollout_block")
def rollout_block(spark, sf_dir):
    h = hourly_table(spark, sf_dir)
    fit = ml.direct_multihorizon_fit(ml.seq2seq_frame(h))
    return r6(ml.rollout_block(fit, h))


def _forest(spark, sf_dir):
    s = sp.split_train_test(hourly_table(spark, sf_dir), 0.9)
    pairs = ml.forest_pairs(s, split_col="split")
    models = ml.forest_fit(pairs.filter(F.col("split") == "train"))
    return s, pairs, models


@register("rf_fit_predict")
def rf_fit_predict(spark, sf_dir):
    _, pairs, models = _forest(spark, sf_dir)
    pred = ml.forest_predict(models, pairs.filter(F.col("split") == "test"))
    return r6(pred.select("series_id", "utc", *[f"y_{v}" for v in V], *[f"{v}_pred" for v in V]))


@register("rollout_forest")
def rollout_forest(spark, sf_dir):
    s, _, models = _forest(spark, sf_dir)
    start = st.last_observation(s.filter(F.col("split") == "train"))
    return r6(ml.rollout_forest(models, start, horizon=72))


def _joint(spark, sf_dir):
    s = sp.split_train_test(hourly_table(spark, sf_dir), 0.9)
    rows, features = jf.pairs(s, year=True)
    labels = [f"y_{v}" for v in V]
    nodes = jf.fit(rows.filter(F.col("split") == "train"), features, labels, num_trees=20, max_depth=6, min_leaf=5)
    return s, rows, features, nodes


@register("joint_forest_predict")
def joint_forest_predict(spark, sf_dir):
    """One forest for the three variables, scored on the test hours."""
    _, rows, features, nodes = _joint(spark, sf_dir)
    labels = [f"y_{v}" for v in V]
    return r6(jf.predict(nodes, rows.filter(F.col("split") == "test"), features, V, ["series_id", "utc", *labels]))


@register("joint_forest_rollout")
def joint_forest_rollout(spark, sf_dir):
    s, _, _, nodes = _joint(spark, sf_dir)
    return r6(jf.rollout(nodes, st.last_observation(s.filter(F.col("split") == "train")), horizon=72, year=True))


@register("batch_inference")
def batch_inference(spark, sf_dir):
    w = _windows(spark, sf_dir)
    fit = ml.window_regression_fit(w.filter(F.col("split") == "train"))
    coef = fit.first()["coef"]  # the fitted coefficients of one global model
    score = ml.coefficient_batch_udf(coef)
    test = w.filter(F.col("split") == "test")
    out = test.withColumn("_p", score("xflat"))
    return r6(out.select("series_id", "utc", *[F.col("_p")[i].alias(f"{v}_pred") for i, v in enumerate(V)]))


@register("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    s = sp.split_train_test(hourly_table(spark, sf_dir), 0.9)
    pairs = ml.forest_pairs(s, split_col="split").drop("features")
    model = ml.linear_pipeline_fit(pairs.filter(F.col("split") == "train"), "y_ts")
    path = ml.save_model(model, scratch_path(spark, "pipeline-model"))
    loaded = ml.load_pipeline(path)
    test = pairs.filter(F.col("split") == "test")
    a = model.transform(test).select("series_id", "utc", F.col("y_ts_pred").alias("in_memory"))
    b = loaded.transform(test).select("series_id", "utc", F.col("y_ts_pred").alias("loaded"))
    return r6(a.join(b, ["series_id", "utc"]).withColumn("diff", F.col("in_memory") - F.col("loaded")))
