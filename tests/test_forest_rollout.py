"""The one-pass forest roll-out against MLlib's own predictions, step by step."""

import datetime as dt

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from sensorcast.functions.time import calendar_features
from sensorcast.models import ml

START = "series_id string, utc timestamp_ntz, ts double, hr double, qfe double"


def test_rollout_follows_mllib(spark):
    t0 = dt.datetime(2021, 1, 30)
    rows = [(s, t0 + dt.timedelta(hours=i), i, float((7 * i + k) % 24), float((5 * i + k) % 31), 900.0 + (3 * i) % 17)
            for k, s in enumerate("ab") for i in range(120)]
    df = spark.createDataFrame(rows, "series_id string, utc timestamp_ntz, pos long, ts double, hr double, qfe double")
    models = ml.forest_fit(ml.forest_pairs(df), num_trees=7, max_depth=9)
    state = df.where("pos = 119").drop("pos")
    nothing = spark.createDataFrame([("c", t0, None, 1.0, 2.0)], START)
    got = {(r.series_id, r.step): r for r in ml.rollout_forest(models, state.unionByName(nothing), horizon=3).collect()}
    assert len(got) == 9 and all(got["c", i].hr is None for i in (1, 2, 3))
    assembler = VectorAssembler(inputCols=ml.FOREST_FEATURES, outputCol="features")
    for step in (1, 2, 3):
        want = ml.forest_predict(models, assembler.transform(calendar_features(state, year=False))).collect()
        for r in want:
            now = got[r.series_id, step]
            assert now.utc == r.utc + dt.timedelta(hours=1)
            assert [now[v] for v in ml.VALUES] == [r[f"{v}_pred"] for v in ml.VALUES]
        state = spark.createDataFrame([(r.series_id, r.utc + dt.timedelta(hours=1), r.ts_pred, r.hr_pred, r.qfe_pred)
                                       for r in want], START)


def test_no_start_rows(spark):
    t0 = dt.datetime(2021, 1, 30)
    rows = [("a", t0 + dt.timedelta(hours=i), i, float(i % 5), float(i % 3), 1.0) for i in range(30)]
    df = spark.createDataFrame(rows, "series_id string, utc timestamp_ntz, pos long, ts double, hr double, qfe double")
    models = ml.forest_fit(ml.forest_pairs(df), num_trees=2, max_depth=2)
    assert ml.rollout_forest(models, df.where(F.lit(False)), horizon=2).count() == 0
