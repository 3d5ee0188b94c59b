"""Refresh and fill: no station is lost, no stored value turns null, linear frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorcast.operators.append import append_hours_dedup
from sensorcast.operators.regularize import interpolate_linear
from sensorcast.sources.readings import incremental_scan, latest_hours

DDL = "series_id long, utc timestamp_ntz, ts double, hr double, qfe double"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def frame(spark, rows):
    return spark.createDataFrame([(s, t, *(v if isinstance(v, tuple) else (v, v, v))) for s, t, v in rows], DDL)


def keys(df):
    return sorted((r.series_id, r.utc) for r in df.collect())


def test_lagging_and_new_stations_are_read(spark):
    stored = frame(spark, [(0, at(2), 1.0), (1, at(1, 5), 1.0)])
    raw = frame(spark, [(0, at(1, 23), 1.0), (0, at(2), 2.0), (1, at(1, 6), 3.0), (2, at(1, 9), 4.0)])
    assert keys(incremental_scan(raw, stored, keys=["series_id"])) == [(0, at(2)), (1, at(1, 6)), (2, at(1, 9))]


@pytest.mark.parametrize("by", [None, ["series_id"]])
def test_first_load_reads_all(spark, by):
    raw = frame(spark, [(0, at(1), 1.0), (1, at(2), 2.0)])
    assert incremental_scan(raw, raw.limit(0), keys=by).count() == 2


def test_latest_hours_counts_back_from_each_series(spark):
    raw = frame(spark, [(0, at(1), 1.0), (0, at(9), 1.0), (1, at(1), 1.0), (1, at(2), 1.0), (1, at(5), 1.0)])
    assert keys(latest_hours(raw, 96, ["series_id"])) == [(0, at(9)), (1, at(2)), (1, at(5))]
    assert latest_hours(raw.limit(0), 48, ["series_id"]).count() == 0


def test_stored_value_survives_a_rebuilt_null(spark):
    stored = frame(spark, [(0, at(1), (1.0, 2.0, None))])
    new = frame(spark, [(0, at(1), (None, 5.0, 6.0)), (0, at(1, 1), (None, None, None))])
    got = {r.utc: (r.ts, r.hr, r.qfe) for r in append_hours_dedup(stored, new).collect()}
    assert got == {at(1): (1.0, 5.0, 6.0), at(1, 1): (None, None, None)}


def test_fill_frames_grow_row_by_row(spark):
    df = spark.range(50).select(F.lit(0).cast("long").alias("series_id"), F.col("id").alias("pos"), F.when(
        F.col("id") % 7 == 3, F.col("id").cast("double")).alias("ts"))
    out = interpolate_linear(df, values=["ts"], block=8)
    assert "UnboundedFollowing" not in out._jdf.queryExecution().toString().replace("unboundedfollowing", "UnboundedFollowing")
    got = {r.pos: r.ts for r in out.collect()}
    assert got[2] is None and got[20] == 20.0 and got[49] == 45.0
