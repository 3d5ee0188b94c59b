"""Live roll-out: the window of a station equals the batch fill, the stream equals the batch job."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sensorcast.models import families as fam
from sensorcast.operators import regularize as rg
from sensorcast.operators import windows as wn
from sensorcast.session import scratch_path
from sensorcast.streaming import hourly as sh
from sensorcast.streaming import live as lv

RAW = "ID long, series_id long, utc timestamp_ntz, ts double, hr double, qfe double"


def test_window_equals_batch_fill():
    rng = np.random.default_rng(6)
    for gap_rate in (0.0, 0.3, 0.9):
        hours = [h for h in range(1000, 1200) if rng.random() >= gap_rate] + [1300, 1301]
        rows = {h: np.where(rng.random(3) < 0.5, np.nan, rng.normal(size=3)) for h in hours}
        window = lv.HourWindow()
        for h in hours:
            window = lv.HourWindow(*window.state())  # as it is stored between batches
            assert window.advance(h, rows[h]) and not window.advance(h, rows[h])
            frame = pd.DataFrame({k: rows[k] for k in hours if k <= h}).T.reindex(range(hours[0], h + 1))
            assert window.n == len(frame) and window.last == h
            want = frame.interpolate("linear").tail(24).to_numpy()
            assert np.allclose(window.filled()[-len(want):], want, equal_nan=True)


def readings(spark, n):
    rng = np.random.default_rng(8)
    rows, i = [], 0
    for s in (0, 1):
        for h in range(n):
            if s == 1 and 40 <= h < 45 or h % 17 == 5:
                continue  # empty hours
            for k in range(2):
                i += 1
                t = dt.datetime(2024, 3, 1) + dt.timedelta(hours=h, minutes=20 * k + s)
                rows.append((i, s, t, float(10 + 5 * np.sin(h / 4) + rng.normal()), float(rng.normal()) if h % 5 else None, 900.0 + h % 24))
    return spark.createDataFrame(rows, RAW)


def test_live_stream_equals_batch(spark):
    raw = readings(spark, 120)
    model = fam.Window().fit(rg.regularize(raw))
    coef, mean, std = fam.global_numbers(model, fam.Window.columns)
    feed, hours, out = (scratch_path(spark, f"test-live-{n}") for n in ("feed", "hours", "out"))
    cut = "timestamp_ntz'2024-03-04 06:30:00'"
    first, then = raw.where(f"utc < {cut}"), raw.where(f"utc >= {cut}")
    for part in (first.unionByName(first.where("ID % 3 = 0")), then.unionByName(first.where("ID % 4 = 0"))):  # repeated and late rows
        part.write.mode("append").parquet(feed)
        stream = spark.readStream.schema(raw.schema).parquet(feed)
        closed = sh.run_to_table(spark, sh.stream_hourly_mean(sh.stream_dedup(stream, keep_event_time=True)), hours, f"{hours}-ckpt")
        live = lv.live_forecasts(spark.readStream.schema(closed.schema).parquet(hours), lv.window_roll(coef, mean, std, 12), 12)
        got = sh.run_to_table(spark, live, out, f"{out}-ckpt")
    pdf = got.toPandas()
    assert len(pdf) == len(pdf.drop_duplicates(["series_id", "run_utc", "step"]))
    # a run in each delivery, after gaps, and the last closed hour
    for run in (dt.datetime(2024, 3, 2, 20), dt.datetime(2024, 3, 4, 7), pdf["run_utc"].max().to_pydatetime()):
        upto = rg.regularize(raw.where(F.col("utc") < F.lit(run + dt.timedelta(hours=1)).cast("timestamp_ntz")))
        want = {(r.series_id, r.utc): (r.ts, r.hr, r.qfe) for r in fam.forecast(model, upto, 12).collect()}
        mine = {(r.series_id, r.utc.to_pydatetime()): (r.ts, r.hr, r.qfe) for r in pdf[pdf["run_utc"] == run].itertuples()}
        assert mine and all(np.allclose(np.array(v, float), np.array(want[k], float), rtol=1e-8) for k, v in mine.items())


def test_fifo_advance(spark):
    row = spark.range(1).select(wn.fifo_advance(F.array(F.lit(1), F.lit(2), F.lit(3)), F.lit(4), 3).alias("w")).first()
    assert row.w == [2, 3, 4]
