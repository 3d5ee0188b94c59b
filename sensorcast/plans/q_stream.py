"""Queries: streaming twins (X1, X2), fed by a file stream over ``events``."""

from pyspark.sql import functions as F

from sensorcast.models import ar
from sensorcast.operators import regularize as rg
from sensorcast.plans import sql as S
from sensorcast.plans.q_models import fit_cte, pairs_cte
from sensorcast.plans.registry import r6, register
from sensorcast.session import scratch_path, write_and_read
from sensorcast.sources import testdata as td
from sensorcast.streaming import hourly as sh
from sensorcast.streaming import live as lv

V = ["ts", "hr", "qfe"]


def _feed(spark, sf_dir, run):
    """Two deliveries of ``events`` to a watched folder, each processed by ``run``,
    which resumes from its checkpoint.  Every seventh row of the first comes
    twice; the second repeats every fifth of its own rows and brings every
    eleventh row of the first again, long after its hour was closed."""
    ev, path = td.table(spark, sf_dir, "events"), scratch_path(spark, "feed")
    i, early = F.col("event_id"), F.col("ts") < F.lit(td.STORED_BEFORE).cast("timestamp_ntz")
    old, new = ev.where(early), ev.where(~early)
    old.unionByName(old.where(i % 7 == 0)).write.mode("append").parquet(path)
    run(path)
    new.unionByName(new.where(i % 5 == 0)).unionByName(old.where(i % 11 == 0)).write.mode("append").parquet(path)
    return run(path)


def _stream(spark, path):
    ev = spark.readStream.schema(sh.EVENTS_SCHEMA).parquet(path)
    return td.events_as_readings(ev)


def _to_table(spark, name, build):
    """A ``run`` for :func:`_feed`: the built stream, appended to one table with one checkpoint."""
    out, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-ckpt")
    return lambda path: sh.run_to_table(spark, build(_stream(spark, path)), out, checkpoint)


@register("stream_hourly_mean", f"""WITH {S.readings_cte()}, {S.hourly_cte()}
SELECT series_id, utc, {S.r6(V)} FROM h
WHERE utc + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def stream_hourly_mean(spark, sf_dir):
    """Means of closed hours; repeated and late rows change none of them."""
    return r6(_feed(spark, sf_dir, _to_table(spark, "stream-hourly", lambda s: sh.stream_hourly_mean(sh.stream_dedup(s, keep_event_time=True)))))


@register("stream_dedup", f"""WITH {S.readings_cte()}
SELECT DISTINCT ON ("ID") "ID", series_id, utc, ts, hr, qfe FROM r""")
def stream_dedup(spark, sf_dir):
    return _feed(spark, sf_dir, _to_table(spark, "stream-dedup", sh.stream_dedup))


@register("live_forecast", f"""WITH {S.readings_cte()}, {S.hourly_table_sql(p='s', where=f"ts < TIMESTAMP '{td.STORED_BEFORE}'")},
{pairs_cte('si', part='series_id')}, {fit_cte('p', 'TRUE')},
{S.hourly_cte()},
w AS (SELECT series_id, utc, min(utc) OVER (PARTITION BY series_id) AS lo,
        {', '.join(f'last_value({v} IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY utc) AS {v}' for v in V)} FROM h),
st AS (SELECT * FROM w WHERE utc >= lo + INTERVAL 23 HOUR AND utc + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE)
SELECT st.series_id, st.utc AS run_utc, CAST(k AS INTEGER) AS step, st.utc + k * INTERVAL 1 HOUR AS utc,
  {', '.join(f'round({v}_intercept * (1 - pow({v}_slope, k)) / (1 - {v}_slope) + pow({v}_slope, k) * st.{v}, 6) AS {v}' for v in V)}
FROM st JOIN fit USING (series_id), range(1, 13) t(k)""")
def live_forecast(spark, sf_dir):
    """A 12-hour AR(1) forecast at every closed hour, from a model of the stored part."""
    fit = write_and_read(ar.ar1_fit(rg.regularize(td.readings(spark, sf_dir).where(
        F.col("utc") < F.lit(td.STORED_BEFORE).cast("timestamp_ntz")))), "live-fit")
    hours, hours_ckpt = scratch_path(spark, "live-hours"), scratch_path(spark, "live-hours-ckpt")
    out, ckpt = scratch_path(spark, "live"), scratch_path(spark, "live-ckpt")

    def run(path):
        closed = sh.run_to_table(spark, sh.stream_hourly_mean(sh.stream_dedup(_stream(spark, path), keep_event_time=True)), hours, hours_ckpt)
        stream = spark.readStream.schema(closed.schema).parquet(hours).join(fit, "series_id")
        return sh.run_to_table(spark, lv.live_forecasts(stream, lv.ar1_roll(12), 12, lv.AR1_EXTRAS), out, ckpt)
    return r6(_feed(spark, sf_dir, run))
