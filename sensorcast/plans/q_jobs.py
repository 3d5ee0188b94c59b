"""Queries: the composed jobs and the forecast table."""

from pyspark.sql import functions as F

from sensorcast.models import ar, families
from sensorcast.models.store import ModelStore
from sensorcast.operators import regularize as rg
from sensorcast.plans import jobs
from sensorcast.plans import sql as S
from sensorcast.plans.q_models import _clim_fit_sql, _clim_forecast_sql, CAL, fit_cte, pairs_cte, recursion_cte
from sensorcast.plans.registry import r6, register
from sensorcast.session import scratch_path, write_and_read
from sensorcast.sources import testdata as td
from sensorcast.sources.forecasts import ForecastTable
from sensorcast.sources.months import MonthTable
from sensorcast.sources.zones import RawTable

V = ["ts", "hr", "qfe"]


def _stored(spark, sf_dir):
    raw = td.readings(spark, sf_dir)
    old = raw.filter(F.col("utc") < F.lit(td.STORED_BEFORE).cast("timestamp_ntz"))
    return raw, rg.regularize(old)


def daily_forecast_frame(spark, sf_dir):
    raw, stored = _stored(spark, sf_dir)
    fit = ar.ar1_fit(stored)
    return jobs.daily_forecast(raw, fit, horizon=72)


DAILY_SQL = f"""WITH RECURSIVE {S.readings_cte()},
sr AS (SELECT * FROM r WHERE utc < TIMESTAMP '{td.STORED_BEFORE}'),
{S.hourly_table_sql(p='s', raw='sr')},
{pairs_cte('si', part='series_id')}, {fit_cte('p', 'TRUE')},
lm AS (SELECT series_id, max(utc) - INTERVAL 48 HOUR AS m FROM r GROUP BY series_id),
lr AS (SELECT r.* FROM r JOIN lm USING (series_id) WHERE r.utc > lm.m),
{S.hourly_table_sql(p='l', raw='lr')},
st AS (SELECT series_id, max(utc) AS utc, {', '.join(f'arg_max_null({v}, utc) AS {v}' for v in V)} FROM li GROUP BY series_id),
{recursion_cte('st')}
SELECT f.series_id, 'ar1' AS model, st.utc AS run_utc, CAST(f.step AS INTEGER) AS step, f.utc,
  {', '.join(f'round_even(f.{v}, 3) AS {v}' for v in V)}
FROM f JOIN st ON f.series_id = st.series_id"""


@register("daily_forecast", DAILY_SQL)
def daily_forecast(spark, sf_dir):
    return daily_forecast_frame(spark, sf_dir)


@register("monthly_refresh", f"""WITH {S.readings_cte()},
sr AS (SELECT * FROM r WHERE utc < TIMESTAMP '{td.STORED_BEFORE}'),
{S.hourly_table_sql(p='s', raw='sr')},
mark AS (SELECT series_id, max(utc) AS m FROM si GROUP BY series_id),
nr AS (SELECT r.* FROM r LEFT JOIN mark USING (series_id) WHERE m IS NULL OR r.utc >= m),
{S.hourly_table_sql(p='n', raw='nr')},
u AS (SELECT series_id, utc, ts, hr, qfe, 0 AS ver FROM si UNION ALL
      SELECT series_id, utc, round_even(ts, 2), round_even(hr, 2), round_even(qfe, 2), 1 AS ver FROM ni)
SELECT series_id, utc, {', '.join(f'round(arg_max({v}, ver), 6) AS {v}' for v in V)} FROM u GROUP BY series_id, utc""")
def monthly_refresh(spark, sf_dir):
    raw, stored = _stored(spark, sf_dir)
    return r6(jobs.monthly_refresh(raw, stored.drop("pos")))


def _raw_table(spark, sf_dir):
    """Raw files of the days before the stored mark, with an empty zone map."""
    path = td.write_day_files(spark, sf_dir, scratch_path(spark, "raw"), stored=True)
    return RawTable(spark, path, scratch_path(spark, "zones"), td.events_as_readings)


def _new_days(raw, sf_dir):
    td.write_day_files(raw.spark, sf_dir, raw.path, stored=False)
    raw.refresh()


OLD = f"sr AS (SELECT * FROM r WHERE utc < TIMESTAMP '{td.STORED_BEFORE}')"


@register("zone_map", f"""WITH {S.readings_cte()}
SELECT CAST(utc AS DATE) AS day, series_id, min(utc) AS min_utc, max(utc) AS max_utc, min("ID") AS min_id, max("ID") AS max_id,
  CAST(count(*) AS BIGINT) AS rows FROM r GROUP BY ALL""")
def zone_map(spark, sf_dir):
    """The zone map of one folder a day, extended by the later days."""
    raw = _raw_table(spark, sf_dir)
    raw.refresh()
    _new_days(raw, sf_dir)
    # a day may be written as several files
    return raw.zones().groupBy(F.to_date("min_utc").alias("day"), "series_id").agg(
        F.min("min_utc").alias("min_utc"), F.max("max_utc").alias("max_utc"), F.min("min_id").alias("min_id"), F.max("max_id").alias("max_id"),
        F.sum("rows").alias("rows"))


@register("incremental_scan_by_series", f"""WITH {S.readings_cte()}, {OLD},
mark AS (SELECT series_id, max(date_trunc('hour', utc)) AS m FROM sr GROUP BY series_id)
SELECT "ID", r.series_id, utc, ts, hr, qfe FROM r LEFT JOIN mark USING (series_id) WHERE m IS NULL OR utc >= m""")
def incremental_scan_by_series(spark, sf_dir):
    """Rows from each station's mark on; files without any are not read."""
    raw = _raw_table(spark, sf_dir)
    raw.refresh()
    marks = raw.zones().groupBy("series_id").agg(F.max(F.date_trunc("hour", "max_utc").cast("timestamp_ntz")).alias("mark"))
    marks = write_and_read(marks, "marks")
    _new_days(raw, sf_dir)
    return raw.since(marks)


@register("latest_hours", f"""WITH {S.readings_cte()},
lm AS (SELECT series_id, max(utc) - INTERVAL 48 HOUR AS m FROM r GROUP BY series_id)
SELECT "ID", r.series_id, utc, ts, hr, qfe FROM r JOIN lm USING (series_id) WHERE utc > m""")
def latest_hours(spark, sf_dir):
    raw = _raw_table(spark, sf_dir)
    _new_days(raw, sf_dir)
    return raw.latest_hours(48)


@register("monthly_refresh_commit", f"""WITH {S.readings_cte()}, {OLD},
{S.hourly_table_sql(p='s', raw='sr')},
mark AS (SELECT series_id, max(utc) AS m FROM si GROUP BY series_id),
nr AS (SELECT r.* FROM r LEFT JOIN mark USING (series_id) WHERE m IS NULL OR r.utc >= m),
{S.hourly_table_sql(p='n', raw='nr')},
u AS (SELECT series_id, utc, {', '.join(f'round_even({v}, 2) AS {v}' for v in V)}, 0 AS ver FROM si UNION ALL
      SELECT series_id, utc, {', '.join(f'round_even({v}, 2) AS {v}' for v in V)}, 1 AS ver FROM ni)
SELECT series_id, utc, {', '.join(f'round(arg_max({v}, ver), 6) AS {v}' for v in V)} FROM u GROUP BY series_id, utc""")
def monthly_refresh_commit(spark, sf_dir):
    """First load, refresh with the later days, and a repeated refresh that changes nothing."""
    raw, table = _raw_table(spark, sf_dir), MonthTable(spark, scratch_path(spark, "months"))
    jobs.refresh(raw, table)
    _new_days(raw, sf_dir)
    jobs.refresh(raw, table)
    if jobs.refresh(raw, table) is not None:
        raise AssertionError("a repeated refresh made a commit")
    return r6(table.read())


def _run_ctes(p, raw):
    """The AR(1) forecast of the last 48 hours of ``raw``, as ``{p}f`` with the start rows ``{p}st``."""
    return f"""{p}lm AS (SELECT series_id, max(utc) - INTERVAL 48 HOUR AS m FROM {raw} GROUP BY series_id),
{p}lr AS (SELECT {raw}.* FROM {raw} JOIN {p}lm USING (series_id) WHERE {raw}.utc > {p}lm.m),
{S.hourly_table_sql(p=p + 'l', raw=p + 'lr')},
{p}st AS (SELECT series_id, max(utc) AS utc, {', '.join(f'arg_max_null({v}, utc) AS {v}' for v in V)} FROM {p}li GROUP BY series_id),
{recursion_cte(p + 'st', p + 'f')}"""


def _run_rows(p, run):
    return f"""SELECT 'ar1' AS model, '{run}' AS run, {p}f.series_id, {p}st.utc AS run_utc, CAST({p}f.step AS INTEGER) AS step, {p}f.utc,
  {', '.join(f'round_even({p}f.{v}, 3) AS {v}' for v in V)} FROM {p}f JOIN {p}st ON {p}f.series_id = {p}st.series_id"""


RUNS_SQL = f"""WITH RECURSIVE {S.readings_cte()}, {OLD},
{S.hourly_table_sql(p='s', raw='sr')},
{pairs_cte('si', part='series_id')}, {fit_cte('p', 'TRUE')},
{_run_ctes('a', 'sr')},
{_run_ctes('b', 'r')},
u AS ({_run_rows('a', '1')} UNION ALL {_run_rows('b', '2')})"""


def _two_runs(spark, sf_dir):
    """Two daily runs of a stored AR(1) model, the second one repeated."""
    raw, store = _raw_table(spark, sf_dir), ModelStore(spark, scratch_path(spark, "models"))
    table = ForecastTable(spark, scratch_path(spark, "forecasts"))
    raw.refresh()
    store.save("ar1", families.FAMILIES["ar1"].fit(rg.regularize(raw.scan())))
    jobs.publish_forecasts(raw, store, table, "1", ["ar1"])
    _new_days(raw, sf_dir)
    for _ in range(2):
        jobs.publish_forecasts(raw, store, table, "2", ["ar1"])
    return table.read()


@register("forecast_append", f"{RUNS_SQL} SELECT * FROM u")
def forecast_append(spark, sf_dir):
    return _two_runs(spark, sf_dir).drop("id")


@register("forecast_row_id", f"""{RUNS_SQL}
SELECT row_number() OVER (ORDER BY run, run_utc, series_id, step) AS id, run, series_id, step FROM u""")
def forecast_row_id(spark, sf_dir):
    """Dense ids over both runs."""
    return _two_runs(spark, sf_dir).select("id", "run", "series_id", "step")


@register("daily_forecast_families")
def daily_forecast_families(spark, sf_dir):
    """The monthly and the daily job of every family: refresh, refit, publish."""
    raw, store = _raw_table(spark, sf_dir), ModelStore(spark, scratch_path(spark, "models"))
    hours, table = MonthTable(spark, scratch_path(spark, "months")), ForecastTable(spark, scratch_path(spark, "forecasts"))
    jobs.refresh(raw, hours)
    jobs.refit(hours, store, params={"forest": {"num_trees": 10, "max_depth": 8}})
    _new_days(raw, sf_dir)
    jobs.publish_forecasts(raw, store, table, "1", list(families.FAMILIES))
    return r6(table.read())


@register("daily_forecast_climatology", f"""WITH {S.readings_cte()}, {OLD},
{S.hourly_table_sql(p='s', raw='sr')},
cal AS (SELECT series_id, {CAL}, ts, hr, qfe FROM si), fit AS ({_clim_fit_sql('cal')}),
l AS (SELECT series_id, date_trunc('hour', max(utc)) AS t0 FROM r GROUP BY series_id),
grid AS (SELECT series_id, CAST(s AS INTEGER) AS step, t0 + s * INTERVAL 1 HOUR AS utc FROM l, range(1, 73) AS t(s)),
c AS (SELECT * FROM ({_clim_forecast_sql('grid', bare=True)}))
SELECT c.series_id, l.t0 AS run_utc, c.step, c.utc, {', '.join(f'round_even(c.{v}, 3) AS {v}' for v in V)} FROM c JOIN l USING (series_id)""")
def daily_forecast_climatology(spark, sf_dir):
    raw, store = _raw_table(spark, sf_dir), ModelStore(spark, scratch_path(spark, "models"))
    table = ForecastTable(spark, scratch_path(spark, "forecasts"))
    raw.refresh()
    store.save("climatology", families.FAMILIES["climatology"].fit(rg.regularize(raw.scan())))
    _new_days(raw, sf_dir)
    jobs.publish_forecasts(raw, store, table, "1", ["climatology"])
    return table.read("climatology").drop("id", "model", "run")
