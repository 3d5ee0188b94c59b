"""The composed jobs: daily forecast (M11) and monthly refresh (M12), as frames
and as committed jobs over raw files with a zone map, the stored hourly table,
the model store and the forecast table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorcast.functions.numeric import round_columns
from sensorcast.models import ar
from sensorcast.operators import append as ap
from sensorcast.operators import regularize as rg
from sensorcast.models import families as fam
from sensorcast.models.store import ModelStore
from sensorcast.operators.position import with_position
from sensorcast.operators.stats import last_observation
from sensorcast.session import write_and_read
from sensorcast.sources import readings as rd
from sensorcast.sources.forecasts import ForecastTable
from sensorcast.sources.months import MonthTable
from sensorcast.sources.zones import RawTable

VALUES = ["ts", "hr", "qfe"]


def daily_forecast(raw: DataFrame | RawTable, fit: DataFrame, history_hours: int = 48, horizon: int = 72,
                   first_step: int = 1, digits: int = 3) -> DataFrame:
    """Each series' last two days of raw rows -> hourly mean -> gap grid -> interpolation -> AR(1)
    roll-out over ``horizon`` hours for every series -> rounding -> forecast rows.

    ``first_step`` = 1 stamps the first forecast one hour after the last
    observed hour; 0 reproduces stamping it at the last observed hour.  A
    ``RawTable`` reads only the files of the last hours.
    Output: ``(series_id, model, run_utc, step, utc, ts, hr, qfe)``.
    """
    recent = raw.latest_hours(history_hours) if isinstance(raw, RawTable) else rd.latest_hours(raw, history_hours, ["series_id"])
    hourly = rg.regularize(recent)
    last = last_observation(hourly)
    fc = ar.ar1_forecast(fit, last, horizon, first_step=first_step)
    run = last.select("series_id", F.col("utc").alias("run_utc"))
    out = fc.join(run, "series_id").withColumn("model", F.lit("ar1"))
    out = round_columns(out, VALUES, digits)
    return out.select("series_id", "model", "run_utc", "step", "utc", *VALUES)


def monthly_refresh(raw: DataFrame, stored: DataFrame, digits: int = 2) -> DataFrame:
    """High-water mark of each series -> new raw rows -> hourly -> grid -> interpolation ->
    rounding -> append without double-counting the boundary hour.

    Returns the refreshed hourly table ``(series_id, utc, ts, hr, qfe)``; the
    caller writes it with ``files.write_hourly_table`` (dynamic partition
    overwrite rewrites only the touched months) and refits from it.
    """
    new = rg.regularize(rd.incremental_scan(raw, stored, keys=["series_id"])).drop("pos")
    new = round_columns(new, VALUES, digits)
    return ap.append_hours_dedup(stored.select("series_id", "utc", *VALUES), new)


def refresh(raw: RawTable, table: MonthTable, digits: int = 2) -> dict | None:
    """The monthly refresh as a commit: files with new rows -> hourly -> grid ->
    interpolation -> rounding -> merge of the touched months.

    Returns the commit, or None when nothing changed, so a repeated run is
    harmless.
    """
    raw.refresh()
    new = rg.regularize(raw.since(table.marks())).drop("pos")
    return table.merge(round_columns(new, VALUES, digits))


def refit(table: MonthTable, store: ModelStore, names: list[str] | None = None,
          params: dict[str, dict] | None = None) -> dict[str, int]:
    """Fit the families on the stored hours and save each as a new version."""
    hourly = write_and_read(with_position(table.read(), ["series_id"]), "refit-hours")
    return {n: store.save(n, fam.FAMILIES[n].fit(hourly, **(params or {}).get(n, {}))) for n in names or fam.FAMILIES}


def publish_forecasts(raw: RawTable, store: ModelStore, table: ForecastTable, run: str, names: list[str],
                      history_hours: int = 48, horizon: int = 72, first_step: int = 1, digits: int = 3) -> list[dict]:
    """The daily job of every named model: the last hours are read and
    regularised once, each model's last version is rolled out and its run
    committed to the forecast table once."""
    raw.refresh()
    recent = write_and_read(rg.regularize(raw.latest_hours(history_hours)), "recent-hours")
    runs = last_observation(recent, values=[]).select("series_id", F.col("utc").alias("run_utc"))
    out = []
    for name in names:
        fc = fam.forecast(store.load(name), recent, horizon, first_step).join(runs, "series_id")
        out.append(table.publish(round_columns(fc, VALUES, digits), name, run))
    return out
