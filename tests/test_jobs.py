"""Zone map, month table, forecast table, model store and forecast families."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorcast.models import families as fam
from sensorcast.models.store import Model, ModelStore
from sensorcast.operators import regularize as rg
from sensorcast.plans import jobs
from sensorcast.session import scratch_path
from sensorcast.sources.commits import CommitConflict, CommitLog
from sensorcast.sources.forecasts import ForecastTable
from sensorcast.sources.months import MonthTable
from sensorcast.sources.zones import RawTable

RAW = "ID long, series_id long, utc timestamp_ntz, ts double, hr double, qfe double"


def at(day, hour=0, month=1):
    return dt.datetime(2024, month, day, hour)


def add_files(spark, path, rows):
    """One file for each (station, time, value) list entry's day."""
    df = spark.createDataFrame([(i, s, t, v, v, v) for i, (s, t, v) in enumerate(rows, add_files.n)], RAW)
    add_files.n += len(rows)
    df.withColumn("day", F.to_date("utc")).repartition("day").write.mode("append").partitionBy("day").parquet(path)


add_files.n = 1


@pytest.fixture
def raw(spark):
    path = scratch_path(spark, "test-raw")
    # station 0 current, 1 lags, 2 stopped on the first day
    add_files(spark, path, [(s, at(d, h), float(d)) for d in range(1, 9) for s in ((0, 1, 2) if d == 1 else (0, 1) if d < 6 else (0,)) for h in (3, 4)])
    table = RawTable(spark, path, scratch_path(spark, "test-zones"))
    table.refresh()
    return table


def days_read(df):
    return sorted({f.split("day=")[1].split("/")[0][-2:] for f in df.inputFiles() if "day=" in f})


def keys(df):
    return sorted((r.series_id, r.utc) for r in df.collect())


def test_zone_map_reads_new_files_only(spark, raw):
    assert raw.refresh() == 0
    add_files(spark, raw.path, [(0, at(9, 1), 9.0)])
    assert raw.refresh() == 1 and raw.refresh() == 0
    z = {(r.series_id, r.min_utc.day): (r.min_utc.hour, r.max_utc.hour, r.rows) for r in raw.zones().collect()}
    assert z[0, 9] == (1, 1, 1) and z[1, 5] == (3, 4, 2) and (1, 6) not in z and len(z) == 8 + 5 + 1 + 1


def test_since_reads_files_with_new_rows_only(spark, raw):
    marks = spark.createDataFrame([(0, at(8, 4)), (1, at(5, 4)), (2, at(1, 4))], "series_id long, mark timestamp_ntz")
    got = raw.since(marks)
    assert keys(got) == [(0, at(8, 4)), (1, at(5, 4)), (2, at(1, 4))] and days_read(got) == ["01", "05", "08"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(utc," in plan
    current = raw.since(marks.where("series_id = 0").unionByName(spark.createDataFrame([(1, at(9)), (2, at(9))], marks.schema)))
    assert days_read(current) == ["08"] and keys(current) == [(0, at(8, 4))]
    # a station without a mark is read whole
    assert len(keys(raw.since(marks.where("series_id <> 1")))) == 2 + 10
    assert raw.since(marks.withColumn("mark", F.lit(at(20)).cast("timestamp_ntz"))).count() == 0


def test_latest_hours_reads_last_files_only(raw):
    got = raw.latest_hours(20)
    assert keys(got) == [(0, at(8, 3)), (0, at(8, 4)), (1, at(5, 3)), (1, at(5, 4)), (2, at(1, 3)), (2, at(1, 4))]
    assert days_read(got) == ["01", "05", "08"]
    # one scan of the raw files, no aggregate over them
    assert got._jdf.queryExecution().executedPlan().toString().count("day=") <= 3


def test_latest_n_reads_last_files_only(spark, raw):
    got = raw.latest_n(3)
    assert len(days_read(got)) <= 3
    assert [r.ID for r in got.collect()] == [r.ID for r in raw.scan().orderBy(F.desc("ID")).limit(3).collect()]
    assert RawTable(spark, raw.path, scratch_path(spark, "none")).latest_n(3).count() == 0  # nothing known yet


def hours(spark, rows):
    return spark.createDataFrame([(s, t, v, v, v) for s, t, v in rows], MonthTable.SCHEMA)


def values(table):
    return {(r.series_id, r.utc): (r.ts, r.hr) for r in table.read().collect()}


def test_month_table_merges_touched_months(spark):
    table = MonthTable(spark, scratch_path(spark, "months"))
    assert table.read().count() == 0 and table.marks().count() == 0 and table.merge(hours(spark, [])) is None
    table.merge(hours(spark, [(0, at(31, 22), 1.0), (0, at(31, 23), 2.0), (1, at(5, 1, 2), 3.0)]))
    first = table.manifest()
    assert sorted(first["months"]) == ["2024-01", "2024-02"]
    again = hours(spark, [(0, at(31, 23), 2.0), (1, at(5, 1, 2), 3.0)])
    assert table.merge(again) is None and table.manifest() == first
    new = spark.createDataFrame([(1, at(5, 1, 2), 4.0, None, 3.0), (1, at(5, 2, 2), 5.0, 5.0, 5.0)], MonthTable.SCHEMA)
    done = table.merge(new.unionByName(hours(spark, [(0, at(31, 23), 2.0)])))
    assert done["changed"] == ["2024-02"] and done["number"] == 2
    assert done["months"]["2024-01"] == first["months"]["2024-01"]  # untouched months keep their files
    assert values(table) == {(0, at(31, 22)): (1.0, 1.0), (0, at(31, 23)): (2.0, 2.0), (1, at(5, 1, 2)): (4.0, 3.0), (1, at(5, 2, 2)): (5.0, 5.0)}
    assert {(r.series_id, r.mark) for r in table.marks().collect()} == {(0, at(31, 23)), (1, at(5, 2, 2))}
    assert values(table) and len(table.vacuum()) >= 2 and len(values(table)) == 4


def test_month_table_of_a_failed_refresh(spark, monkeypatch):
    """A writer that loses, or dies before its commit, changes nothing."""
    table = MonthTable(spark, scratch_path(spark, "months"))
    table.merge(hours(spark, [(0, at(1), 1.0)]))
    before = values(table)
    append = CommitLog.append

    def late(log, entry, number):
        append(log, {**table.manifest(), "winner": True}, number)
        return append(log, entry, number)
    monkeypatch.setattr(CommitLog, "append", late)
    with pytest.raises(CommitConflict):
        table.merge(hours(spark, [(0, at(1), 9.0)]))
    monkeypatch.undo()
    assert values(table) == before and table.manifest()["winner"]
    table.merge(hours(spark, [(0, at(1), 9.0)]))
    assert values(table) == {(0, at(1)): (9.0, 9.0)}


def test_refresh_job_is_repeatable(spark, raw):
    table = MonthTable(spark, scratch_path(spark, "months"))
    assert jobs.refresh(raw, table)["number"] == 1
    assert jobs.refresh(raw, table) is None
    add_files(spark, raw.path, [(0, at(8, 4), 20.0), (0, at(8, 6), 30.0), (1, at(6, 0), 7.0), (3, at(2, 0), 1.0)])
    jobs.refresh(raw, table)
    got = values(table)
    # the boundary hour is rebuilt from all its rows, the gap after it is filled
    assert got[0, at(8, 4)][0] == 14.0 and got[0, at(8, 5)][0] == 22.0 and got[0, at(8, 6)][0] == 30.0
    assert got[3, at(2)][0] == 1.0 and got[1, at(5, 14)][0] == 6.0 and got[1, at(6)][0] == 7.0


def forecasts(spark, base, series=(0, 1)):
    rows = [(s, at(1), k, at(1, k), base + k, 0.0, None) for s in series for k in (1, 2, 3)]
    return spark.createDataFrame(rows, "series_id long, run_utc timestamp_ntz, step int, utc timestamp_ntz, ts double, hr double, qfe double")


def test_forecast_table_stores_a_run_once(spark, monkeypatch):
    table = ForecastTable(spark, scratch_path(spark, "forecasts"))
    assert table.read().count() == 0
    a = table.publish(forecasts(spark, 10.0), "ar1", "1")
    table._stage(forecasts(spark, 99.0))  # a run that died before its commit
    assert table.publish(forecasts(spark, 50.0), "ar1", "1") == a  # repeated: the first one stays
    # another writer commits while this one writes
    stage = ForecastTable._stage

    def slow(self, df):
        made = stage(self, df)
        monkeypatch.undo()
        ForecastTable(spark, table.path).publish(forecasts(spark, 30.0, (5,)), "forest", "1")
        return made
    monkeypatch.setattr(ForecastTable, "_stage", slow)
    table.publish(forecasts(spark, 20.0), "ar1", "2")
    rows = sorted(table.read().collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == list(range(1, 16))
    assert [(r.model, r.run) for r in rows] == [("ar1", "1")] * 6 + [("forest", "1")] * 3 + [("ar1", "2")] * 6
    assert [(r.series_id, r.step, r.ts) for r in rows[:6]] == [(s, k, 10.0 + k) for s in (0, 1) for k in (1, 2, 3)]
    assert table.read("forest").count() == 3 and all("forest" != r.model for r in table.read("ar1").collect())
    assert len(table.vacuum()) == 1 and table.read().count() == 15


def test_forecast_table_takes_the_next_number_after_a_conflict(spark, monkeypatch):
    table = ForecastTable(spark, scratch_path(spark, "forecasts"))
    append, lost = CommitLog.append, []

    def late(log, entry, number):
        if not lost:
            lost.append(append(log, {"model": "x", "run": "1", "attempt": table._stage(forecasts(spark, 0.0))[0], "first_id": 1, "rows": 6}, number))
        return append(log, entry, number)
    monkeypatch.setattr(CommitLog, "append", late)
    assert table.publish(forecasts(spark, 1.0), "ar1", "1")["first_id"] == 7
    assert sorted(r.id for r in table.read().collect()) == list(range(1, 13))


@pytest.fixture(scope="module")
def hourly(spark):
    rng = np.random.default_rng(4)
    rows = []
    for s in range(2):
        level = np.cumsum(rng.normal(size=400)) * 0.2
        for i in range(400):
            t = at(1) + dt.timedelta(hours=i)
            rows.append((i, s, t, 15 + 5 * np.sin(i * 2 * np.pi / 24) + level[i], 60.0 + 10 * np.cos(i / 9) + level[i], 900.0 + s + 0.1 * level[i]))
    return rg.regularize(spark.createDataFrame([tuple(map(lambda x: x.item() if hasattr(x, "item") else x, r)) for r in rows], RAW)).cache()


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", list(fam.FAMILIES))
def test_every_family_round_trips(spark, hourly, name):
    store = ModelStore(spark, scratch_path(spark, "models"))
    model = fam.FAMILIES[name].fit(hourly, **({"num_trees": 3, "max_depth": 4} if name == "forest" else {}))
    assert store.save(name, model) == 1
    back = store.load(name)
    a = sorted_rows(fam.forecast(Model(model.family, model.tables, model.params), hourly, 30))
    b = sorted_rows(fam.forecast(back, hourly, 30))
    assert a == b and len(a) == 60 and back.version == 1 and all(v is not None for r in a for v in r)
    assert {(r[0], r[1]): r[2] for r in a}[0, 1] == at(1) + dt.timedelta(hours=400)
    shifted = fam.forecast(back, hourly, 2, first_step=0)
    assert {r.utc for r in shifted.where("step = 1").collect()} == {at(1) + dt.timedelta(hours=399)}
    # a station of five hours gets nothing from the families that need 25, and never an error
    few = hourly.where("pos < 5 and series_id = 0")
    assert fam.forecast(back, few, 3).count() in ((0,) if name in ("ar_diff", "window", "multihorizon") else (3,))


def test_store_keeps_versions(spark, hourly):
    store = ModelStore(spark, scratch_path(spark, "models"))
    for rows in (100, 200):
        store.save("ar1", fam.FAMILIES["ar1"].fit(hourly.where(F.col("pos") < rows)))
    assert store.versions("ar1") == [1, 2] and store.load("ar1").version == 2
    n = {v: {r.ts_n for r in store.load("ar1", v).tables["coefficients"].collect()} for v in (1, 2)}
    assert n == {1: {99}, 2: {199}}
    with pytest.raises(LookupError):
        store.load("ar1", 3)
    with pytest.raises(LookupError):
        store.load("none")


def test_window_rollout_equals_numpy(spark, hourly):
    """The stored statistics and coefficients, applied by hand to one station."""
    model = fam.Window().fit(hourly)
    stats, coef = model.tables["statistics"].first(), np.array(model.tables["coefficients"].first()["coef"])
    cols = fam.Window.columns
    mean, std = np.array([stats[f"{c}_mean"] for c in cols]), np.array([stats[f"{c}_std"] for c in cols])
    pdf = hourly.where("series_id = 1").toPandas().sort_values("pos")
    assert abs(mean[0] - hourly.agg(F.avg("ts")).first()[0]) < 1e-9
    rows = [[r.ts, r.hr, r.qfe, r.utc.hour, r.utc.day, r.utc.month] for r in pdf.tail(24).itertuples()]
    t, want = pdf["utc"].iloc[-1].to_pydatetime(), []
    for _ in range(30):
        x = (np.array(rows[-24:], float) - mean) / std
        y = np.append(x.ravel(), 1.0) @ coef * std[:3] + mean[:3]
        t += dt.timedelta(hours=1)
        rows.append([*y, t.hour, t.day, t.month])
        want.append(y)
    got = {r.step: (r.ts, r.hr, r.qfe) for r in fam.forecast(model, hourly, 30).where("series_id = 1").collect()}
    assert np.allclose([got[k] for k in range(1, 31)], want, rtol=1e-9)


def test_cyclic_fit_equals_lstsq_per_station(spark, hourly):
    model = fam.Cyclic().fit(hourly)
    pdf = hourly.where("series_id = 1").toPandas()
    s = pdf["utc"].astype("datetime64[s]").astype("int64").to_numpy().astype(float)
    x = np.column_stack([np.sin(s * 2 * np.pi / 86400), np.sin(s * 2 * np.pi / (365.2425 * 86400)), np.ones(len(s))])
    want = np.linalg.lstsq(x, pdf["hr"].to_numpy(), rcond=None)[0]
    got = model.tables["coefficients"].where("series_id = 1 and variable = 'hr'").first()["coef"]
    # the yearly wave is nearly a line over 17 days: compare what is predicted
    assert np.allclose(x @ np.array(got).ravel(), x @ want, rtol=1e-4)


def test_jobs_of_all_models(spark, raw):
    store, table = ModelStore(spark, scratch_path(spark, "models")), ForecastTable(spark, scratch_path(spark, "forecasts"))
    months = MonthTable(spark, scratch_path(spark, "months"))
    jobs.refresh(raw, months)
    assert jobs.refit(months, store, ["ar1", "climatology"]) == {"ar1": 1, "climatology": 1}
    for _ in range(2):
        jobs.publish_forecasts(raw, store, table, "today", ["ar1", "climatology"], horizon=4)
    got = table.read()
    assert got.groupBy("model").count().where("count = 12").count() == 2
    assert sorted(r.id for r in got.collect()) == list(range(1, 25))
