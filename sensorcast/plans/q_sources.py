"""Queries: sources, sinks, projections, filters."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorcast.operators import append as ap
from sensorcast.operators import regularize as rg
from sensorcast.operators import windows as wn
from sensorcast.plans import sql as S
from sensorcast.plans.registry import r6, register
from sensorcast.session import scratch_path
from sensorcast.sources import files as fs
from sensorcast.sources import readings as rd
from sensorcast.sources import testdata as td

V = ["ts", "hr", "qfe"]
RAW = ['"ID"', "series_id", "utc", "ts", "hr", "qfe"]


def hourly_table(spark, sf_dir, series="mod3"):
    return rg.regularize(td.readings(spark, sf_dir, series))


READINGS_SCHEMA = T.StructType([
    T.StructField("ID", T.LongType()), T.StructField("series_id", T.LongType()),
    T.StructField("utc", T.TimestampNTZType()),
    *[T.StructField(v, T.DoubleType()) for v in V]])


@register("read_csv_typed", f"WITH {S.readings_cte()} SELECT {', '.join(RAW)} FROM r")
def read_csv_typed(spark, sf_dir):
    path = fs.write_csv(td.readings(spark, sf_dir), scratch_path(spark, "readings-csv"))
    return fs.read_csv_typed(spark, path, READINGS_SCHEMA)


@register("read_csv_semicolon", f"""WITH {S.readings_cte('0')}, {S.hourly_cte()}
SELECT utc, round(ts, 6) AS ts FROM h WHERE ts IS NOT NULL""")
def read_csv_semicolon(spark, sf_dir):
    official = rg.hourly_mean(td.official_rows(spark, sf_dir, "ts").withColumn("series_id", F.lit(0)),
                              values=["ts"])
    path = fs.write_official_csv(official, "ts", scratch_path(spark, "official-ts"))
    return r6(fs.read_official_csv(spark, path, "ts"))


@register("scan_full", f"""SELECT event_id AS "ID", CAST(user_id % 3 AS BIGINT) AS series_id, ts AS utc,
  CAST(CAST(CASE WHEN event_type = 'click' THEN value END AS DECIMAL(6,2)) AS DOUBLE) AS ts,
  CAST(CAST(CASE WHEN event_type = 'view' THEN value END AS DECIMAL(6,2)) AS DOUBLE) AS hr,
  CAST(CAST(CASE WHEN event_type = 'error' THEN value END AS DECIMAL(6,2)) AS DOUBLE) AS qfe
FROM events""")
def scan_full(spark, sf_dir):
    path = scratch_path(spark, "weather-measurement")
    td.weather_measurement(spark, sf_dir).write.parquet(path)
    return rd.to_internal(rd.scan_parquet(spark, path, rd.WEATHER_MEASUREMENT))


@register("incremental_scan", f"""WITH {S.readings_cte()},
old AS (SELECT max(date_trunc('hour', utc)) AS mark FROM r WHERE utc < TIMESTAMP '{td.STORED_BEFORE}')
SELECT {', '.join(RAW)} FROM r WHERE utc >= (SELECT mark FROM old)""")
def incremental_scan(spark, sf_dir):
    raw = td.readings(spark, sf_dir)
    stored = rg.hourly_mean(raw.filter(F.col("utc") < F.lit(td.STORED_BEFORE).cast("timestamp_ntz")))
    return rd.incremental_scan(raw, stored)


@register("latest_n", f"""WITH {S.readings_cte()}
SELECT {', '.join(RAW)} FROM r ORDER BY "ID" DESC LIMIT 720""")
def latest_n(spark, sf_dir):
    return rd.latest_n(td.readings(spark, sf_dir), 720)


@register("head_preview", f"""WITH {S.readings_cte()}
SELECT {', '.join(RAW)} FROM r ORDER BY "ID" LIMIT 6""")
def head_preview(spark, sf_dir):
    return ap.head_preview(td.readings(spark, sf_dir), ["ID"], 6)


@register("project_named", f"""WITH {S.readings_cte()}
SELECT utc, qfe, ts, hr FROM r""")
def project_named(spark, sf_dir):
    # select by name in a new order, dropping ID and series
    return td.readings(spark, sf_dir).select("utc", "qfe", "ts", "hr")


@register("rename_domain", f"""WITH {S.hourly_table_sql()}
SELECT series_id, utc, round(ts, 6) AS "Ts_Valor", round(hr, 6) AS "HR_Valor", round(qfe, 6) AS "QFE_Valor" FROM i""")
def rename_domain(spark, sf_dir):
    h = hourly_table(spark, sf_dir).drop("pos")
    return r6(rd.rename_domain(h, rd.INTERNAL_TO_HOURLY))


@register("filter_after", f"""WITH {S.readings_cte()}
SELECT {', '.join(RAW)} FROM r WHERE utc > TIMESTAMP '2024-01-25 16:45:25'""")
def filter_after(spark, sf_dir):
    return rd.filter_after(td.readings(spark, sf_dir), "2024-01-25 16:45:25")


@register("filter_time_of_day", f"""WITH {S.readings_cte()}
SELECT {', '.join(RAW)} FROM r WHERE hour(utc) * 3600 + minute(utc) * 60 + second(utc) > 14 * 3600""")
def filter_time_of_day(spark, sf_dir):
    return rd.filter_time_of_day(td.readings(spark, sf_dir), 14 * 3600)


def _tail_sql(last, skip):
    return f"""WITH {S.hourly_table_sql()},
n AS (SELECT series_id, count(*) AS n FROM i GROUP BY series_id)
SELECT i.series_id, i.utc, i.pos, {S.r6(['i.ts', 'i.hr', 'i.qfe']).replace('AS i.', 'AS ')}
FROM i JOIN n USING (series_id) WHERE i.pos >= n.n - {last + skip} AND i.pos < n.n - {skip}"""


@register("tail_slice", _tail_sql(24, 0))
def tail_slice(spark, sf_dir):
    return r6(wn.tail_slice(hourly_table(spark, sf_dir), last=24))


@register("tail_range_slice", _tail_sql(76, 72))
def tail_range_slice(spark, sf_dir):
    # the [-148:-72] slice
    return r6(wn.tail_slice(hourly_table(spark, sf_dir), last=76, skip_last=72))


@register("write_roundtrip", f"""WITH {S.hourly_table_sql()}
SELECT series_id, utc, pos, {S.r6(V)}, CAST(year(utc) AS INTEGER) AS year, CAST(month(utc) AS INTEGER) AS month FROM i""")
def write_roundtrip(spark, sf_dir):
    path = fs.write_hourly_table(hourly_table(spark, sf_dir), scratch_path(spark, "hourly"))
    back = fs.read_hourly_table(spark, path)
    return r6(back.select("series_id", "utc", "pos", *V, "year", "month"))
