"""Queries: scalar functions, statistics, normalisation, sequences, splits
(N1-N12, A4-A7, Z1-Z4, W2-W12)."""

from pyspark.sql import functions as F

from sensorcast.functions import time as tf
from sensorcast.functions.numeric import round_even
from sensorcast.operators import regularize as rg
from sensorcast.operators import scale as sc
from sensorcast.operators import split as sp
from sensorcast.operators import stats as st
from sensorcast.operators import windows as wn
from sensorcast.plans import sql as S
from sensorcast.plans.registry import r6, register
from sensorcast.sources import testdata as td

V = ["ts", "hr", "qfe"]
H = S.hourly_table_sql()


def hourly_table(spark, sf_dir, series="mod3"):
    return rg.regularize(td.readings(spark, sf_dir, series))


# ---------------------------------------------------------------- time functions

@register("calendar_features", f"""WITH {S.readings_cte()}
SELECT "ID", utc, CAST(minute(utc) AS INTEGER) AS minute, CAST(hour(utc) AS INTEGER) AS hour,
  CAST(day(utc) AS INTEGER) AS day, CAST(month(utc) AS INTEGER) AS month, CAST(year(utc) AS INTEGER) AS year FROM r""")
def calendar_features(spark, sf_dir):
    r = td.readings(spark, sf_dir).select("ID", "utc")
    return tf.calendar_features(r, minute=True)


@register("cyclic_features", f"""WITH {H}
SELECT series_id, utc, round(sin(epoch(utc) * (2 * pi() / 86400)), 6) AS dsin,
  round(sin(epoch(utc) * (2 * pi() / (365.2425 * 86400))), 6) AS ysin FROM i""")
def cyclic_features(spark, sf_dir):
    return r6(tf.cyclic_features(hourly_table(spark, sf_dir).select("series_id", "utc")))


@register("cyclic_calendar", f"""WITH {H}
SELECT series_id, utc, round(sin(CAST(hour(utc) AS DOUBLE)), 6) AS hour_sin,
  round(sin(CAST(day(utc) + month(utc) AS DOUBLE)), 6) AS daymonth_sin FROM i""")
def cyclic_calendar(spark, sf_dir):
    return r6(tf.cyclic_calendar(hourly_table(spark, sf_dir).select("series_id", "utc")))


@register("time_of_day_split", f"""WITH {S.readings_cte()}
SELECT "ID", utc, CAST(hour(utc) * 3600 + minute(utc) * 60 + second(utc) AS INTEGER) AS time_of_day,
  CAST(utc AS DATE) AS date FROM r""")
def time_of_day_split(spark, sf_dir):
    return tf.time_of_day_split(td.readings(spark, sf_dir).select("ID", "utc"))


@register("parse_ts_ymd", """SELECT event_id AS "ID", strftime(ts, '%Y-%m-%d %H:%M:%S') AS raw,
  date_trunc('second', ts) AS utc FROM events""")
def parse_ts_ymd(spark, sf_dir):
    raw = td.readings(spark, sf_dir).select("ID", F.date_format("utc", tf.YMD_HMS).alias("raw"))
    return raw.withColumn("utc", tf.parse_timestamp("raw", tf.YMD_HMS))


@register("parse_ts_dmy", """SELECT event_id AS "ID", strftime(ts, '%d-%m-%Y %H:%M:%S') AS raw,
  date_trunc('second', ts) AS utc FROM events""")
def parse_ts_dmy(spark, sf_dir):
    raw = td.readings(spark, sf_dir).select("ID", F.date_format("utc", tf.DMY_HMS).alias("raw"))
    return raw.withColumn("utc", tf.parse_timestamp("raw", tf.DMY_HMS))


@register("future_grid", f"""WITH {H},
l AS (SELECT series_id, max(utc) AS t0 FROM i GROUP BY series_id)
SELECT series_id, CAST(s AS INTEGER) AS step, t0 + s * INTERVAL 1 HOUR AS utc
FROM l, range(1, 73) AS t(s)""")
def future_grid(spark, sf_dir):
    last = st.last_observation(hourly_table(spark, sf_dir), values=[])
    return tf.future_grid(last, ["series_id"], horizon=72, first_step=1)


@register("round_even", """WITH x AS (SELECT event_id AS "ID", floor(value * 8) / 8 AS x FROM events)
SELECT "ID", x, round_even(x, 2) AS r2, round_even(x, 0) AS r0, round_even(x / 2, 3) AS r3 FROM x""")
def round_even_q(spark, sf_dir):
    x = td.table(spark, sf_dir, "events").select(F.col("event_id").alias("ID"),
                                                 (F.floor(F.col("value") * 8) / 8).alias("x"))
    return x.select("ID", "x", round_even("x", 2).alias("r2"), round_even("x", 0).alias("r0"),
                    round_even(F.col("x") / 2, 3).alias("r3"))


# ---------------------------------------------------------------- statistics

@register("column_stats", f"""WITH {H}
SELECT series_id, {', '.join(f'round(avg({v}), 6) AS {v}_mean, round(stddev_samp({v}), 6) AS {v}_std' for v in V)}
FROM i GROUP BY series_id""")
def column_stats(spark, sf_dir):
    return r6(sc.column_stats(hourly_table(spark, sf_dir), keys=["series_id"]))


@register("summary_stats", """WITH x AS (SELECT l_quantity AS ts, l_extendedprice AS hr, l_discount AS qfe FROM lineitem),
u AS (UNPIVOT x ON ts, hr, qfe INTO NAME variable VALUE value)
SELECT variable, round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q1,
  round(quantile_cont(value, 0.5), 6) AS median, round(avg(value), 6) AS mean,
  round(quantile_cont(value, 0.75), 6) AS q3, round(max(value), 6) AS max,
  (SELECT count(*) FROM lineitem) - count(value) AS na
FROM u GROUP BY variable""")
def summary_stats(spark, sf_dir):
    return r6(st.summary_stats(td.lineitem_readings(spark, sf_dir), V))


@register("last_observation", f"""WITH {H}
SELECT series_id, max(utc) AS utc, {', '.join(f'round(arg_max_null({v}, utc), 6) AS {v}' for v in V)}
FROM i GROUP BY series_id""")
def last_observation(spark, sf_dir):
    return r6(st.last_observation(hourly_table(spark, sf_dir)))


# ---------------------------------------------------------------- normalisation

def _z_sql(stats_from: str, inverse: bool = False) -> str:
    expr = ", ".join(
        (f"round(((i.{v} - s.{v}_mean) / NULLIF(s.{v}_std, 0)) * s.{v}_std + s.{v}_mean, 6) AS {v}" if inverse
         else f"round((i.{v} - s.{v}_mean) / NULLIF(s.{v}_std, 0), 6) AS {v}") for v in V)
    return f"""WITH {H},
sp AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM i),
s AS (SELECT series_id, {', '.join(f'avg({v}) AS {v}_mean, stddev_samp({v}) AS {v}_std' for v in V)}
      FROM sp WHERE {stats_from} GROUP BY series_id)
SELECT i.series_id, i.utc, i.pos, {expr} FROM i JOIN s USING (series_id)"""


@register("zscore", _z_sql("TRUE"))
def zscore(spark, sf_dir):
    h = hourly_table(spark, sf_dir)
    stats = sc.fit_zscore(h, keys=["series_id"], fit_on="all")
    return r6(sc.zscore(h, stats, keys=["series_id"]))


@register("zscore_train", _z_sql("pos < round_even(n * 0.9, 0)"))
def zscore_train(spark, sf_dir):
    h = sp.split_train_test(hourly_table(spark, sf_dir), 0.9)
    stats = sc.fit_zscore(h, keys=["series_id"], split_col="split", fit_on="train")
    return r6(sc.zscore(h, stats, keys=["series_id"]).drop("split"))


@register("zscore_inverse", _z_sql("TRUE", inverse=True))
def zscore_inverse(spark, sf_dir):
    h = hourly_table(spark, sf_dir)
    stats = sc.fit_zscore(h, keys=["series_id"], fit_on="all")
    return r6(sc.zscore_inverse(sc.zscore(h, stats, keys=["series_id"]), stats, keys=["series_id"]))


@register("zscore_future", f"""WITH {H},
c AS (SELECT series_id, hour(utc) AS hour, day(utc) AS day, month(utc) AS month FROM i),
s AS (SELECT avg(hour) AS hm, stddev_samp(hour) AS hs, avg(day) AS dm, stddev_samp(day) AS ds,
             avg(month) AS mm, stddev_samp(month) AS ms FROM c),
l AS (SELECT series_id, max(utc) AS t0 FROM i GROUP BY series_id),
f AS (SELECT series_id, CAST(s AS INTEGER) AS step, t0 + s * INTERVAL 1 HOUR AS utc FROM l, range(1, 73) AS t(s))
SELECT series_id, step, utc, round((hour(utc) - hm) / NULLIF(hs, 0), 6) AS hour,
  round((day(utc) - dm) / NULLIF(ds, 0), 6) AS day, round((month(utc) - mm) / NULLIF(ms, 0), 6) AS month FROM f, s""")
def zscore_future(spark, sf_dir):
    h = hourly_table(spark, sf_dir)
    cal = ["hour", "day", "month"]
    stats = sc.column_stats(tf.calendar_features(h, year=False), cal)
    last = st.last_observation(h, values=[])
    grid = tf.calendar_features(tf.future_grid(last, ["series_id"], horizon=72), year=False)
    return r6(sc.zscore(grid.withColumns({c: F.col(c).cast("double") for c in cal}), stats, cal))


# ---------------------------------------------------------------- sequences

@register("lag_supervised", f"""WITH {H},
x AS (SELECT *, {', '.join(f'lead({v}) OVER w AS y_{v}' for v in V)}, lead(pos) OVER w AS lp
      FROM i WINDOW w AS (PARTITION BY series_id ORDER BY pos))
SELECT series_id, utc, pos, {S.r6(V + ['y_' + v for v in V])} FROM x WHERE lp IS NOT NULL""")
def lag_supervised(spark, sf_dir):
    return r6(wn.lag_supervised(hourly_table(spark, sf_dir)))


@register("lag_matrix", f"""WITH {H}
SELECT series_id, utc, pos, round(ts, 6) AS ts,
  {', '.join(f'round(lag(ts, {k}) OVER (PARTITION BY series_id ORDER BY pos), 6) AS ts_lag{k}' for k in range(1, 25))}
FROM i""")
def lag_matrix(spark, sf_dir):
    h = hourly_table(spark, sf_dir).select("series_id", "utc", "pos", "ts")
    return r6(wn.lag_matrix(h, values=["ts"], lags=24))


@register("difference", f"""WITH {H}
SELECT series_id, utc, pos, {S.r6(V)},
  {', '.join(f'round({v} - lag({v}) OVER (PARTITION BY series_id ORDER BY pos), 6) AS d_{v}' for v in V)}
FROM i""")
def difference(spark, sf_dir):
    return r6(wn.difference(hourly_table(spark, sf_dir)))


@register("undifference", f"""WITH {H},
d AS (SELECT *, {', '.join(f'{v} - lag({v}) OVER (PARTITION BY series_id ORDER BY pos) AS d_{v}' for v in V)} FROM i),
b AS (SELECT series_id, {', '.join(f'max(CASE WHEN pos = 0 THEN {v} END) AS b_{v}' for v in V)} FROM i GROUP BY series_id)
SELECT series_id, utc, pos,
  {', '.join(f'round(b_{v} + sum(coalesce(d_{v}, 0)) OVER (PARTITION BY series_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS {v}' for v in V)}
FROM d JOIN b USING (series_id)""")
def undifference(spark, sf_dir):
    h = hourly_table(spark, sf_dir)
    d = wn.difference(h).select("series_id", "utc", "pos", *[f"d_{v}" for v in V])
    base = h.filter(F.col("pos") == 0).select("series_id", *V)
    return r6(wn.undifference(d, base).select("series_id", "utc", "pos", *V))


CAL = ["hour", "day", "month"]


def _nsum(arr, field):
    """SQL ``sum`` over an array of structs: nulls skipped, null when all are null."""
    return F.aggregate(arr, F.lit(None).cast("double"),
                       lambda a, r: F.when(r[field].isNull(), a).otherwise(F.coalesce(a, F.lit(0.0)) + r[field]))


def _windows_spark(spark, sf_dir):
    h = tf.calendar_features(hourly_table(spark, sf_dir), year=False)
    h = sp.split_train_test(h, 0.9)
    return wn.sliding_windows(h, keys=["series_id", "split"], features=V + CAL, targets=V, length=24)


@register("sliding_windows", f"""WITH {H},
c AS (SELECT *, hour(utc) AS hour, count(*) OVER (PARTITION BY series_id) AS n FROM i),
s AS (SELECT *, CASE WHEN pos < round_even(n * 0.9, 0) THEN 'train' ELSE 'test' END AS split FROM c),
w AS (SELECT *, count(*) OVER w24 AS len, sum(ts) OVER w24 AS x_sum_ts, sum(hour) OVER w24 AS x_sum_hour,
        first_value(qfe) OVER w24 AS x_first_qfe, last_value(hr) OVER w24 AS x_last_hr
      FROM s WINDOW w24 AS (PARTITION BY series_id, split ORDER BY pos ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
SELECT series_id, split, utc, pos, len, round(x_sum_ts, 6) AS x_sum_ts, CAST(x_sum_hour AS BIGINT) AS x_sum_hour,
  round(x_first_qfe, 6) AS x_first_qfe, round(x_last_hr, 6) AS x_last_hr, {S.r6(['y_' + v for v in V]).replace('round(y_', 'round(')}
FROM w WHERE len = 24""")
def sliding_windows(spark, sf_dir):
    w = _windows_spark(spark, sf_dir)
    return r6(w.select(
        "series_id", "split", "utc", "pos", F.size("x").cast("bigint").alias("len"),
        _nsum("x", "ts").alias("x_sum_ts"),
        F.aggregate("x", F.lit(0).cast("bigint"), lambda a, r: a + r["hour"]).alias("x_sum_hour"),
        F.col("x")[0]["qfe"].alias("x_first_qfe"), F.element_at("x", -1)["hr"].alias("x_last_hr"),
        *[F.col(f"y_{v}") for v in V]))


@register("window_reshape", f"""WITH {H},
t AS (SELECT series_id, pos FROM i WHERE pos >= 24),
e AS (SELECT t.series_id, t.pos, s.pos - (t.pos - 24) AS j, s.ts, s.hr, s.qfe
      FROM t JOIN i s ON s.series_id = t.series_id AND s.pos BETWEEN t.pos - 24 AND t.pos - 1),
u AS (SELECT series_id, pos, j * 3 AS k, ts AS value FROM e UNION ALL
      SELECT series_id, pos, j * 3 + 1, hr FROM e UNION ALL SELECT series_id, pos, j * 3 + 2, qfe FROM e)
SELECT series_id, pos, CAST(k AS INTEGER) AS k, round(value, 6) AS value FROM u""")
def window_reshape(spark, sf_dir):
    w = wn.sliding_windows(hourly_table(spark, sf_dir), features=V, targets=[], length=24)
    flat = w.select("series_id", "pos", wn.flatten_window("x", V).alias("flat"))
    back = flat.select("series_id", "pos", wn.unflatten_window("flat", V).alias("rows"))
    again = back.select("series_id", "pos", wn.flatten_window("rows", V).alias("flat"))
    return r6(again.select("series_id", "pos", F.posexplode("flat").alias("k", "value")))


def _s2s_sql(inp, lab, shift, label_cols):
    total = inp + shift
    return f"""WITH {H},
c AS (SELECT *, sin(epoch(utc) * (2 * pi() / 86400)) AS dsin FROM i),
w AS (SELECT *, count(*) OVER wi AS n_in, sum(dsin) OVER wi AS in_sum_dsin, sum(ts) OVER wi AS in_sum_ts,
        count(*) OVER wl AS n_lab, sum({label_cols[-1]}) OVER wl AS lab_sum, first_value({label_cols[0]}) OVER wl AS lab_first
      FROM c WINDOW wi AS (PARTITION BY series_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {inp - 1} FOLLOWING),
                    wl AS (PARTITION BY series_id ORDER BY pos ROWS BETWEEN {total - lab} FOLLOWING AND {total - 1} FOLLOWING))
SELECT series_id, utc, pos, n_in, n_lab, round(in_sum_dsin, 6) AS in_sum_dsin, round(in_sum_ts, 6) AS in_sum_ts,
  round(lab_sum, 6) AS lab_sum, round(lab_first, 6) AS lab_first
FROM w WHERE n_in = {inp} AND n_lab = {lab}"""


def _s2s_spark(spark, sf_dir, inp, lab, shift, label_cols):
    h = tf.cyclic_features(hourly_table(spark, sf_dir))
    w = wn.seq2seq_windows(h, features=V + ["dsin", "ysin"], label_columns=label_cols,
                           input_width=inp, label_width=lab, shift=shift)
    add = _nsum
    return r6(w.select("series_id", "utc", "pos", F.size("inputs").cast("bigint").alias("n_in"),
                       F.size("labels").cast("bigint").alias("n_lab"), add("inputs", "dsin").alias("in_sum_dsin"),
                       add("inputs", "ts").alias("in_sum_ts"), add("labels", label_cols[-1]).alias("lab_sum"),
                       F.col("labels")[0][label_cols[0]].alias("lab_first")))


@register("seq2seq_windows", _s2s_sql(24, 24, 24, V))
def seq2seq_windows(spark, sf_dir):
    return _s2s_spark(spark, sf_dir, 24, 24, 24, V)


@register("seq2seq_windows_onestep", _s2s_sql(24, 1, 1, ["ts"]))
def seq2seq_windows_onestep(spark, sf_dir):
    return _s2s_spark(spark, sf_dir, 24, 1, 1, ["ts"])


@register("shuffled_sample")
def shuffled_sample(spark, sf_dir):
    w = wn.sliding_windows(hourly_table(spark, sf_dir), features=V, targets=V, length=24)
    return wn.shuffled_batches(w.select("series_id", "utc", "y_ts"), seed=42)


# ---------------------------------------------------------------- splits

def _split_sql(case):
    return f"""WITH {H}, c AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM i)
SELECT series_id, utc, pos, {case} AS split FROM c"""


@register("split_train_test", _split_sql("CASE WHEN pos < round_even(n * 0.9, 0) THEN 'train' ELSE 'test' END"))
def split_train_test(spark, sf_dir):
    return sp.split_train_test(hourly_table(spark, sf_dir), 0.9).select("series_id", "utc", "pos", "split")


@register("split_train_val_test", _split_sql(
    "CASE WHEN pos < floor(n * 0.8) THEN 'train' WHEN pos < floor(n * 0.95) THEN 'val' ELSE 'test' END"))
def split_train_val_test(spark, sf_dir):
    return sp.split_train_val_test(hourly_table(spark, sf_dir)).select("series_id", "utc", "pos", "split")


@register("split_validation_tail", _split_sql(
    "CASE WHEN pos < floor(round_even(n * 0.9, 0) * (1 - 0.15)) THEN 'train' "
    "WHEN pos < round_even(n * 0.9, 0) THEN 'val' ELSE 'test' END"))
def split_validation_tail(spark, sf_dir):
    return sp.split_validation_tail(hourly_table(spark, sf_dir)).select("series_id", "utc", "pos", "split")
