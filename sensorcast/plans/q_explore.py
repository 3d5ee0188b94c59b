"""Queries: joins, appends and exploration."""

from pyspark.sql import functions as F

from sensorcast.operators import append as ap
from sensorcast.operators import explore as ex
from sensorcast.operators import joins as jn
from sensorcast.operators import regularize as rg
from sensorcast.plans import sql as S
from sensorcast.plans.registry import r6, register
from sensorcast.sources import readings as rd
from sensorcast.sources import testdata as td

V = ["ts", "hr", "qfe"]
H = S.hourly_table_sql()


def hourly_table(spark, sf_dir, series="mod3"):
    return rg.regularize(td.readings(spark, sf_dir, series))


def _official(spark, sf_dir, v):
    rows = td.official_rows(spark, sf_dir, v).withColumn("series_id", F.lit(0).cast("long"))
    return rg.hourly_mean(rows, values=[v])


def _official_sql(v, t):
    return f"""{v} AS (SELECT CAST(0 AS BIGINT) AS series_id, date_trunc('hour', ts) AS utc, avg(value) AS {v}
  FROM events WHERE event_type = '{t}' GROUP BY date_trunc('hour', ts))"""


@register("join_three_sources", f"""WITH {_official_sql('ts', 'click')}, {_official_sql('hr', 'view')},
{_official_sql('qfe', 'error')}
SELECT series_id, utc, round(ts, 6) AS ts, round(hr, 6) AS hr, round(qfe, 6) AS qfe
FROM ts JOIN hr USING (series_id, utc) JOIN qfe USING (series_id, utc)""")
def join_three_sources(spark, sf_dir):
    return r6(jn.join_sources([_official(spark, sf_dir, v) for v in V]))


def _overlay_sql(kind):
    src = lambda name, parity: f"""{name} AS (SELECT CAST(0 AS BIGINT) AS series_id, date_trunc('hour', ts) AS utc,
  avg(CASE WHEN event_type = 'click' THEN value END) AS ts, avg(CASE WHEN event_type = 'view' THEN value END) AS hr,
  avg(CASE WHEN event_type = 'error' THEN value END) AS qfe
  FROM events WHERE user_id % 2 = {parity} GROUP BY date_trunc('hour', ts))"""  # noqa: E731
    if kind == "left":
        sel = "b.series_id, b.utc"
        join = "b LEFT JOIN o ON b.series_id = o.series_id AND b.utc = o.utc"
    else:
        sel = "coalesce(b.series_id, o.series_id) AS series_id, coalesce(b.utc, o.utc) AS utc"
        join = "b FULL JOIN o ON b.series_id = o.series_id AND b.utc = o.utc"
    vals = ", ".join(f"round(coalesce(o.{v}, b.{v}), 6) AS {v}" for v in V)
    return f"WITH {src('o', 0)}, {src('b', 1)} SELECT {sel}, {vals} FROM {join}"


def _overlay_inputs(spark, sf_dir):
    local, official = td.local_and_official(spark, sf_dir)
    return rg.hourly_mean(official), rg.hourly_mean(local)


@register("overlay_update", _overlay_sql("left"))
def overlay_update(spark, sf_dir):
    base, over = _overlay_inputs(spark, sf_dir)
    return r6(jn.overlay_update(base, over))


@register("overlay_full", _overlay_sql("full"))
def overlay_full(spark, sf_dir):
    base, over = _overlay_inputs(spark, sf_dir)
    return r6(jn.overlay_full(base, over))


# ---------------------------------------------------------------- appends

def _append_parts(spark, sf_dir):
    raw = td.readings(spark, sf_dir)
    old = raw.filter(F.col("utc") < F.lit(td.STORED_BEFORE).cast("timestamp_ntz"))
    stored = rg.regularize(old).drop("pos")
    new = rg.regularize(rd.incremental_scan(raw, stored)).drop("pos")
    return stored, new


APPEND_CTES = ",\n".join([
    S.readings_cte(),
    f"sr AS (SELECT * FROM r WHERE utc < TIMESTAMP '{td.STORED_BEFORE}')",
    S.hourly_table_sql(p="s", raw="sr"),
    "mark AS (SELECT max(utc) AS m FROM si)",
    "nr AS (SELECT * FROM r WHERE utc >= (SELECT m FROM mark))",
    S.hourly_table_sql(p="n", raw="nr"),
])


@register("append_hours", f"""WITH {APPEND_CTES}
SELECT series_id, utc, {S.r6(V)} FROM si UNION ALL SELECT series_id, utc, {S.r6(V)} FROM ni""")
def append_hours(spark, sf_dir):
    stored, new = _append_parts(spark, sf_dir)
    return r6(ap.append_hours(stored, new))


@register("append_hours_dedup", f"""WITH {APPEND_CTES},
u AS (SELECT *, 0 AS ver FROM si UNION ALL SELECT *, 1 AS ver FROM ni)
SELECT series_id, utc, {', '.join(f'round(arg_max({v}, ver), 6) AS {v}' for v in V)} FROM u GROUP BY series_id, utc""")
def append_hours_dedup(spark, sf_dir):
    stored, new = _append_parts(spark, sf_dir)
    return r6(ap.append_hours_dedup(stored, new))


# ---------------------------------------------------------------- exploration

@register("evolution_series", f"""WITH {H}
SELECT series_id, date_trunc('day', utc) AS utc,
  {', '.join(f'round(min({v}), 6) AS {v}_min, round(avg({v}), 6) AS {v}_mean, round(max({v}), 6) AS {v}_max' for v in V)}
FROM i GROUP BY series_id, date_trunc('day', utc)""")
def evolution_series(spark, sf_dir):
    return r6(ex.evolution_series(hourly_table(spark, sf_dir)))


@register("diurnal_by_date", f"""WITH {S.readings_cte()}
SELECT CAST(utc AS DATE) AS date, CAST(hour(utc) AS INTEGER) AS hour, count(*) AS n, {', '.join(f'round(avg({v}), 6) AS {v}' for v in V)}
FROM r GROUP BY CAST(utc AS DATE), hour(utc)""")
def diurnal_by_date(spark, sf_dir):
    return r6(ex.diurnal_by_date(td.readings(spark, sf_dir)))


@register("diurnal_by_month", f"""WITH {S.readings_cte()},
c AS (SELECT CAST(month(utc) AS INTEGER) AS month, CAST(hour(utc) AS INTEGER) AS hour, ts, hr, qfe FROM r),
u AS (SELECT * FROM c UNPIVOT INCLUDE NULLS (value FOR variable IN (ts, hr, qfe)))
SELECT month, hour, variable, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(quantile_cont(value, 0.5), 6) AS median
FROM u GROUP BY month, hour, variable""")
def diurnal_by_month(spark, sf_dir):
    return r6(ex.diurnal_by_month(td.readings(spark, sf_dir)))


LI = """x AS (SELECT CAST(l_shipdate AS TIMESTAMP) AS utc, l_quantity AS ts, l_extendedprice AS hr, l_discount AS qfe FROM lineitem),
b AS (SELECT min(ts) AS xl, max(ts) AS xh, min(hr) AS yl, max(hr) AS yh FROM x),
bx AS (SELECT x.*, CASE WHEN ts < xl THEN 0 WHEN ts >= xh THEN 11 ELSE CAST(floor(10.0 * (ts - xl) / (xh - xl)) AS BIGINT) + 1 END AS x_bin,
              CASE WHEN hr < yl THEN 0 WHEN hr >= yh THEN 11 ELSE CAST(floor(10.0 * (hr - yl) / (yh - yl)) AS BIGINT) + 1 END AS y_bin
       FROM x, b)"""


@register("binned_relation", f"""WITH {LI}
SELECT x_bin, y_bin, count(*) AS n, round(CAST(sum(CAST(qfe AS DECIMAL(28,10))) AS DOUBLE) / count(qfe), 6) AS qfe_mean FROM bx GROUP BY x_bin, y_bin""")
def binned_relation(spark, sf_dir):
    return r6(ex.binned_relation(td.lineitem_readings(spark, sf_dir), "ts", "hr", "qfe", bins=10))


@register("binned_relation_by_month", f"""WITH {LI}
SELECT CAST(month(utc) AS INTEGER) AS month, x_bin, y_bin, count(*) AS n, round(CAST(sum(CAST(qfe AS DECIMAL(28,10))) AS DOUBLE) / count(qfe), 6) AS qfe_mean
FROM bx GROUP BY month(utc), x_bin, y_bin""")
def binned_relation_by_month(spark, sf_dir):
    return r6(ex.binned_relation(td.lineitem_readings(spark, sf_dir), "ts", "hr", "qfe", bins=10, by_month=True))


@register("density_2d", f"""WITH {LI}
SELECT x_bin, y_bin, count(*) AS n, round(count(*) / (SELECT count(*) FROM bx), 6) AS share FROM bx GROUP BY x_bin, y_bin""")
def density_2d(spark, sf_dir):
    return r6(ex.density_2d(td.lineitem_readings(spark, sf_dir), "ts", "hr", bins=10))


@register("smooth_density", """WITH e AS (SELECT min(l_quantity) AS xl, max(l_quantity) AS xh, min(l_extendedprice) AS yl, max(l_extendedprice) AS yh,
  1.06 * stddev_samp(l_quantity) * pow(count(*), -0.2) AS hx, 1.06 * stddev_samp(l_extendedprice) * pow(count(*), -0.2) AS hy, count(*) AS n FROM lineitem),
c AS (SELECT least(floor((l_quantity - xl) * 100 / (xh - xl)), 99) AS i, least(floor((l_extendedprice - yl) * 100 / (yh - yl)), 99) AS j, count(*) AS k
      FROM lineitem, e GROUP BY ALL),
g AS (SELECT xl + a * (xh - xl) / 24 AS x_point, yl + b * (yh - yl) / 24 AS y_point, e.* FROM e, range(25) t(a), range(25) u(b))
SELECT round(x_point, 6) AS x_point, round(y_point, 6) AS y_point, round(1e6 * sum(k * exp(-0.5 * pow((x_point - xl - (i + 0.5) * (xh - xl) / 100) / hx, 2))
  * exp(-0.5 * pow((y_point - yl - (j + 0.5) * (yh - yl) / 100) / hy, 2))) / any_value(n * hx * hy * 2 * pi()), 6) AS density_per_million
FROM g, c GROUP BY x_point, y_point""")
def smooth_density(spark, sf_dir):
    d = ex.smooth_density(td.lineitem_readings(spark, sf_dir), "ts", "hr")
    return r6(d.select("x_point", "y_point", (F.col("density") * 1e6).alias("density_per_million")))


@register("correlations", """SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr_ts_hr,
  round(corr(l_quantity, l_discount), 6) AS corr_ts_qfe, round(corr(l_extendedprice, l_discount), 6) AS corr_hr_qfe
FROM lineitem""")
def correlations(spark, sf_dir):
    return r6(ex.correlations(td.lineitem_readings(spark, sf_dir)))


@register("correlations_by_month", """SELECT CAST(month(l_shipdate) AS INTEGER) AS month,
  round(corr(l_quantity, l_extendedprice), 6) AS corr_ts_hr,
  round(corr(l_quantity, l_discount), 6) AS corr_ts_qfe, round(corr(l_extendedprice, l_discount), 6) AS corr_hr_qfe
FROM lineitem GROUP BY month(l_shipdate)""")
def correlations_by_month(spark, sf_dir):
    return r6(ex.correlations_by_month(td.lineitem_readings(spark, sf_dir)))


@register("diurnal_extrema", f"""WITH {H},
c AS (SELECT series_id, CAST(hour(utc) AS INTEGER) AS hour, ts, hr, qfe FROM i),
u AS (SELECT * FROM c UNPIVOT INCLUDE NULLS (value FOR variable IN (ts, hr, qfe))),
p AS (SELECT series_id, variable, hour, avg(value) AS mean FROM u GROUP BY ALL),
n AS (SELECT *, coalesce(lag(mean) OVER w, last_value(mean) OVER wa) AS prv, coalesce(lead(mean) OVER w, first_value(mean) OVER wa) AS nxt
      FROM p WINDOW w AS (PARTITION BY series_id, variable ORDER BY hour),
                    wa AS (PARTITION BY series_id, variable ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT series_id, variable, arg_max(hour, mean) AS peak_hour, round(max(mean), 6) AS peak_mean,
  arg_min(hour, mean) AS trough_hour, round(min(mean), 6) AS trough_mean,
  count(*) FILTER (WHERE mean > prv AND mean > nxt) AS local_maxima,
  count(*) FILTER (WHERE mean < prv AND mean < nxt) AS local_minima
FROM n GROUP BY series_id, variable""")
def diurnal_extrema(spark, sf_dir):
    return r6(ex.diurnal_extrema(hourly_table(spark, sf_dir), keys=["series_id"]))


@register("monthly_drift", """SELECT date_trunc('month', l_shipdate) AS month,
  round(avg(l_quantity), 6) AS ts_mean, round(var_samp(l_quantity), 6) AS ts_var,
  round(avg(l_extendedprice), 6) AS hr_mean, round(var_samp(l_extendedprice), 6) AS hr_var,
  round(avg(l_discount), 6) AS qfe_mean, round(var_samp(l_discount), 6) AS qfe_var
FROM lineitem GROUP BY date_trunc('month', l_shipdate)""")
def monthly_drift(spark, sf_dir):
    return r6(ex.monthly_drift(td.lineitem_readings(spark, sf_dir)))


@register("gap_runs", f"""WITH {S.readings_cte()}, {S.hourly_cte()}, {S.grid_cte()},
u AS (SELECT * FROM (SELECT series_id, utc, pos, ts, hr, qfe FROM g) UNPIVOT INCLUDE NULLS (value FOR variable IN (ts, hr, qfe))),
e AS (SELECT *, pos - row_number() OVER (PARTITION BY series_id, variable ORDER BY pos) AS grp FROM u WHERE value IS NULL)
SELECT series_id, variable, min(utc) AS start, max(utc) AS "end", count(*) AS steps FROM e GROUP BY series_id, variable, grp""")
def gap_runs(spark, sf_dir):
    grid = rg.gap_grid(rg.hourly_mean(td.readings(spark, sf_dir)))
    return ex.gap_runs(grid)


@register("daily_coverage", f"""WITH {S.readings_cte()}
SELECT series_id, CAST(utc AS DATE) AS date, count(*) AS n, round(count(*) / 17280.0, 6) AS coverage
FROM r GROUP BY series_id, CAST(utc AS DATE)""")
def daily_coverage(spark, sf_dir):
    return r6(ex.daily_coverage(td.readings(spark, sf_dir)))
