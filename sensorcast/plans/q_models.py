"""Queries: climatology and autoregressive forecasters, roll-outs and their
evaluation (M1, M3, M4, M4q, M8, J4, E1-E6)."""

from pyspark.sql import functions as F

from sensorcast.functions import time as tf
from sensorcast.models import ar, arma
from sensorcast.models import climatology as cl
from sensorcast.operators import evaluate as ev
from sensorcast.operators import joins as jn
from sensorcast.operators import regularize as rg
from sensorcast.operators import split as sp
from sensorcast.operators import stats as st
from sensorcast.plans import sql as S
from sensorcast.plans.registry import r6, register
from sensorcast.sources import testdata as td

V = ["ts", "hr", "qfe"]
H = S.hourly_table_sql()
HORIZON = 72


def hourly_table(spark, sf_dir, series="mod3"):
    return rg.regularize(td.readings(spark, sf_dir, series))


def split_table(spark, sf_dir):
    return sp.split_train_test(hourly_table(spark, sf_dir), 0.9)


# ------------------------------------------------------------------ SQL building blocks

SPLIT = f"""{H},
c AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM i),
s AS (SELECT series_id, utc, pos, ts, hr, qfe, CASE WHEN pos < round_even(n * 0.9, 0) THEN 'train' ELSE 'test' END AS split FROM c)"""


def pairs_cte(src, name="p", part="series_id, split"):
    return f"""{name} AS (SELECT *, {', '.join(f'lead({v}) OVER w AS y_{v}' for v in V)}, lead(pos) OVER w AS lp
  FROM {src} WINDOW w AS (PARTITION BY {part} ORDER BY pos))"""


def fit_cte(src, where, name="fit"):
    cols = ", ".join(f"regr_slope(y_{v}, {v}) AS {v}_slope, regr_intercept(y_{v}, {v}) AS {v}_intercept, "
                     f"regr_count(y_{v}, {v}) AS {v}_n" for v in V)
    return f"{name} AS (SELECT series_id, {cols} FROM {src} WHERE lp IS NOT NULL AND {where} GROUP BY series_id)"


def recursion_cte(start, name="f"):
    step = lambda src: ", ".join(f"fit.{v}_intercept + fit.{v}_slope * {src}.{v}" for v in V)
    return f"""{name}(series_id, step, utc, ts, hr, qfe) AS (
  SELECT {start}.series_id, 1, {start}.utc + INTERVAL 1 HOUR, {step(start)} FROM {start} JOIN fit ON {start}.series_id = fit.series_id
  UNION ALL
  SELECT {name}.series_id, {name}.step + 1, {name}.utc + INTERVAL 1 HOUR, {step(name)} FROM {name} JOIN fit ON {name}.series_id = fit.series_id
  WHERE {name}.step < {HORIZON})"""


REASON = ("CASE WHEN " + " OR ".join(f"{v}_slope IS NULL" for v in V) + " THEN 'no slope: ' || concat_ws(',', "
          + ", ".join(f"CASE WHEN {v}_slope IS NULL THEN '{v}' END" for v in V) + ") END AS reason")

FIT_COLS = ", ".join(f"round({v}_slope, 6) AS {v}_slope, round({v}_intercept, 6) AS {v}_intercept, {v}_n" for v in V)

ERR = """round(avg(abs(pred - actual)), 6) AS mae, round(avg(pred - actual), 6) AS bias,
  round(avg((pred - actual) * (pred - actual)), 6) AS mse, count(*) AS n,
  round(sqrt(avg((pred - actual) * (pred - actual))), 6) AS rmse"""


def unpivot_pairs(src):
    return " UNION ALL ".join(
        f"SELECT series_id, utc, '{v}' AS variable, {v}_pred AS pred, {v} AS actual FROM {src}" for v in V)


# ------------------------------------------------------------------ AR(1)

@register("ar1_fit", f"""WITH {H}, {pairs_cte('i', part='series_id')}, {fit_cte('p', 'TRUE')}
SELECT series_id, {FIT_COLS}, {REASON} FROM fit""")
def ar1_fit(spark, sf_dir):
    return r6(ar.ar1_fit(hourly_table(spark, sf_dir)))


@register("ar1_forecast", f"""WITH RECURSIVE {H}, {pairs_cte('i', part='series_id')}, {fit_cte('p', 'TRUE')},
st AS (SELECT series_id, max(utc) AS utc, {', '.join(f'arg_max_null({v}, utc) AS {v}' for v in V)} FROM i GROUP BY series_id),
{recursion_cte('st')}
SELECT series_id, CAST(step AS INTEGER) AS step, utc, {S.r6(V)} FROM f""")
def ar1_forecast(spark, sf_dir):
    h = hourly_table(spark, sf_dir)
    fit = ar.ar1_fit(h)
    return r6(ar.ar1_forecast(fit, st.last_observation(h), HORIZON))


AUTONOMY_CTES = f"""{SPLIT}, {pairs_cte('s')}, {fit_cte('p', "split = 'train'")},
cut AS (SELECT series_id, max(utc) AS utc FROM s WHERE split = 'train' GROUP BY series_id),
st AS (SELECT s.series_id, s.utc, s.ts, s.hr, s.qfe FROM s JOIN cut ON s.series_id = cut.series_id AND s.utc = cut.utc),
{recursion_cte('st')}"""


def _autonomy_forecast(spark, sf_dir):
    s = split_table(spark, sf_dir)
    fit = ar.ar1_fit(s, split_col="split")
    start = st.last_observation(s.filter(F.col("split") == "train"))
    return s, ar.ar1_forecast(fit, start, HORIZON)


@register("rollout_linear", f"""WITH RECURSIVE {AUTONOMY_CTES}
SELECT series_id, CAST(step AS INTEGER) AS step, utc, {S.r6(V)} FROM f""")
def rollout_linear(spark, sf_dir):
    # the AR(1) fold roll-out from the end of the train part
    return r6(_autonomy_forecast(spark, sf_dir)[1])


AUTONOMY_ERR = f"""WITH RECURSIVE {AUTONOMY_CTES},
j AS (SELECT f.series_id, f.utc, {', '.join(f'f.{v} AS {v}_pred, s.{v} AS {v}' for v in V)}
      FROM f JOIN s ON f.series_id = s.series_id AND f.utc = s.utc),
u AS ({unpivot_pairs('j')}),
e AS (SELECT series_id, variable, {ERR} FROM u WHERE pred IS NOT NULL AND actual IS NOT NULL GROUP BY series_id, variable)"""


def _autonomy(spark, sf_dir):
    s, f = _autonomy_forecast(spark, sf_dir)
    return ev.autonomy_test(f, s.filter(F.col("split") == "test"))


@register("autonomy_test", f"{AUTONOMY_ERR} SELECT * FROM e")
def autonomy_test(spark, sf_dir):
    return r6(_autonomy(spark, sf_dir))


@register("eval_mae", f"{AUTONOMY_ERR} SELECT series_id, variable, mae FROM e")
def eval_mae(spark, sf_dir):
    return r6(_autonomy(spark, sf_dir).select("series_id", "variable", "mae"))


@register("eval_bias", f"{AUTONOMY_ERR} SELECT series_id, variable, bias FROM e")
def eval_bias(spark, sf_dir):
    return r6(_autonomy(spark, sf_dir).select("series_id", "variable", "bias"))


@register("eval_mse", f"{AUTONOMY_ERR} SELECT series_id, variable, mse, rmse FROM e")
def eval_mse(spark, sf_dir):
    return r6(_autonomy(spark, sf_dir).select("series_id", "variable", "mse", "rmse"))


@register("traditional_test", f"""WITH {SPLIT}, {pairs_cte('s')}, {fit_cte('p', "split = 'train'")},
j AS (SELECT p.series_id, p.utc + INTERVAL 1 HOUR AS utc,
        {', '.join(f'fit.{v}_intercept + fit.{v}_slope * p.{v} AS {v}_pred, p.y_{v} AS {v}' for v in V)}
      FROM p JOIN fit USING (series_id) WHERE p.split = 'test' AND p.lp IS NOT NULL),
u AS ({unpivot_pairs('j')})
SELECT series_id, variable, {ERR} FROM u WHERE pred IS NOT NULL AND actual IS NOT NULL GROUP BY series_id, variable""")
def traditional_test(spark, sf_dir):
    s = split_table(spark, sf_dir)
    fit = ar.ar1_fit(s, split_col="split")
    return r6(ev.traditional_test(ar.ar1_one_step(fit, s, split_col="split")))


# ------------------------------------------------------------------ climatology

LEVEL_SQL = [("month, day, hour", 0), ("month, hour", 1), ("hour", 2)]


def _clim_fit_sql(src):
    parts = []
    for cols, lv in LEVEL_SQL:
        sel = ", ".join(c if c in cols else f"CAST(NULL AS INTEGER) AS {c}" for c in ("month", "day", "hour"))
        parts.append(f"SELECT series_id, {lv} AS level, {sel}, avg(ts) AS ts, avg(hr) AS hr, avg(qfe) AS qfe "
                     f"FROM {src} GROUP BY series_id, {cols}")
    return " UNION ALL ".join(parts)


CAL = "CAST(month(utc) AS INTEGER) AS month, CAST(day(utc) AS INTEGER) AS day, CAST(hour(utc) AS INTEGER) AS hour"


@register("climatology_fit", f"""WITH {H}, cal AS (SELECT series_id, {CAL}, ts, hr, qfe FROM i),
fit AS ({_clim_fit_sql('cal')})
SELECT series_id, level, month, day, hour, {S.r6(V)} FROM fit""")
def climatology_fit(spark, sf_dir):
    return r6(cl.climatology_fit(hourly_table(spark, sf_dir)))


def _clim_forecast_sql(grid, bare=False):
    joins = []
    for cols, lv in LEVEL_SQL:
        on = " AND ".join(f"fg.{c} = l{lv}.{c}" for c in cols.split(", "))
        joins.append(f"LEFT JOIN (SELECT * FROM fit WHERE level = {lv}) l{lv} ON fg.series_id = l{lv}.series_id AND {on}")
    vals = ", ".join(f"round(coalesce(l0.{v}, l1.{v}, l2.{v}), 6) AS {v}" for v in V)
    if bare:  # one SELECT without rounding
        vals = ", ".join(f"coalesce(l0.{v}, l1.{v}, l2.{v}) AS {v}" for v in V)
        return f"SELECT fg.series_id, fg.step, fg.utc, {vals} FROM (SELECT series_id, step, utc, {CAL} FROM {grid}) fg {' '.join(joins)}"
    return f"""fg AS (SELECT series_id, step, utc, {CAL} FROM {grid})
SELECT fg.series_id, fg.step, fg.utc, {vals} FROM fg {' '.join(joins)}"""


@register("climatology_forecast", f"""WITH {H}, cal AS (SELECT series_id, {CAL}, ts, hr, qfe FROM i),
fit AS ({_clim_fit_sql('cal')}),
l AS (SELECT series_id, max(utc) AS t0 FROM i GROUP BY series_id),
grid AS (SELECT series_id, CAST(s AS INTEGER) AS step, t0 + s * INTERVAL 1 HOUR AS utc FROM l, range(1, {HORIZON + 1}) AS t(s)),
{_clim_forecast_sql('grid')}""")
def climatology_forecast(spark, sf_dir):
    h = hourly_table(spark, sf_dir)
    grid = tf.future_grid(st.last_observation(h, values=[]), ["series_id"], horizon=HORIZON)
    return r6(cl.climatology_forecast(cl.climatology_fit(h), grid))


def _clim_autonomy(spark, sf_dir):
    s = split_table(spark, sf_dir)
    fit = cl.climatology_fit(s.filter(F.col("split") == "train"))
    grid = tf.future_grid(st.last_observation(s.filter(F.col("split") == "train"), values=[]),
                          ["series_id"], horizon=HORIZON)
    return ev.autonomy_test(cl.climatology_forecast(fit, grid), s.filter(F.col("split") == "test"))


@register("model_comparison", f"""WITH RECURSIVE {AUTONOMY_CTES},
j AS (SELECT f.series_id, f.utc, {', '.join(f'f.{v} AS {v}_pred, s.{v} AS {v}' for v in V)}
      FROM f JOIN s ON f.series_id = s.series_id AND f.utc = s.utc),
u AS ({unpivot_pairs('j')}),
e1 AS (SELECT series_id, variable, avg(abs(pred - actual)) AS mae FROM u WHERE pred IS NOT NULL AND actual IS NOT NULL GROUP BY ALL),
cal AS (SELECT series_id, {CAL}, ts, hr, qfe FROM s WHERE split = 'train'),
fit2 AS ({_clim_fit_sql('cal')}),
grid AS (SELECT cut.series_id, CAST(x AS INTEGER) AS step, cut.utc + x * INTERVAL 1 HOUR AS utc FROM cut, range(1, {HORIZON + 1}) AS t(x)),
fg AS (SELECT series_id, step, utc, {CAL} FROM grid),
cf AS (SELECT fg.series_id, fg.utc, {', '.join(f'coalesce(l0.{v}, l1.{v}, l2.{v}) AS {v}_pred' for v in V)}
       FROM fg {' '.join(f"LEFT JOIN (SELECT * FROM fit2 WHERE level = {lv}) l{lv} ON fg.series_id = l{lv}.series_id AND " + ' AND '.join(f'fg.{c} = l{lv}.{c}' for c in cols.split(', ')) for cols, lv in LEVEL_SQL)}),
j2 AS (SELECT cf.*, {', '.join(f's.{v} AS {v}' for v in V)} FROM cf JOIN s ON cf.series_id = s.series_id AND cf.utc = s.utc),
u2 AS ({unpivot_pairs('j2')}),
e2 AS (SELECT series_id, variable, avg(abs(pred - actual)) AS mae FROM u2 WHERE pred IS NOT NULL AND actual IS NOT NULL GROUP BY ALL)
SELECT e1.series_id, e1.variable, round(e1.mae, 6) AS ar1, round(e2.mae, 6) AS climatology
FROM e1 JOIN e2 ON e1.series_id = e2.series_id AND e1.variable = e2.variable""")
def model_comparison(spark, sf_dir):
    return r6(ev.model_comparison({"ar1": _autonomy(spark, sf_dir), "climatology": _clim_autonomy(spark, sf_dir)}))


@register("attach_future_time", f"""WITH RECURSIVE {H}, {pairs_cte('i', part='series_id')}, {fit_cte('p', 'TRUE')},
st AS (SELECT series_id, max(utc) AS utc, {', '.join(f'arg_max_null({v}, utc) AS {v}' for v in V)} FROM i GROUP BY series_id),
{recursion_cte('st')}
SELECT series_id, CAST(step AS INTEGER) AS step, {S.r6(V)}, utc FROM f""")
def attach_future_time(spark, sf_dir):
    h = hourly_table(spark, sf_dir)
    last = st.last_observation(h)
    preds = ar.ar1_forecast(ar.ar1_fit(h), last, HORIZON).drop("utc")
    grid = tf.future_grid(last.select("series_id", "utc"), ["series_id"], horizon=HORIZON)
    return r6(jn.attach_future_time(preds, grid))


# ------------------------------------------------------------------ AR(p) on differences, ARMA

@register("ar_diff_fit")
def ar_diff_fit(spark, sf_dir):
    s = split_table(spark, sf_dir)
    fit = ar.ar_diff_fit(s, p=24, split_col="split")
    return fit.select("series_id", "variable", "n", "reason", F.posexplode("coef").alias("lag", "coef"))


@register("ar_diff_forecast")
def ar_diff_forecast(spark, sf_dir):
    h = hourly_table(spark, sf_dir)
    fit = ar.ar_diff_fit(h, p=24)
    return r6(ar.ar_diff_forecast(fit, h, p=24, horizon=HORIZON))


@register("arma_hr_forecast")
def arma_hr_forecast(spark, sf_dir):
    h = hourly_table(spark, sf_dir)
    fit = ar.arma_hr_fit(h, p=24)
    return r6(ar.arma_hr_forecast(fit, h, p=24, horizon=HORIZON))


@register("arma_fit")
def arma_fit(spark, sf_dir):
    """Conditional least squares of ARMA(24,1) on differences; tested against loops in numpy."""
    fit = arma.arma_fit(hourly_table(spark, sf_dir), p=24)
    return r6(fit.select("series_id", "variable", "n", "sse", "last_resid", "converged", "reason",
                         F.posexplode_outer("coef").alias("term", "coef")))


@register("arma_forecast")
def arma_forecast(spark, sf_dir):
    h = hourly_table(spark, sf_dir)
    return r6(arma.arma_forecast(arma.arma_fit(h, p=24), h, p=24, horizon=HORIZON))


# residuals of given coefficients (two autoregressive terms, then theta)
GIVEN = [0.5, -0.2, 0.4]


@register("arma_residuals", f"""WITH RECURSIVE {H},
l AS (SELECT * FROM (SELECT series_id, pos, ts, hr, qfe FROM i) UNPIVOT INCLUDE NULLS (value FOR variable IN (ts, hr, qfe))),
d AS (SELECT series_id, variable, pos, value - lag(value) OVER w AS d FROM l WINDOW w AS (PARTITION BY series_id, variable ORDER BY pos)),
u AS (SELECT series_id, variable, pos, d - ({GIVEN[0]}) * lag(d) OVER w - ({GIVEN[1]}) * lag(d, 2) OVER w AS u
  FROM d WINDOW w AS (PARTITION BY series_id, variable ORDER BY pos)),
e(series_id, variable, pos, resid) AS (
  SELECT series_id, variable, min(pos), arg_min(u, pos) FROM u WHERE u IS NOT NULL GROUP BY series_id, variable
  UNION ALL SELECT u.series_id, u.variable, u.pos, u.u - ({GIVEN[2]}) * e.resid FROM e JOIN u
    ON u.series_id = e.series_id AND u.variable = e.variable AND u.pos = e.pos + 1)
SELECT series_id, variable, pos, round(resid, 6) + 0.0 AS resid FROM e""")
def arma_residuals(spark, sf_dir):
    h = hourly_table(spark, sf_dir)
    groups = h.select("series_id").distinct().select("series_id", F.explode(F.array(*[F.lit(v) for v in V])).alias("variable"))
    given = groups.withColumn("coef", F.array(*[F.lit(c) for c in GIVEN]))
    out = arma.arma_residuals(h, given, p=2)
    return out.withColumn("resid", F.round("resid", 6) + F.lit(0.0))
