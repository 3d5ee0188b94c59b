"""Autoregressive forecasters for many series.

* AR(1) ``v(n) ~ v(n-1)`` per series and variable (M3): ``regr_slope`` /
  ``regr_intercept`` in one grouped aggregation; roll-out by fold.
* AR(p) on first differences, the ARIMA(p,1,0) formula (M4): lag matrix of
  the differenced series, Gram sums ``X'X`` and ``X'y`` per ``(series,
  variable)`` summed per task and then by a combinable aggregation
  (``models.gram``), then a p x p ridge solve per group.
* Hannan-Rissanen ARMA(p,1) on differences (M4q): a second regression that
  adds the lagged residual of the long AR fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorcast.models.gram import linear_fit
from sensorcast.models.rollout import fold_rollout
from sensorcast.operators import windows as wn
from sensorcast.operators.stats import long_format

KEYS = ["series_id"]
VALUES = ["ts", "hr", "qfe"]


# ------------------------------------------------------------------ AR(1)

def ar1_fit(df: DataFrame, keys: list[str] = KEYS, values: list[str] = VALUES,
            split_col: str | None = None, fit_on: str = "train") -> DataFrame:
    """Slope and intercept of ``v(n) ~ v(n-1)`` per series and variable.

    Pairs are built inside each split part (none crosses the cut).  A
    constant or too short series has no slope: its ``reason`` is set and it
    gets no forecast.
    """
    part = [*keys, split_col] if split_col else list(keys)
    pairs = wn.lag_supervised(df, keys=part, labels=values)
    if split_col:
        pairs = pairs.filter(F.col(split_col) == fit_on)
    aggs = []
    for v in values:
        aggs += [F.regr_slope(f"y_{v}", v).alias(f"{v}_slope"),
                 F.regr_intercept(f"y_{v}", v).alias(f"{v}_intercept"),
                 F.regr_count(f"y_{v}", v).alias(f"{v}_n")]
    fit = pairs.groupBy(*keys).agg(*aggs)
    no_slope = [F.when(F.col(f"{v}_slope").isNull(), F.lit(v)) for v in values]
    return fit.withColumn("reason", F.when(
        F.size(F.array_compact(F.array(*no_slope))) > 0,
        F.concat(F.lit("no slope: "), F.array_join(F.array_compact(F.array(*no_slope)), ","))))


def ar1_forecast(fit: DataFrame, start: DataFrame, horizon: int = 72, keys: list[str] = KEYS,
                 values: list[str] = VALUES, time_col: str = "utc", first_step: int = 1) -> DataFrame:
    """Recursive AR(1) forecast from ``start`` (one row per series: time and values)."""
    base = start.select(*keys, time_col, *values).join(fit, keys)

    def step(prev, i):
        return {v: F.col(f"{v}_intercept") + F.col(f"{v}_slope") * prev[v] for v in values}

    return fold_rollout(base, keys, {v: F.col(v) for v in values}, step, horizon, time_col, first_step)


def ar1_one_step(fit: DataFrame, df: DataFrame, keys: list[str] = KEYS, values: list[str] = VALUES,
                 split_col: str | None = None) -> DataFrame:
    """One-step predictions fed with true values: ``{v}_pred`` for the row after each row."""
    part = [*keys, split_col] if split_col else list(keys)
    pairs = wn.lag_supervised(df, keys=part, labels=values).join(fit, keys)
    return pairs.select(*part, F.timestamp_add("HOUR", F.lit(1), F.col("utc")).alias("utc"),
                        *[(F.col(f"{v}_intercept") + F.col(f"{v}_slope") * F.col(v)).alias(f"{v}_pred")
                          for v in values],
                        *[F.col(f"y_{v}").alias(v) for v in values])


# ------------------------------------------------------------------ AR(p) on differences

def _gram_frame(df: DataFrame, keys: list[str], values: list[str], p: int,
                extra_lag: str | None = None, split_col: str | None = None,
                fit_on: str = "train") -> tuple[DataFrame, int]:
    """Long frame of (keys, variable, y, x1..xk) for the differenced series."""
    part = [*keys, split_col] if split_col else list(keys)
    d = wn.difference(df, keys=part, values=values, prefix="d_")
    if split_col:
        d = d.filter(F.col(split_col) == fit_on)
    cols = [*part, "pos", *[f"d_{v}" for v in values]]
    long = long_format(d.select(*cols).withColumnsRenamed({f"d_{v}": v for v in values}),
                       values, [*part, "pos"])
    lagged = wn.lag_matrix(long, keys=[*part, "variable"], values=["value"], lags=p)
    k = p
    xs = [F.col(f"value_lag{j}") for j in range(1, p + 1)]
    if extra_lag:
        xs.append(F.col(extra_lag))
        k += 1
    frame = lagged.select(*keys, "variable", F.col("value").alias("y"),
                          *[x.alias(f"x{j}") for j, x in enumerate(xs, 1)])
    frame = frame.dropna()
    return frame, k


def _fit_frame(frame: DataFrame, keys: list[str], k: int, ridge: float) -> DataFrame:
    """Per ``(keys, variable)`` least squares of y on x1..xk via summed Gram entries."""
    fit = linear_fit(frame, [*keys, "variable"], [f"x{j}" for j in range(1, k + 1)], ["y"],
                     ridge=ridge, min_rows=k + 1)
    return fit.withColumn("coef", F.flatten("coef"))


def ar_diff_fit(df: DataFrame, p: int = 24, keys: list[str] = KEYS, values: list[str] = VALUES,
                split_col: str | None = None, fit_on: str = "train", ridge: float = 1e-8) -> DataFrame:
    """AR(p) on first differences, no constant (ARIMA(p,1,0) formula).

    Returns one row per ``(keys, variable)`` with ``coef`` (lag 1 first) or a
    ``reason`` when there are not more than p + 1 rows.
    """
    frame, k = _gram_frame(df, keys, values, p, split_col=split_col, fit_on=fit_on)
    return _fit_frame(frame, keys, k, ridge)


def _diff_state(df: DataFrame, keys: list[str], values: list[str], p: int, time_col: str,
                split_col: str | None, start_on: str | None) -> DataFrame:
    """Per (series, variable): last level, last time and the last p differences (newest first)."""
    part = [*keys, split_col] if split_col else list(keys)
    src = df.filter(F.col(split_col) == start_on) if split_col and start_on else df
    tail = wn.tail_slice(src.drop(*([split_col] if split_col else [])), keys=keys, last=p + 1,
                         time_col=time_col)
    long = long_format(tail.select(*keys, time_col, "pos", *values), values, [*keys, time_col, "pos"])
    g = long.groupBy(*keys, "variable").agg(
        F.sort_array(F.collect_list(F.struct(F.col("pos"), F.col("value"))), asc=False).alias("_h"),
        F.max(time_col).alias(time_col))
    # differences newest first: h[0]-h[1], h[1]-h[2], ...
    diffs = F.transform(F.sequence(F.lit(0), F.lit(p - 1)),
                        lambda i: F.try_element_at("_h", i + 1)["value"] - F.try_element_at("_h", i + 2)["value"])
    return g.select(*keys, "variable", time_col, F.element_at("_h", 1)["value"].alias("level"),
                    diffs.alias("lags"), F.size("_h").alias("_len")).filter(F.col("_len") == p + 1).drop("_len")


def ar_diff_forecast(fit: DataFrame, df: DataFrame, p: int = 24, horizon: int = 72,
                     keys: list[str] = KEYS, values: list[str] = VALUES, time_col: str = "utc",
                     split_col: str | None = None, start_on: str | None = None,
                     first_step: int = 1) -> DataFrame:
    """Recursive forecast of AR(p) on differences, integrated back to levels.

    The last p+1 rows per series come from ``tail_slice`` (bounded per
    series), the fold state is (level, last p differences); long output
    ``(keys, variable, step, utc, value)``.
    """
    state = _diff_state(df, keys, values, p, time_col, split_col, start_on).join(
        fit.filter(F.col("coef").isNotNull()).select(*keys, "variable", "coef"), [*keys, "variable"])
    st_type = f"struct<level:double,lags:array<double>>"

    def step(prev, i):
        d = F.aggregate(F.zip_with(F.col("coef"), prev["lags"], lambda a, b: a * b), F.lit(0.0),
                        lambda acc, x: acc + x)
        return {"level": prev["level"] + d,
                "lags": F.slice(F.concat(F.array(d), prev["lags"]), 1, p)}

    out = fold_rollout(state, [*keys, "variable"], {"level": F.col("level"), "lags": F.col("lags")},
                       step, horizon, time_col, first_step, state_type=st_type)
    return out.select(*keys, "variable", "step", time_col, F.col("level").alias("value"))


# ------------------------------------------------------------------ ARMA(p,1) (Hannan-Rissanen)

def arma_hr_fit(df: DataFrame, p: int = 24, long_p: int | None = None, keys: list[str] = KEYS,
                values: list[str] = VALUES, ridge: float = 1e-8) -> DataFrame:
    """ARMA(p,1) on differences by Hannan-Rissanen.

    Step 1: a long AR(m) fit, m twice p unless given, gives residuals e(n); m
    must exceed p, or the residual is a combination of the other regressors.
    Step 2: regress d(n) on d(n-1..n-p) and e(n-1).  ``coef`` holds p AR terms then the MA term.
    """
    m = long_p or 2 * p
    long_fit = ar_diff_fit(df, m, keys, values, ridge=ridge)
    d = wn.difference(df, keys=keys, values=values, prefix="d_")
    long = long_format(d.select(*keys, "pos", *[F.col(f"d_{v}").alias(v) for v in values]),
                       values, [*keys, "pos"])
    lagged = wn.lag_matrix(long, keys=[*keys, "variable"], values=["value"], lags=max(m, p))
    lagged = lagged.join(long_fit.select(*keys, "variable", F.col("coef").alias("_c1")), [*keys, "variable"])
    lag_arr = F.array(*[F.col(f"value_lag{j}") for j in range(1, m + 1)])
    yhat = F.aggregate(F.zip_with(F.col("_c1"), lag_arr, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    res = lagged.withColumn("resid", F.col("value") - yhat)
    res = wn.lag_matrix(res, keys=[*keys, "variable"], values=["resid"], lags=1)
    frame = res.select(*keys, "variable", F.col("value").alias("y"),
                       *[F.col(f"value_lag{j}").alias(f"x{j}") for j in range(1, p + 1)],
                       F.col("resid_lag1").alias(f"x{p + 1}")).dropna()
    fit = _fit_frame(frame, keys, p + 1, ridge)
    last_resid = res.groupBy(*keys, "variable").agg(F.max_by("resid", "pos").alias("last_resid"))
    return fit.join(last_resid, [*keys, "variable"], "left")


def arma_hr_forecast(fit: DataFrame, df: DataFrame, p: int = 24, horizon: int = 72,
                     keys: list[str] = KEYS, values: list[str] = VALUES, time_col: str = "utc",
                     first_step: int = 1) -> DataFrame:
    """Roll-out of the ARMA(p,1): the MA term uses the last residual at step 1, zero after."""
    state = _diff_state(df, keys, values, p, time_col, None, None).join(
        fit.filter(F.col("coef").isNotNull()).select(*keys, "variable", "coef", "last_resid"),
        [*keys, "variable"])
    st_type = "struct<level:double,lags:array<double>,e:double>"

    def step(prev, i):
        ar = F.aggregate(F.zip_with(F.slice(F.col("coef"), 1, p), prev["lags"], lambda a, b: a * b),
                         F.lit(0.0), lambda s, x: s + x)
        d = ar + F.element_at(F.col("coef"), p + 1) * prev["e"]
        return {"level": prev["level"] + d, "lags": F.slice(F.concat(F.array(d), prev["lags"]), 1, p),
                "e": F.lit(0.0)}

    out = fold_rollout(state, [*keys, "variable"],
                       {"level": F.col("level"), "lags": F.col("lags"),
                        "e": F.coalesce(F.col("last_resid"), F.lit(0.0))},
                       step, horizon, time_col, first_step, state_type=st_type)
    return out.select(*keys, "variable", "step", time_col, F.col("level").alias("value"))
