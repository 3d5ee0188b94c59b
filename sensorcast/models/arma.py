"""ARMA(p,1) on first differences by conditional least squares (M4q).

``d(n) = sum_j phi_j d(n-j) + e(n) + theta e(n-1)``.  The residuals and their
derivatives follow one affine recursion with factor ``-theta``, so a position
block can be summed up without knowing what comes before it: its Gram matrix
is a quadratic form of the state that enters.  :func:`joined` composes two
neighbouring blocks; it is associative, and one pass over the data per
Gauss-Newton step (Levenberg-Marquardt damping) serves every series and
variable at once.  The start is the Hannan-Rissanen fit of ``models.ar``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorcast.models import ar
from sensorcast.operators import windows as wn
from sensorcast.operators.affine import affine_across_blocks, decayed_sums
from sensorcast.operators.position import DEFAULT_BLOCK, blocked
from sensorcast.operators.stats import long_format
from sensorcast.session import write_and_read

KEYS = ["series_id"]
VALUES = ["ts", "hr", "qfe"]
# |theta| stays below this: the residuals must forget their start
THETA_BOUND = 0.99
# blocks that one task joins before the per-series join
FAN = 256


def differences(df: DataFrame, keys: list[str] = KEYS, values: list[str] = VALUES) -> DataFrame:
    """``(keys, variable, pos, value)``: first differences, from position 1 on."""
    d = wn.difference(df, keys=keys, values=values, prefix="d_")
    wide = d.select(*keys, "pos", *[F.col(f"d_{v}").cast("double").alias(v) for v in values]).where("pos >= 1")
    return long_format(wide, values, [*keys, "pos"])


def packed_differences(df: DataFrame, p: int, keys: list[str] = KEYS, values: list[str] = VALUES,
                       block: int = DEFAULT_BLOCK) -> DataFrame:
    """One row per series, variable and position block: its known differences and the p before them."""
    rows = blocked(differences(df, keys, values).where("value is not null"), before=p, block=block)
    home = F.when(F.col("_home"), F.col("pos"))
    return (rows.groupBy(*keys, "variable", "_blk")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("_r"), F.count(home).alias("n_home"),
                 F.count_if(~F.col("_home")).cast("int").alias("halo"), F.min(home).alias("lo"), F.max(home).alias("hi"))
            .where("n_home > 0")
            .select(*keys, "variable", "_blk", "halo", "n_home", "lo", "hi", F.col("_r.value").alias("x")))


# ------------------------------------------------------------------ summaries of blocks

def summary(x: np.ndarray, halo: int, beta: np.ndarray) -> dict:
    """Gram matrix of (e, de/dphi, de/dtheta) over a block entered with state zero, and how a state would change it."""
    p, a = len(beta) - 1, -beta[-1]
    first = max(halo, p)
    n = max(len(x) - first, 0)
    if n == 0:
        zero = np.zeros(p + 2)
        return dict(n=0, end=zero, gram=np.zeros((p + 2, p + 2)), c1=zero, c2=zero, s=np.zeros(3), a=1.0, b=0.0)
    frame = np.lib.stride_tricks.sliding_window_view(x, p + 1)[first - p:]
    lags, y = frame[:, :p][:, ::-1], frame[:, p]
    v = np.empty((n, p + 2))
    v[:, 0] = y - lags @ beta[:p]
    v[:, 1:p + 1] = -lags
    v[:, :p + 1] = decayed_sums(a, v[:, :p + 1])
    v[0, -1], v[1:, -1] = 0.0, -v[:-1, 0]
    v[:, -1] = decayed_sums(a, v[:, -1])
    i = np.arange(n)
    w1 = a ** (i + 1.0)
    w2 = -(i + 1.0) * a ** i.astype(float)
    return dict(n=n, end=v[-1].copy(), gram=v.T @ v, c1=v.T @ w1, c2=v.T @ w2,
                s=np.array([w1 @ w1, w1 @ w2, w2 @ w2]), a=w1[-1], b=w2[-1])


def joined(one: dict, two: dict) -> dict:
    """The summary of two neighbouring blocks."""
    s, e, q = one["end"], one["end"][0], np.zeros(len(one["end"]))
    q[-1] = 1.0
    s11, s12, s22 = two["s"]
    c1 = two["c1"] + s11 * s + s12 * e * q
    c2 = two["c2"] + s12 * s + s22 * e * q

    def both(u, w):
        return np.outer(u, w) + np.outer(w, u)

    gram = (two["gram"] + both(two["c1"], s) + e * both(two["c2"], q) + s11 * np.outer(s, s)
            + s12 * e * both(s, q) + s22 * e * e * np.outer(q, q))
    a, b = one["a"], one["b"]
    return dict(n=one["n"] + two["n"], end=two["end"] + two["a"] * s + two["b"] * e * q, gram=one["gram"] + gram,
                c1=one["c1"] + a * c1, c2=one["c2"] + b * c1 + a * c2,
                s=one["s"] + np.array([a * a * s11, a * (b * s11 + a * s12), b * b * s11 + 2 * a * b * s12 + a * a * s22]),
                a=a * two["a"], b=two["a"] * b + two["b"] * a)


_PARTS = ["n", "end", "gram", "c1", "c2", "s", "a", "b"]


def _flat(s: dict) -> list[float]:
    return np.concatenate([np.ravel(s[k]) for k in _PARTS]).astype(float).tolist()


def _unflat(v, p: int) -> dict:
    v, k = np.asarray(v, float), p + 2
    cut = np.cumsum([1, k, k * k, k, k, 3, 1])
    n, end, gram, c1, c2, s, a, b = np.split(v, cut)
    return dict(n=int(n[0]), end=end, gram=gram.reshape(k, k), c1=c1, c2=c2, s=s, a=a[0], b=b[0])


def _summaries(packed: DataFrame, betas: DataFrame, group: list[str], p: int) -> DataFrame:
    """One summary per series and variable under the coefficients ``beta`` of each."""
    work = packed.join(betas.select(*group, "beta"), group)
    fields = [work.schema[c] for c in group]
    number = T.StructField("_blk", T.LongType())
    array = T.StructField("sums", T.ArrayType(T.DoubleType()))

    def blocks(batches):
        for batch in batches:
            sums = [_flat(summary(np.array(x, float), h, np.array(b, float)))
                    for x, h, b in zip(batch["x"], batch["halo"], batch["beta"])]
            yield batch[[*group, "_blk"]].assign(sums=sums)

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_blk")
        total = None
        for v in pdf["sums"]:
            s = _unflat(v, p)
            total = s if total is None else joined(total, s)
        return pdf[[*group, "_blk"]].iloc[:1].assign(sums=[_flat(total)])

    schema = T.StructType([*fields, number, array])
    parts = work.mapInPandas(blocks, schema)
    wide = parts.groupBy(*group, F.floor(F.col("_blk") / FAN).alias("_fan")).applyInPandas(fold, schema)
    return wide.groupBy(*group).applyInPandas(fold, schema).drop("_blk")


# ------------------------------------------------------------------ fit

def _advanced(row: dict, p: int, tol: float) -> dict:
    """The next state of one series: accept or refuse the trial, then a new trial from the best."""
    if row["sums"] is None:
        return {**row, "done": True, "reason": "too few rows"}
    s = _unflat(row["sums"], p)
    sse = s["gram"][0, 0]
    if row["coef"] is None and (s["n"] <= p + 1 or not np.isfinite(sse)):
        return {**row, "done": True, "n": s["n"], "reason": "too few rows" if s["n"] <= p + 1 else "missing values"}
    if row["coef"] is None or (np.isfinite(sse) and sse <= row["sse"]):
        gain = np.inf if row["coef"] is None else (row["sse"] - sse) / max(row["sse"], 1e-300)
        row = {**row, "coef": row["beta"], "sse": float(sse), "gram": s["gram"].ravel().tolist(), "n": s["n"],
               "last_resid": float(s["end"][0]), "damping": max(row["damping"] / 10, 1e-5), "done": bool(gain < tol)}
    else:
        row = {**row, "damping": row["damping"] * 10, "done": bool(row["damping"] > 1e4)}
    gram = np.array(row["gram"]).reshape(p + 2, p + 2)
    h, g = gram[1:, 1:], gram[1:, 0]
    damped, best = h + row["damping"] * np.diag(np.maximum(np.diag(h), 1e-300)), np.array(row["coef"])
    beta = best - np.linalg.lstsq(damped, g, rcond=None)[0]
    theta = np.clip(beta[-1], -THETA_BOUND, THETA_BOUND)
    if theta != beta[-1]:  # theta goes to its bound, the others to their best beside it
        move = np.linalg.lstsq(damped[:p, :p], g[:p] + h[:p, p] * (theta - best[-1]), rcond=None)[0]
        beta = np.append(best[:p] - move, theta)
    same = np.allclose(beta, row["coef"], rtol=1e-12, atol=1e-14)
    return {**row, "beta": beta.tolist(), "done": bool(row["done"] or same)}


def arma_fit(df: DataFrame, p: int = 24, keys: list[str] = KEYS, values: list[str] = VALUES, max_iter: int = 20,
             tol: float = 1e-6, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Conditional least squares of ARMA(p,1) on differences, one row per ``(keys, variable)``.

    ``coef`` holds the p autoregressive terms and then theta, with ``sse``,
    ``n`` residuals, ``last_resid`` for the forecast and ``converged``; the
    residual before the first full row of lags is zero.  A series that is too short or
    constant, or that misses values between others (leading ones are left out), gets a ``reason`` and no ``coef``.
    At most ``max_iter`` passes are made; each reads the packed differences
    of the unfinished series only.
    """
    group = [*keys, "variable"]
    start = ar.arma_hr_fit(df, p, keys=keys, values=values)
    packed = write_and_read(packed_differences(df, p, keys, values, block), "arma-blocks")
    bound = F.lit(0.9)
    theta = F.greatest(-bound, F.least(bound, F.element_at("coef", p + 1)))
    spans = packed.groupBy(*group).agg((F.max("hi") - F.min("lo") + 1 > F.sum("n_home")).alias("_holes"))
    start = spans.join(start, group, "left").withColumns({
        "reason": F.when(F.col("_holes"), F.lit("missing values")).otherwise(F.col("reason")),
        "coef": F.when(~F.col("_holes"), F.col("coef"))})
    state = start.select(
        *group, F.concat(F.slice("coef", 1, p), F.array(theta)).alias("beta"), F.lit(None).cast("array<double>").alias("coef"),
        F.lit(None).cast("double").alias("sse"), F.lit(None).cast("array<double>").alias("gram"),
        F.lit(None).cast("double").alias("last_resid"), F.col("n").cast("long").alias("n"), F.lit(1e-3).alias("damping"),
        F.col("coef").isNull().alias("done"),
        F.when(F.col("coef").isNull(), F.coalesce("reason", F.lit("no start: too few rows or constant"))).alias("reason"))
    state = write_and_read(state, "arma-state")
    schema = state.schema

    def update(batches):
        for batch in batches:
            rows = []
            for row in batch.astype(object).where(batch.notna(), None).to_dict("records"):
                rows.append(row if row["done"] else _advanced(row, p, tol))
            yield pd.DataFrame(rows, columns=schema.names).astype({"n": "Int64", "sse": float, "last_resid": float,
                                                                   "damping": float, "done": bool})

    for _ in range(max_iter):
        if state.where("not done").isEmpty():
            break
        sums = _summaries(packed, state.where("not done"), group, p)
        state = write_and_read(state.join(sums, group, "left").mapInPandas(update, schema), "arma-state")
    known = F.col("coef").isNotNull()
    return state.select(*group, "coef", "n", F.when(known, F.col("sse")).alias("sse"),
                        F.when(known, F.col("last_resid")).alias("last_resid"), (F.col("done") & known).alias("converged"), "reason")


def arma_residuals(df: DataFrame, fit: DataFrame, p: int = 24, keys: list[str] = KEYS, values: list[str] = VALUES,
                   block: int = DEFAULT_BLOCK) -> DataFrame:
    """``(keys, variable, pos, resid)``: ``e(n) = d(n) - sum_j phi_j d(n-j) - theta e(n-1)``
    from the first position with p lags on, the residual before it zero; a
    position without them has no row, and the residual before it counts as the last one."""
    group = [*keys, "variable"]
    lagged = wn.lag_matrix(differences(df, keys, values), keys=group, values=["value"], lags=p)
    known = fit.where("coef is not null").select(*group, "coef")
    rows = lagged.dropna(subset=["value", *[f"value_lag{j}" for j in range(1, p + 1)]]).join(known, group)
    lags = F.array(*[F.col(f"value_lag{j}") for j in range(1, p + 1)])
    u = F.col("value") - F.aggregate(F.zip_with(F.slice("coef", 1, p), lags, lambda c, x: c * x), F.lit(0.0), lambda s, x: s + x)
    return affine_across_blocks(rows, group, -F.element_at("coef", p + 1), u, name="resid", block=block)


def arma_forecast(fit: DataFrame, df: DataFrame, p: int = 24, horizon: int = 72, keys: list[str] = KEYS,
                  values: list[str] = VALUES, time_col: str = "utc", first_step: int = 1) -> DataFrame:
    """Roll-out of the fitted models: theta times the last residual at step 1, none after."""
    return ar.arma_hr_forecast(fit, df, p, horizon, keys, values, time_col, first_step)
