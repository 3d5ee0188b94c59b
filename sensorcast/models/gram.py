"""Normal equations of many linear least-squares problems, on Spark.

For every group (a series and variable, or one global model) the sums
``X'X``, ``X'Y``, ``Y'Y`` and ``n`` are all a least-squares solve needs.  They
are computed in two combinable steps:

1. ``mapInPandas``: each task folds its rows into per-group partial sums with
   numpy (one matrix product per Arrow batch and group) and emits them as
   ``(group, idx, value)`` entries - a few hundred numbers per group and task,
   whatever the row count.
2. ``groupBy(group, idx).sum(value)``: partial aggregation, then a small
   shuffle.

A hot group is therefore summed by every task that holds its rows.  The
solve sees only the summed entries: one ``applyInPandas`` call per group with
``k*k + k*m + 2`` rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorcast.session import write_and_read


def _layout(k: int, m: int):
    # entry ids: X'X row-major [0, k*k), X'Y row-major [k*k, k*k + k*m), then n, then Y'Y trace
    return k * k, k * k + k * m, k * k + k * m + 1


def gram_entries(frame: DataFrame, group: list[str], xcols: list[str], ycols: list[str]) -> DataFrame:
    """Summed normal-equation entries per group: ``(group..., idx, value)``.

    Rows with a null in any x or y are skipped.
    """
    k, m = len(xcols), len(ycols)
    off_xy, off_n, off_yy = _layout(k, m)
    gfields = [frame.schema[c] for c in group]
    schema = T.StructType([*gfields, T.StructField("idx", T.IntegerType()),
                           T.StructField("value", T.DoubleType())])
    cols = [*group, *xcols, *ycols]

    def partial(batches):
        acc: dict = {}
        for pdf in batches:
            pdf = pdf.dropna(subset=xcols + ycols)
            if pdf.empty:
                continue
            grouped = pdf.groupby(group, sort=False) if group else [((), pdf)]
            for key, g in grouped:
                key = key if isinstance(key, tuple) else (key,)
                x = g[xcols].to_numpy(dtype=np.float64)
                y = g[ycols].to_numpy(dtype=np.float64)
                part = (x.T @ x, x.T @ y, len(g), float(np.einsum("ij,ij->", y, y)))
                if key in acc:
                    a = acc[key]
                    acc[key] = (a[0] + part[0], a[1] + part[1], a[2] + part[2], a[3] + part[3])
                else:
                    acc[key] = part
        rows = []
        for key, (xtx, xty, n, yy) in acc.items():
            vals = np.concatenate([xtx.ravel(), xty.ravel(), [n, yy]])
            out = pd.DataFrame({"idx": np.arange(len(vals), dtype=np.int32), "value": vals})
            for c, v in zip(group, key):
                out[c] = v
            rows.append(out[[*group, "idx", "value"]])
        if rows:
            yield pd.concat(rows, ignore_index=True)

    partials = frame.select(*cols).mapInPandas(partial, schema)
    return partials.groupBy(*group, "idx").agg(F.sum("value").alias("value"))


def solve_entries(entries: DataFrame, group: list[str], k: int, m: int, ridge: float = 1e-8,
                  min_rows: int = 0, materialize: bool = True) -> DataFrame:
    """Ridge solution per group: ``coef`` = k x m matrix as ``array<array<double>>``
    (row i = weights of feature i), ``n`` rows used, ``reason`` when unsolved.

    ``ridge`` is relative to the mean diagonal of ``X'X`` (scale free).
    """
    off_xy, off_n, off_yy = _layout(k, m)
    use = list(group) or ["_one"]
    src = entries if group else entries.withColumn("_one", F.lit(0))
    gfields = [src.schema[c] for c in use]
    schema = T.StructType([*gfields, T.StructField("coef", T.ArrayType(T.ArrayType(T.DoubleType()))),
                           T.StructField("n", T.LongType()), T.StructField("reason", T.StringType())])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.zeros(off_yy + 1)
        v[pdf["idx"].to_numpy()] = pdf["value"].to_numpy()
        n = int(round(v[off_n]))
        coef, reason = None, None
        if n < max(min_rows, k):
            reason = f"too few rows: {n}"
        else:
            xtx = v[:off_xy].reshape(k, k)
            xty = v[off_xy:off_n].reshape(k, m)
            reg = ridge * (np.trace(xtx) / k if k else 0.0)
            try:
                coef = np.linalg.solve(xtx + reg * np.eye(k), xty).tolist()
            except np.linalg.LinAlgError:
                reason = "singular"
        row = {c: pdf[c].iloc[0] for c in use}
        row.update(coef=coef, n=n, reason=reason)
        return pd.DataFrame([row], columns=[*use, "coef", "n", "reason"])

    out = src.groupBy(*use).applyInPandas(solve, schema)
    out = out if group else out.drop("_one")
    # A fitted model is a small table: write it once (Parquet in the shared
    # checkpoint folder) so scoring plans start from it, not from the whole
    # fitting lineage.
    return write_and_read(out, "linear-fit") if materialize else out


def linear_fit(frame: DataFrame, group: list[str], xcols: list[str], ycols: list[str],
               ridge: float = 1e-8, intercept: bool = False, min_rows: int = 0) -> DataFrame:
    """Least squares of ``ycols`` on ``xcols`` per group (optionally with an intercept,
    which becomes the last row of ``coef``)."""
    if intercept:
        frame = frame.withColumn("_bias", F.lit(1.0))
        xcols = [*xcols, "_bias"]
    entries = gram_entries(frame, group, xcols, ycols)
    return solve_entries(entries, group, len(xcols), len(ycols), ridge, min_rows)
