"""Local twin of the driver's correctness gate: Spark query vs DuckDB SQL.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import numpy as np
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if s.dtype.kind == "f":
            df[c] = s.round(6)
        elif s.dtype.kind == "M":
            df[c] = pd.to_datetime(s).astype("datetime64[us]")
        elif s.dtype == object:
            df[c] = s.map(lambda x: None if x is None or (isinstance(x, float) and np.isnan(x))
                          else (tuple(x) if isinstance(x, (list, np.ndarray)) else x)).astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def compare(spark_df: pd.DataFrame, oracle: pd.DataFrame) -> str | None:
    if sorted(spark_df.columns) != sorted(oracle.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(oracle.columns)}"
    if len(spark_df) != len(oracle):
        return f"rows {len(spark_df)} != {len(oracle)}"
    a, b = _norm(spark_df), _norm(oracle)
    for c in a.columns:
        x, y = a[c], b[c]
        if x.dtype.kind in "fiu" and y.dtype.kind in "fiu":
            ok = np.isclose(x.astype(float), y.astype(float), rtol=0, atol=2e-6, equal_nan=True)
            if not ok.all():
                i = int(np.argmin(ok))
                return f"value {c} row {i}: {x.iloc[i]} != {y.iloc[i]}"
        else:
            xs, ys = x.astype(str).values, y.astype(str).values
            if not (xs == ys).all():
                i = int(np.argmin(xs == ys))
                return f"value {c} row {i}: {xs[i]} != {ys[i]}"
    return None


def main(argv):
    sys.path.insert(0, ".")
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from sensorcast.session import get_session
    import __spark_entry__ as E
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or sorted(qs):
        t0 = time.time()
        try:
            got = qs[k](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {type(e).__name__}: {str(e)[:400]}"); bad += 1; continue
        dt = time.time() - t0
        if k not in sqls:
            print(f"ROWS {k}: {len(got)} rows {dt:.1f}s"); continue
        try:
            exp = con.execute(sqls[k]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: sql error {str(e)[:400]}"); bad += 1; continue
        err = compare(got, exp)
        if err:
            bad += 1
        print(f"{'FAIL' if err else 'OK  '} {k}: {len(got)} rows {dt:.1f}s {err or ''}")
    print(f"failures: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
