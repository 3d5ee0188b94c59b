"""Sequence operators: lead/lag pairs, lag matrices, sliding and seq2seq
windows, differencing (W2-W4, W8-W10, W12, N12).

All of them are positional (row offsets inside a series, as the reference
uses positions) and run on position blocks with halo rows, so a series is
never sorted in one task.  ``pos`` must be dense per series (the gap grid
makes it so; ``with_position`` builds it otherwise).  Extra partition columns
(for example a split label, W11) keep windows from crossing a cut.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorcast.functions.time import epoch_seconds
from sensorcast.operators.position import (
    DEFAULT_BLOCK, DEFAULT_CHUNK_SECONDS, block_window, blocked, home_rows, prefix_across_blocks, with_position,
)

KEYS = ["series_id"]
VALUES = ["ts", "hr", "qfe"]


def _ensure_pos(df: DataFrame, keys, time_col, pos_col):
    if pos_col in df.columns:
        return df
    return with_position(df, keys, time_col, pos_col)


def lag_supervised(df: DataFrame, keys: list[str] = KEYS, labels: list[str] = VALUES,
                   time_col: str = "utc", pos_col: str = "pos", horizon: int = 1,
                   prefix: str = "y_", block: int = DEFAULT_BLOCK) -> DataFrame:
    """Features at row n, labels from row n + horizon; rows without a label row drop."""
    df = _ensure_pos(df, keys, time_col, pos_col)
    b = blocked(df, pos_col, after=horizon, block=block)
    w = block_window(keys, pos_col)
    out = b.withColumns({
        **{f"{prefix}{v}": F.lead(v, horizon).over(w) for v in labels},
        "_lead_pos": F.lead(pos_col, horizon).over(w),
    })
    return home_rows(out.filter(F.col("_lead_pos") == F.col(pos_col) + horizon)).drop("_lead_pos")


def lag_matrix(df: DataFrame, keys: list[str] = KEYS, values: list[str] = ("ts",), lags: int = 24,
               time_col: str = "utc", pos_col: str = "pos", block: int = DEFAULT_BLOCK) -> DataFrame:
    """``{v}_lag{k}`` = value k rows back, k = 1..lags, null where absent."""
    df = _ensure_pos(df, keys, time_col, pos_col)
    b = blocked(df, pos_col, before=lags, block=block)
    w = block_window(keys, pos_col)
    cols = {f"{v}_lag{k}": F.lag(v, k).over(w) for v in values for k in range(1, lags + 1)}
    return home_rows(b.withColumns(cols))


def difference(df: DataFrame, keys: list[str] = KEYS, values: list[str] = VALUES,
               time_col: str = "utc", pos_col: str = "pos", prefix: str = "d_",
               block: int = DEFAULT_BLOCK) -> DataFrame:
    """First difference ``v - lag(v)`` (W8); null on the first row of a series."""
    df = _ensure_pos(df, keys, time_col, pos_col)
    b = blocked(df, pos_col, before=1, block=block)
    w = block_window(keys, pos_col)
    return home_rows(b.withColumns({f"{prefix}{v}": F.col(v) - F.lag(v, 1).over(w) for v in values}))


def undifference(diffs: DataFrame, base: DataFrame, keys: list[str] = KEYS, values: list[str] = VALUES,
                 pos_col: str = "pos", prefix: str = "d_", block: int = DEFAULT_BLOCK) -> DataFrame:
    """Inverse of ``difference``: level = base level + running sum of differences.

    ``base`` holds one row per series with the level before the first
    difference (columns named like ``values``).
    """
    sums = prefix_across_blocks(diffs, keys, {f"_cs_{v}": F.col(f"{prefix}{v}") for v in values},
                                pos_col, block)
    b = base.select(*keys, *[F.col(v).alias(f"_b_{v}") for v in values])
    out = sums.join(b, keys)
    return (out.withColumns({v: F.col(f"_b_{v}") + F.col(f"_cs_{v}") for v in values})
               .drop(*[f"_b_{v}" for v in values], *[f"_cs_{v}" for v in values]))


def sliding_windows(df: DataFrame, keys: list[str] = KEYS, features: list[str] = VALUES,
                    targets: list[str] = VALUES, length: int = 24, time_col: str = "utc",
                    pos_col: str = "pos", block: int = DEFAULT_BLOCK) -> DataFrame:
    """``x`` = rows i-length..i-1 (array of structs of ``features``), targets at row i.

    Only complete windows are kept, so a series of n rows yields
    max(0, n - length) windows (per extra partition key such as a split label).
    """
    df = _ensure_pos(df, keys, time_col, pos_col)
    b = blocked(df, pos_col, before=length, block=block)
    w = block_window(keys, pos_col).rowsBetween(-length, -1)
    row = F.struct(*[F.col(c).alias(c) for c in features])
    out = b.withColumn("x", F.collect_list(row).over(w))
    out = home_rows(out.filter(F.size("x") == length))
    return out.select(*keys, time_col, pos_col, "x", *[F.col(t).alias(f"y_{t}") for t in targets])


def seq2seq_windows(df: DataFrame, keys: list[str] = KEYS, features: list[str] = VALUES,
                    label_columns: list[str] | None = None, input_width: int = 24,
                    label_width: int = 24, shift: int = 24, time_col: str = "utc",
                    pos_col: str = "pos", block: int = DEFAULT_BLOCK) -> DataFrame:
    """Input rows i..i+input_width-1 and label rows i+total-label_width..i+total-1,
    total = input_width + shift, stride 1, complete windows only (W4, W4b).

    Labels keep only ``label_columns`` (all features when None).  The window
    is emitted at its first row ``i``.
    """
    df = _ensure_pos(df, keys, time_col, pos_col)
    labels = label_columns or features
    total = input_width + shift
    b = blocked(df, pos_col, after=total - 1, block=block)
    w = block_window(keys, pos_col)
    xin = F.collect_list(F.struct(*[F.col(c).alias(c) for c in features])).over(
        w.rowsBetween(0, input_width - 1))
    yout = F.collect_list(F.struct(*[F.col(c).alias(c) for c in labels])).over(
        w.rowsBetween(total - label_width, total - 1))
    out = b.withColumns({"inputs": xin, "labels": yout})
    out = home_rows(out.filter((F.size("inputs") == input_width) & (F.size("labels") == label_width)))
    return out.select(*keys, time_col, pos_col, "inputs", "labels")


def flatten_window(col: str | Column, fields: list[str]) -> Column:
    """Array of structs -> flat array of doubles, row-major (N12 reshape)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.flatten(F.transform(c, lambda r: F.array(*[r[f].cast("double") for f in fields])))


def unflatten_window(col: str | Column, fields: list[str]) -> Column:
    """Flat row-major array -> array of structs (inverse of ``flatten_window``).

    ``try_element_at``: indices are always in range for a real row, but
    Catalyst may evaluate a pushed-down predicate on this expression for rows
    a later filter removes (empty halo windows), which must not raise.
    """
    c = F.col(col) if isinstance(col, str) else col
    k = len(fields)
    n = (F.size(c) / k).cast("int")
    idx = F.slice(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), 1, F.greatest(n, F.lit(0)))
    return F.transform(idx,
                       lambda i: F.struct(*[F.try_element_at(c, i * k + j + 1).alias(f)
                                            for j, f in enumerate(fields)]))


def fifo_advance(window: Column, newest: Column, length: int) -> Column:
    """Append the newest row and keep the last ``length``."""
    return F.slice(F.concat(window, F.array(newest)), 2, length)


ROUNDS = 4
WALKS = 16


def permuted(index: Column, n: int, seed: int = 42) -> Column:
    """A keyed permutation of 0..n-1, computed for each index alone.

    The index is a pair (left, right) of a grid of just over n places; each
    round adds a hash of one half to the other, which can be undone, so no two
    indexes meet.  The few places beyond n are walked on until they fall
    inside: there are fewer than ``sqrt(n)`` of them, so at most 16 steps are
    needed up to 256 rows, and beyond that more are as good as impossible.
    """
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))

    def once(x):
        left, right = F.floor(x / b).cast("long"), (x % b).cast("long")
        for r in range(ROUNDS):
            left = F.pmod(left + F.pmod(F.xxhash64(right, F.lit(seed), F.lit(2 * r)), F.lit(a)), F.lit(a))
            right = F.pmod(right + F.pmod(F.xxhash64(left, F.lit(seed), F.lit(2 * r + 1)), F.lit(b)), F.lit(b))
        return left * b + right
    # each step is a lambda of its own, so the halves are not written out many times over
    walk = lambda x: F.element_at(F.transform(F.array(x), once), 1)
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), walk(index.cast("long")), lambda x, i: F.when(x < n, x).otherwise(walk(x)))


def shuffled_batches(df: DataFrame, keys: list[str] = KEYS, time_col: str = "utc", size: int = 32, seed: int = 42) -> DataFrame:
    """Rows with the ``batch`` and ``place`` of a seeded shuffle into mini-batches.

    Every row gets a dense index over all series (two levels, no global sort),
    and a keyed permutation of the index says where it goes; all batches but
    the last are full.  ``keys`` and time must identify a row for the shuffle
    to be the same every time.
    """
    one = df.withColumn("_all", F.lit(0))
    chunk = [*[F.col(k) for k in keys], F.floor(epoch_seconds(time_col) / DEFAULT_CHUNK_SECONDS)]
    indexed = with_position(one, ["_all"], keys[0], "_index", tiebreak=[*keys[1:], time_col], chunk=chunk).drop("_all")
    n = df.count()
    at = permuted(F.col("_index"), n, seed)
    return (indexed.withColumn("_at", at).withColumns({"batch": F.floor(F.col("_at") / size).cast("long"), "place": (F.col("_at") % size).cast("int")})
            .drop("_index", "_at"))


def tail_slice(df: DataFrame, keys: list[str] = KEYS, last: int = 24, skip_last: int = 0,
               time_col: str = "utc", pos_col: str = "pos") -> DataFrame:
    """Python slice ``[-(last+skip_last):-skip_last]`` per series.

    ``last``=24, ``skip_last``=0 is ``[-24:]``; ``last``=76, ``skip_last``=72
    is ``[-148:-72]``.  Uses the series length (a combinable aggregate), not a
    per-series window.
    """
    df = _ensure_pos(df, keys, time_col, pos_col)
    n = df.groupBy(*keys).agg((F.max(pos_col) + 1).alias("_n"))
    out = df.join(n, keys)
    p = F.col(pos_col)
    return (out.filter((p >= F.col("_n") - (last + skip_last)) & (p < F.col("_n") - skip_last))
               .drop("_n"))


__all__ = [
    "lag_supervised", "lag_matrix", "difference", "undifference", "sliding_windows",
    "seq2seq_windows", "flatten_window", "unflatten_window", "fifo_advance",
    "shuffled_batches", "permuted", "tail_slice",
]
