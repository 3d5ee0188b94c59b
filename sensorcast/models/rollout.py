"""Recursive roll-out as one projection (M8).

A forecaster that feeds its own output back is a fold over the steps.  For
models whose one-step rule is a Spark expression, the whole horizon is
computed by ``aggregate(sequence(1, H), ...)`` inside a single projection over
one row per series: no loop of H jobs, no H-deep plan, all series in
parallel.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorcast.functions.time import step_time


def fold_rollout(df: DataFrame, keys: list[str], state: dict[str, Column],
                 step_fn: Callable[[Column, Column], dict[str, Column]], horizon: int,
                 time_col: str = "utc", first_step: int = 1, unit: str = "HOUR",
                 state_type: str | None = None) -> DataFrame:
    """Roll a one-step rule forward ``horizon`` times per row.

    ``state`` gives the starting values (normally the last observation);
    ``step_fn(prev, i)`` returns the next values from the previous state
    struct ``prev`` and the step number ``i`` (1-based).  Output: one row per
    key and step with ``time_col`` = start time + (step - 1 + first_step).
    """
    names = list(state)
    scalar = state_type is None
    st_type = state_type or "struct<" + ",".join(f"{n}:double" for n in names) + ">"
    fix = (lambda c: c.cast("double")) if scalar else (lambda c: c)
    init = F.array(F.struct(*[fix(c).alias(n) for n, c in state.items()]).cast(st_type))

    def merge(acc, i):
        prev = F.element_at(acc, -1)
        nxt = step_fn(prev, i)
        row = F.struct(*[fix(nxt[n]).alias(n) for n in names]).cast(st_type)
        return F.concat(acc, F.array(row))

    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), init, merge)
    out = df.select(*keys, F.col(time_col).alias("_t0"),
                    F.posexplode(F.slice(path, 2, horizon)).alias("_i", "_s"))
    return out.select(*keys, (F.col("_i") + 1).alias("step"),
                      step_time("_t0", F.col("_i") + first_step, unit).alias(time_col),
                      *[F.col(f"_s.{n}").alias(n) for n in names])
