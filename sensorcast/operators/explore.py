"""Exploration: the data behind the reference's charts (V1-V9).

Everything is aggregated on the cluster; only bounded result tables (bins,
hours of day, months) leave it.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorcast.operators.position import DEFAULT_BLOCK, carry_across_blocks
from sensorcast.operators.quantiles import exact_quantiles
from sensorcast.operators.stats import join_null_safe, long_format

VALUES = ["ts", "hr", "qfe"]


def evolution_series(df: DataFrame, keys: list[str] = ("series_id",), time_col: str = "utc",
                     values: list[str] = VALUES, bucket: str = "1 day") -> DataFrame:
    """Value over time, bucketed to min / mean / max per bucket (V1)."""
    aggs = []
    for v in values:
        aggs += [F.min(v).alias(f"{v}_min"), F.avg(v).alias(f"{v}_mean"), F.max(v).alias(f"{v}_max")]
    return df.groupBy(*keys, F.window(time_col, bucket).start.alias(time_col)).agg(*aggs)


def diurnal_by_date(df: DataFrame, time_col: str = "utc", values: list[str] = VALUES,
                    keys: list[str] = ()) -> DataFrame:
    """Mean per date and hour of day (V2)."""
    t = F.col(time_col)
    return (df.groupBy(*keys, F.to_date(t).alias("date"), F.hour(t).alias("hour"))
              .agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(v) for v in values]))


def diurnal_by_month(df: DataFrame, time_col: str = "utc", values: list[str] = VALUES,
                     keys: list[str] = (), exact: bool = True) -> DataFrame:
    """Per month, hour of day and variable: count, mean, sample std, median (V3)."""
    t = F.col(time_col)
    base = df.select(*keys, F.month(t).alias("month"), F.hour(t).alias("hour"), *values)
    long = long_format(base, values, [*keys, "month", "hour"])
    by = [*keys, "month", "hour", "variable"]
    aggs = [F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")]
    if not exact:
        return long.groupBy(*by).agg(*aggs, F.percentile_approx("value", 0.5, 10000).cast("double").alias("median"))
    medians = exact_quantiles(long, by, [0.5]).select(*by, F.col("q")[0].alias("median"))
    return join_null_safe(long.groupBy(*by).agg(*aggs), medians, by)


def value_bounds(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Min and max of columns: one aggregate row, used to fix bin edges.  A column without values gets (0, 1)."""
    row = df.agg(*[F.min(c).alias(f"{c}_lo") for c in cols], *[F.max(c).alias(f"{c}_hi") for c in cols]).first()
    return {c: (0.0, 1.0) if row[f"{c}_lo"] is None else (float(row[f"{c}_lo"]), float(row[f"{c}_hi"])) for c in cols}


def _bins(x: str, y: str, bins: int, bounds: dict) -> list:
    (xl, xh), (yl, yh) = bounds[x], bounds[y]
    return [F.width_bucket(F.col(x), F.lit(xl), F.lit(xh), F.lit(bins)).alias("x_bin"),
            F.width_bucket(F.col(y), F.lit(yl), F.lit(yh), F.lit(bins)).alias("y_bin")]


def _exact_mean(col: str):
    """Mean by a decimal sum (ten places), the same in whatever order rows are added."""
    return F.sum(F.col(col).cast("decimal(28,10)")).cast("double") / F.count(col)


def binned_relation(df: DataFrame, x: str, y: str, z: str, bins: int = 10, bounds: dict | None = None,
                    by: list = (), time_col: str = "utc", by_month: bool = False) -> DataFrame:
    """Two variables against each other, the third as colour (V4).

    Equal-width 2-D bins (``width_bucket``: 0 below, bins+1 at or above the
    top edge), with the row count and mean of ``z`` per bin; optionally per
    month.  The result has at most (bins+2)^2 rows per group.
    """
    bounds = bounds or value_bounds(df, [x, y])
    groups = list(by) + ([F.month(time_col).alias("month")] if by_month else [])
    return (df.groupBy(*groups, *_bins(x, y, bins, bounds))
              .agg(F.count(F.lit(1)).alias("n"), _exact_mean(z).alias(f"{z}_mean")))


def density_2d(df: DataFrame, x: str, y: str, bins: int = 10, bounds: dict | None = None) -> DataFrame:
    """Share of rows per 2-D bin (V5).

    The total comes from a window over the binned table, which has at most
    (bins+2)^2 rows whatever the input size.
    """
    bounds = bounds or value_bounds(df, [x, y])
    counts = df.groupBy(*_bins(x, y, bins, bounds)).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def smooth_density(df: DataFrame, x: str, y: str, bandwidth: tuple[float, float] | None = None, points: int = 25, bins: int = 100,
                   bounds: dict | None = None) -> DataFrame:
    """Two-dimensional Gaussian kernel density on a grid of ``points`` x ``points`` (V5).

    Rows are counted in ``bins`` x ``bins`` cells first (a combinable
    aggregate); the kernel is a product, so the cells are convolved along x and
    then along y: ``bins^2 * points`` small rows, whatever the number of
    readings.  The bandwidth (standard deviation per axis) is the normal
    reference ``1.06 * std * n^(-1/5)`` unless given.  Output: ``(x_point,
    y_point, density)``; rows with a null do not count, and without rows or
    spread the result is empty.
    """
    rows = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    s = rows.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{c}_{k}") for c in "xy" for k, f in
                                                 (("lo", F.min), ("hi", F.max), ("sd", F.stddev_samp))]).first()  # one row
    edges = {c: (bounds or {}).get(name, (s[f"{c}_lo"], s[f"{c}_hi"])) for c, name in (("x", x), ("y", y))}
    h = dict(zip("xy", bandwidth)) if bandwidth else {c: 1.06 * (s[f"{c}_sd"] or 0.0) * max(s["n"], 1) ** -0.2 for c in "xy"}
    empty = not s["n"] or any(not h[c] or edges[c][0] == edges[c][1] for c in "xy")
    if empty:
        return df.sparkSession.createDataFrame([], "x_point double, y_point double, density double")

    def cell(c):
        lo, hi = edges[c]
        return F.least(F.greatest(F.floor((F.col(c) - lo) * bins / (hi - lo)), F.lit(0)), F.lit(bins - 1))

    def weight(c, point):
        lo, hi = edges[c]
        centre = lo + (F.col(f"{c}_cell") + 0.5) * ((hi - lo) / bins)
        return F.exp(-0.5 * F.pow((point - centre) / h[c], 2)) / (h[c] * math.sqrt(2 * math.pi))

    def grid(c):
        lo, hi = edges[c]
        return F.explode(F.array(*[F.lit(lo + i * (hi - lo) / (points - 1)) for i in range(points)]))
    cells = rows.groupBy(cell("x").alias("x_cell"), cell("y").alias("y_cell")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    along = (cells.withColumn("x_point", grid("x")).groupBy("x_point", "y_cell")
             .agg(F.sum(F.col("n") * weight("x", F.col("x_point"))).alias("n")))
    return (along.withColumn("y_point", grid("y")).groupBy("x_point", "y_point")
            .agg((F.sum(F.col("n") * weight("y", F.col("y_point"))) / s["n"]).alias("density")))


def correlations(df: DataFrame, values: list[str] = VALUES, keys: list = ()) -> DataFrame:
    """Pearson correlation of every pair of variables (V6); a combinable aggregate."""
    pairs = list(combinations(values, 2))
    return df.groupBy(*keys).agg(*[F.corr(a, b).alias(f"corr_{a}_{b}") for a, b in pairs])


def correlations_by_month(df: DataFrame, values: list[str] = VALUES, time_col: str = "utc") -> DataFrame:
    return correlations(df, values, [F.month(time_col).alias("month")])


def diurnal_extrema(df: DataFrame, time_col: str = "utc", values: list[str] = VALUES,
                    keys: list[str] = ()) -> DataFrame:
    """Peak and trough hour of the mean daily cycle, and its local extrema (V7).

    The hourly profile has 24 rows per group, so the cyclic neighbour window
    over it is bounded.
    """
    base = df.select(*keys, F.hour(time_col).alias("hour"), *values)
    prof = long_format(base, values, [*keys, "hour"]).groupBy(*keys, "variable", "hour") \
        .agg(F.avg("value").alias("mean"))
    w = Window.partitionBy(*keys, "variable").orderBy("hour")
    first = F.first("mean").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    last = F.last("mean").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    prev = F.coalesce(F.lag("mean").over(w), last)
    nxt = F.coalesce(F.lead("mean").over(w), first)
    prof = prof.withColumns({"_max": (F.col("mean") > prev) & (F.col("mean") > nxt),
                             "_min": (F.col("mean") < prev) & (F.col("mean") < nxt)})
    return prof.groupBy(*keys, "variable").agg(
        F.max_by("hour", "mean").alias("peak_hour"), F.max("mean").alias("peak_mean"),
        F.min_by("hour", "mean").alias("trough_hour"), F.min("mean").alias("trough_mean"),
        F.count_if("_max").alias("local_maxima"), F.count_if("_min").alias("local_minima"))


def monthly_drift(df: DataFrame, time_col: str = "utc", values: list[str] = VALUES,
                  keys: list = ()) -> DataFrame:
    """Mean and sample variance per calendar month (V8)."""
    m = F.date_trunc("month", F.col(time_col)).cast("timestamp_ntz").alias("month")
    aggs = []
    for v in values:
        aggs += [F.avg(v).alias(f"{v}_mean"), F.var_samp(v).alias(f"{v}_var")]
    return df.groupBy(*keys, m).agg(*aggs)


def gap_runs(grid: DataFrame, keys: list[str] = ("series_id",), values: list[str] = VALUES,
             time_col: str = "utc", pos_col: str = "pos", step_seconds: int = 3600,
             block: int = DEFAULT_BLOCK) -> DataFrame:
    """Runs of consecutive empty steps per series and variable on a gap grid (V9).

    A run starts at a null whose previous row is not null (or at position 0)
    and ends before the next non-null (or at the series end).  Uses the
    carried previous/next non-null positions, no per-series window.
    """
    keys = list(keys)
    long = long_format(grid.select(*keys, time_col, pos_col, *values), values, [*keys, time_col, pos_col])
    c = carry_across_blocks(long, [*keys, "variable"], ["value"], pos_col, block)
    n = grid.groupBy(*keys).agg(F.max(pos_col).alias("_last"))
    c = c.join(n, keys)
    p = F.col(pos_col)
    pp, np_ = F.col("value__pp"), F.col("value__np")
    start = F.col("value").isNull() & ((pp.isNull() & (p == 0)) | (pp == p - 1))
    end = F.coalesce(np_ - 1, F.col("_last"))
    return c.filter(start).select(
        *keys, "variable", F.col(time_col).alias("start"),
        F.timestamp_add("SECOND", (end - p) * step_seconds, F.col(time_col)).alias("end"),
        (end - p + 1).alias("steps"))


# Fixed value: rows per day of a 5-second feed.
EXPECTED_PER_DAY = 17280


def daily_coverage(raw: DataFrame, keys: list[str] = ("series_id",), time_col: str = "utc",
                   expected: int = EXPECTED_PER_DAY) -> DataFrame:
    """Rows per series and day against the expected count (V9)."""
    return (raw.groupBy(*keys, F.to_date(time_col).alias("date"))
               .agg(F.count(F.lit(1)).alias("n"))
               .withColumn("coverage", F.col("n") / F.lit(expected)))
