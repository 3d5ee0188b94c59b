"""Ordered operators without one-task-per-series windows.

A window ``partitionBy(series).orderBy(time)`` sorts a whole series in one
task; one station may hold a third of all rows, so every ordered operator here
works on *position blocks* instead:

* ``with_position`` numbers rows 0..n-1 inside each series in two levels:
  row numbers inside ``(series, time chunk)`` plus the running count of the
  earlier chunks, taken from the small chunk-count table.
* ``blocked`` assigns ``_blk = pos // block`` and copies the few rows a
  neighbouring block needs (``before`` rows of history, ``after`` rows of
  future) into it as halo rows.  A window over ``(series, _blk)`` then gives
  exactly the result of the window over the whole series for every home row.
* ``carry_across_blocks`` and ``prefix_across_blocks`` finish the operators
  whose reach is unbounded (gap fill, running sums): each block is solved
  locally, then a per-block summary table - one row per block, so tiny - is
  scanned per series and joined back.

``pos`` must be dense (0..n-1 without holes) within each series; the gap grid
emits it that way and ``with_position`` builds it for any frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorcast.functions.time import epoch_seconds

# Rows per position block.  Big enough that halos (at most a few hundred rows)
# are a rounding error, small enough that one block sorts in memory easily.
DEFAULT_BLOCK = 1 << 16

# Width of the time chunks used to number rows.
DEFAULT_CHUNK_SECONDS = 7 * 24 * 3600


def with_position(df: DataFrame, keys: list[str], time_col: str = "utc", pos_col: str = "pos",
                  tiebreak: list[str] | None = None,
                  chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
                  chunk: list[Column] | None = None) -> DataFrame:
    """Add a dense 0-based position per ``keys`` in ``(time_col, *tiebreak)`` order.

    ``chunk`` (default: the time chunk of ``time_col``) must be monotone in
    that order; rows are numbered inside ``(keys, chunk)`` and shifted by the
    counts of the earlier chunks.
    """
    order = [F.col(time_col)] + [F.col(c) for c in (tiebreak or [])]
    chunk = chunk or [F.floor(epoch_seconds(time_col) / chunk_seconds)]
    cnames = [f"_chunk{i}" for i in range(len(chunk))]
    local = df.withColumns(dict(zip(cnames, chunk)))
    local = local.withColumn("_rn", F.row_number().over(
        Window.partitionBy(*keys, *cnames).orderBy(*order)) - 1)
    counts = local.groupBy(*keys, *cnames).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(
            Window.partitionBy(*keys).orderBy(*cnames)
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return (local.join(offsets, [*keys, *cnames])
                 .withColumn(pos_col, (F.col("_off") + F.col("_rn")).cast("long"))
                 .drop(*cnames, "_rn", "_off"))


def blocked(df: DataFrame, pos_col: str = "pos", before: int = 0, after: int = 0,
            block: int = DEFAULT_BLOCK) -> DataFrame:
    """Tag rows with ``_blk`` and ``_home``; add halo copies for neighbour blocks.

    A row near the end of its block is also copied (``_home`` false) into the
    next block when ``before`` > 0, and a row near the start into the previous
    block when ``after`` > 0.  One pass over the input (``explode``), no union.
    """
    if before > block or after > block:
        raise ValueError("halo wider than a block")
    p = F.col(pos_col)
    blk = F.floor(p / block)
    off = p - blk * block
    targets = [F.struct(blk.alias("b"), F.lit(True).alias("h"))]
    if before:
        targets.append(F.when(off >= block - before,
                              F.struct((blk + 1).alias("b"), F.lit(False).alias("h"))))
    if after:
        targets.append(F.when(off < after,
                              F.struct((blk - 1).alias("b"), F.lit(False).alias("h"))))
    if len(targets) == 1:
        return df.withColumns({"_blk": blk, "_home": F.lit(True)})
    t = F.explode(F.filter(F.array(*targets), lambda x: x.isNotNull()))
    return (df.withColumn("_t", t)
              .withColumns({"_blk": F.col("_t.b"), "_home": F.col("_t.h")})
              .drop("_t"))


def block_window(keys: list[str], pos_col: str = "pos") -> Window:
    return Window.partitionBy(*keys, "_blk").orderBy(pos_col)


def home_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_home")).drop("_blk", "_home")


def carry_across_blocks(df: DataFrame, keys: list[str], values: list[str], pos_col: str = "pos",
                        block: int = DEFAULT_BLOCK) -> DataFrame:
    """Previous and next non-null value (and its position) of every column.

    Adds ``{v}__pv, {v}__pp`` (value and position of the last non-null at or
    before the row) and ``{v}__nv, {v}__np`` (first non-null at or after it).
    """
    b = df.withColumn("_blk", F.floor(F.col(pos_col) / block))
    back = block_window(keys, pos_col).rowsBetween(Window.unboundedPreceding, 0)
    # "first at or after" is "last so far" in descending order: a frame that
    # grows row by row, where one up to the end would be read anew for each row
    fwd = Window.partitionBy(*keys, "_blk").orderBy(F.col(pos_col).desc()).rowsBetween(Window.unboundedPreceding, 0)
    p = F.col(pos_col)
    local = {}
    for v in values:
        nn = F.col(v).isNotNull()
        local[f"{v}__pv"] = F.last(v, ignorenulls=True).over(back)
        local[f"{v}__pp"] = F.last(F.when(nn, p), ignorenulls=True).over(back)
        local[f"{v}__nv"] = F.last(v, ignorenulls=True).over(fwd)
        local[f"{v}__np"] = F.last(F.when(nn, p), ignorenulls=True).over(fwd)
    b = b.withColumns(local)

    # One row per block: its last and first non-null of each column.
    aggs = []
    for v in values:
        nnp = F.when(F.col(v).isNotNull(), p)
        aggs += [F.max_by(v, nnp).alias(f"{v}__bl"), F.max(nnp).alias(f"{v}__blp"),
                 F.min_by(v, nnp).alias(f"{v}__bf"), F.min(nnp).alias(f"{v}__bfp")]
    summary = b.groupBy(*keys, "_blk").agg(*aggs)
    sw = Window.partitionBy(*keys).orderBy("_blk")
    prev_w = sw.rowsBetween(Window.unboundedPreceding, -1)
    next_w = Window.partitionBy(*keys).orderBy(F.col("_blk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = {}
    for v in values:
        carried[f"{v}__cpv"] = F.last(f"{v}__bl", ignorenulls=True).over(prev_w)
        carried[f"{v}__cpp"] = F.last(f"{v}__blp", ignorenulls=True).over(prev_w)
        carried[f"{v}__cnv"] = F.last(f"{v}__bf", ignorenulls=True).over(next_w)
        carried[f"{v}__cnp"] = F.last(f"{v}__bfp", ignorenulls=True).over(next_w)
    summary = summary.select(*keys, "_blk", *[e.alias(n) for n, e in carried.items()])

    out = b.join(summary, [*keys, "_blk"], "left")
    fill = {}
    for v in values:
        has_prev = F.col(f"{v}__pp").isNotNull()
        has_next = F.col(f"{v}__np").isNotNull()
        fill[f"{v}__pv"] = F.when(has_prev, F.col(f"{v}__pv")).otherwise(F.col(f"{v}__cpv"))
        fill[f"{v}__pp"] = F.when(has_prev, F.col(f"{v}__pp")).otherwise(F.col(f"{v}__cpp"))
        fill[f"{v}__nv"] = F.when(has_next, F.col(f"{v}__nv")).otherwise(F.col(f"{v}__cnv"))
        fill[f"{v}__np"] = F.when(has_next, F.col(f"{v}__np")).otherwise(F.col(f"{v}__cnp"))
    drop = [f"{v}__{s}" for v in values for s in ("cpv", "cpp", "cnv", "cnp")]
    return out.withColumns(fill).drop(*drop, "_blk")


def prefix_across_blocks(df: DataFrame, keys: list[str], values: dict[str, Column],
                         pos_col: str = "pos", block: int = DEFAULT_BLOCK) -> DataFrame:
    """Running sums (inclusive, in position order) of the given expressions.

    ``values`` maps output name -> expression.  Nulls count as 0, as in a
    cumulative sum that skips missing values.
    """
    b = df.withColumns({"_blk": F.floor(F.col(pos_col) / block),
                        **{f"{n}__x": F.coalesce(e, F.lit(0.0)) for n, e in values.items()}})
    w = block_window(keys, pos_col).rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumns({f"{n}__in": F.sum(f"{n}__x").over(w) for n in values})
    summary = b.groupBy(*keys, "_blk").agg(*[F.sum(f"{n}__x").alias(f"{n}__bs") for n in values])
    prev_w = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*keys, "_blk", *[
        F.coalesce(F.sum(f"{n}__bs").over(prev_w), F.lit(0.0)).alias(f"{n}__off") for n in values])
    out = b.join(summary, [*keys, "_blk"], "left")
    return (out.withColumns({n: F.col(f"{n}__in") + F.col(f"{n}__off") for n in values})
               .drop("_blk", *[f"{n}__{s}" for n in values for s in ("x", "in", "off")]))
