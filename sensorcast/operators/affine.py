"""Affine recursions ``y(n) = a y(n-1) + u(n)`` over long series.

The recursion is an associative scan: a block of rows turns an incoming value
``s`` into ``a^L s + end``, so blocks are solved on their own, one row a block
is folded per series, and the incoming value is added back, decayed by
``a^(i+1)`` at the block's row ``i``.  A series is therefore never read by one
task, however long it is.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorcast.operators.position import DEFAULT_BLOCK


def decayed_sums(a: float, u: np.ndarray) -> np.ndarray:
    """``y(i) = a y(i-1) + u(i)`` along axis 0 from zero, by doubling: after step k a row holds its last ``2^k`` terms."""
    y, reach, weight = np.array(u, float), 1, float(a)
    while reach < len(y) and weight != 0.0:
        y[reach:] = y[reach:] + weight * y[:-reach]
        reach, weight = 2 * reach, weight * weight
    return y


def affine_across_blocks(df: DataFrame, keys: list[str], a: Column, u: Column, pos_col: str = "pos", name: str = "y",
                         block: int = DEFAULT_BLOCK) -> DataFrame:
    """``(keys, pos, name)`` with ``name(n) = a name(n-1) + u(n)`` in position order, starting from zero.

    ``a`` is one number a series, ``|a| <= 1``; a null ``u`` counts as zero and
    a null ``a`` gives no rows.  Positions may have holes: a row follows the row before it.
    """
    rows = df.select(*keys, F.col(pos_col).cast("long").alias("_pos"), a.cast("double").alias("_a"),
                     F.coalesce(u.cast("double"), F.lit(0.0)).alias("_u")).where("_a is not null")
    packed = (rows.groupBy(*keys, F.floor(F.col("_pos") / block).alias("_blk"))
              .agg(F.max("_a").alias("_a"), F.sort_array(F.collect_list(F.struct("_pos", "_u"))).alias("_r"))
              .select(*keys, "_blk", "_a", F.col("_r._pos").alias("_pos"), F.col("_r._u").alias("_y")))

    def local(batches):
        for batch in batches:
            batch["_y"] = [decayed_sums(k, y) for k, y in zip(batch["_a"], batch["_y"])]
            yield batch

    solved = packed.mapInPandas(local, packed.schema)
    n = F.size("_y")
    ends = solved.select(*keys, "_blk", F.pow("_a", n).alias("_m"), F.element_at("_y", -1).alias("_e"))

    # one pair of numbers a block, folded over the blocks before it
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    chunk = 1024
    cw = Window.partitionBy(*keys, "_chunk").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)

    def fold(pairs: Column, init: Column) -> Column:
        return F.aggregate(pairs, init, lambda s, p: F.struct(
            (s["m"] * p["m"]).alias("m"), (p["m"] * s["e"] + p["e"]).alias("e")))

    unit = F.struct(F.lit(1.0).alias("m"), F.lit(0.0).alias("e"))
    pair = F.struct(F.col("_m").alias("m"), F.col("_e").alias("e"))
    ends = ends.withColumn("_chunk", F.floor(F.col("_blk") / chunk))
    inner = ends.select(*keys, "_blk", "_chunk", fold(F.collect_list(pair).over(cw), unit).alias("_in"))
    chunks = ends.groupBy(*keys, "_chunk").agg(
        F.sort_array(F.collect_list(F.struct(F.col("_blk").alias("b"), F.col("_m").alias("m"), F.col("_e").alias("e")))).alias("_l"))
    chunks = chunks.select(*keys, "_chunk", fold(F.col("_l"), unit).alias("_c")).select(
        *keys, F.col("_chunk"), F.col("_chunk").alias("_blk"), F.col("_c.m").alias("_m"), F.col("_c.e").alias("_e"))
    outer = chunks.select(*keys, "_chunk", fold(F.collect_list(pair).over(before), unit).alias("_out"))
    incoming = inner.join(outer, [*keys, "_chunk"]).select(
        *keys, "_blk", (F.col("_in.m") * F.col("_out.e") + F.col("_in.e")).alias("_s"))

    out = solved.join(incoming, [*keys, "_blk"])
    value = F.transform("_y", lambda y, i: F.struct(
        F.element_at("_pos", i + 1).alias("p"), (y + F.pow("_a", i + 1) * F.col("_s")).alias("y")))
    return out.select(*keys, F.explode(value).alias("_v")).select(
        *keys, F.col("_v.p").alias(pos_col), F.col("_v.y").alias(name))
