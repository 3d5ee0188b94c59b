"""Exact quantiles of groups of any size (A5, V3).

Equal values of a group are counted first, so ties cost one row.  The counted
values are range-partitioned by group and value; one row per group and
partition says how many values lie before it, which tells the partition of
every wanted rank.  Only those partitions are ranked, so a group is spread over
as many tasks as it has values for, and none is gathered in one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorcast.session import write_and_read


def exact_quantiles(df: DataFrame, keys: list[str], probs: list[float], value: str = "value", name: str = "q") -> DataFrame:
    """``(keys, name)`` with one array of quantiles per group, in the order of ``probs``.

    Linear interpolation between the two neighbours (R type 7).  Nulls do not
    count; a group without values gets no row.  Null keys are a group.
    """
    alias = [f"_k{i}" for i in range(len(keys))]
    counted = (df.where(F.col(value).isNotNull()).groupBy(*[F.col(k).alias(a) for k, a in zip(keys, alias)], F.col(value).cast("double").alias("_v"))
               .agg(F.count(F.lit(1)).alias("_c")))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written once: the bounds of the ranges are sampled, and both steps below must see the same
    ranged = write_and_read(counted.repartitionByRange(parts, *alias, "_v").withColumn("_part", F.spark_partition_id()), "ranged-values")
    group = F.struct(*alias) if alias else F.lit(0)
    ranged = ranged.select(group.alias("_g"), "_part", "_v", "_c")
    # a partition holds a range: at most one row more than groups and partitions together
    sizes = ranged.groupBy("_g", "_part").agg(F.sum("_c").alias("_n"))
    by_group = Window.partitionBy("_g")
    before = F.coalesce(F.sum("_n").over(by_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("_g", "_part", "_n", before.alias("_before"), F.sum("_n").over(by_group).alias("_all"))
    h = F.array(*[F.lit(float(p)) for p in probs])
    wanted = (sizes.select("_g", "_part", "_n", "_before", "_all", F.posexplode(h).alias("_i", "_p"))
              .withColumn("_h", (F.col("_all") - 1) * F.col("_p"))
              .withColumn("_r", F.explode(F.array_distinct(F.array(F.floor("_h"), F.ceil("_h")))))
              .where("_r >= _before and _r < _before + _n"))
    needed = wanted.select("_g", "_part", "_before").distinct()
    upto = F.sum("_c").over(Window.partitionBy("_g", "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    needed = needed.withColumnsRenamed({"_g": "_g2", "_part": "_part2"})
    ranked = (ranged.join(needed, F.col("_g").eqNullSafe(F.col("_g2")) & (F.col("_part") == F.col("_part2")))
              .select("_g", "_part", "_v", "_c", (F.col("_before") + upto).alias("_to")))
    hit = (wanted.select("_g", "_part", "_i", "_h", "_r").alias("w").join(ranked.alias("x"), (F.col("w._part") == F.col("x._part"))
           & F.col("w._g").eqNullSafe(F.col("x._g")) & (F.col("w._r") < F.col("x._to")) & (F.col("w._r") >= F.col("x._to") - F.col("x._c")))
           .select("w._g", "w._i", "w._h", "w._r", "x._v"))
    low = F.max(F.when(F.col("_r") == F.floor("_h"), F.col("_v")))
    high = F.max(F.when(F.col("_r") == F.ceil("_h"), F.col("_v")))
    at = F.max("_h")
    each = hit.groupBy("_g", "_i").agg(F.when(F.floor(at) == at, low).otherwise(
        (F.ceil(at) - at) * low + (at - F.floor(at)) * high).alias("_q"))
    out = each.groupBy("_g").agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_q"))), lambda s: s["_q"]).alias(name))
    return out.select(*[F.col(f"_g.{a}").alias(k) for a, k in zip(alias, keys)], name)
