"""Connected components of a link table: every round links the neighbours of a node to the smallest (hash-to-min)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from sensorcast.llm.common import drop_stored, stored

MAX_ROUNDS = 60


def _round(edges: DataFrame) -> DataFrame:
    """``(hi, lo, open)``: every node links itself and its neighbours to the
    smallest of them.  ``open`` marks nodes that saw several neighbours, a
    smaller one among them: without such nodes the edges were stars before.

    The edges are read once and shuffled once; a node's neighbours are sorted
    and may spill.  Every distinct edge gives two rows at most.
    """
    both = edges.select(F.inline(F.array(F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")),
                                         F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))))
    of_node = Window.partitionBy("u")
    seen = (both.repartition("u").distinct()
            .select("u", "v", F.min("v").over(of_node).alias("least"), F.max("v").over(of_node).alias("most")))
    low = F.least("u", "least")
    return seen.select(F.when(F.col("v") == low, F.col("u")).otherwise(F.col("v")).alias("hi"), low.alias("lo"),
                       ((F.col("least") < F.col("u")) & (F.col("least") < F.col("most"))).alias("open"))


def _written(edges: DataFrame):
    """The edges after a round as a written table, its path, and whether any
    node was open, which is found while they are written."""
    seen = Observation()
    table, path = stored(_round(edges).observe(seen, F.max("open").alias("open")).select("hi", "lo"), "links")
    return table, path, bool(seen.get["open"])


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every id in a link; the component is the
    smallest id reachable.

    Links may repeat, come in either order, or join an id to itself.  Null
    ends are ignored.  Each round is written to the shared folder and the one
    before removed, so the plan stays short and lost executors cost one round.
    """
    spark = links.sparkSession
    edges = (links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
             .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")))
    path = None
    for _ in range(MAX_ROUNDS):
        edges, now, is_open = _written(edges)
        if path:
            drop_stored(spark, path)
        path = now
        if not is_open:
            break
    else:
        raise RuntimeError(f"links did not settle in {MAX_ROUNDS} rounds")
    # every edge now joins a node to the smallest of its component
    return edges.select(F.inline(F.array(F.struct(F.col("hi").alias("id"), F.col("lo").alias("component")),
                                         F.struct(F.col("lo").alias("id"), F.col("lo").alias("component"))))).distinct()
