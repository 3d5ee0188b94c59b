"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Vectors are scaled to length one and turned into the principal axes of the
whole table, largest variance first.  Vectors of one label are sorted along
the leading axes and cut into tiles with a bounding box.  Two tiles are
compared only where their boxes are near enough for the threshold.  Inside a
pair of tiles, products are summed over the leading dimensions first; what is
left of a product is at most the product of the norms of the remaining parts,
and a pair stops as soon as its sum plus that bound cannot reach the
threshold.  Pairs that get through are confirmed on the original vectors.

Equal vectors of a label are one class.  A pair of tiles returns link counts
per class and a spanning forest of its links, never the links themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorcast.llm.common import stored
from sensorcast.llm.components import connected_components

THRESHOLD = 0.93
TILE_ROWS = 512
STEPS = (8, 16, 32)
BOX_DIMS = 4
CELL = 0.25
_SAFE = 1e-9


def is_usable(vec_col: str = "embedding") -> Column:
    """Whether a vector is there, finite and not zero (never null)."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.coalesce(fine, F.lit(False))


def usable(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows with an id and a usable vector, which becomes ``array<double>``."""
    return rows.where(F.col(id_col).isNotNull() & is_usable(vec_col)).withColumn(vec_col, F.col(vec_col).cast("array<double>"))


def principal_axes(vectors: DataFrame, vec_col: str = "v", dim: int | None = None) -> np.ndarray:
    """Orthonormal axes of all vectors (scaled to length one), as columns.

    Tasks sum outer products; a few thousand sums, the square of the
    dimension, reach the driver.
    """
    if dim is None:
        dim = vectors.agg(F.max(F.size(vec_col)).alias("d")).first()["d"] or 0
    if dim == 0:
        return np.zeros((0, 0))

    def run(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            x = unit(matrix(batch.column(vec_col), dim))
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim), pa.int32()), pa.array(total.ravel())],
                                         names=["i", "s"])
    sums = vectors.select(vec_col).mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    gram = np.zeros(dim * dim)
    for r in sums:
        gram[r["i"]] = r["s"]
    gram = gram.reshape(dim, dim)
    _, axes = np.linalg.eigh((gram + gram.T) / 2)
    return axes[:, ::-1]


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``dim``."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    at = 0
    for i, n in enumerate(sizes.tolist()):
        out[i, :n] = flat[at:at + n]
        at += n
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one (first by their largest component, so that
    very small and very large vectors keep their direction)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _near_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (of unit vectors in principal axes) that can reach the threshold."""
    dim = a.shape[1]
    cuts = [c for c in STEPS if c < dim] + [dim]
    head = a[:, :cuts[0]] @ b[:, :cuts[0]].T

    def rest(x, cut):
        return np.sqrt(np.maximum((x[:, cut:] ** 2).sum(axis=1), 0.0))
    may = head + np.outer(rest(a, cuts[0]), rest(b, cuts[0])) >= threshold - _SAFE
    if same:
        may = np.triu(may, 1)
    r, c = np.nonzero(may)
    sums = head[r, c]
    for low, high in zip(cuts[:-1], cuts[1:]):
        ra, rb = rest(a, high), rest(b, high)
        keep_r, keep_c, keep_s = [], [], []
        for i in range(0, len(r), 1 << 16):
            rr, cc = r[i:i + (1 << 16)], c[i:i + (1 << 16)]
            s = sums[i:i + (1 << 16)] + np.einsum("ij,ij->i", a[rr, low:high], b[cc, low:high])
            ok = s + ra[rr] * rb[cc] >= threshold - _SAFE
            keep_r.append(rr[ok]), keep_c.append(cc[ok]), keep_s.append(s[ok])
        if not keep_r:
            break
        r, c, sums = np.concatenate(keep_r), np.concatenate(keep_c), np.concatenate(keep_s)
    return r, c


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of matching rows, in double precision, on the vectors as they are."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    y = y / np.abs(y).max(axis=1, keepdims=True)
    return np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))


def spanning_forest(n: int, r: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every node of a link its smallest reachable node, where they differ."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[r], label[c])
        new = label.copy()
        np.minimum.at(new, r, low)
        np.minimum.at(new, c, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def _compare(axes: np.ndarray, threshold: float, dim: int):
    schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            cols = [batch.column(n).to_pylist() for n in ("same", "ids_a", "m_a", "vecs_a", "ids_b", "m_b", "vecs_b")]
            for same, ids_a, m_a, vecs_a, ids_b, m_b, vecs_b in zip(*cols):
                ids_a, m_a, ids_b, m_b = (np.frombuffer(x, np.int64) for x in (ids_a, m_a, ids_b, m_b))
                x, y = (np.frombuffer(v, np.float64).reshape(-1, dim) for v in (vecs_a, vecs_b))
                r, c = _near_pairs(unit(x) @ axes, unit(y) @ axes, threshold, same)
                if not len(r):
                    continue
                ok = np.concatenate([cosines(x[r[i:i + 65536]], y[c[i:i + 65536]]) >= threshold
                                     for i in range(0, len(r), 65536)])
                r, c = r[ok], c[ok]
                if not len(r):
                    continue
                if same:
                    links = (np.bincount(r, weights=m_a[c], minlength=len(ids_a))
                             + np.bincount(c, weights=m_a[r], minlength=len(ids_a)))
                    ids, node = ids_a, spanning_forest(len(ids_a), r, c)
                else:
                    links = np.concatenate([np.bincount(r, weights=m_b[c], minlength=len(ids_a)),
                                            np.bincount(c, weights=m_a[r], minlength=len(ids_b))])
                    ids = np.concatenate([ids_a, ids_b])
                    node = spanning_forest(len(ids), r, c + len(ids_a))
                hit = np.flatnonzero(links)
                kind = np.concatenate([np.zeros(len(hit), np.int32), np.ones(len(node[0]), np.int32)])
                a = np.concatenate([ids[hit], ids[node[0]]])
                b = np.concatenate([links[hit].astype(np.int64), ids[node[1]]])
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(a), pa.array(b)], schema=schema)
    return run


def _tiles(axes: np.ndarray, dim: int, rows: int):
    """Cuts sorted rows of (label, d, rep, m, v) into tiles with boxes."""
    names = ["label", "d", "n", "lo", "hi", "ids", "m", "vecs"]
    types = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]

    def tile(label, d, ids, m, x):
        p = unit(x) @ axes[:, :BOX_DIMS]
        return [label, d, len(ids), p.min(axis=0).tolist(), p.max(axis=0).tolist(), ids.tobytes(), m.tobytes(), x.tobytes()]

    def run(batches):
        for batch in batches:
            x = np.ascontiguousarray(matrix(batch.column("v"), dim))
            key = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in ("label", "d")])
            ids, m = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("rep", "m"))
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), len(ids)]
            out = [tile(int(key[0, s]), int(key[1, s]), ids[s:e], m[s:e], x[s:e])
                   for a, b in zip(cuts[:-1], cuts[1:]) for s in range(a, b, rows) for e in [min(s + rows, b)]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
    return run


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row.

    Vectors with equal, not null labels are linked when their cosine reaches
    the threshold; vectors of different lengths never are.  ``n_links`` counts
    the other rows linked directly, ``component_id`` is the smallest id
    reachable.  Null, zero and not finite vectors and rows with a null label
    link with nothing.  A null ``vec_id`` takes no part and is returned with no
    links, a null component and ``kept`` true.  Rows that repeat an id are
    rows of their own.  Other columns are ignored; an empty table gives an
    empty result.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"), F.col("label").cast("int").alias("label"))
    good = usable(rows).where("label is not null").withColumnRenamed("embedding", "v")
    # -0.0 and 0.0 are one value
    good = good.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).withColumn("h", F.xxhash64("v"))
    classes = good.groupBy("label", "h", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m")) \
        .withColumn("d", F.size("v"))
    classes, _ = stored(classes, "vectors")
    spark = embeddings.sparkSession
    dim = classes.agg(F.max("d").alias("d")).first()["d"] or 0
    if dim == 0:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    axes = principal_axes(classes.select("v"), "v", dim)

    def lead(k):
        weights = F.array(*[F.lit(float(x)) for x in axes[:, k]])
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
        return F.aggregate(F.zip_with("v", F.slice(weights, 1, F.size("v")), lambda x, w: x * w), F.lit(0.0),
                           lambda s, x: s + x) / norm
    placed = classes.withColumn("cell", F.floor(lead(0) / CELL)).withColumn("p1", lead(min(1, dim - 1)))
    total = classes.count()
    parts = max(1, min(-(-total // (4 * tile_rows)), 4 * spark.sparkContext.defaultParallelism + total // 100_000))
    # equal sort keys never meet: p1 and rep spread a hot label over partitions
    sorted_rows = placed.repartitionByRange(parts, "label", "d", "cell", "p1", "rep").sortWithinPartitions(
        "label", "d", "cell", "p1", "rep").select("label", "d", "rep", "m", "v")
    ddl = "label int, d int, n int, lo array<double>, hi array<double>, ids binary, m binary, vecs binary"
    tiles, _ = stored(sorted_rows.mapInArrow(_tiles(axes, dim, tile_rows), ddl)
                      .withColumn("tile", F.monotonically_increasing_id()), "tiles")
    near = 2.0 - 2.0 * threshold + 1e-6
    meta = tiles.select("tile", "label", "d", "lo", "hi")
    other = meta.select(F.col("tile").alias("tile_b"), "label", "d", F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"))
    gaps = [F.greatest(F.col("lo")[k] - F.col("hi_b")[k], F.col("lo_b")[k] - F.col("hi")[k], F.lit(0.0))
            for k in range(min(BOX_DIMS, dim))]
    apart = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])
    # box against box, a few numbers per tile of 512 rows
    pairs = meta.join(other, ["label", "d"]).where((F.col("tile") <= F.col("tile_b")) & (apart <= near)).select("tile", "tile_b")
    body = tiles.select("tile", "ids", "m", "vecs")
    loaded = (pairs.join(body.select("tile", F.col("ids").alias("ids_a"), F.col("m").alias("m_a"), F.col("vecs").alias("vecs_a")), "tile")
              .join(body.select(F.col("tile").alias("tile_b"), F.col("ids").alias("ids_b"), F.col("m").alias("m_b"),
                                F.col("vecs").alias("vecs_b")), "tile_b")
              .select((F.col("tile") == F.col("tile_b")).alias("same"), "ids_a", "m_a", "vecs_a", "ids_b", "m_b", "vecs_b"))
    found, _ = stored(loaded.mapInArrow(_compare(axes, threshold, dim), "kind int, a long, b long"), "links")
    counts = found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("links"))
    comp = connected_components(found.where("kind = 1").select("a", "b"))
    per_class = (classes.select("label", "h", "v", "rep", "m").join(counts, "rep", "left")
                 .join(comp.select(F.col("id").alias("rep"), "component"), "rep", "left")
                 .select("label", "h", "v", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                         F.coalesce("component", "rep").alias("component_id")))
    linked = good.join(per_class, ["label", "h", "v"]).select(
        "vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    part = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & is_usable()
    return linked.unionByName(rows.where(~part).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")))
