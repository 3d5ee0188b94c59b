"""Near-duplicate documents by HyperMinHash.

Every text becomes the set of its five-word shingles.  One hash of a shingle
chooses one of 512 buckets; a bucket keeps, for its smallest hash, the number
of leading zeros (6 bits) and the first bits after the leading one (10 bits).
Empty buckets borrow the register of another one, in a fixed random order.
The first 128 registers are banded by fours.  Documents that share a band are
candidates, the collision-corrected Jaccard estimate over all registers drops
those that are far apart, and the rest is confirmed on the full shingle sets.

Documents with equal sets are one class and are represented by the smallest
id.  Inside a band bucket every class is compared to the bucket's smallest
member first: each class to one such leader in the first bands, then, where
leaders it meets in any band are in other components, to one of each.  A class
is joined with the bands as one row and with their buckets only where its
component is not the leader's, so a large group makes a few rows a document,
not one for every band.  Links between members are then implied unless two of
them are still in different components.  Buckets that still hold several components
are cut into tiles; pairs of tiles are compared by their registers inside a
task, which returns the members that may be alike to one of another component.
The full sets of those alone are dealt in tiles again, and every pair of
different components is decided on them inside a task, which returns a link
only where it joins two components of the bucket.  No link between components
is lost, and the pairs of a bucket are never emitted, those just below the
threshold included.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorcast.llm.common import drop_stored, stored, text_slices
from sensorcast.llm.components import connected_components
from sensorcast.llm.textvec import mix, shingle_sets

REGISTERS = 512
BUCKET_BITS = 9
MANTISSA_BITS = 10
BANDS = 32
BAND_ROWS = 4
# bands in which a class looks for its one leader
FIRST_BANDS = 8
# a bucket is cut into tiles of about this many members
TILE_ROWS = 256
# and of at most about this many shingles, where full sets are compared
TILE_SHINGLES = 1 << 17
SHINGLE_WORDS = 5
THRESHOLD_PCT = 75
# the estimate may drop a pair at the threshold with this chance
MISS = 1e-5
FLOOR_SIZES = 100

_SKETCH = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()),
                     ("set_b", pa.int64()), ("registers", pa.binary())])
_SKETCH_DDL = "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, registers binary"


def borrow_order(buckets: int = REGISTERS) -> np.ndarray:
    """For every bucket the order in which it asks the others for a register."""
    rng = np.random.default_rng(20240117)
    return np.stack([np.concatenate(([j], rng.permutation(np.delete(np.arange(buckets), j)))) for j in range(buckets)])


def encode_registers(rest: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of 55-bit minima, as 16-bit registers."""
    value = (rest >> np.uint64(2)).astype(np.float64)  # 53 bits: exact
    bits = value.view(np.uint64)
    length = np.where(value > 0, (bits >> np.uint64(52)).astype(np.int64) - 1022, 0)
    zeros = np.minimum(53 - length, 63)
    mantissa = np.where(value > 0, (bits >> np.uint64(52 - MANTISSA_BITS)) & np.uint64((1 << MANTISSA_BITS) - 1), 0)
    return ((zeros << MANTISSA_BITS) | mantissa.astype(np.int64)).astype(np.uint16)


def sketch(sets: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """The registers of every set, ``(len(sets), REGISTERS)``; an empty set gives zeros."""
    bits = np.uint64(64 - BUCKET_BITS)
    numbers = np.arange(REGISTERS, dtype=np.uint64)
    edges = numbers << bits
    rest = np.zeros((len(sets), REGISTERS), np.uint64)
    filled = np.zeros((len(sets), REGISTERS), bool)
    low = np.uint64((1 << (64 - BUCKET_BITS)) - 1)
    for i, s in enumerate(sets):
        if len(s):
            at = np.searchsorted(s, edges)
            first = s[np.minimum(at, len(s) - 1)]
            rest[i], filled[i] = first & low, (at < len(s)) & ((first >> bits) == numbers)
    regs = encode_registers(rest)
    regs[~filled] = 0
    doc, bucket = np.nonzero(~filled & filled.any(axis=1)[:, None])
    for turn in range(1, REGISTERS):
        if not len(doc):
            break
        lender = order[bucket, turn]
        found = filled[doc, lender]
        regs[doc[found], bucket[found]] = regs[doc[found], lender[found]]
        doc, bucket = doc[~found], bucket[~found]
    return regs


def _sketch_batches(batches):
    order = borrow_order()
    for batch in batches:
        for first, last, data, offsets in text_slices(batch):
            sets = shingle_sets(data, offsets, SHINGLE_WORDS)
            regs = sketch(sets, order)
            a = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            b = np.array([np.bitwise_xor.reduce(mix(s)) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(first, last - first), batch.column("text_hash").slice(first, last - first),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(a), pa.array(b), pa.array([r.tobytes() for r in regs], pa.binary())], schema=_SKETCH)


def collision_rate(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Chance that the registers of two different minima agree.

    With ``m`` shingles in a bucket the minimum has its leading one ``i``
    places down with a probability that the two sizes fix; given both do, the
    mantissas agree once in ``2**MANTISSA_BITS``.
    """
    m_a = np.maximum(n_a / REGISTERS, 1.0)[:, None]
    m_b = np.maximum(n_b / REGISTERS, 1.0)[:, None]
    i = np.arange(1, 54, dtype=np.float64)[None, :]

    def share(m):
        return (1 - 2.0 ** -i) ** m - (1 - 2.0 ** (1 - i)) ** m
    return (share(m_a) * share(m_b)).sum(axis=1) * 2.0 ** -MANTISSA_BITS


def estimate(regs_a: np.ndarray, regs_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimate of pairs of register rows."""
    same = (regs_a == regs_b).mean(axis=1)
    chance = collision_rate(n_a, n_b)
    return np.clip((same - chance) / (1 - chance), 0.0, 1.0)


def _estimate_batches(floors: np.ndarray):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("est", pa.float64())])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield passing(batch)

    def passing(batch):
        regs = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                for c in ("regs_a", "regs_b")]
        n = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("n_a", "n_b")]
        est = estimate(*regs, *n)
        good = np.flatnonzero(est >= floor_of(floors, *n))
        return pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(good)), batch.column("b").take(pa.array(good)),
                                           pa.array(est[good])], schema=schema)
    return run


def estimate_floors(threshold_pct: int = THRESHOLD_PCT) -> np.ndarray:
    """The estimate below which a pair at the threshold falls with a chance of
    ``MISS`` at most, by the size of the larger set.

    Of ``n`` shingles about ``n^2 / 1024`` pairs fall in one bucket, where one
    vanishes: a shared one (or one of a mixed pair) lowers the share of equal
    registers, another raises it.  The registers then sample what is left.
    From ``FLOOR_SIZES`` shingles on the allowance stays.
    """
    p = threshold_pct / 100.0
    out = np.zeros(FLOOR_SIZES + 1)
    for n in range(1, FLOOR_SIZES + 1):
        mean, cases = n * n / (2.0 * REGISTERS), []
        for lost in range(min(n, 60)):
            chance = math.exp(lost * math.log(mean) - mean - math.lgamma(lost + 1))
            for down in range(lost + 1):
                q = min(max((p * n - down) / (n - lost), 0.0), 1.0)
                sigma = max((q * (1 - q) / REGISTERS) ** 0.5, 1e-3)
                cases.append((chance * math.comb(lost, down) * p ** down * (1 - p) ** (lost - down), q, sigma))
        low, high = 0.0, p
        for _ in range(30):
            mid = (low + high) / 2
            miss = sum(w * 0.5 * math.erfc((q - mid) / (sigma * 2 ** 0.5)) for w, q, sigma in cases)
            low, high = (mid, high) if miss <= MISS else (low, mid)
        out[n] = low
    return out


def floor_of(floors: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    return floors[np.minimum(np.maximum(n_a, n_b), len(floors) - 1).astype(np.int64)]


def word_shingles(text: str, width: int = SHINGLE_WORDS) -> set:
    """The shingle set of one text, as tuples of words."""
    ws = text.encode().lower().split()
    if not ws:
        return set()
    if len(ws) < width:
        return {tuple(ws)}
    return set(zip(*(ws[i:] for i in range(width))))


def _confirm_batches(batches):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("inter", pa.int64()), ("total", pa.int64())])
    last_id, last_set = None, None
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
            inter, total = [], []
            for i in range(part.num_rows):
                if a[i] != last_id:
                    last_id, last_set = a[i], word_shingles(part.column("text_a")[i].as_py() or "")
                other = word_shingles(part.column("text_b")[i].as_py() or "")
                k = len(last_set & other)
                inter.append(k)
                total.append(len(last_set) + len(other) - k)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, inter, total)], schema=schema)


def sketches(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, set_a, set_b, registers)`` of every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text") \
        .mapInArrow(_sketch_batches, _SKETCH_DDL)


def band_keys(reps: DataFrame) -> DataFrame:
    """``(doc_id, keys)``: the hash of every band of compressed registers."""
    width = 2 * BAND_ROWS
    return reps.select("doc_id", F.array(*[F.xxhash64(F.lit(b), F.substring("registers", b * width + 1, width)) for b in range(BANDS)])
                       .alias("keys"))


def _band_members(keyed: DataFrame, heads: DataFrame) -> tuple[DataFrame, list[str]]:
    """``(member, leader)`` of every class that shares a bucket: its smallest
    leader in the first bands, null where only others are shared."""
    early = keyed.select("doc_id", F.explode(F.slice("keys", 1, FIRST_BANDS)).alias("key")).join(heads, "key")
    early, early_path = stored(early.groupBy(F.col("doc_id").alias("member")).agg(F.min("leader").alias("leader")), "early-members")
    rest = keyed.join(early.select(F.col("member").alias("doc_id")), "doc_id", "left_anti")
    late = rest.select("doc_id", F.explode(F.slice("keys", FIRST_BANDS + 1, BANDS)).alias("key")).join(heads, "key", "left_semi")
    late, late_path = stored(late.select(F.col("doc_id").alias("member"), F.lit(None).cast("long").alias("leader")).distinct(), "late-members")
    return early.unionByName(late), [early_path, late_path]


def _named(keyed: DataFrame, comp: DataFrame) -> DataFrame:
    """``(member, c, band, key)``: the component of every class, by bands."""
    named = (keyed.join(comp.select(F.col("id").alias("doc_id"), F.col("component").alias("c")), "doc_id", "left")
             .select(F.col("doc_id").alias("member"), F.coalesce("c", "doc_id").alias("c"), "keys"))
    return named.select("member", "c", F.posexplode("keys").alias("band", "key"))


def _mixed(named: DataFrame) -> DataFrame:
    """``(key, n, leader, cl)`` of the buckets with several components; the
    leader is the smallest member, ``cl`` its component."""
    return (named.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("member").alias("leader"),
                                     F.min_by("c", "member").alias("cl"), F.min("c").alias("c0"), F.max("c").alias("c1"))
            .where("c0 <> c1").select("key", "n", "leader", "cl"))


def _estimated(pairs: DataFrame, reps: DataFrame, floors: np.ndarray) -> DataFrame:
    """``(a, b, est)`` of the pairs that may reach the threshold."""
    side = reps.select("doc_id", "registers", "n_shingles")
    joined = (pairs
              .join(side.select(F.col("doc_id").alias("b"), F.col("registers").alias("regs_b"),
                                F.col("n_shingles").alias("n_b")), "b")
              .join(side.select(F.col("doc_id").alias("a"), F.col("registers").alias("regs_a"),
                                F.col("n_shingles").alias("n_a")), "a"))
    return joined.select("a", "b", "regs_a", "regs_b", "n_a", "n_b").mapInArrow(
        _estimate_batches(floors), "a long, b long, est double")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(a, b, inter, total)`` of every pair, from the whole texts."""
    joined = (pairs.select("a", "b")
              .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
              .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a"))
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(
        _confirm_batches, "a long, b long, inter long, total long")


def _keyed_rows(batches):
    """The rows of all batches as dicts of columns, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def _bands(regs: np.ndarray) -> np.ndarray:
    """The bands of register rows, one number each."""
    return np.ascontiguousarray(regs[:, :BANDS * BAND_ROWS]).view(np.uint64)


def _open_batches(floors: np.ndarray):
    schema = pa.schema([("key", pa.int64()), ("band", pa.int32()), ("member", pa.int64()), ("c", pa.int64()), ("n_shingles", pa.int64())])

    def run(batches):
        key, seen = None, set()
        for row in _keyed_rows(batches):
            if row["key"] != key:
                key, seen = row["key"], set()
            sides = []
            for rows in (row["docs_a"], row["docs_b"]):
                regs = np.frombuffer(b"".join(r["registers"] for r in rows), np.uint16).reshape(-1, REGISTERS)
                sides.append((np.array([r["member"] for r in rows]), np.array([r["c"] for r in rows]),
                              np.array([r["n_shingles"] for r in rows], float), regs))
            (ids_a, comp_a, n_a, regs_a), (ids_b, comp_b, n_b, regs_b) = sides
            bands_a, bands_b = _bands(regs_a), _bands(regs_b)
            old_a, old_b = (np.array([i in seen for i in ids.tolist()]) for ids in (ids_a, ids_b))
            in_a, in_b = old_a.copy(), old_b.copy()
            for i in range(len(ids_a)):
                # two members that are both known to be open need no further pair
                want = (comp_b != comp_a[i]) & ~(in_b & in_a[i])
                if row["same"]:
                    want[:i + 1] = False
                j = np.flatnonzero(want)
                # a pair that shares several bands is met in the first of them
                j = j[np.argmax(bands_b[j] == bands_a[i], axis=1) == row["band"]]
                if not len(j):
                    continue
                agree, floor = (regs_b[j] == regs_a[i]).mean(axis=1), floor_of(floors, n_a[i], n_b[j])
                j, agree, floor = (x[agree >= floor] for x in (j, agree, floor))
                if not len(j):
                    continue
                chance = collision_rate(np.full(len(j), n_a[i]), n_b[j])
                j = j[np.clip((agree - chance) / (1 - chance), 0.0, 1.0) >= floor]
                if len(j):
                    in_a[i] = in_b[j] = True
                    if row["same"]:
                        in_a |= in_b
                        in_b = in_a
            for ids, comps, n, now, old in ((ids_a, comp_a, n_a, in_a, old_a), (ids_b, comp_b, n_b, in_b, old_b)):
                new = [k for k in np.flatnonzero(now & ~old).tolist() if int(ids[k]) not in seen]
                seen.update(ids[new].tolist())
                if new:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([key] * len(new), pa.int64()), pa.array([row["band"]] * len(new), pa.int32()), pa.array(ids[new], pa.int64()),
                        pa.array(comps[new], pa.int64()), pa.array(n[new].astype(np.int64))], schema=schema)
    return run


def _tiles(rows: DataFrame, slots, *columns: str) -> DataFrame:
    """``(key, band, slot, docs)``: the members of a bucket in tiles."""
    slot = F.pmod(F.xxhash64("member", "band"), F.ceil(slots).cast("long"))
    return rows.withColumn("slot", slot).groupBy("key", "band", "slot").agg(
        F.sort_array(F.collect_list(F.struct("member", "c", *columns))).alias("docs"))


def _tile_pairs(tiles: DataFrame) -> DataFrame:
    """``(key, band, same, docs_a, docs_b)`` of the pairs of tiles of a bucket."""
    other = tiles.select("key", F.col("slot").alias("slot_b"), F.col("docs").alias("docs_b"))
    pairs = tiles.withColumnRenamed("docs", "docs_a").join(other, "key").where("slot <= slot_b")
    return pairs.select("key", "band", (F.col("slot") == F.col("slot_b")).alias("same"), "docs_a", "docs_b")


def _open_members(rows: DataFrame, reps: DataFrame, floors: np.ndarray) -> tuple[DataFrame, list[str]]:
    """``(key, band, member, c, n_shingles)`` of the members of a bucket that
    may be alike to one of another component, by registers, tile against tile."""
    side = reps.select(F.col("doc_id").alias("member"), "n_shingles", "registers")
    tiles, tiles_path = stored(_tiles(rows.join(side, "member"), F.col("n") / TILE_ROWS, "n_shingles", "registers"), "bucket-tiles")
    found, found_path = stored(_tile_pairs(tiles).mapInArrow(
        _open_batches(floors), "key long, band int, member long, c long, n_shingles long").distinct(), "open-members")
    return found, [tiles_path, found_path]


def _set_batches(batches):
    schema = pa.schema([("member", pa.int64()), ("shingles", pa.binary())])
    for batch in batches:
        for first, last, data, offsets in text_slices(batch):
            sets = shingle_sets(data, offsets, SHINGLE_WORDS)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)


def shared_counts(sets: list[np.ndarray], others: list[np.ndarray]):
    """A function of ``(i, j)``: how many shingles set ``i`` shares with each of
    the other sets ``j``, an array of numbers.  No set is empty."""
    ends = np.cumsum([0] + [len(s) for s in others])
    known, place = np.unique(np.concatenate(others), return_inverse=True)
    mark = np.zeros(len(known), np.uint8)

    def count(i: int, j: np.ndarray) -> np.ndarray:
        at = np.searchsorted(known, sets[i])
        at[at == len(known)] = 0
        at = at[known[at] == sets[i]]
        mark[at] = 1
        if len(j) * 8 < len(others):
            out = np.array([np.count_nonzero(mark[place[ends[k]:ends[k + 1]]]) for k in j.tolist()], np.int64)
        else:
            out = np.add.reduceat(mark[place], ends[:-1], dtype=np.int64)[j]
        mark[at] = 0
        return out
    return count


def _link_batches(threshold_pct: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        key, over = None, {}

        def root(c):
            while (up := over.get(c, c)) != c:
                over[c] = c = over.get(up, up)
            return c
        for row in _keyed_rows(batches):
            if row["key"] != key:
                key, over = row["key"], {}
            sides = []
            for rows in (row["docs_a"], row["docs_b"]):
                regs = np.frombuffer(b"".join(r["head"] for r in rows), np.uint16).reshape(len(rows), -1)
                sides.append((np.array([r["member"] for r in rows]), np.array([root(r["c"]) for r in rows]), _bands(regs),
                              [np.frombuffer(r["shingles"], np.uint64) for r in rows]))
            (ids_a, comp_a, bands_a, sets_a), (ids_b, comp_b, bands_b, sets_b) = sides
            n_a, n_b = (np.array([len(s) for s in sets], np.int64) for sets in (sets_a, sets_b))
            shared = shared_counts(sets_a, sets_b)
            a, b = [], []
            for i in range(len(ids_a)):
                # sizes alone tell some pairs apart
                want = (comp_b != comp_a[i]) & (100 * np.minimum(n_b, n_a[i]) >= threshold_pct * np.maximum(n_b, n_a[i]))
                if row["same"]:
                    want[:i + 1] = False
                j = np.flatnonzero(want)
                j = j[np.argmax(bands_b[j] == bands_a[i], axis=1) == row["band"]]
                if not len(j):
                    continue
                inter = shared(i, j)
                j = j[100 * inter >= threshold_pct * (n_a[i] + n_b[j] - inter)]
                # of the links to one component the first is enough
                for c, k in zip(*np.unique(comp_b[j], return_index=True)):
                    a.append(int(ids_a[i]))
                    b.append(int(ids_b[j[k]]))
                    left, right = sorted((root(int(comp_a[i])), root(int(c))))
                    over[right] = left
                if len(j):
                    comp_a, comp_b = (np.array([root(c) for c in x.tolist()]) for x in (comp_a, comp_b))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)
    return run


def _bucket_links(found: DataFrame, reps: DataFrame, texts: DataFrame, threshold_pct: int) -> tuple[DataFrame, list[str]]:
    """``(a, b)`` links between open members, enough to join the components of
    every bucket: each pair is decided on its full sets inside a task, and a
    task returns the links that join two components of a bucket."""
    sets, sets_path = stored(texts.join(found.select(F.col("member").alias("doc_id")).distinct(), "doc_id", "left_semi")
                             .select("doc_id", "text").mapInArrow(_set_batches, "member long, shingles binary"), "shingle-sets")
    heads = reps.select(F.col("doc_id").alias("member"), F.substring("registers", 1, 2 * BANDS * BAND_ROWS).alias("head"))
    sizes = found.groupBy("key").agg(F.greatest(F.count(F.lit(1)) / TILE_ROWS, F.sum("n_shingles") / TILE_SHINGLES).alias("slots"))
    rows = found.drop("n_shingles").join(sizes, "key").join(heads, "member").join(sets, "member")
    tiles, tiles_path = stored(_tiles(rows, F.col("slots"), "head", "shingles"), "set-tiles")
    links, links_path = stored(_tile_pairs(tiles).mapInArrow(_link_batches(threshold_pct), "a long, b long"), "bucket-links")
    return links, [sets_path, tiles_path, links_path]


def _joined_components(comp: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links."""
    return connected_components(comp.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(links))


def near_duplicates(docs: DataFrame, threshold_pct: int = THRESHOLD_PCT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every document.

    Documents are linked with ``100 * intersection >= threshold_pct * union``
    of their shingle sets.  ``component_id`` is the smallest id reachable,
    ``kept`` holds for one document of each component.

    Null or empty texts and texts without words have an empty set and are
    linked with nothing.  A repeated ``doc_id`` gives one output row per input
    row.  A row with a null ``doc_id`` takes no part: its component is null
    and it is kept.  Other columns are ignored; an empty table gives an empty
    result.
    """
    return classified(docs, threshold_pct).select("doc_id", "n_shingles", "component_id", "kept")


def classified(docs: DataFrame, threshold_pct: int = THRESHOLD_PCT) -> DataFrame:
    """:func:`near_duplicates` with two more columns: ``text_hash`` (xxhash64 of
    the text) and ``first``, true for the rows of one id and text of each
    component, the smallest, and for rows that are linked with nothing."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made, made_path = stored(sketches(docs), "sketches")
    floors = estimate_floors(threshold_pct)
    # a class is one shingle set; its number stands for it, as one id can come with several texts
    usable = made.where("n_shingles > 0 and doc_id is not null")
    classes, classes_path = stored(usable.groupBy("n_shingles", "set_a", "set_b").agg(
        F.min(F.struct("doc_id", "text_hash", "registers")).alias("r")).select(
        F.monotonically_increasing_id().alias("node"), "n_shingles", "set_a", "set_b", "r.doc_id", "r.text_hash", "r.registers"), "classes")
    rows_of, _ = stored(made.drop("registers"), "sketch-rows")
    drop_stored(spark, made_path)
    reps = classes.select(F.col("node").alias("doc_id"), "n_shingles", "registers")

    keyed, keyed_path = stored(band_keys(reps), "band-keys")
    heads, heads_path = stored(keyed.select("doc_id", F.explode("keys").alias("key")).groupBy("key").agg(
        F.min("doc_id").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "leader"), "band-heads")
    members, member_paths = _band_members(keyed, heads)
    # one leader of each member first: members of a large group share most of their buckets
    least = members.where("leader <> member").select(F.col("leader").alias("a"), F.col("member").alias("b"))
    wanted, wanted_path = stored(_estimated(least, reps, floors), "estimates")
    needed = classes.join(members.select(F.col("member").alias("node")), "node", "left_semi").select("node", "doc_id", "text_hash")
    # the one pass that moves texts: those of bucket members only
    texts, texts_path = stored(docs.where("doc_id is not null").withColumn("text_hash", F.xxhash64("text"))
                               .join(needed, ["doc_id", "text_hash"]).groupBy(F.col("node").alias("doc_id")).agg(F.min("text").alias("text")), "texts")

    def links_of(pairs):
        return _confirmed(pairs, texts).where(F.col("inter") * 100 >= F.col("total") * threshold_pct).select("a", "b")
    comp = connected_components(links_of(wanted))
    # then one leader in each component that a member meets and is not in; what
    # this leaves open is in buckets with several components
    shared, shared_path = stored(keyed.join(members.select(F.col("member").alias("doc_id")), "doc_id", "left_semi"), "member-keys")
    named = _named(shared, comp)
    met = named.join(_mixed(named), "key").where("c <> cl").groupBy(F.col("member").alias("b"), "cl").agg(F.min("leader").alias("a"))
    further, further_path = stored(_estimated(met.select("a", "b").join(least, ["a", "b"], "left_anti"), reps, floors), "estimates")
    comp = _joined_components(comp, links_of(further))

    # then the pairs of buckets with several components, decided inside tasks
    named = _named(shared, comp)
    mixed = _mixed(named).select("key", "n")
    found, found_paths = _open_members(named.join(mixed, "key"), reps, floors)
    bridges, bridge_paths = _bucket_links(found, reps, texts, threshold_pct)
    final = _joined_components(comp, links_of(bridges))

    of_class = (classes.drop("registers").join(final.select(F.col("id").alias("node"), "component"), "node", "left")
                .withColumn("component", F.coalesce("component", "node")))
    smallest = of_class.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("least"))
    known, _ = stored(of_class.join(smallest, "component").select("n_shingles", "set_a", "set_b", "least"), "class-components")
    for path in (classes_path, keyed_path, heads_path, *member_paths, shared_path, wanted_path, further_path, texts_path,
                 *found_paths, *bridge_paths):
        drop_stored(spark, path)
    linked = rows_of.join(known, ["n_shingles", "set_a", "set_b"], "left").withColumn(
        "least", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("least")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least.doc_id", "doc_id"))
    first = F.col("least").isNull() | ((F.col("least.doc_id") == F.col("doc_id")) & F.col("least.text_hash").eqNullSafe(F.col("text_hash")))
    return linked.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "text_hash", first.alias("first"))
