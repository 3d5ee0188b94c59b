"""Phrase collocations by mergeable Misra-Gries summaries and an exact second pass.

First pass: phrases of one to four words are dealt by hash into partitions.
Each task counts its phrases by fingerprint and writes one small sorted summary
a partition.  The summaries of a partition are merged with a capacity above
its mass (all its phrase occurrences) divided by the threshold: whenever more
counters are held, the next largest count is taken off all of them.  What is
taken off in all stays below the threshold, so the counter of every frequent
phrase survives.

The fingerprints of the survivors become a bit map of bounded size.  The second
pass counts, by their words, exactly the phrases that it lets through; a false
hit costs a count and changes nothing.  Scores, coverage by longer phrases and
the ranking are joins over the counted phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorcast.llm.common import drop_stored, stored, text_slices
from sensorcast.llm.textvec import mix

THRESHOLD = 30
LONGEST = 4
COVERED = 80  # percent of a phrase's occurrences inside one longer phrase
TOP = 2000
# a task's words are counted in portions of about this many
UNIT_WORDS = 1 << 20
# the bit map that goes to all tasks has 32 bits for a survivor, but never more than this
MAP_BITS = 28
# of a fingerprint inside its partition; phrases that share them are counted as one in the first pass
KEY_BITS = 26
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BREAK = b"."
_TO_BREAK = bytes.maketrans(b",;:!?\n\x0b\x0c\r", _BREAK * 9)


class Numbers(dict):
    """Word to number, in the order of first use; the break is number 0."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def word_numbers(texts: list[bytes], numbers: Numbers) -> np.ndarray:
    """The words of texts as numbers, with a break after each piece (0)."""
    joined = _BREAK.join(texts) + _BREAK
    tokens = joined.lower().translate(_TO_BREAK).replace(_BREAK, b" . ").split()
    return np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens))


class Unit:
    """The words of a portion of a task, by language."""

    def __init__(self):
        self.numbers, self.parts, self.size = Numbers({_BREAK: 0}), {}, 0

    def add(self, lang: str, texts: list[bytes]) -> None:
        ids = word_numbers(texts, self.numbers)
        self.parts.setdefault(lang, []).append(ids)
        self.size += len(ids)

    def languages(self) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
        """Per language the word numbers, how many words follow up to the next
        break, and the fingerprints of the words."""
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.numbers), np.uint64, len(self.numbers))
        for lang, parts in self.parts.items():
            ids = np.concatenate(parts)
            stops = np.flatnonzero(ids == 0)
            left = np.repeat(stops, np.diff(stops, prepend=-1)) - np.arange(len(ids))
            yield lang, ids, left, mix(hashes ^ np.uint64(xxhash.xxh3_64_intdigest(lang)))[ids]


def units(batches) -> Iterator[Unit]:
    unit = Unit()
    for batch in batches:
        for first, last, data, offsets in text_slices(batch):
            raw, by = data.tobytes(), {}
            langs = batch.column("lang").slice(first, last - first).to_pylist()
            for lang, a, b in zip(langs, offsets[:-1].tolist(), offsets[1:].tolist()):
                by.setdefault(lang, []).append(raw[a:b])
            for lang, texts in by.items():
                unit.add(lang, texts)
            if unit.size >= UNIT_WORDS:
                yield unit
                unit = Unit()
    if unit.size:
        yield unit


def longer(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Fingerprints of phrases one word longer."""
    return mix(before * _FACTOR + words)


def packed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, byte by place, compressed."""
    return pa.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def unpacked(blob: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(blob, 4 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, n).T).view("<u4").reshape(n)


# --- first pass
SUMMARY = pa.schema([("part", pa.int32()), ("mass", pa.int64()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
SUMMARY_DDL = "part int, mass long, n int, keys binary, counts binary"


def _summaries(part_bits: int):
    """One summary a portion and partition: sorted keys (as steps) and counts."""
    def counted(unit: Unit) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Keys and their counts, for one language and length after the other."""
        for _, _, left, words in unit.languages():
            grams = words
            for k in range(1, LONGEST + 1):
                if k > 1:
                    grams = longer(grams[:-1], words[k - 1:])
                keys = grams[left[:len(grams)] >= k]
                keys >>= np.uint64(64 - KEY_BITS - part_bits)
                keys.sort()
                at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
                yield keys[at].astype(np.int64), np.diff(at, append=len(keys)).astype(np.int32)

    def run(batches):
        for unit in units(batches):
            tables = list(counted(unit))
            edges = [np.searchsorted(keys, np.arange((1 << part_bits) + 1) << KEY_BITS) for keys, _ in tables]
            rows = []
            for part in range(1 << part_bits):
                low = np.concatenate([keys[e[part]:e[part + 1]] for (keys, _), e in zip(tables, edges)]) & ((1 << KEY_BITS) - 1)
                if len(low):
                    counts = np.concatenate([n[e[part]:e[part + 1]] for (_, n), e in zip(tables, edges)])
                    order = np.argsort(low, kind="stable")  # a key may come once for each length
                    rows.append((part, int(counts.sum()), len(low), packed(np.diff(low[order], prepend=0)), packed(counts[order])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SUMMARY)], schema=SUMMARY)
    return run


class Summary:
    """A Misra-Gries summary over integer keys; summaries merge."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._new: list[tuple[np.ndarray, np.ndarray]] = []
        self._waiting = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._new.append((keys, counts))
        self._waiting += len(keys)
        if self._waiting > max(self.capacity, 1 << 16):
            self.settle()

    def settle(self) -> None:
        """Add up what waits; above capacity the largest count that does not fit is taken off all."""
        keys = np.concatenate([self.keys, *(k for k, _ in self._new)])
        counts = np.concatenate([self.counts, *(c for _, c in self._new)])
        self._new, self._waiting = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.counts = keys[at], np.add.reduceat(counts, at) if len(at) else counts
        if len(self.keys) > self.capacity:
            cut = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            stay = self.counts > cut
            self.keys, self.counts, self.taken = self.keys[stay], self.counts[stay] - cut, self.taken + cut

    def survivors(self, threshold: int) -> np.ndarray:
        """Keys that may have come ``threshold`` times; all that did are among them."""
        self.settle()
        return self.keys[self.counts + self.taken >= threshold]


SURVIVORS = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("taken", pa.int64()), ("keys", pa.binary())])
SURVIVORS_DDL = "part int, n long, taken long, keys binary"


def _merge_summaries(threshold: int):
    """Merge the summaries of each partition; rows of a partition follow each other."""
    def run(batches):
        part, summary = None, None

        def done():
            keys = summary.survivors(threshold)
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(
                (part, len(keys), summary.taken, packed(np.diff(keys, prepend=0))), SURVIVORS)], schema=SURVIVORS)
        for batch in batches:
            for p, all_mass, n, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "all_mass", "n", "keys", "counts"))):
                if p != part:
                    if summary is not None:
                        yield done()
                    part, summary = p, Summary(all_mass // threshold)
                summary.merge(np.cumsum(unpacked(keys, n).astype(np.int64)), unpacked(counts, n).astype(np.int64))
        if summary is not None:
            yield done()
    return run


def _map_slices(part_bits: int, bits: int):
    """Each partition's own stretch of the bit map."""
    def run(batches):
        schema = pa.schema([("part", pa.int32()), ("bits", pa.binary())])
        for batch in batches:
            for p, n, keys in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "keys"))):
                found = np.zeros(1 << (bits - part_bits), np.uint8)
                found[np.cumsum(unpacked(keys, n).astype(np.int64)) >> (KEY_BITS - bits + part_bits)] = 1
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([np.packbits(found, bitorder="little").tobytes()], pa.binary())],
                                                 schema=schema)
    return run


def frequent_map(docs: DataFrame, threshold: int, part_bits: int) -> tuple[np.ndarray, int]:
    """The bit map of phrases that may be frequent, and its size in bits (as a power of two)."""
    spark = docs.sparkSession
    summaries, path = stored(docs.mapInArrow(_summaries(part_bits), SUMMARY_DDL), "phrase-summaries")
    masses = summaries.groupBy("part").agg(F.sum("mass").alias("all_mass"))  # one row a partition
    merged, merged_path = stored(
        summaries.join(F.broadcast(masses), "part").repartition(1 << part_bits, "part").sortWithinPartitions("part")
        .select("part", "all_mass", "n", "keys", "counts").mapInArrow(_merge_summaries(threshold), SURVIVORS_DDL), "phrase-survivors")
    drop_stored(spark, path)
    n = merged.agg(F.sum("n").alias("n")).first()["n"] or 0
    bits = min(max((32 * n).bit_length(), part_bits + 3), MAP_BITS, part_bits + KEY_BITS)
    out = np.zeros(1 << (bits - 3), np.uint8)
    width = 1 << (bits - 3 - part_bits)
    for row in merged.mapInArrow(_map_slices(part_bits, bits), "part int, bits binary").toLocalIterator():
        out[row["part"] * width:(row["part"] + 1) * width] = np.frombuffer(row["bits"], np.uint8)
    drop_stored(spark, merged_path)
    return out, bits


# --- second pass
COUNTS = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


def _exact_counts(shared, bits: int):
    """Counts of the phrases that the bit map lets through, by their words; and per language all words (k = 0)."""
    def passes(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
        index = keys >> np.uint64(64 - bits)
        return (table[(index >> np.uint64(3)).astype(np.int64)] >> (index & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def run(batches):
        table = shared.value
        for unit in units(batches):
            names = [w.decode() for w in unit.numbers]
            for lang, ids, left, words in unit.languages():
                rows: list[tuple[list, list]] = [([None], [int((ids != 0).sum())])]
                ks, grams, number = [0], words, ids.astype(np.int64)
                hit = np.zeros(len(ids), bool)
                hit[left >= 1] = passes(words[left >= 1], table)
                for k in range(1, LONGEST + 1):
                    if k > 1:
                        # both parts that lack an end word are frequent if the phrase is
                        may = np.flatnonzero(hit[:-1] & hit[1:] & (left[:-1] >= k))
                        may = may[may + k <= len(ids)]
                        made = longer(grams[may], words[may + k - 1])
                        good = passes(made, table)
                        may, made = may[good], made[good]
                        hit = np.zeros(len(ids), bool)
                        hit[may] = True
                        grams = np.zeros(len(ids), np.uint64)
                        grams[may] = made
                        keys = (number[may] << 32) | ids[may + k - 1]
                    else:
                        may = np.flatnonzero(hit)
                        keys = number[may]
                    found, at, which, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
                    if not len(found):
                        break
                    number = np.zeros(len(ids), np.int64)
                    number[may] = which
                    place = may[at]
                    parts = [ids[place + j].tolist() for j in range(k)]
                    rows.append(([" ".join([names[i] for i in p]) for p in zip(*parts)], counts.tolist()))
                    ks.append(k)
                for k, (phrases, counts) in zip(ks, rows):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), pa.array([k] * len(phrases), pa.int32()),
                                                      pa.array(phrases, pa.string()), pa.array(counts, pa.int64())], schema=COUNTS)
    return run


def phrase_counts(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``(lang, k, phrase, f)``: every phrase of one to four words that comes at
    least ``threshold`` times in its language; ``k`` = 0 with a null phrase has
    the number of all words of the language.

    Texts are lower-cased in A-Z and cut at ``.,;:!?`` and line ends into
    pieces; words are runs of characters other than blank and tab.  Null texts
    are empty and a null language is ``und``.  Repeated rows count as often as
    they come; no other columns are read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    part_bits = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    table, bits = frequent_map(docs, threshold, part_bits)
    shared = spark.sparkContext.broadcast(table)
    counted = (docs.mapInArrow(_exact_counts(shared, bits), "lang string, k int, phrase string, f long")
               .groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= threshold) | (F.col("k") == 0)))
    return stored(counted, "phrase-counts")[0]


def _exact(x: Column) -> Column:
    return x.cast("decimal(20,0)")


def scored(counts: DataFrame) -> DataFrame:
    """``(lang, k, phrase, a, l, r, score)`` of phrases of two words and more:
    the cut into two parts with the lowest ``floor(2000000 a / (l + r))``, ties to the shortest first part."""
    f = counts.where("k > 0")
    cut = F.explode(F.array(*[F.lit(j) for j in range(1, LONGEST)])).alias("cut")
    cuts = (f.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"), cut).where("cut < k")
            .withColumn("first", F.expr("substring_index(phrase, ' ', cut)"))
            .withColumn("rest", F.expr("substring_index(phrase, ' ', cut - k)")))
    both = (cuts.join(f.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
            .join(f.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]))
    score = F.expr("cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    return (both.groupBy("lang", "k", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("s"))
            .select("lang", "k", "phrase", "a", "s.l", "s.r", "s.score"))


def coverage(counts: DataFrame) -> DataFrame:
    """``(lang, phrase, longer)``: the count of the most frequent longer phrase that contains the words in a row."""
    words = F.split("phrase", " ")
    subs = [F.when((F.col("k") > size) & (F.col("k") >= i + size), F.concat_ws(" ", F.slice(words, i + 1, size)))
            for size in range(2, LONGEST) for i in range(LONGEST - size + 1)]
    return (counts.where("k > 2").select("lang", F.explode(F.array(*subs)).alias("phrase"), "f").where("phrase is not null")
            .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))


def collocations(docs: DataFrame, threshold: int = THRESHOLD, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of two to
    four words of every language by score, count and phrase.

    A phrase that has at least ``covered`` percent of its occurrences inside
    one longer frequent phrase is left out.  The ranking keeps ``top`` phrases
    of every bucket of phrases first, so no task sorts a whole language.  An
    empty table gives an empty result.
    """
    counts = phrase_counts(docs, threshold)
    found = (scored(counts).join(coverage(counts), ["lang", "phrase"], "left")
             .where(F.col("longer").isNull() | (_exact(F.col("longer")) * 100 < _exact(F.col("a")) * covered)))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    buckets = found.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(32)))
    best = (buckets.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))).where(F.col("rank") <= top)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top))
    totals = counts.where("k = 0").select("lang", F.col("f").alias("n"))  # one row a language
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
