"""Best-fit packing of token pieces into sequences of a fixed length.

Only the histogram of piece lengths decides the packing.  Its configuration
linear program (choose how often to use each multiset of lengths that fits)
is solved approximately by multiplicative weights: every length has a weight,
a knapsack dynamic program prices the best configurations under the current
weights, and lengths that they cover lose weight.  The fractional solution is
rounded down to whole configurations and what is left over is best-fitted.
The result is a table of configurations with multiplicities whose size depends
on the sequence length only; pieces find their place in it by their rank among
the pieces of the same length.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorcast.llm.common import stored, text_slices

CAPACITY = 2048
END_ID = 0
MW_ROUNDS = 60
MW_RATE = 0.5
# the oracle's mixture takes configurations within this share of the best price
MW_NEAR = 0.08
# words kept by a worker, and as many of those kept before
CACHE_WORDS = 500_000
# plain words that are encoded in one call
JOINED_WORDS = 512
# pieces of one length are ranked in slots of about this many rows
SLOT_ROWS = 50_000

_PIECES = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
           ("ids_crc32", pa.int64())]
_PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


# marks of which a run at the end of a word is a pre-token of its own; an apostrophe can begin a contraction, and
# angle brackets and bars can belong to a special token
_MARKS = ".,;:!?*#$&%)]}\"~+=-"
_beyond_latin = re.compile("[^\x00-\xff]").search


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder:
    """Ids of whole texts, word by word.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its words between blanks and line ends, one after another.
    Ids of words are kept as little-endian unsigned 32-bit bytes.  When
    ``limit`` words are kept they become the older ones and those before them
    go, so that frequent words stay.  Words of Latin-1 letters are one
    pre-token, whose last token the vocabulary marks as an end: many of them
    are encoded in one call and told apart by the ends.
    """

    def __init__(self, definition: str, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        self.encode_batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.limit = limit
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _core(self, word: str) -> tuple[str, str]:
        """A word without the marks at its end, where those are a pre-token of
        their own; words of Latin-1 letters in lower case, as the tokenizer has them."""
        core = word.rstrip(_MARKS)
        if core == word or not core[-1:].lower()[-1:].isalpha():
            core = word
        plain = "|" not in core and (core.isascii() or not _beyond_latin(core))
        return (core.lower() if plain else core), word[len(core):]

    def _encode_plain(self, cores: list[str]) -> list[bytes] | None:
        """The ids of each of some words of letters; None if their ends do not show."""
        ids = np.array(self.encode_batch([" ".join(cores)], add_special_tokens=False)[0].ids, dtype="<u4")
        cuts = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        if len(cuts) != len(cores):
            return None
        data = ids.tobytes()
        return [data[i:j] for i, j in zip([0] + cuts, cuts)]

    def _add_cores(self, cores: list[str]) -> None:
        plain = [c for c in cores if c.isalpha() and (c.isascii() or not _beyond_latin(c))]
        for i in range(0, len(plain), JOINED_WORDS):
            part = plain[i:i + JOINED_WORDS]
            got = self._encode_plain(part)
            if got is not None:
                self.cores.update(zip(part, got))
        others = [c for c in cores if c not in self.cores]
        for i in range(0, len(others), JOINED_WORDS):
            part = others[i:i + JOINED_WORDS]
            encodings = self.encode_batch(part, add_special_tokens=False)
            self.cores.update((c, pack_ids(e.ids)) for c, e in zip(part, encodings))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        words = set().union(*split) if split else set()
        if len(self.known) > self.limit:
            self.known, self.older = {"": b""}, self.known
        if len(self.cores) > self.limit:
            self.cores = {}
        known, older, cores = self.known, self.older, self.cores
        whole, marked, missing = {}, {}, set()
        for word in words.difference(known):
            ids = older.get(word)
            if ids is not None:
                known[word] = ids
            elif word.isascii() and word.isalpha():  # most words: nothing to take off
                core = word.lower()
                whole[word] = core
                if core not in cores:
                    missing.add(core)
            else:
                core, mark = self._core(word)
                if mark:
                    marked[word] = core, mark
                    if mark not in cores:
                        missing.add(mark)
                else:
                    whole[word] = core
                if core not in cores:
                    missing.add(core)
        self._add_cores(list(missing))
        for word, core in whole.items():
            known[word] = cores[core]
        for word, (core, mark) in marked.items():
            known[word] = cores[core] + cores[mark]
        get = known.__getitem__
        return [b"".join(map(get, s)) for s in split]


_ENCODERS: dict[str, WordEncoder] = {}


def worker_encoder(definition: str) -> WordEncoder:
    """The encoder of this Python worker: later tasks find the words of earlier ones."""
    if definition not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[definition] = WordEncoder(definition)
    return _ENCODERS[definition]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])`` of every document.

    A document is the ids of its text followed by one end id; documents longer
    than ``capacity`` are cut into pieces of that length.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # a few MB, the vocabulary
    schema = pa.schema(_PIECES + ([("ids", pa.binary())] if with_ids else []))
    end = pack_ids([END_ID])

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = worker_encoder(shared.value)
        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            for first, last, *_ in text_slices(batch):
                texts = [t or "" for t in batch.column("text").slice(first, last - first).to_pylist()]
                out = [[] for _ in schema.names]
                for doc_id, ids in zip(ids_of[first:last], encoder.encode(texts)):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        row = (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part)
                        for col, value in zip(out, row):
                            col.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
    ddl = _PIECES_DDL + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ddl)


def _knapsack(prices: np.ndarray, room: np.ndarray, capacity: int):
    """Bounded knapsack over lengths ``1..capacity``.

    ``prices[l]`` is the value of a piece of length ``l`` (at most ``room[l]``
    of them).  Returns the best value for every capacity and the pieces taken,
    as (length, copies, taken per capacity) layers.
    """
    best = np.zeros(capacity + 1)
    layers = []
    for length in np.flatnonzero((prices > 0) & (room > 0)).tolist():
        left = int(min(room[length], capacity // length))
        copies = 1
        while left > 0:
            copies = min(copies, left)
            size = copies * length
            other = np.full(capacity + 1, -1.0)
            other[size:] = best[:capacity + 1 - size] + copies * prices[length]
            taken = other > best
            best = np.where(taken, other, best)
            layers.append((length, copies, taken))
            left -= copies
            copies *= 2
    return best, layers


def _configuration(layers, capacity: int) -> dict[int, int]:
    config: dict[int, int] = {}
    at = capacity
    for length, copies, taken in reversed(layers):
        if taken[at]:
            config[length] = config.get(length, 0) + copies
            at -= copies * length
    return config


def fractional_solution(counts: np.ndarray, capacity: int, rounds: int = MW_ROUNDS) -> list[tuple[dict, float]]:
    """Configurations and how often to use each, covering about every count.

    One round prices all lengths by weight / count.  The knapsack gives the
    best configuration for every capacity; completing each length with the
    best of the rest gives one configuration per length, and those near the
    best price answer together, which keeps a round from overfilling a few
    lengths.  Weights then fall exponentially with the coverage received.
    """
    lengths = np.flatnonzero(counts)
    weight = np.zeros(capacity + 1)
    weight[lengths] = counts[lengths] * lengths / float((counts * np.arange(capacity + 1)).sum())
    covered = np.zeros(capacity + 1)
    used: dict[tuple, float] = {}
    for _ in range(rounds):
        prices = np.zeros(capacity + 1)
        prices[lengths] = weight[lengths] / counts[lengths]
        best, layers = _knapsack(prices, counts, capacity)
        value = prices[lengths] + best[capacity - lengths]
        near = lengths[value >= (1 - MW_NEAR) * value.max()]
        if len(near) > 48:  # an even spread of the near-best ones
            near = near[np.linspace(0, len(near) - 1, 48).astype(int)]
        gain = np.zeros(capacity + 1)
        for length in near.tolist():
            config = _configuration(layers, capacity - length)
            config[length] = config.get(length, 0) + 1
            if config[length] > counts[length]:
                continue
            share = min(counts[k] / c for k, c in config.items())
            key = tuple(sorted(config.items()))
            used[key] = used.get(key, 0.0) + share
            for k, c in config.items():
                gain[k] += share * c / counts[k]
        if gain.max() <= 0:
            break
        covered += gain
        weight[lengths] *= np.exp(-MW_RATE * gain[lengths] / gain.max())
        weight /= weight.sum()
    top = max(covered.max(), 1e-9)
    return [(dict(k), v / top) for k, v in used.items()]


def configurations(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Whole configurations with multiplicities that place every piece once.

    Two rounds of solving and rounding down, then best fit for the remainder;
    each best-fit step uses up a length, so their number is bounded by the
    sequence length and not by the number of pieces.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"length {length} outside 1..{capacity}")
        counts[length] += n
    out: list[tuple[dict[int, int], int]] = []
    if counts[capacity]:
        out.append(({capacity: 1}, int(counts[capacity])))
        counts[capacity] = 0
    for _ in range(2):
        if counts.sum() == 0:
            break
        for config, times in sorted(fractional_solution(counts, capacity), key=lambda x: (-x[1], sorted(x[0].items()))):
            # a configuration that leaves room is left to the best fit
            if sum(k * c for k, c in config.items()) < capacity:
                continue
            m = min(int(times), min(int(counts[k]) // c for k, c in config.items()))
            if m > 0:
                for k, c in config.items():
                    counts[k] -= m * c
                out.append((config, m))
    while counts.any():
        config, left, top = {}, capacity, np.flatnonzero(counts)[-1]
        room = counts.copy()
        fill = int(top)
        while fill:
            config[fill] = config.get(fill, 0) + 1
            room[fill] -= 1
            left -= fill
            fill = _best_fill(room, left)
        m = min(int(counts[k]) // c for k, c in config.items())
        for k, c in config.items():
            counts[k] -= m * c
        out.append((config, m))
    return out


def _best_fill(room: np.ndarray, left: int) -> int:
    """The next piece for a gap: one that closes it, else the larger of two
    that close it together, else the largest that fits; 0 if none fits."""
    if left <= 0:
        return 0
    if room[left]:
        return left
    have = room[:left + 1] > 0
    both = have[1:left] & have[1:left][::-1]
    if left % 2 == 0 and room[left // 2] == 1:
        both[left // 2 - 1] = False
    pair = np.flatnonzero(both)
    if len(pair):
        return int(pair[-1]) + 1
    some = np.flatnonzero(have)
    return int(some[-1]) if len(some) else 0


def place_table(configs: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, rank after the last, first sequence, offset)``:
    the pieces of a length with those ranks go to consecutive sequences."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for config, m in configs:
        offset = 0
        for length in sorted(config, reverse=True):
            for _ in range(config[length]):
                first = ranks.get(length, 0)
                rows.append((length, first, first + m, sequence, offset))
                ranks[length] = first + m
                offset += length
        sequence += m
    return rows


def pack(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces.

    Equal lengths are interchangeable, so a hot length costs nothing: ranks
    are counted inside hash slots of a length and shifted by the sizes of the
    slots before.  The table must be cheap to read again (written).
    """
    spark = made.sparkSession
    hist = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(hist.values())
    slots = max(1, -(-total // SLOT_ROWS))
    rows = place_table(configurations(hist, capacity))
    columns = list(zip(*rows)) or [[]] * 5
    names = ["length", "lo", "hi", "first_sequence", "offset"]
    # bounded by the capacity and the number of rounds, not by the pieces
    places = spark.createDataFrame(pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)}))
    slotted = made.withColumn("slot", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slots)))
    before = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = (slotted.groupBy("length", "slot").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    inside = Window.partitionBy("length", "slot").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (slotted.withColumn("r", F.row_number().over(inside) - 1).join(bases, ["length", "slot"])
              .withColumn("rank", F.col("r") + F.col("base")).drop("r", "base", "slot"))
    ranges = F.broadcast(places.withColumnRenamed("length", "place_length"))
    return (ranked.join(ranges, (F.col("length") == F.col("place_length")) & (F.col("rank") >= F.col("lo"))
                        & (F.col("rank") < F.col("hi")))
            .withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("lo"))
            .drop("rank", "place_length", "lo", "hi", "first_sequence"))


def best_fit_pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Tokenize and pack every document.

    Returns ``(doc_id, piece, start, length, ids_crc32[, ids], sequence_id,
    offset)``.  Null and empty texts are one end id.  Every input row is packed,
    also repeated ones and rows with a null ``doc_id``.  Other columns are
    ignored; an empty table gives an empty result.
    """
    made, _ = stored(pieces(docs, tokenizer_path, capacity, with_ids), "pieces")
    first = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    return pack(made, capacity).select(*first, "sequence_id", "offset")
