"""Periodic runs of words, by a sparse dynamic programme over diagonals.

A diagonal of lag d counts how many words in a row equal the word d places
before.  When m words matched and m + d is long enough, the diagonal is a run
of period d.  Each word may have many earlier occurrences, and most lags die at
once, so a word extends a diagonal only through the nearest earlier occurrence
of the gram that begins with it:

* For a period in (g/2, g] the gram has g words.  Inside a run that holds its
  period four times, the nearest earlier occurrence of such a gram is exactly
  one period away (a shorter lag would give the run a shorter period).  So one
  active lag a word and gram length is enough, and a diagonal of that lag
  begins and ends exactly where the run does.
* Gram numbers double: a gram of 2g words is the pair of the numbers of two
  grams of g words, as in a dictionary of basic factors.  Only grams that come
  again within their document go on, so the work is n log n at worst and a few
  passes for ordinary text.

A whole slice of documents is scanned in numpy at once; a separator that
equals nothing stands between documents.
"""

from __future__ import annotations

import hashlib
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorcast.llm.common import text_slices

MIN_LENGTH = 6
MIN_REPEATS = 4
# lags up to this are compared directly, place by place
DIRECT = 8


def _stretches(lag: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, last place and lag of the stretches of equal lag in [low, high]."""
    fits = (lag >= low) & (lag <= high)
    begin = fits & np.concatenate(([True], (lag[1:] != lag[:-1])))
    end = fits & np.concatenate(((lag[1:] != lag[:-1]), [True]))
    first, last = np.flatnonzero(begin), np.flatnonzero(end)
    return first, last, lag[first]


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted order of ``keys``, where a new key begins in it, and the number of each key."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.empty(len(keys), bool)
    new[:1] = True
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order, new, number


def find_runs(ids: np.ndarray, longest: int, min_length: int = MIN_LENGTH,
              min_repeats: int = MIN_REPEATS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, period)`` of all runs in ``ids``, by start, then period.

    ``ids`` are word numbers; separators between documents are numbers that
    occur once.  ``longest`` bounds the number of words of a document.
    """
    n, found = len(ids), []
    most = longest // min_repeats  # no run has a longer period

    def take(first, last, lag, gram):
        matched = last - first + gram
        good = (matched >= (min_repeats - 1) * lag) & (matched + lag >= min_length)
        found.append((first[good] - lag[good], matched[good] + lag[good], lag[good]))

    seen: set[tuple[int, int]] = set()  # a multiple of a period has the same stretch of words
    for d in range(1, min(DIRECT, most) + 1):
        same = np.zeros(n + 1, bool)
        np.equal(ids[d:], ids[:-d], out=same[d:n])
        edge = np.flatnonzero(same[1:] != same[:-1]) + 1
        first, last = edge[::2], edge[1::2] - 1
        matched = last - first + 1
        good = (matched >= (min_repeats - 1) * d) & (matched + d >= min_length)
        runs = [r for r in zip((first[good] - d).tolist(), (matched[good] + d).tolist()) if r not in seen]
        if runs:
            seen.update(runs)
            at = np.array(runs, np.int64)
            found.append((at[:, 0], at[:, 1], np.full(len(runs), d, np.int64)))
    if most > DIRECT:
        place, gram, number = np.arange(n), 1, ids
        while gram < most:
            # grams of twice the length: pairs of neighbours that both go on
            slot = np.full(n + gram, -1, np.int64)
            slot[place] = number
            after = slot[place + gram]
            both = after >= 0
            place, key = place[both], (number[both] << 32) | after[both]
            gram *= 2
            if not len(place):
                break
            order, new, number = _numbered(key)
            ranked = place[order]
            step = np.zeros(len(place), np.int64)
            step[1:] = ranked[1:] - ranked[:-1]
            step[new] = 0
            if gram > DIRECT:
                lag = np.zeros(n, np.int64)
                lag[ranked] = step
                take(*_stretches(lag, max(DIRECT, gram // 2) + 1, gram), gram)
            # go on with grams that come again within reach of a period
            near = (step > 0) & (step <= most)
            keep = near.copy()
            keep[:-1] |= near[1:]
            chosen = np.sort(order[keep])
            place, number = place[chosen], number[chosen]
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    start, length, period = (np.concatenate(x) for x in zip(*found))
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def _slice_runs(texts: list[bytes], min_length: int, min_repeats: int):
    """Words of every text, and its runs as lists of ``(start, length, period)``."""
    words = [t.split() for t in texts]  # ASCII white space only
    number: dict[bytes, int] = {}
    ids = np.empty(sum(map(len, words)) + len(words), np.int64)
    at, begins = 0, []
    flat = chain.from_iterable(words)
    known = np.fromiter((number.setdefault(w, len(number)) for w in flat), np.int64, len(ids) - len(words))
    for k, w in enumerate(words):
        begins.append(at)
        ids[at:at + len(w)] = known[at - k:at - k + len(w)]
        at += len(w)
        ids[at] = len(number) + k  # the separator
        at += 1
    start, length, period = find_runs(ids, max(map(len, words), default=0), min_length, min_repeats)
    doc = np.searchsorted(np.array(begins), start, side="right") - 1
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for d, s, n, p in zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist()):
        runs[d].append((s - begins[d], n, p))
    return words, runs


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats: of each run its first period stays."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return list(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, exactly; ties to the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _mapped(fn, schema: pa.Schema, keep: list[str], min_length: int, min_repeats: int):
    def run(batches):
        for batch in batches:
            for first, last, data, offsets in text_slices(batch):
                part = batch.slice(first, last - first)
                raw = data.tobytes()
                texts = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                rows = [fn(w, r) for w, r in zip(*_slice_runs(texts, min_length, min_repeats))]
                made = dict(zip([n for n in schema.names if n not in keep], zip(*rows)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) if c in keep else pa.array(made[c], schema.field(c).type) for c in schema.names], schema=schema)
    return run


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUN_SPARK = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def collapse_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """``(doc_id, n_words, runs, text)``, one row per input row.

    ``runs`` lists every maximal stretch of words with smallest period
    ``period`` that holds it ``min_repeats`` times and has ``min_length``
    words, by start, then period.  ``text`` has the words that are kept, joined
    by one space: a word goes if any run contains it after that run's first
    period.  Words are runs of characters other than ASCII white space; null
    and empty texts have none.  Rows with a null id and repeated rows stay;
    other columns are not read.  ``min_repeats`` is at least 4, as the nearest occurrence need
    not tell the period of shorter runs.
    """
    if min_repeats < 4:
        raise ValueError("min_repeats is at least 4")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("text", pa.string())])
    out = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                        T.StructField("runs", T.ArrayType(_RUN_SPARK)), T.StructField("text", T.StringType())])

    def fn(words, runs):
        return (len(words), [dict(zip(("start", "length", "period"), r)) for r in runs],
                b" ".join(collapsed(words, runs)).decode())
    return _texts(docs).mapInArrow(_mapped(fn, schema, ["doc_id"], min_length, min_repeats), out)


def digest(docs: DataFrame, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """Per input row the number of runs, the strongest run (null without any)
    and digests of all runs and of the collapsed text."""
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    schema = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in names])
    out = T.StructType([T.StructField(n, T.StringType() if n.endswith("sha256") else T.LongType()) for n in names])

    def fn(words, runs):
        best = strongest(runs)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
        return (len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
                hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest())
    return _texts(docs).mapInArrow(_mapped(fn, schema, ["doc_id"], min_length, min_repeats), out)
