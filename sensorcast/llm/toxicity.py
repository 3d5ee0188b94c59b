"""Toxicity by FTRL-proximal logistic regression over hashed word features.

The features of a text are its distinct words, adjacent word pairs and pairs
with one word between them, each hashed to 32 bits.  FTRL-proximal gives every
coordinate its own rate and an L1 penalty that leaves most weights at exactly
zero, so the fitted model is a short list of (feature, weight).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorcast.llm.common import text_slices
from sensorcast.llm.textvec import ngrams, words

# The fit reads at most this many labelled documents of each class, those with
# the smallest hash of their id.  Everything else covers all documents.
FIT_DOCS_PER_CLASS = 2500
EPOCHS = 8
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.05
# a feature takes part in the fit when this many fitted documents have it
MIN_DOCS = 3
HELD_OUT_MOD = 5
_LOOK_BITS = 20


@dataclass
class SparseModel:
    """Non-zero weights by feature (sorted) and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float

    def lookup(self) -> np.ndarray:
        """Marks the low bits of every feature, to skip most absent ones."""
        marks = np.zeros(1 << _LOOK_BITS, bool)
        marks[self.features & np.uint32((1 << _LOOK_BITS) - 1)] = True
        return marks

    def score(self, docs: np.ndarray, feats: np.ndarray, n_docs: int, marks: np.ndarray) -> np.ndarray:
        """Probability per document from (document, feature) rows, repeats counted once."""
        total = np.full(n_docs, self.intercept)
        if len(self.features):
            near = marks[feats & np.uint32((1 << _LOOK_BITS) - 1)]
            docs, feats = docs[near], feats[near]
            at = np.minimum(np.searchsorted(self.features, feats), len(self.features) - 1)
            hit = self.features[at] == feats
            rows = np.unique(docs[hit].astype(np.int64) * len(self.features) + at[hit])
            total += np.bincount(rows // len(self.features), weights=self.weights[rows % len(self.features)],
                                 minlength=n_docs)
        return 1.0 / (1.0 + np.exp(-np.clip(total, -500.0, 500.0)))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of every word, word pair and skip pair inside a document."""
    hashes, before = words(data, offsets, alnum=True)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    docs, feats = [doc], [hashes]
    for gap in (1, 2):
        pairs = ngrams(hashes, 2, gap)
        inside = doc[:len(pairs)] == doc[gap:gap + len(pairs)]
        docs.append(doc[:len(pairs)][inside])
        feats.append(pairs[inside])
    return np.concatenate(docs), (np.concatenate(feats) >> np.uint64(32)).astype(np.uint32)


def _feature_batches(batches):
    schema = pa.schema([("y", pa.int32()), ("feats", pa.binary())])
    for batch in batches:
        for first, last, data, offsets in text_slices(batch):
            docs, feats = features(data, offsets)
            rows = np.unique(docs.astype(np.uint64) << np.uint64(32) | feats)
            cuts = np.searchsorted(rows, np.arange(last - first + 1, dtype=np.uint64) << np.uint64(32))
            low = rows.astype(np.uint32)
            yield pa.RecordBatch.from_arrays([
                batch.column("y").slice(first, last - first),
                pa.array([low[s:e].tobytes() for s, e in zip(cuts[:-1], cuts[1:])], pa.binary())], schema=schema)


def ftrl(rows: list[np.ndarray], y: np.ndarray, n_features: int, epochs: int = EPOCHS, seed: int = 7):
    """Weights and intercept of FTRL-proximal over binary features.

    ``rows`` holds the feature numbers of every document.  The intercept is
    not penalised by L1.
    """
    z, n = np.zeros(n_features), np.zeros(n_features)
    z0 = n0 = 0.0
    rng = np.random.default_rng(seed)

    def shrink(zz, nn):
        return np.where(np.abs(zz) <= L1, 0.0, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(nn)) / ALPHA + L2))

    def free(zz, nn):
        return -zz / ((BETA + nn ** 0.5) / ALPHA + L2)

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at = rows[i]
            w, w0 = shrink(z[at], n[at]), free(z0, n0)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + w0, -35, 35))) - y[i]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
            z0 += g - ((n0 + g * g) ** 0.5 - n0 ** 0.5) / ALPHA * w0
            n0 += g * g
    return shrink(z, n), free(z0, n0)


def repeated(values: np.ndarray, times: int) -> np.ndarray:
    """The distinct values that occur ``times`` times at least, sorted; sorts ``values`` in place."""
    values.sort()
    ends = values[times - 1:]
    often = values[:len(ends)] == ends
    found = ends[often]
    return found[np.append(True, found[1:] != found[:-1])] if len(found) else found


def held_out(doc_id="doc_id"):
    """crc32 of the id as text leaves 0 modulo 5; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT_MOD == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = FIT_DOCS_PER_CLASS) -> SparseModel:
    """Fit on labelled documents that are not held out.

    At most ``per_class`` documents of each class are read (those whose id
    hashes smallest).  A feature is the same number wherever it occurs; those
    in fewer than three fitted documents are left out.  The intercept is moved
    to the class shares of all labelled documents.  Without labels of both
    classes the model is an intercept only.
    """
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
             .where(~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max("toxic").cast("int").alias("y")))
    shares = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most 2 * per_class rows of two integers
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    got = sample.select("doc_id", "y", "text").mapInArrow(_feature_batches, "y int, feats binary").collect()
    got = sorted((bytes(r["feats"]), r["y"]) for r in got)
    y = np.array([label for _, label in got], float)
    raw = [np.frombuffer(feats, np.uint32) for feats, _ in got]
    del got
    n1, n0 = shares.get(1, 0), shares.get(0, 0)
    prior = float(np.log((n1 + 0.5) / (n0 + 1.5)))
    if len(y) == 0 or y.min() == y.max():
        return SparseModel(np.zeros(0, np.uint32), np.zeros(0), prior)
    names = repeated(np.concatenate(raw), MIN_DOCS)
    if len(names) == 0:
        return SparseModel(np.zeros(0, np.uint32), np.zeros(0), prior)
    rows = []
    for r in raw:
        at = np.minimum(np.searchsorted(names, r), len(names) - 1)
        rows.append(at[names[at] == r].astype(np.int32))
    del raw
    w, w0 = ftrl(rows, y, len(names))
    w0 += prior - float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 1.5)))
    used = np.flatnonzero(w)
    return SparseModel(names[used], w[used], float(w0))


def score(docs: DataFrame, model: SparseModel) -> DataFrame:
    """``(doc_id, score)`` of every document from its whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        marks = model.lookup()
        for batch in batches:
            for first, last, data, offsets in text_slices(batch):
                doc, feats = features(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first),
                                                  pa.array(model.score(doc, feats, last - first, marks))],
                                                 schema=schema)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = FIT_DOCS_PER_CLASS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row.

    Null and empty texts have no features and score the intercept.  Repeated
    rows are scored alike; a null ``doc_id`` stays null and is not held out.
    Labels are only read for documents that are not held out, and a document
    labelled twice is toxic if either label says so.  Other columns are
    ignored; an empty table gives an empty result.
    """
    scored = score(docs, fit(docs, labels, per_class))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: SparseModel) -> DataFrame:
    """The rows whose whole text scores below 0.5, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        marks = model.lookup()
        for batch in batches:
            for first, last, data, offsets in text_slices(batch):
                scores = model.score(*features(data, offsets), last - first, marks)
                yield batch.slice(first, last - first).filter(pa.array(scores < 0.5))
    return docs.mapInArrow(run, docs.schema)
