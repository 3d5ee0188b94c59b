"""Large groups of texts just below the near-duplicate threshold."""

import itertools

import numpy as np

from sensorcast.llm import minhash


def _group(n: int):
    """Texts of 200 common words and 35 of their own (any two share 196 of 266
    shingles, 73.7 %), and near copies of every tenth."""
    base = [f"w{i}" for i in range(200)]
    texts = {k: [*base, *(f"x{k}y{i}" for i in range(35))] for k in range(n)}
    texts |= {n + k: [*texts[k][:-1], "last"] for k in range(0, n, 10)}
    return {k: " ".join(words) for k, words in texts.items()}


def _components(texts: dict[int, str]) -> dict[int, int]:
    sets = {k: minhash.word_shingles(t) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for a, b in itertools.combinations(sorted(texts), 2):
        inter = len(sets[a] & sets[b])
        if 100 * inter >= 75 * (len(sets[a]) + len(sets[b]) - inter):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {k: root(k) for k in texts}


def test_pairs_below_the_threshold_are_not_emitted(spark, monkeypatch):
    """rows to confirm grow with the documents, not with the pairs of a group."""
    texts = _group(120)
    rows = []
    confirmed = minhash._confirmed

    def counted(pairs, known):
        rows.append(pairs.count())
        return confirmed(pairs, known)
    monkeypatch.setattr(minhash, "_confirmed", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert got == _components(texts)
    assert len(set(got.values())) == 120
    assert sum(rows) <= 12 * len(texts), rows


def test_links_inside_a_task_join_the_components():
    """Pairs of tiles give a forest of the true links, bucket by bucket, whatever the tiles are."""
    import pyarrow as pa
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
        for _ in range(3):
            drop = rng.integers(2, 14)
            sets.append(np.unique(np.concatenate([base[drop:], rng.integers(0, 1 << 63, int(rng.integers(0, 8)), dtype=np.uint64)])))
    head = np.zeros(minhash.BANDS * minhash.BAND_ROWS, np.uint16).tobytes()
    docs = [{"member": i, "c": i, "head": head, "shingles": s.tobytes()} for i, s in enumerate(sets)]
    tiles = [docs[i::3] for i in range(3)]
    rows = [{"key": key, "band": 0, "same": i == j, "docs_a": tiles[i], "docs_b": tiles[j]}
            for key in (1, 2) for i in range(3) for j in range(i, 3)]
    out = pa.Table.from_batches(list(minhash._link_batches(75)(pa.RecordBatch.from_pylist([r]) for r in rows))).to_pylist()
    truth = {(a, b) for a, b in itertools.combinations(range(len(sets)), 2)
             if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))}
    links = [tuple(sorted((r["a"], r["b"]))) for r in out]
    assert set(links) <= truth and len(links) < 2 * len(sets)

    def classes(pairs):
        label = list(range(len(sets)))
        for a, b in pairs:
            old, new = label[a], label[b]
            label = [new if x == old else x for x in label]
        return {frozenset(i for i in range(len(sets)) if label[i] == x) for x in label}
    assert classes(links[:len(links) // 2]) == classes(truth) == classes(links[len(links) // 2:])


def test_shared_counts():
    rng = np.random.default_rng(7)
    sets = [np.unique(rng.integers(0, 50, n).astype(np.uint64)) for n in (1, 5, 40, 30)]
    others = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in [2, 9, 33] * 8]
    count = minhash.shared_counts(sets, others)
    for i, s in enumerate(sets):
        for j in (np.arange(len(others)), np.array([4]), np.array([], np.int64)):
            assert count(i, j).tolist() == [len(np.intersect1d(s, others[k])) for k in j]
