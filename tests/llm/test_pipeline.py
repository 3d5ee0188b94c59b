"""The pipeline: what each stage keeps, against brute force, and edge rows."""

import itertools

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sensorcast.llm import minhash

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(texts):
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts]


def near_groups(texts):
    """Groups of row numbers by brute force over full shingle sets."""
    sets = [minhash.word_shingles(t or "") for t in texts]
    group = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    return group


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]


def test_near_duplicates_equal_brute_force(spark, documents):
    docs = spark.createDataFrame(rows_of(documents), DDL).repartition(4)
    group = near_groups([t for _, t in documents])
    least = {g: min(i for (i, _), h in zip(documents, group) if h == g) for g in group}
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in left.collect()) == sorted(least.values())
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert got == {i: (len(minhash.word_shingles(t or "")), least[g], least[g] == i) for (i, t), g in zip(documents, group)}


def test_near_duplicates_of_repeated_rows_and_null_ids(spark):
    same = "one two three four five six seven eight"
    own = "no other row has these words in it at all"
    texts = [(1, same), (1, same), (None, same), (None, same), (3, same.upper()), (None, own), (None, own), (7, None), (8, ""), (None, None)]
    left = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows_of(texts), DDL), "").collect()
    assert sorted(((r.doc_id is None, r.doc_id, r.text) for r in left), key=str) == sorted(
        [(False, 1, same), (True, None, own), (False, 7, None), (False, 8, ""), (True, None, None)], key=str)


def test_stages_keep_columns_and_clean_rows(spark, documents):
    docs = spark.createDataFrame(rows_of(documents[:60] + [(None, None), (9001, ""), (9001, "")]), DDL)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == corpus_pipeline.COLUMNS, name
        assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0
    lines = corpus_pipeline.drop_lines(spark, docs, "").collect()
    assert len(lines) == 63 and all(r.text is None or r.n_chars == len(r.text) for r in lines)


def test_whole_run(spark):
    """Every stage's rows go on: pieces of the kept documents, gapless in their sequences."""
    sf = "/root/testdata/sf0.001"
    toxic = corpus_pipeline.drop_toxic(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, corpus_pipeline.drop_lines(spark, toxic, sf), sf).collect()}
    pieces = corpus_pipeline.run(spark, sf).collect()
    assert {p.doc_id for p in pieces} == kept
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    assert toxic.where(F.col("doc_id").isNull()).count() == 0 and len(kept) > 100
