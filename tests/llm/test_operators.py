"""Operators on small tables: brute force, edge rows, clashing columns."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorcast.llm import ann, bpe, components, edit_counts, embedding_dedup, licenses, line_dedup, minhash, packing, pii, toxicity

P = pytest.importorskip("public_tokenizers")
RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")
BASE = "the quick brown fox jumps over the lazy dog while many other animals look on and wonder why it does so today".split()


@pytest.fixture(scope="module")
def edge(spark):
    """Null and empty texts, null ids, repeated rows, a very long text, extra columns."""
    long = " ".join(f"word{i}" for i in range(30_000))
    rows = [(1, " ".join(BASE)), (2, " ".join(BASE[:-1] + ["now"])), (3, None), (4, ""), (5, " \n "), (6, long),
            (7, "short text"), (7, "short text"), (None, "short text"), (None, None)]
    return spark.createDataFrame([(i, t, 1, "x", "k") for i, t in rows], "doc_id long, text string, a int, key string, base string")


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (3, 3), (None, 1), (7, 8), (5, 4)], "a long, b long")
    got = {r.id: r.component for r in components.connected_components(links).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 7: 7, 8: 7, 9: 7}


def test_minhash_edges(spark, edge):
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.near_duplicates(edge).collect()}
    assert got[1, len(BASE) - 4] == (1, True) and got[2, len(BASE) - 4] == (1, False)
    assert got[3, 0] == (3, True) and got[4, 0] == (4, True) and got[7, 1] == (7, True) and got[None, 1] == (None, True)
    assert minhash.near_duplicates(edge).count() == 10 and minhash.near_duplicates(edge.limit(0)).count() == 0


def test_packing_edges(spark, edge):
    rows = packing.best_fit_pack(edge, WORDS).collect()
    assert sum(r.piece == 0 for r in rows) == 10
    used = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert packing.best_fit_pack(edge.limit(0), WORDS).count() == 0


def test_bpe_edges(spark, edge):
    back = bpe.decode(bpe.encode(edge, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == sorted((r.doc_id or 0, r.text or "") for r in edge.collect())
    got = {r.doc_id: r for r in bpe.round_trip(edge, RANKS, P.PATTERN).collect()}
    assert got[3].n_tokens == 0 and got[3].ids_sha256 == hashlib.sha256(b"").hexdigest()


def test_toxicity_edges(spark, edge):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    assert toxicity.toxicity(edge, labels).count() == 10
    assert {r.predicted for r in toxicity.toxicity(edge, labels.limit(0)).collect()} == {0}
    assert toxicity.toxicity(edge.limit(0), labels).count() == 0


def test_pii_equals_brute_force_and_redacts(spark, edge):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    texts = ["é a.b@c.de_x@y.org, 1.2.3.4.5.6.7.8 256.1.1.1", "4111 1111 1111 1111 +1 (555) 123-4567 +1", "@ a@b .a@b.c.", "", None,
             "1-2 3  4 4111111111111112 010.0.0.01 +49 30 1234567890"]
    docs = spark.createDataFrame([(i, t, "q") for i, t in enumerate(texts)], "doc_id long, text string, base string")

    def valid(kind, m):
        d = [int(c) for c in m if c.isdigit()]
        if kind == "card":
            return 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0
        return {"ip": lambda: all(int(x) <= 255 for x in m.split(".")), "phone": lambda: 9 <= len(d) <= 15}.get(kind, lambda: True)()
    got = {r.doc_id: r for r in pii.digest(docs).collect()}
    for i, t in enumerate(texts):
        spans = [f"{k}:{m.start()}:{m.end()}" for k, p in patterns.items() for m in re.finditer(p, t or "") if valid(k, m.group())]
        assert got[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(got[i].spans.split(",")) or not spans
    out = {r.doc_id: r for r in pii.redact(docs, pii.Selector([], [], {})).collect()}
    assert out[1].text == "[CARD] [PHONE] +1" and out[4].text is None and out[0].base == "q"
    assert pii.digest(edge).count() == 10


def test_license_scan(spark, edge):
    texts = ["x CC-by y\nall rights RESERVED", "licensed under the apache license, version 2.0", "general public", None,
             "apache license version of 2.0 licensed words under the", "Licensed\nunder\nthe\nApache\nLicense"]
    rows = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert (rows[0].n_words, rows[0].n_base, rows[0].first_word, rows[0].last_word, rows[0].base_labels) == (7, 2, 1, 4, "cc-by,reserved")
    assert rows[1].labels == "apache-2.0" and rows[1].score == 1.0 and rows[4].labels == "apache-2.0"
    assert rows[2].n_base == 0 and rows[3].n_words == 0 and rows[5].labels == "" and rows[5].score == 0.0
    assert licenses.scan(edge).count() == 10 and licenses.scan(edge.limit(0)).count() == 0


def test_license_scan_wrapped_notices(spark):
    def wrapped(template, width, lead):
        words = licenses.TEMPLATES[template][1].split()
        return "own code\n" + "\n".join(lead + " ".join(words[i:i + width]) for i in range(0, len(words), width)) + "\nmore code"
    texts = [wrapped(3, 8, " * "), wrapped(5, 6, "# "), wrapped(6, 9, "// "), wrapped(0, 1, ""),
             ("\n" + "filler of other text " * 8 + "\n").join(licenses.TEMPLATES[3][1].split())]
    rows = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [rows[i].labels for i in range(5)] == ["mit", "gpl", "bsd", "apache-2.0", ""]
    assert all(rows[i].score == 1.0 for i in range(4)) and rows[4].score == 0.0


def test_line_dedup(spark, edge):
    lines = [(i, f"own {chr(97 + i)} words only here {chr(98 + i)}\nPage {i} of the big site map\nshort one") for i in range(12)]
    copies = [(100 + i, "a copied document line\nwith a second line here") for i in range(20)]
    docs = spark.createDataFrame(lines + copies + [(200, None), (201, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert got[0].n_dropped == 0  # the first document keeps the line
    assert all("Page" not in got[i].text and got[i].n_lines == 3 for i in range(1, 12))
    assert all(got[100 + i].n_dropped == 0 for i in range(20)) and got[200].text is None and got[201].text == ""
    assert line_dedup.dedup_lines(edge).count() == 10 and line_dedup.dedup_lines(edge.limit(0)).count() == 0


def test_line_dedup_line_that_hashes_lowest(spark):
    texts = [f"own {chr(97 + i)} words only here {chr(98 + i)}\nanother {chr(97 + i)} line of it" for i in range(12)]
    some = spark.createDataFrame([(f"Foot {chr(97 + i // 26)}{chr(97 + i % 26)} of every page here",) for i in range(600)], "line string")
    low, next_low = [r.line for r in some.orderBy(F.xxhash64("line")).limit(2).collect()]
    docs = spark.createDataFrame([(i, f"{t}\n{low}\n{next_low}") for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert got[0].n_dropped == 0 and all(got[i].text == texts[i] and got[i].n_dropped == 2 for i in range(1, 12))


def test_line_dedup_counts_unlike_documents_by_length(spark):
    def own(i):
        return f"own {chr(97 + i)} words only here {chr(98 + i)}\nanother {chr(97 + i)} line of it"
    long = " ".join(f"{a}{b}" for a in "bcdfghkl" for b in "aeiouyw")
    other = " ".join(["ba", "be", "bi"] + [f"{a}{b}" for a in "mnpqrstv" for b in "aeiouyw"][3:])  # of the same leaf
    rows = [(i, f"{own(i)}\n{long}") for i in range(2)] + [(2, f"{own(2)}\n{other}")]
    rows += [(10 + i, f"{own(10 + i)}\na short common sentence") for i in range(7)]
    # many copies of one document do not keep a line that unlike documents share
    rows += [(30 + i, f"{chr(97 + i)} single page of text\nthe {chr(97 + i)} second row of it\nfoot of all the pages") for i in range(9)]
    rows += [(100 + i, "a copied document line\nwith a second line here\nfoot of all the pages") for i in range(40)]
    body = [f"near copied {chr(97 + k)} line" for k in range(9)]
    rows += [(200 + i, "\n".join([*body, f"edit {chr(97 + i % 26)}{chr(97 + i // 26)} line"])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(docs).collect()}
    assert got[0] == 0 and got[1] == 1 and got[2] == 0
    assert all(got[10 + i] == 0 for i in range(7))
    assert got[30] == 0 and all(got[30 + i] == 1 for i in range(1, 9)) and all(got[100 + i] == 1 for i in range(40))
    assert all(got[200 + i] == 0 for i in range(30))


def test_embeddings(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.01], 2), (5, [0.0, 0.0], 1), (6, None, 1),
            (7, [nan, 1.0], 1), (8, [1.0, 0.0], None), (9, [0.0, 1.0], 1), (None, [1.0, 0.0], 1), (10, [1.0, None], 1)]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "vec_id long, embedding array<double>, label int, score double")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[3] == (2, 1, False)
    assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10)) and got[None] == (0, None, True)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    near = ann.nearest(df, F.col("vec_id") == 1).orderBy("rank").collect()
    assert [r.vec_id for r in near] == [2, 3, 8, 4, 9]
    assert ann.nearest(df.limit(0), F.col("vec_id") == 1).count() == 0


def test_nearest_with_a_third_copies(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(3000, 16))
    x[r.permutation(3000)[:1000]] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for row in ann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(row.query_id, {})[row.rank] = row.vec_id
    u = x / np.linalg.norm(x, axis=1)[:, None]
    same = (x == x[0]).all(axis=1)
    recall, in_copies = [], 0
    for q in range(0, 3000, 20):
        if same[q]:  # the smallest ids of the copies
            assert [got[q][k] for k in range(1, 6)] == [i for i in np.flatnonzero(same)[:6] if i != q][:5]
            in_copies += 1
            continue
        score = u @ u[q]
        score[same] = score[same].max()
        score[q] = -2
        recall.append(len(set(np.lexsort((np.arange(3000), -score))[:5].tolist()) & set(got[q].values())) / 5)
    assert in_copies > 20 and np.mean(recall) > 0.85


def test_edit_counts(spark, edge):
    edits = spark.createDataFrame([(1, 0, 0, 3, "a"), (1, 1, 5, 5, None), (4, 0, 0, 9, "new words"), (None, 0, 0, 1, "x"),
                                   (6, 0, 7, None, "x")], "doc_id long, seq int, start int, stop int, replacement string")
    got = {r.doc_id: r for r in edit_counts.count_edited(edge, edits, RANKS, P.PATTERN).collect()}
    assert got[1].n_edits == 2 and got[4].n_tokens == 0 and got[4].n_tokens_after == 2 and got[6].n_edits == 0
    assert got[6].n_reencoded == 0 and got[3].n_tokens == 0


def test_kept_trees_follow_edits(spark, edge, tmp_path):
    """Trees written as a table and edited twice equal trees built from the edited texts; the rest is not encoded."""
    path = str(tmp_path / "trees")
    edit_counts.build_trees(edge, RANKS, P.PATTERN).write.parquet(path)
    trees = spark.read.parquet(path)
    assert trees.count() == 10
    ddl = "doc_id long, seq int, start int, stop int, replacement string"
    first = spark.createDataFrame([(6, 0, 100_000, 100_003, "new  words"), (6, 1, 7, 7, "'s"), (7, 0, 0, 5, None),
                                   (4, 0, 0, 0, "text for an empty one"), (None, 0, 0, 2, "x"), (99, 0, 0, 1, "y")], ddl)
    second = spark.createDataFrame([(6, 0, 100_001, 100_020, ""), (4, 0, 99, 120, "!"), (3, 0, 0, 0, "\n\n a")], ddl)
    texts = {i: (t or "") for i, t in edge.select("doc_id", "text").where("doc_id in (3, 4, 6, 7)").collect()}
    expected = dict(texts)
    for batch in (first, second):
        trees = edit_counts.apply_edits(trees, batch, RANKS, P.PATTERN)
        for r in sorted(batch.collect(), key=lambda r: r.seq):
            if r.doc_id in expected:
                t = expected[r.doc_id]
                expected[r.doc_id] = t[:r.start] + (r.replacement or "") + t[max(r.start, r.stop):]
    got = trees.collect()
    assert len(got) == 10 and {r.doc_id: r.text for r in got if r.doc_id in expected} == expected
    again = {r.doc_id: r for r in edit_counts.build_trees(
        spark.createDataFrame([(i, t) for i, t in expected.items()], "doc_id long, text string"), RANKS, P.PATTERN).collect()}
    for r in got:
        if r.doc_id in again:
            assert (r.lengths, r.counts, r.n_tokens) == (again[r.doc_id].lengths, again[r.doc_id].counts, again[r.doc_id].n_tokens)
        assert r.n_tokens == sum(r.counts) and sum(r.lengths) == len(r.text)
    spent = {r.doc_id: r.n_reencoded for r in got}
    assert 0 < spent[6] < 100 and spent[1] == spent[2] == spent[None] == 0  # of 30,000 words
    assert edit_counts.apply_edits(trees.limit(0), first, RANKS, P.PATTERN).count() == 0
    assert edit_counts.apply_edits(trees, first.limit(0), RANKS, P.PATTERN).agg(F.sum("n_reencoded")).first()[0] == 0


def test_pii_fit_reads_all_documents(spark):
    """Only documents after the 4,000 with the smallest hashes have addresses; of 27,603 proposals none is left out."""
    rows = spark.range(4600).withColumnRenamed("id", "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    texts = [(r.doc_id, "no 1234567 x 2345678 y" + (" a.b@c.de" if k >= 4000 else " 3456789") * 2) for k, r in enumerate(rows)]
    docs = spark.createDataFrame(texts + [(None, "null id 12345678 z@y.xx"), (9001, None)], "doc_id long, text string").repartition(3)
    assert "email" in pii.fit(docs).thresholds
    counts = {(r.of, r.label): r.n for r in pii.training_rows(docs).groupBy("of", "label").agg(F.sum("n").alias("n")).collect()}
    assert counts == {("card", 0.0): 3 * 4000 + 2 * 600 + 1, ("phone", 0.0): 3 * 4000 + 2 * 600 + 1, ("email", 1.0): 2 * 600 + 1}


def test_near_copies_meet_few_leaders(spark, monkeypatch):
    """A large group of near copies makes about one pair a document, not one for every band."""
    words = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(words[:i] + ["changed"] + words[i + 1:])) for i in range(120)]
    pairs = []
    estimated = minhash._estimated

    def counted(some, *rest):
        pairs.append(some.count())
        return estimated(some, *rest)
    monkeypatch.setattr(minhash, "_estimated", counted)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 120
    assert sum(pairs) < 2 * 120


def test_near_copies_are_few_bucket_rows(spark, monkeypatch):
    """Members of a large group are not written or joined once for every band; the rows grow with the group, not its square."""
    words = [f"w{i}" for i in range(150)]
    copies = [(i, " ".join(words[:i] + ["changed"] + words[i + 1:])) for i in range(120)]
    write = minhash.stored
    made = {}

    def counted(df, name):
        out, path = write(df, name)
        made[name] = max(made.get(name, 0), out.count())
        return out, path
    monkeypatch.setattr(minhash, "stored", counted)
    most = []
    for n in (60, 120):
        made.clear()
        got = minhash.near_duplicates(spark.createDataFrame(copies[:n], "doc_id long, text string").repartition(4)).collect()
        assert {r.component_id for r in got} == {0} and len(got) == n
        most.append(max(made.values()))
    assert most[1] <= 2 * 120 and most[1] <= 2.5 * most[0]
    keyed = spark.range(40).select(F.col("id").alias("doc_id"), F.array(*[F.lit(k) for k in range(minhash.BANDS)]).alias("keys"))
    apart = minhash._named(keyed, spark.createDataFrame([(i, 0) for i in range(39)], "id long, component long"))
    mixed = minhash._mixed(apart)
    assert mixed.count() == minhash.BANDS and {(r.n, r.leader, r.cl) for r in mixed.collect()} == {(40, 0, 0)}
    assert apart.join(mixed, "key").where("c <> cl").count() == minhash.BANDS  # of the one class that is apart


def test_line_dedup_moves_few_texts(spark, monkeypatch):
    """Only lines of recurring leaves and texts that lose lines pass the bit map; columns named as its own stay."""
    rows = [(i, f"own {chr(97 + i)} words only here {chr(98 + i)}\n" + "foot of all the pages\n" * (i < 12)) for i in range(24)]
    docs = spark.createDataFrame([(i, t, "kept") for i, t in rows + [(None, rows[3][1]), (50, None)]], "doc_id long, text string, bits string")
    mark = line_dedup._marked
    seen = []

    def counted(df, *rest):
        out = mark(df, *rest)
        seen.append((df.count(), out.where("_marked").count()))
        return out
    monkeypatch.setattr(line_dedup, "_marked", counted)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert len(got) == 26 and all(r.bits == "kept" for r in got.values()) and got[50].text is None
    assert got[None].n_dropped == 0 and all(got[i].n_dropped == (1 if i < 12 else 0) for i in range(24))
    (lines, some_lines), (texts, some_texts) = seen
    assert lines == 25 + 13 and some_lines < lines and texts == 26 and some_texts == 12
