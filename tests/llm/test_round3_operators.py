"""Exact dedup, periodic runs and phrase mining against brute force, with edge rows and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from sensorcast.llm import collocations, exact_dedup, licenses, minhash, periodic_runs, pii, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- exact dedup
def owners(rows, largest):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    pick = max if largest else min
    return {t: (pick([i for i in ids if i is not None], default=None), len(ids)) for t, ids in groups.items()}


def check_owners(spark, rows, keep, memory):
    docs = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in rows],
                                 "doc_id long, text string, sha256 string, row int, members int").repartition(7)
    got = exact_dedup.exact_duplicates(docs, keep, memory).collect()
    want = owners(rows, keep == "largest")
    sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in want.items()}
    assert len(got) == len(rows)
    assert sorted((r.doc_id is None, r.doc_id, r.text_sha256) for r in got) == sorted(
        (i is None, i, hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest()) for i, t in rows)
    kept = Counter()
    for r in got:
        assert (r.keep_id, r.group_size) == sha[r.text_sha256]
        if r.kept:
            assert r.doc_id == r.keep_id
            kept[r.text_sha256] += 1
    assert set(kept.values()) == {1} and len(kept) == len(want)


ROWS = ([(i, "Some Text shared by a third") for i in range(120)] + [(200 + i, f"prefix {i % 9} of texts") for i in range(60)]
        + [(300 + i, "p" * (i % 30)) for i in range(60)] + [(400, None), (401, ""), (402, "É"), (403, "é"), (404, "K"), (405, "k"), (406, "K")]
        + [(500, "again"), (500, "AGAIN"), (500, "again"), (None, "again"), (None, "no id"), (None, "NO id"), (501, "x" * 200_000), (502, "X" * 200_000)])


@pytest.mark.parametrize("keep,memory", [("largest", 1 << 26), ("smallest", 1 << 26), ("largest", 3000), ("smallest", 3000)])
def test_exact_duplicates(spark, keep, memory):
    """Also with tries of three texts, so that subtrees are spilled over rounds."""
    check_owners(spark, ROWS, keep, memory)


def test_exact_duplicates_of_hot_keys(spark):
    rows = [(i, "HOT" if i % 3 else f"own {i}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(150)
    got = exact_dedup.exact_duplicates(docs, "largest").where("kept").collect()
    assert {(r.doc_id, r.group_size) for r in got} == {(899, 600)} | {(i, 1) for i in range(0, 900, 3)}


def test_exact_duplicates_empty_and_drop(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0
    wide = docs.selectExpr("doc_id", "text", "1 as _row", "2 as _sha", "3 as kept")
    left = exact_dedup.drop_duplicates(wide, "largest")
    assert left.columns == wide.columns
    want = owners(ROWS, True)
    assert sorted((r.doc_id or 0, (r.text or "").translate(LOWER)) for r in left.collect()) == sorted((i or 0, t) for t, (i, _) in want.items())


def test_trie_keeps_prefixes_apart():
    trie = exact_dedup.Trie()
    texts = [b"", b"a", b"ab", b"abc", b"abd", b"b", b"ab"]
    for i, t in enumerate(texts):
        trie.add(t, (i, i), 1, [i])
    assert {t: (n.best, n.count, n.members) for t, n in trie.terminals()} == {
        b"": ((0, 0), 1, [0]), b"a": ((1, 1), 1, [1]), b"ab": ((2, 2), 2, [2, 6]), b"abc": ((3, 3), 1, [3]), b"abd": ((4, 4), 1, [4]), b"b": ((5, 5), 1, [5])}
    cut = list(trie.spill())
    assert {t for _, t, _ in cut} == {b"a", b"ab", b"abc", b"abd"} and len({k for k, _, _ in cut}) == 1
    assert isinstance(trie.add(b"abx", (9, 9), 1, []), exact_dedup.Spilled)


# --- periodic runs
def brute_runs(w):
    out = set()
    for q in range(1, len(w) // 4 + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            s, n = i - q, j - i + q
            x = w[s:j]
            if j > i and n >= max(6, 4 * q) and not any(x[p:] == x[:-p] for p in range(1, q)):
                out.add((s, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def brute_digest(words):
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    keep = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(keep)))


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def random_words(rng):
    words = []
    for _ in range(rng.randint(0, 4)):
        block = [rng.choice("abc"[:rng.randint(1, 3)]) if rng.random() < 0.8 else str(rng.randint(0, 9))
                 for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 13, 17, 33]))]
        words += (block * rng.randint(1, 7))[:rng.randint(0, 160)] + [rng.choice("abxyz") for _ in range(rng.randint(0, 6))]
    return words


def test_periodic_runs_equal_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, rng.choice(" \n\t\x0b").join(random_words(rng))) for i in range(600)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "é x é x " * 9), (7, "a a a a a a"), (7, "a a a a a a"), (None, "b " * 8), (None, None)]
    rows += [(2000 + i, "one two three four five six seven eight nine ten " * rng.randint(1, 3)) for i in range(300)]
    rows.append((1005, " ".join(f"w{i}" for i in range(40_000)) + " tail end" * 5000))
    spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, runs string, n_runs int").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_periodic_runs(spark, str(tmp_path)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))
    want = [(i, *brute_digest(planted(i, split_words(t)))) if i != 1005 else None for i, t in rows]
    assert sorted((tuple(r) for r in got if r.doc_id != 1005), key=key) == sorted(filter(None, want), key=key)
    long = next(r for r in got if r.doc_id == 1005)
    assert (long.n_runs, long.start, long.length, long.period) == (1, 40_000, 10_000, 2)
    assert sum(r.n_runs > 0 for r in got) > 200


def test_collapse_runs(spark):
    docs = spark.createDataFrame([(1, "say a b a b a b a b now"), (2, None), (None, "x")], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs.collapse_runs(docs).collect()}
    assert got[1].text == "say a b now" and [tuple(r) for r in got[1].runs] == [(1, 8, 2)] and got[1].n_words == 10
    assert got[2].text == "" and got[2].runs == [] and got[None].text == "x"
    assert periodic_runs.collapse_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.collapse_runs(docs, min_repeats=3)


# --- phrase collocations
def brute_phrases(rows, threshold, covered, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(" ".join(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in counts.items():
        c = {p: n for p, n in c.items() if n >= threshold}
        long = Counter()
        for p, n in c.items():
            w = p.split(" ")
            for k in range(2, len(w)):
                for i in range(len(w) - k + 1):
                    sub = " ".join(w[i:i + k])
                    long[sub] = max(long[sub], n)
        found = []
        for p, a in c.items():
            w = p.split(" ")
            if len(w) > 1 and 100 * long[p] < covered * a:
                s, _, l, r = min((2000000 * a // (c[" ".join(w[:k])] + c[" ".join(w[k:])]), k, c[" ".join(w[:k])], c[" ".join(w[k:])])
                                 for k in range(1, len(w)))
                found.append((-s, -a, p.encode(), p, a, l, r, s))
        out += [(lang, i + 1, p, a, l, r, totals[lang], s) for i, (_, _, _, p, a, l, r, s) in enumerate(sorted(found)[:top])]
    return sorted(out)


def phrase_rows():
    rng = random.Random(9)
    names = ["of", "the", "and", "Tea", "tea", "É", "é", "new", "york", "x", "ab", "日本", "mean"]
    rows = []
    for i in range(300):
        words = [rng.choice(names) + rng.choice(["", "", "", ".", ",", "\n", "\x0b"]) for _ in range(rng.randint(0, 40))]
        rows.append((rng.choice([" ", "  ", "\t"]).join(words), rng.choice(["en", None, "fr"])))
    rows += [("new york city of lights", "en")] * 40 + [("a a a a a a", "de")] * 30 + [(None, "en"), ("", "xx"), (" \t. ", None), ("in \x85 line", None)]
    return rows


def test_collocations_equal_brute_force(spark):
    rows = phrase_rows()
    docs = spark.createDataFrame([(t, g, "p", 1) for t, g in rows], "text string, lang string, phrase string, k int").repartition(5)
    for top in (2000, 10):
        got = sorted(tuple(r) for r in collocations.collocations(docs, 5, 80, top).collect())
        assert got == brute_phrases(rows, 5, 80, top) and len(got) >= 20
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_no_frequent_phrase_is_lost(spark):
    """Also by summaries that must take counts off."""
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    rng = np.random.default_rng(2)
    keys = rng.zipf(1.3, 60_000) % 5000
    summary = collocations.Summary(len(keys) // 30)
    for part in np.array_split(keys, 300):
        k, n = np.unique(part, return_counts=True)
        summary._waiting = 1 << 20  # settle at once
        summary.merge(k, n)
    true = {int(k) for k, n in zip(*np.unique(keys, return_counts=True)) if n >= 30}
    assert 0 < summary.taken < 30 and true <= set(summary.survivors(30).tolist()) and len(summary.keys) <= summary.capacity
    got = {(r.lang, r.phrase): r.f for r in collocations.phrase_counts(docs, 12).where("k > 0").collect()}
    want = Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            want.update((lang or "und", " ".join(words[i:i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    assert got == {p: n for p, n in want.items() if n >= 12}


def test_packed_round_trip():
    for values in (np.zeros(0, np.int64), np.array([0, 1, 255, 256, (1 << 32) - 1])):
        assert collocations.unpacked(collocations.packed(values), len(values)).tolist() == values.tolist()


# --- links of short texts, repeated ids, license names, many matches
def test_short_texts_at_the_threshold_are_linked(spark):
    """Pairs that share exactly three of four shingles: none may be lost by the estimate."""
    rows = []
    for i in range(1500):
        w = [f"w{i}x{k}" for k in range(8)]
        rows += [(2 * i, " ".join(w[:7])), (2 * i + 1, " ".join(w[:7] + ["end"]))]  # 3 shingles, and 4 of which 3 are shared
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert all(r.component_id == r.doc_id // 2 * 2 for r in got)


def test_estimate_floors_leave_room_for_lost_shingles():
    floors = minhash.estimate_floors(75)
    assert floors[4] < 0.5 and floors[8] < 0.61 and all(0.6 < f < 0.67 for f in floors[16:]) and len(floors) == minhash.FLOOR_SIZES + 1


def test_one_id_with_two_texts(spark):
    words = [f"word{i}" for i in range(40)]
    other = [f"else{i}" for i in range(30)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1] + ["changed"])), (2, "aa " + " ".join(other)), (3, "aa " + " ".join(other[:-1] + ["z"]))]
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 36, 1, True), (2, 27, 2, True), (2, 36, 1, False), (3, 27, 2, False)]


LICENSE_LINES = [("Licensed under CC BY 4.0", "cc-by"), ("Licensed under CC BY NC 4.0", "cc-by,cc-by-nc"), ("released under the license", ""),
                 ("This work is licensed under the Mozilla Public License", ""), ("Licensed under the MIT License, Version 2.0", "mit"),
                 ("Licensed under the Apache License, Version 2.0", "apache-2.0"), ("Released under the MIT License", "mit"),
                 ("This work is licensed under the GNU\nGeneral Public License", "gpl"), ("All rights reserved", "reserved"),
                 ("Licensed under CC\nBY-NC 4.0", "cc-by,cc-by-nc"), ("Kit", "")]


def test_license_labels_need_the_name(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LICENSE_LINES)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan(docs).collect()}
    assert [got[i] for i in range(len(LICENSE_LINES))] == [want for _, want in LICENSE_LINES]


def test_pii_of_a_long_number_table(spark):
    import time
    n = 30_000
    docs = spark.createDataFrame([(1, "12;34," * n + "a@b.de")], "doc_id long, text string")
    began = time.time()
    spans = docs.select(pii.match_spans(F.col("text"), "[0-9]+", "n").alias("s")).first().s
    assert len(spans) == 2 * n and [(s.start, s.end) for s in spans[-2:]] == [(6 * n - 6, 6 * n - 4), (6 * n - 3, 6 * n - 1)]
    rows = [(1, "12;34," * n + "a@b.de"), (2, "a@b.de;" * 20_000), (3, None), (4, "x a@b.de@c.de 1.2.3.4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text"))
    out = {r.doc_id: r for r in pii.redact(docs, pii.Selector([], [], {})).collect()}
    assert out[1].text == "12;34," * n + "[EMAIL]" and out[2].text == "[EMAIL];" * 20_000 and out[2].n_chars == 160_000
    assert out[3].text is None and out[4].text == "x [EMAIL]@c.de [IP]" and time.time() - began < 90
