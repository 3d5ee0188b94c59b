"""Parts that need no Spark: against the public libraries and brute force."""

import bisect
import random

import numpy as np
import pytest

from sensorcast.llm import ann, bpe, edit_counts, embedding_dedup, minhash, packing, pii, textvec, toxicity

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def ranks():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read()


def texts(n, seed):
    rng = random.Random(seed)
    sets = ["aeioutnsrh", "abcdefgh'", "=-_*#.", "éèß你好😀", "0123456789", " \n\t 's", "\x1c\x85   a"]
    return ["".join(rng.choice(rng.choice(sets) if rng.random() < .3 else sets[k % 7]) for _ in range(rng.randint(0, 200)))
            for k in range(n)]


def test_transducer_equals_tiktoken_and_decodes(ranks):
    import tiktoken
    table = bpe.read_ranks(ranks)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=table, special_tokens={})
    coder = bpe.ByteBpe(table, P.PATTERN, max_pieces=500)
    coder.machine.flush_bytes = 40
    for text in texts(800, 1) + ["", " ", "a" * 5000, "ab " * 3000]:
        ids = coder.encode(text)
        assert ids == enc.encode_ordinary(text)
        assert "".join(s for _, s in coder.decode_stream(ids, 3)) == text


def test_utf8_stream_holds_back_unfinished_characters():
    data = "aé你😀b".encode()
    for size in (1, 2, 3, 5):
        s = bpe.Utf8Stream()
        assert "".join(s.feed(data[i:i + size]) for i in range(0, len(data), size)) + s.close() == data.decode()
    s = bpe.Utf8Stream()
    assert s.feed(b"\xe4\xbd") == "" and s.close() == "�"


def test_word_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    tok = Tokenizer.from_str(definition)
    encoder = packing.WordEncoder(definition, limit=200)
    rng = random.Random(3)
    alphabet = "abcABCéÉ'.,!?012 \n\tßΣσİ̈*#-)\"|<>ªµÅ_"
    some = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(800)] + ["", "<|endoftext|> x", "<|ENDOFTEXT|> a|B", "x<|endoftext|>.!"]
    some += ["done*** Word$$$ it's## o'clock's). A=\u0338 x--y--"]
    for text, got in zip(some, encoder.encode(some)):
        assert list(np.frombuffer(got, "<u4")) == tok.encode(text, add_special_tokens=False).ids


def test_edits_equal_a_full_count(ranks):
    counter = edit_counts.PieceCounter(ranks, P.PATTERN)
    rng = random.Random(5)
    for text in texts(150, 8) + ["word " * 2000]:
        doc = edit_counts.EditedDocument(text, counter.cut, counter.count)
        for _ in range(6):
            start = rng.randint(-1, len(text) + 2)
            stop = start + rng.randint(0, 30)
            new = rng.choice(["", " ", "x", " two words", "'s", "\n", "ab\n"])
            doc.edit(start, stop, new)
            start = min(max(start, 0), len(text))
            text = text[:start] + new + text[min(max(stop, start), len(text)):]
            assert doc.text == text
            assert doc.n_tokens == sum(map(counter.count, counter.cut.findall(text)))


def best_fit_decreasing(lengths, capacity):
    gaps = []
    n = 0
    for x in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, x)
        left = gaps.pop(at) if at < len(gaps) else capacity
        n += left == capacity
        bisect.insort(gaps, left - x)
    return n


@pytest.mark.parametrize("capacity,n", [(64, 400), (256, 3000), (100, 1), (10, 0)])
def test_configurations_place_every_piece_once(capacity, n):
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, capacity + 1, n)
    hist = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)))) if n else {}
    configs = packing.configurations(hist, capacity)
    placed = {}
    for config, m in configs:
        assert m > 0 and sum(k * c for k, c in config.items()) <= capacity
        for k, c in config.items():
            placed[k] = placed.get(k, 0) + m * c
    assert placed == hist
    assert sum(m for _, m in configs) <= best_fit_decreasing(lengths.tolist(), capacity)
    seen = {}
    for length, lo, hi, _, _ in packing.place_table(configs):
        assert lo == seen.get(length, 0)
        seen[length] = hi
    assert seen == hist


def test_shingle_sets_and_registers():
    docs = ["One two THREE four five six", "one two three four", "", "  \n", "a b c d e a b c d e a", "one two three four five six"]
    data = [d.encode() for d in docs]
    offsets = np.cumsum([0] + [len(d) for d in data])
    sets = textvec.shingle_sets(np.frombuffer(b"".join(data), np.uint8), offsets)
    assert [len(s) for s in sets] == [len(minhash.word_shingles(d)) for d in docs]
    assert (sets[0] == sets[5]).all()
    regs = minhash.sketch(sets, minhash.borrow_order())
    assert (regs[0] == regs[5]).all() and not regs[2].any()


def test_estimate_follows_jaccard():
    rng = np.random.default_rng(0)
    order = minhash.borrow_order()
    for size in (5, 60, 3000):
        for share in (0.3, 0.75, 1.0):
            common = max(1, round(share * size))
            pool = np.sort(rng.integers(0, 1 << 63, 3 * size, dtype=np.uint64) * np.uint64(2))
            pick = rng.permutation(pool)
            a, b = np.sort(pick[:size]), np.sort(np.concatenate([pick[:common], pick[size:2 * size - common]]))
            true = common / (2 * size - common)
            r = minhash.sketch([a, b], order)
            n = np.array([float(size)])
            assert abs(minhash.estimate(r[:1], r[1:], n, n)[0] - true) < 0.2


def test_tiled_pairs_equal_brute_force():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 24))
    x[150:] = x[:150] + rng.normal(size=(150, 24)) * rng.uniform(0, 0.6, (150, 1))
    u = embedding_dedup.unit(x)
    r, c = embedding_dedup._near_pairs(u, u, 0.93, True)
    ok = embedding_dedup.cosines(x[r], x[c]) >= 0.93
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(u @ u.T >= 0.93, 1)))}
    assert {(i, j) for i, j in zip(r[ok], c[ok])} == want


def test_footrule_of_inverted_files():
    rng = np.random.default_rng(1)
    lists = np.stack([rng.permutation(20)[:6] for _ in range(50)]).astype(np.uint8)
    files = ann.inverted_files(lists, 20)
    got = ann.footrules(lists[0], *files, 50)
    for i in range(50):
        a, b = ({p: k for k, p in enumerate(row.tolist())} for row in (lists[0], lists[i]))
        assert got[i] == sum(abs(a.get(p, 6) - b.get(p, 6)) for p in set(a) | set(b))


def test_ftrl_learns_and_is_sparse():
    rng = np.random.default_rng(3)
    rows, y = [], []
    for k in range(600):
        noise = rng.integers(10, 400, 30)
        rows.append(np.unique(np.append(noise, k % 3) if k % 2 else noise))
        y.append(float(k % 2))
    w, w0 = toxicity.ftrl(rows, np.array(y), 400)
    right = np.mean([(w[r].sum() + w0 >= 0) == (t > 0) for r, t in zip(rows, y)])
    assert right > 0.98 and (w != 0).sum() < 200


def test_thresholds_need_precision():
    rows = [("card", 0.9, True)] * 9 + [("card", 0.5, False)] * 5 + [("phone", 0.8, False)] * 4
    assert pii.calibrate(rows) == {"card": 0.9}


def test_a_small_machine_forgets_and_agrees(ranks):
    """Moves beyond the limit are forgotten, also within a text; the ids stay the same."""
    table = bpe.read_ranks(ranks)
    whole, small = bpe.Transducer(table), bpe.Transducer(table, max_pairs=50, flush_bytes=40, max_moves=30)
    for piece in (b" unbelievable", b"antidisestablishmentarianism" * 20, bytes(range(256)) * 3, b"aaaaaaaa" * 40, b"x"):
        assert small.encode(piece) == whole.encode(piece)
        assert len(small.steps) <= 30


def test_plain_words_need_no_marks_taken_off(monkeypatch):
    """Words of ASCII letters go to the tokenizer without a look at their ends."""
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        encoder = packing.WordEncoder(f.read())
    looked = []
    core = encoder._core
    monkeypatch.setattr(encoder, "_core", lambda word: looked.append(word) or core(word))
    text = "Plain words only, Éa words plain ONLY"
    assert encoder.encode([text]) == [packing.pack_ids(encoder.tokenizer.encode(text, add_special_tokens=False).ids)]
    assert sorted(looked) == ["only,", "Éa"]


def test_repeated_values_in_little_memory():
    import tracemalloc
    rng = np.random.default_rng(5)
    for values in (rng.integers(0, 300_000, 400_000, dtype=np.uint32), np.zeros(0, np.uint32), np.array([3, 3], np.uint32), np.full(9, 7, np.uint32)):
        names, seen = np.unique(values, return_counts=True)
        tracemalloc.start()
        got = toxicity.repeated(values, 3)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert got.tolist() == names[seen >= 3].tolist() and peak < 1.2 * values.nbytes + 10_000
