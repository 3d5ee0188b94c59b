"""Byte-level BPE as a lazily determinised finite-state transducer.

Byte-pair merging has two properties that make it a left-to-right machine: the
encoding of a prefix is fixed by its last token, and a token sequence is the
encoding of its bytes exactly when each two neighbours are (merging their
bytes gives the two back).  After some bytes only the encodings of prefixes
that end inside the longest suffix that can still grow into a token matter.
That suffix is the state of the transducer; a byte moves to the next state and
chooses the token that ends there.  What all open encodings have in common is
emitted, so the lookahead depends on the longest token only.  States and moves
are made when first met; there are at most as many as token prefixes.  Which of
the tokens is chosen depends on the last tokens inside the suffix; suffix and
tokens together are one state of the determinised machine, so that a byte met
there before costs one look-up.
"""

from __future__ import annotations

import base64
import hashlib
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorcast.llm.common import text_slices

# borders of token pairs that are kept
MAX_PAIRS = 400_000
# moves of the determinised machine that are kept
MAX_MOVES = 600_000
# a pre-token longer than this emits on the way
FLUSH_BYTES = 4096
MAX_PIECES = 400_000
DECODE_BLOCK = 8192


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 token, blank, rank per line)."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


_NEVER = 1 << 60


def merge(ranks: dict[bytes, int], data: bytes, stop: int = 1) -> list[bytes]:
    """The tokens of ``data`` by merging the pair of smallest rank again and
    again, until ``stop`` are left.  Quadratic; used on single tokens only."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > stop:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
        if rank == _NEVER:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """Encodes single pre-tokens; states and moves are filled lazily.

    A state is the longest suffix of the bytes read that can still grow into a
    token.  A move by one byte leads to the next state and lists the tokens
    that may end there, longest first.  ``last[i]`` is the last token of the
    encoding of the first ``i`` bytes: the one of those tokens whose border
    with ``last`` at its start holds.  The borders looked at lie inside the
    suffix, so ``last`` there and the state decide every later token; the two
    are a node of the determinised machine (``nodes``, ``steps``).  When it has
    too many moves it is forgotten but for the node it is in.  Encodings that
    can still go on pass through a position inside the state's suffix, so what
    they have in common before it is emitted and forgotten.
    """

    def __init__(self, ranks: dict[bytes, int], max_pairs: int = MAX_PAIRS, flush_bytes: int = FLUSH_BYTES,
                 max_moves: int = MAX_MOVES):
        self.ranks = ranks
        self.by_id = {i: t for t, i in ranks.items()}
        self.lengths = {i: len(t) for t, i in ranks.items()}
        self.prefixes = {t[:i] for t in ranks for i in range(1, len(t) + 1)}
        self.max_pairs, self.flush_bytes, self.max_moves = max_pairs, flush_bytes, max_moves
        self.states = [b""]
        self.numbers = {b"": 0}
        self.moves: list[dict[int, tuple[int, tuple]]] = [{}]
        self._whole: dict[bytes, bool] = {}
        self._spines: tuple[dict, dict] = ({}, {})
        self._pairs: dict[int, bool] = {}
        # the determinised machine: node -> (state, last tokens inside its suffix), node << 8 | byte -> node
        self.nodes: list[tuple[int, tuple[int, ...]]] = []
        self.tokens_at: list[int] = []
        self.node_numbers: dict[tuple[int, tuple[int, ...]], int] = {}
        self.steps: dict[int, int] = {}
        self._node((0, (-1,)))

    def _is_whole(self, token: bytes) -> bool:
        """Whether merging reaches the token from its bytes."""
        got = self._whole.get(token)
        if got is None:
            got = self._whole[token] = merge(self.ranks, token) == [token]
        return got

    def _spine(self, token: bytes, last: bool) -> tuple:
        """The tokens that the token's last (first) byte belongs to while the
        token is merged, each with the rank of the merge that ends it."""
        spines = self._spines[last]
        got = spines.get(token)
        if got is None:
            if len(token) == 1:
                got = ((token, _NEVER),)
            else:
                below = self._spine(merge(self.ranks, token, stop=2)[-1 if last else 0], last)
                got = below[:-1] + ((below[-1][0], self.ranks[token]), (token, _NEVER))
            spines[token] = got
        return got

    def _border(self, left: bytes, right: bytes) -> bool:
        """Whether no merge crosses the border between two whole tokens.

        Both sides grow in the order of the ranks; a merge of the two parts at
        the border happens when its rank comes before the next one on either
        side (of equal ranks the leftmost merge is first).
        """
        a, b = self._spine(left, True), self._spine(right, False)
        i = j = 0
        get = self.ranks.get
        while True:
            x, until_x = a[i]
            y, until_y = b[j]
            cross = get(x + y, _NEVER)
            if cross < until_x and cross <= until_y:
                return False
            if until_x <= until_y:
                if until_x == _NEVER:
                    return True
                i += 1
            else:
                j += 1

    def _move(self, state: int, byte: int) -> tuple[int, tuple]:
        grown = self.states[state] + bytes((byte,))
        ends = tuple((self.ranks[grown[i:]], len(grown) - i) for i in range(len(grown))
                     if grown[i:] in self.ranks and self._is_whole(grown[i:]))
        while grown not in self.prefixes:
            if not grown:
                raise ValueError(f"byte {byte} has no token")
            grown = grown[1:]
        to = self.numbers.get(grown)
        if to is None:
            to = self.numbers[grown] = len(self.states)
            self.states.append(grown)
            self.moves.append({})
        self.moves[state][byte] = to, ends
        return to, ends

    def _node(self, key: tuple[int, tuple[int, ...]]) -> int:
        node = self.node_numbers.get(key)
        if node is None:
            node = self.node_numbers[key] = len(self.nodes)
            self.nodes.append(key)
            self.tokens_at.append(key[1][-1])
        return node

    def _step(self, node: int, byte: int) -> int:
        """The node after a byte that was not met there: the longest token that
        fits the one before it ends here."""
        state, last = self.nodes[node]
        if len(self.steps) >= self.max_moves:
            # emptied in place, the first node and the present one stay
            for held in (self.steps, self.node_numbers, self.nodes, self.tokens_at):
                held.clear()
            self._node((0, (-1,)))
            node = self._node((state, last))
        if len(self._pairs) > self.max_pairs:
            self._pairs = {}
        pairs, by_id = self._pairs, self.by_id
        to, ends = self.moves[state].get(byte) or self._move(state, byte)
        for token, length in ends:
            left = last[-length]
            if left < 0:
                break
            key = left << 20 | token
            fits = pairs.get(key)
            if fits is None:
                fits = pairs[key] = self._border(by_id[left], by_id[token])
            if fits:
                break
        reached = self._node((to, (last + (token,))[-len(self.states[to]) - 1:]))
        self.steps[node << 8 | byte] = reached
        return reached

    def _chain(self, last: list[int], at: int) -> list[int]:
        """The ids that lead to a position."""
        out = []
        while at > 0:
            out.append(last[at])
            at -= self.lengths[last[at]]
        out.reverse()
        return out

    def _flush(self, last: list[int], width: int) -> tuple[list[int], list[int]]:
        """The ids that all open encodings begin with, and ``last`` after them."""
        n = len(last) - 1
        chains = [self._chain(last, i) for i in range(n - width, n + 1)]
        shared = 0
        while all(len(c) > shared for c in chains) and len({c[shared] for c in chains}) == 1:
            shared += 1
        out = chains[0][:shared]
        return out, last[sum(self.lengths[i] for i in out):]

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one pre-token.  A pre-token that is itself a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        known, tokens_at = self.steps.get, self.tokens_at
        last = [-1]
        node = 0
        if len(piece) <= self.flush_bytes:
            for byte in piece:
                to = known(node << 8 | byte)
                node = self._step(node, byte) if to is None else to
                last.append(tokens_at[node])
            return self._chain(last, len(piece))
        out: list[int] = []
        for byte in piece:
            to = known(node << 8 | byte)
            node = self._step(node, byte) if to is None else to
            last.append(tokens_at[node])
            if len(last) > self.flush_bytes:
                done, last = self._flush(last, len(self.nodes[node][1]) - 1)
                out += done
        return out + self._chain(last, len(last) - 1)


class Utf8Stream:
    """Incremental UTF-8: a state machine that holds back the bytes of an
    unfinished character until the next call.

    ``need`` is the number of continuation bytes still missing and ``low``,
    ``high`` the range of the next one, which rules out overlong forms,
    surrogates and values beyond U+10FFFF.
    """

    def __init__(self):
        self.held = b""

    @staticmethod
    def _lead(byte: int) -> tuple[int, int, int]:
        if byte < 0x80:
            return 0, 0, 0
        if 0xC2 <= byte <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= byte <= 0xEF:
            return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
        if 0xF0 <= byte <= 0xF4:
            return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
        return -1, 0, 0

    def feed(self, data: bytes) -> str:
        """The characters that ``data`` completes; ill-formed bytes become U+FFFD."""
        data = self.held + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            need, low, high = self._lead(data[-back])
            if need == -1 and data[-back] < 0xC0:
                continue  # a continuation byte: look further back
            if need >= back and (back == 1 or low <= data[1 - back] <= high):
                cut = len(data) - back
            break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


def _is_tight(run: str) -> bool:
    return bool(run) and not run[0].isspace() and not run[-1].isspace()


class ByteBpe:
    """Encoder and streaming decoder for whole texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_pieces: int = MAX_PIECES):
        import regex
        self.machine = Transducer(ranks)
        self.split = regex.compile(pattern).findall
        self.tokens = {i: t for t, i in ranks.items()}
        self.max_pieces = max_pieces
        self.known: dict[str, tuple[int, ...]] = {}
        self.known_pieces: dict[str, list[int]] = {}
        self._cut = re.compile(r"(?<=\S) (?=\S)").split

    def _encode_run(self, run: str) -> tuple[int, ...]:
        out: list[int] = []
        known = self.known_pieces
        for piece in self.split(run):
            ids = known.get(piece)
            if ids is None:
                ids = known[piece] = self.machine.encode(piece.encode())
            out += ids
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text.

        A single blank between two characters that are not white space always
        begins a match of the pattern, so the text is cut there and the ids of
        a run (with the blank before it) are kept.  Only runs that neither
        begin nor end with white space are kept; a text with another run at a
        plain cut is cut again at the right blanks.
        """
        runs = text.split(" ")
        known = self.known
        new = [run for run in set(runs).difference(known)]
        if not all(map(_is_tight, new)) and len(runs) > 1:
            runs = self._cut(text)
            new = [run for run in set(runs).difference(known)]
        loose = {run: self._encode_run(" " + run) for run in new if not _is_tight(run)}
        for run in new:
            if run not in loose:
                known[run] = self._encode_run(" " + run)
        out = list(self._encode_run(runs[0]))
        if loose:
            for run in runs[1:]:
                out += loose[run] if run in loose else known[run]
        else:
            out.extend(chain.from_iterable(map(known.__getitem__, runs[1:])))
        if len(known) > self.max_pieces:
            self.known = {}
        if len(self.known_pieces) > self.max_pieces:
            self.known_pieces = {}
        return out

    def decode_stream(self, ids: list[int], block: int = DECODE_BLOCK):
        """``(bytes, characters)`` of every ``block`` ids."""
        stream = Utf8Stream()
        get = self.tokens.__getitem__
        for i in range(0, len(ids), block):
            data = b"".join(map(get, ids[i:i + block]))
            yield data, stream.feed(data)
        tail = stream.close()
        if tail:
            yield b"", tail


_CODERS: dict[tuple[bytes, str], ByteBpe] = {}


def worker_coder(content: bytes, pattern: str) -> ByteBpe:
    """The coder of this Python worker: later tasks find the states and runs of earlier ones."""
    key = hashlib.sha256(content).digest(), pattern
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = ByteBpe(read_ranks(content), pattern)
    return _CODERS[key]


def _load(spark, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())  # under 1 MB, the vocabulary


def encode(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids)``: the ids of every whole text."""
    shared = _load(docs.sparkSession, rank_path)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        coder = worker_coder(shared.value, pattern)
        for batch in batches:
            for first, last, *_ in text_slices(batch):
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(
                    [coder.encode(t or "") for t in part.column("text").to_pylist()], schema.field("ids").type)],
                    schema=schema)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(coded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``(doc_id, text)`` of a table of ids."""
    shared = _load(coded.sparkSession, rank_path)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        coder = worker_coder(shared.value, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(
                ["".join(s for _, s in coder.decode_stream(ids or [])) for ids in batch.column("ids").to_pylist()],
                pa.string())], schema=schema)
    return coded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256, decoded_chars)``.

    Each text is encoded, its ids decoded block by block, and both digested in
    one pass, so that ids never leave the task.  Null and empty texts have no
    tokens.  One output row per input row; other columns are ignored, an empty
    table gives an empty result.
    """
    shared = _load(docs.sparkSession, rank_path)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string()), ("decoded_chars", pa.int64())])

    def run(batches):
        coder = worker_coder(shared.value, pattern)
        digits = {i: str(i) for i in coder.tokens}.__getitem__
        for batch in batches:
            for first, last, *_ in text_slices(batch):
                part = batch.slice(first, last - first)
                out = [[] for _ in range(4)]
                for text in part.column("text").to_pylist():
                    ids = coder.encode(text or "")
                    decoded, chars = hashlib.sha256(), 0
                    for data, string in coder.decode_stream(ids):
                        decoded.update(data)
                        chars += len(string)
                    row = (len(ids), hashlib.sha256(" ".join(map(digits, ids)).encode()).hexdigest(),
                           decoded.hexdigest(), chars)
                    for col, value in zip(out, row):
                        col.append(value)
                yield pa.RecordBatch.from_arrays([part.column("doc_id")] + [
                    pa.array(c, f.type) for c, f in zip(out, list(schema)[1:])], schema=schema)
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_chars long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ddl)
