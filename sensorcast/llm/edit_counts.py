"""Token counts that follow edits.

A document is kept as the leaves of a segment tree, its pre-tokens with their
number of characters and of tokens; inner nodes hold the sums.  An edit finds
its place by walking down the sums, pre-tokenizes again from the last border
that the edit cannot have moved up to the first old border behind it where the
two cuts meet, encodes what is new there, and replaces the leaves.  Everything
outside keeps its counts.

:func:`build_trees` keeps the leaves of all documents as a table and
:func:`apply_edits` turns that table into the one after some edits: documents
without edits pass as they are, and of the edited ones only the regions around
the edits are encoded.  :func:`count_edited` does both in one pass where no
table is kept.
"""

from __future__ import annotations

import hashlib
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorcast.llm.bpe import worker_coder
from sensorcast.llm.common import text_slices

# leaves of the tree hold about this many pre-tokens
NODE_ITEMS = 128
# a match of the pattern looks at most this many characters past its end
LOOKAHEAD = 1
_EDIT = "array<struct<seq:int,start:int,stop:int,replacement:string>>"


class SumTree:
    """Sums of (characters, tokens) over blocks, with point updates in
    logarithmic time (every node holds the sum of its two children)."""

    def __init__(self, values: list[tuple[int, int]]):
        self.size = 1
        while self.size < max(1, len(values)):
            self.size *= 2
        self.sums = [(0, 0)] * (2 * self.size)
        self.sums[self.size:self.size + len(values)] = values
        for i in range(self.size - 1, 0, -1):
            self._pull(i)

    def _pull(self, i: int) -> None:
        a, b = self.sums[2 * i], self.sums[2 * i + 1]
        self.sums[i] = a[0] + b[0], a[1] + b[1]

    def set(self, at: int, value: tuple[int, int]) -> None:
        i = at + self.size
        self.sums[i] = value
        while i > 1:
            i //= 2
            self._pull(i)

    @property
    def total(self) -> tuple[int, int]:
        return self.sums[1]

    def find(self, char: int) -> tuple[int, int]:
        """The block that holds a character, and the characters before it."""
        i, before = 1, 0
        while i < self.size:
            left = self.sums[2 * i][0]
            i *= 2
            if char >= before + left and self.sums[i + 1][0] > 0:
                before += left
                i += 1
        return i - self.size, before


class EditedDocument:
    """A text with its token count, kept under edits.

    ``cut`` is the compiled pre-token pattern, ``count`` gives the number of tokens of a pre-token and ``count_all``
    those of many.  With ``kept``, the lengths and token counts of the text's pre-tokens as :meth:`leaves` gave them,
    nothing is cut or encoded.  The text itself is kept in the blocks, so that an edit copies a block and not the document.
    """

    def __init__(self, text: str, cut, count, count_all=None, kept: tuple[list[int], list[int]] | None = None):
        self.cut, self.count = cut, count
        if kept is None:
            items = cut.findall(text)
            counts = count_all(items) if count_all else list(map(count, items))
        else:
            ends = list(accumulate(kept[0]))
            items = [text[i:j] for i, j in zip([0] + ends, ends)]
            counts = kept[1]
        self.blocks = [items[i:i + NODE_ITEMS] for i in range(0, len(items), NODE_ITEMS)] or [[]]
        self.counts = [counts[i:i + NODE_ITEMS] for i in range(0, len(items), NODE_ITEMS)] or [[]]
        self.encoded = 0
        self._build()

    def leaves(self) -> tuple[list[int], list[int]]:
        """Lengths in characters and token counts of the pre-tokens."""
        return [len(x) for b in self.blocks for x in b], list(chain.from_iterable(self.counts))

    def _build(self) -> None:
        self.tree = SumTree([(sum(map(len, b)), sum(c)) for b, c in zip(self.blocks, self.counts)])

    @property
    def n_tokens(self) -> int:
        return self.tree.total[1]

    @property
    def text(self) -> str:
        return "".join("".join(b) for b in self.blocks)

    def _item_at(self, char: int) -> tuple[int, int, int]:
        """(block, item, first character) of the pre-token that holds a character."""
        block, at = self.tree.find(char)
        for i, item in enumerate(self.blocks[block]):
            if char < at + len(item):
                return block, i, at
            at += len(item)
        return block, len(self.blocks[block]), at

    def edit(self, start: int, stop: int, replacement: str) -> None:
        """Replace the characters from ``start`` to before ``stop``; places
        outside the text are moved to its ends."""
        total = self.tree.total[0]
        start = min(max(start, 0), total)
        stop = min(max(stop, start), total)
        if start == stop and not replacement:
            return
        # pre-tokens that end at least two characters before the edit have not seen it
        block, item, first = self._item_at(max(0, start - LOOKAHEAD - 1))
        if first + (len(self.blocks[block][item]) if item < len(self.blocks[block]) else 0) <= start - LOOKAHEAD - 1:
            first += len(self.blocks[block][item])
            item += 1
        head = self.blocks[block][:item]
        head_counts = self.counts[block][:item]
        # old pre-tokens from there on, read as far as needed
        old = []
        old_ends = []
        at, b, i = first, block, item
        reach = first

        def grow(until: int) -> None:
            nonlocal at, b, i
            while at < until or (b < len(self.blocks) and not old):
                if b >= len(self.blocks):
                    return
                if i >= len(self.blocks[b]):
                    b, i = b + 1, 0
                    if b >= len(self.blocks):
                        return
                    continue
                old.append((self.blocks[b][i], self.counts[b][i]))
                at += len(self.blocks[b][i])
                old_ends.append(at)
                i += 1
        margin = 64
        while True:
            reach = min(total, stop + margin)
            grow(reach)
            region = "".join(x for x, _ in old)
            cut_at, cut_to = start - first, stop - first
            fresh = region[:cut_at] + replacement + region[cut_to:]
            shift = len(replacement) - (stop - start)
            ends = {e - first + shift: k for k, e in enumerate(old_ends) if e >= stop}
            done = at >= total
            new, pos, met = [], 0, None
            limit = len(fresh) if done else len(fresh) - 1 - LOOKAHEAD
            for m in self.cut.finditer(fresh):
                if m.end() > limit and not (done and m.end() == len(fresh)):
                    break
                new.append(m.group())
                pos = m.end()
                if pos >= cut_at + len(replacement) and pos in ends:
                    met = ends[pos]
                    break
            if met is not None or (done and pos == len(fresh)):
                break
            margin *= 4
        used = len(old) if met is None else met + 1
        self.encoded += len(new)
        self._replace(block, item, used, head, head_counts, new)

    def _replace(self, block: int, item: int, used: int, head: list, head_counts: list, new: list) -> None:
        b, left = block, used
        at = item
        while left > 0:
            here = len(self.blocks[b]) - at
            if left < here:
                at += left
                left = 0
            else:
                left -= here
                if left == 0:
                    at = len(self.blocks[b])
                    break
                b, at = b + 1, 0
        tail, tail_counts = self.blocks[b][at:], self.counts[b][at:]
        items = head + new + tail
        counts = head_counts + [self.count(x) for x in new] + tail_counts
        if len(items) <= 4 * NODE_ITEMS:
            self.blocks[block], self.counts[block] = items, counts
            for k in range(block + 1, b + 1):
                self.blocks[k], self.counts[k] = [], []
            for k in range(block, b + 1):
                self.tree.set(k, (sum(map(len, self.blocks[k])), sum(self.counts[k])))
        else:  # an overfull block is cut and the sums above are made again
            cuts = range(0, len(items), NODE_ITEMS)
            self.blocks[block:b + 1] = [items[i:i + NODE_ITEMS] for i in cuts]
            self.counts[block:b + 1] = [counts[i:i + NODE_ITEMS] for i in cuts]
            self._build()


class PieceCounter:
    """Number of tokens of pre-tokens, by the byte-pair transducer."""

    def __init__(self, ranks: bytes, pattern: str, limit: int = 400_000):
        import regex
        self.coder = worker_coder(ranks, pattern)
        self.cut = regex.compile(pattern)
        self.limit = limit
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        return self.counts([piece])[0]

    def counts(self, pieces: list[str]) -> list[int]:
        if len(self.known) > self.limit:
            self.known = {}
        known, encode = self.known, self.coder.machine.encode
        for piece in set(pieces).difference(known):
            known[piece] = len(encode(piece.encode()))
        return list(map(known.__getitem__, pieces))


_COUNTERS: dict[tuple[bytes, str], PieceCounter] = {}


def worker_counter(ranks: bytes, pattern: str) -> PieceCounter:
    """The counter of this Python worker: later tasks find the pre-tokens of earlier ones."""
    key = hashlib.sha256(ranks).digest(), pattern
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = PieceCounter(ranks, pattern)
    return _COUNTERS[key]


def _edit_lists(edits: DataFrame) -> DataFrame:
    """``(doc_id, edits)``: the edits of a document in the order of ``seq``; null places and ids are left out."""
    return (edits.where("doc_id is not null and seq is not null and start is not null and stop is not null")
            .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.sort_array(F.collect_list(F.struct(
                F.col("seq").cast("int").alias("seq"), F.col("start").cast("int").alias("start"),
                F.col("stop").cast("int").alias("stop"), F.coalesce("replacement", F.lit("")).alias("replacement")
            ))).cast(_EDIT).alias("edits")))


def _ranks(spark, rank_path: str):
    with open(rank_path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())  # under 1 MB


_TREE = "doc_id long, text string, lengths array<int>, counts array<int>, n_tokens long, n_reencoded long"
_TREE_ARROW = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lengths", pa.list_(pa.int32())),
                         ("counts", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("n_reencoded", pa.int64())])


def _tree_rows(doc_ids, docs: list[EditedDocument]) -> pa.RecordBatch:
    leaves = [d.leaves() for d in docs]
    cols = [doc_ids, [d.text for d in docs], [x for x, _ in leaves], [c for _, c in leaves],
            [d.n_tokens for d in docs], [d.encoded for d in docs]]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, _TREE_ARROW)],
                                      schema=_TREE_ARROW)


def build_trees(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``(doc_id, text, lengths, counts, n_tokens, n_reencoded)``: the leaves of every document, to be written as a table.

    ``lengths`` and ``counts`` are the characters and tokens of the pre-tokens in order; ``n_reencoded`` is 0.  Null
    texts become empty ones, which have no leaves.  One output row per input row, in no shuffle; other columns are
    ignored, an empty table gives an empty result.
    """
    shared = _ranks(docs.sparkSession, rank_path)

    def run(batches):
        counter = worker_counter(shared.value, pattern)
        for batch in batches:
            for first, last, *_ in text_slices(batch):
                part = batch.slice(first, last - first)
                yield _tree_rows(part.column("doc_id"), [EditedDocument(t or "", counter.cut, counter.count, counter.counts)
                                                         for t in part.column("text").to_pylist()])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _TREE)


def apply_edits(trees: DataFrame, edits: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """The table of :func:`build_trees` after ``edits`` (as :func:`count_edited` reads them).

    Documents without edits pass as they are, with ``n_reencoded`` 0; for the others only pre-tokens that edits touch
    are cut and encoded again, and ``n_reencoded`` counts them.  Rows that repeat a document get the same edits; rows with
    a null id get none; edits of unknown documents are ignored.  An empty table of edits leaves the table unchanged.
    """
    shared = _ranks(trees.sparkSession, rank_path)
    names = ["doc_id", "text", "lengths", "counts", "n_tokens"]
    lists = _edit_lists(edits)
    rows = trees.select(*names).join(lists, "doc_id", "left")

    def run(batches):
        counter = worker_counter(shared.value, pattern)
        for batch in batches:
            for first, last, *_ in text_slices(batch):
                part = batch.slice(first, last - first)
                done = []
                for text, lengths, counts, changes in zip(*(part.column(n).to_pylist() for n in ("text", "lengths", "counts", "edits"))):
                    doc = EditedDocument(text, counter.cut, counter.count, kept=(lengths, counts))
                    for e in changes:
                        doc.edit(e["start"], e["stop"], e["replacement"])
                    done.append(doc)
                yield _tree_rows(part.column("doc_id"), done)
    edited = rows.where("edits is not null").select("doc_id", "text", "lengths", "counts", "edits").mapInArrow(run, _TREE)
    same = rows.where("edits is null").select(*names, F.lit(0).cast("long").alias("n_reencoded"))
    return same.unionByName(edited)


def count_edited(docs: DataFrame, edits: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, n_edits, n_tokens_after, n_pretokens, n_reencoded)``.

    ``edits`` has ``(doc_id, seq, start, stop, replacement)``: the characters
    from ``start`` to before ``stop`` of the text, as the edits of smaller
    ``seq`` left it, are replaced.  Places outside the text are moved to its
    ends, a null replacement deletes, null places and null ids are ignored.
    ``n_reencoded`` is the number of pre-tokens that edits had encoded again.

    Null and empty texts have no tokens until an edit inserts some.  Every
    input row gives one output row; rows that repeat a document get the same
    edits.  Other columns are ignored; an empty table gives an empty result.
    A document's edits are applied one after another and so stay together.
    """
    shared = _ranks(docs.sparkSession, rank_path)
    grouped = _edit_lists(edits)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(grouped, "doc_id", "left")
    names = ["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_pretokens", "n_reencoded"]

    def run(batches):
        counter = worker_counter(shared.value, pattern)
        for batch in batches:
            for first, last, *_ in text_slices(batch):
                part = batch.slice(first, last - first)
                out = [[] for _ in names[1:]]
                for text, changes in zip(part.column("text").to_pylist(), part.column("edits").to_pylist()):
                    doc = EditedDocument(text or "", counter.cut, counter.count, counter.counts)
                    before, pieces = doc.n_tokens, sum(map(len, doc.blocks))
                    for e in changes or []:
                        doc.edit(e["start"], e["stop"], e["replacement"])
                    for col, value in zip(out, (before, len(changes or []), doc.n_tokens, pieces, doc.encoded)):
                        col.append(value)
                yield pa.RecordBatch.from_arrays([part.column("doc_id")] + [pa.array(c, pa.int64()) for c in out], names=names)
    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))
