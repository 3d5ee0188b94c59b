"""Exact dedup with Patricia tries that own texts.

Rows are dealt by length and content hash; each task inserts the full byte
strings that it gets into one compressed radix trie.  A terminal node stands
for one text and stores its owner, so two rows are equal only if all their
bytes led to the same node; the hash only deals rows out.

* The copies of one task meet first in a trie of their own: one row for each
  text goes on, so a text that fills a third of the table reaches the dealt
  tries once per input task.  A key that still has many rows is merged in
  groups of about their square root first.
* A trie holds at most ``memory_bytes``.  Beyond that its heaviest subtree is
  spilled: its texts, and all later ones that would go there, are handed on as
  rows and meet in a task of the next round, dealt by subtree.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorcast.llm.common import drop_stored, stored

MEMORY_BYTES = 96 << 20
BATCH_BYTES = 4 << 20
NODE_BYTES = 400
# A key is merged in groups first if it has more representatives than this and
# than one in HOT_SHARE of all, so at most HOT_SHARE keys are.
HOT_ROWS, HOT_SHARE = 64, 10_000
MAX_ROUNDS = 60
_NO_ID = -(1 << 63)


class Node:
    """``label`` leads here from the parent; a terminal node has a ``best`` entry."""

    __slots__ = ("label", "kids", "best", "count", "members")

    def __init__(self, label: bytes):
        self.label, self.kids, self.best, self.count, self.members = label, {}, None, 0, None


class Spilled:
    """Takes the place of a subtree that was handed on."""

    __slots__ = ("label", "key")

    def __init__(self, label: bytes, key: int):
        self.label, self.key = label, key


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Trie:
    """A radix trie of byte strings; ``smallest`` decides which entry owns a text.

    Entries are ``(id, row)``.  The owner is the one with the smallest id (or
    the largest), then the smallest row.
    """

    def __init__(self, smallest: bool = True):
        self.root, self.size, self.smallest = Node(b""), 0, smallest

    def add(self, text: bytes, entry: tuple[int, int], count: int, members: list[int]) -> Node | Spilled:
        """The terminal node of ``text`` after the insertion, or the spilled
        subtree that it belongs to (then nothing is stored)."""
        node, at, end = self.root, 0, len(text)
        while at < end:
            kid = node.kids.get(text[at])
            if kid is None:
                kid = node.kids[text[at]] = Node(text[at:])
                self.size += NODE_BYTES + end - at
                node = kid
                break
            if isinstance(kid, Spilled):
                return kid
            if text.startswith(kid.label, at):
                at += len(kid.label)
                node = kid
                continue
            n = _common(kid.label, text[at:at + len(kid.label)])
            mid = node.kids[text[at]] = Node(kid.label[:n])
            kid.label = kid.label[n:]
            mid.kids[kid.label[0]] = kid
            self.size += NODE_BYTES
            node, at = mid, at + n
        if node.best is None:
            node.best, node.count, node.members = entry, count, members
        else:
            if (entry[0] < node.best[0] if self.smallest else entry[0] > node.best[0]) or (
                    entry[0] == node.best[0] and entry[1] < node.best[1]):
                node.best = entry
            node.count += count
            node.members.extend(members)
        self.size += 8 * len(members)
        return node

    def terminals(self, node: Node | None = None, path: bytes = b"") -> Iterator[tuple[bytes, Node]]:
        """All terminal nodes below ``node`` with their text; no recursion, as tries can be deep."""
        todo = [(node or self.root, path)]
        while todo:
            node, path = todo.pop()
            if node.best is not None:
                yield path, node
            todo.extend((kid, path + kid.label) for kid in node.kids.values() if isinstance(kid, Node))

    def _weight(self, node: Node) -> int:
        return sum(NODE_BYTES + len(x.label) + 8 * len(x.members or ()) for x in self._below(node))

    def _below(self, node: Node) -> Iterator[Node]:
        todo = [node]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(kid for kid in node.kids.values() if isinstance(kid, Node))

    def spill(self) -> Iterator[tuple[int, bytes, Node]]:
        """Cut off the heaviest subtree at the first branching; its key, texts and nodes."""
        node, path = self.root, b""
        while True:
            live = [kid for kid in node.kids.values() if isinstance(kid, Node)]
            if not live or len(live) == 1 and node.best is None and not live[0].kids:
                return  # a single text stays, however long
            if len(live) > 1 or node.best is not None:
                break
            node, path = live[0], path + live[0].label
        weight, _, kid = heapq.nlargest(1, ((self._weight(k), k.label[0], k) for k in live), key=lambda x: x[:2])[0]
        key = int.from_bytes(hashlib.blake2b(path + kid.label[:1], digest_size=8).digest(), "little", signed=True)
        node.kids[kid.label[0]] = Spilled(kid.label[:1], key)
        self.size -= weight
        for text, below in self.terminals(kid, path + kid.label):
            yield key, text, below


# --- rows of the first pass: one for every input row, and one with the text for each text of a task (then ``sha256`` is null)
ROWS = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("rep", pa.int64()), ("sha256", pa.string()), ("n", pa.int64()),
                  ("length", pa.int64()), ("hash", pa.int64()), ("text", pa.binary())])
ROWS_DDL = "doc_id long, row long, rep long, sha256 string, n long, length long, hash long, text binary"


def _cut(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _hash(text: bytes) -> int:
    return int.from_bytes(hashlib.sha256(text).digest()[:8], "little", signed=True)


def _local(smallest: bool, memory_bytes: int):
    """Number the rows of a task and find its copies: ``rep`` is the row that
    first had the text.  A full trie is given out and begun anew, which only
    lets more than one row of a text go on."""
    none = (1 << 63) - 1 if smallest else _NO_ID

    def run(batches):
        task = TaskContext.get().partitionId() << 33
        trie, n, out, size = Trie(smallest), 0, [], 0
        for batch in _ended(batches):
            if batch is not None:
                text_col = batch.column("text").fill_null("")
                texts = pc.ascii_lower(text_col).cast(pa.binary() if pa.types.is_string(text_col.type) else pa.large_binary()).to_pylist()
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                    row, n = task + n, n + 1
                    node = trie.add(text, (none if doc_id is None else doc_id, row), 1, [])
                    if not node.members:
                        node.members.append(row)
                    out.append((doc_id, row, node.members[0], hashlib.sha256(text).hexdigest(), None, None, None, None))
                yield _cut(out, ROWS)
                out = []
            if batch is None or trie.size > memory_bytes:
                for text, node in trie.terminals():
                    doc_id, row = node.best
                    out.append((None if doc_id == none else doc_id, row, node.members[0], None, node.count, len(text), _hash(text), text))
                    size += len(text) + 200
                    if size > BATCH_BYTES:
                        yield _cut(out, ROWS)
                        out, size = [], 0
                yield _cut(out, ROWS)
                trie, out, size = Trie(smallest), [], 0
    return run


def _ended(batches):
    """The batches, then None."""
    yield from batches
    yield None


# --- rows of the tries: representatives go in; texts come out with their owner, or are handed on
REPS = pa.schema([("subtree", pa.int64()), ("length", pa.int64()), ("hash", pa.int64()), ("text", pa.binary()), ("id", pa.int64()),
                  ("row", pa.int64()), ("n", pa.int64()), ("members", pa.list_(pa.int64()))])
REPS_DDL = "subtree long, length long, hash long, text binary, id long, row long, n long, members array<long>"


def _owners(smallest: bool, memory_bytes: int, with_text: bool):
    """Insert the rows of a task; rows with a null ``subtree`` are done, the others go on."""
    none = (1 << 63) - 1 if smallest else _NO_ID

    def run(batches):
        trie, out, size = Trie(smallest), [], 0

        def entry(text, key, best, count, members, full):
            return (key, len(text), _hash(text), text if full else None, None if best[0] == none else best[0], best[1], count, members)
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("text", "id", "row", "n", "members")]
            for text, doc_id, row, n, members in zip(*cols):
                best = (none if doc_id is None else doc_id, row)
                node = trie.add(text, best, n, members)
                if isinstance(node, Spilled):
                    out.append(entry(text, node.key, best, n, members, True))
                    size += len(text) + 8 * len(members) + 100
                while trie.size > memory_bytes:
                    before = trie.size
                    for key, spilled, node in trie.spill():
                        out.append(entry(spilled, key, node.best, node.count, node.members, True))
                        size += len(spilled) + 8 * len(node.members) + 100
                        if size > BATCH_BYTES:
                            yield _cut(out, REPS)
                            out, size = [], 0
                    if trie.size == before:
                        break
                if size > BATCH_BYTES:
                    yield _cut(out, REPS)
                    out, size = [], 0
        for text, node in trie.terminals():
            out.append(entry(text, None, node.best, node.count, node.members, with_text))
            size += len(text) * with_text + 8 * len(node.members) + 100
            if size > BATCH_BYTES:
                yield _cut(out, REPS)
                out, size = [], 0
        yield _cut(out, REPS)
    return run


def _merged(reps: DataFrame, by: list, smallest: bool, memory_bytes: int, with_text: bool) -> tuple[DataFrame, list[str]]:
    """Owners of all texts in ``reps``: the tries of one round after the other
    until nothing is spilled.  Also the paths of the tables that hold them."""
    done, paths = None, []
    for _ in range(MAX_ROUNDS):
        out, path = stored(reps.select(*REPS.names, *by).repartition(*by).select(*REPS.names)
                           .mapInArrow(_owners(smallest, memory_bytes, with_text), REPS_DDL), "trie-owners")
        paths.append(path)
        part = out.where("subtree is null")
        done = part if done is None else done.unionByName(part)
        reps, by = out.where("subtree is not null"), ["subtree"]
        if reps.isEmpty():
            return done, paths
    raise RuntimeError(f"tries of {memory_bytes} bytes did not settle in {MAX_ROUNDS} rounds")


def exact_duplicates(docs: DataFrame, keep: str = "smallest", memory_bytes: int = MEMORY_BYTES) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per input row.

    Texts are equal when identical after lower-casing A-Z; null is empty.  Of
    equal texts the row with the smallest ``doc_id`` stays (``keep="largest"``:
    the largest); of rows that repeat that id exactly one stays.  A null id
    stays only where the whole group has none, and is then ``keep_id``.  Rows
    are never dropped; an empty table gives an empty result; other columns are
    not read, whatever their names.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    smallest, spark = keep == "smallest", docs.sparkSession
    made, made_path = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                             .mapInArrow(_local(smallest, memory_bytes), ROWS_DDL), "trie-rows")
    rows = made.where("sha256 is not null")
    firsts = made.where("sha256 is null")
    reps = firsts.select(F.lit(None).cast("long").alias("subtree"), "length", "hash", "text", F.col("doc_id").alias("id"), "row", "n",
                         F.array("rep").alias("members"))
    total = firsts.count()
    hot = firsts.groupBy("length", "hash").agg(F.count(F.lit(1)).alias("reps")).where(F.col("reps") > max(HOT_ROWS, total // HOT_SHARE))
    hot, hot_path = stored(hot, "trie-hot")
    paths = [made_path, hot_path]
    if not hot.isEmpty():
        marked = reps.join(F.broadcast(hot), ["length", "hash"], "left")
        groups = F.ceil(F.sqrt("reps"))
        first, more = _merged(marked.where("reps is not null").withColumn("salt", F.pmod(F.xxhash64("row"), groups)),
                              ["length", "hash", "salt"], smallest, memory_bytes, True)
        paths += more
        reps = marked.where("reps is null").select(*REPS.names).unionByName(first)
    owners, more = _merged(reps, ["length", "hash"], smallest, memory_bytes, False)
    paths += more
    classes = owners.select(F.explode("members").alias("rep"), F.col("id").alias("keep_id"), F.col("row").alias("keep_row"),
                            F.col("n").alias("group_size"))
    done, _ = stored(rows.select("doc_id", "row", "rep", "sha256").join(classes, "rep").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha256").alias("text_sha256")), "trie-done")
    for path in paths:
        drop_stored(spark, path)
    return done


def drop_duplicates(docs: DataFrame, keep: str = "smallest", memory_bytes: int = MEMORY_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    One whole row for each kept text: of rows that repeat an id and a text one
    stays.  Rows with a null id stay only where no row of their text has an id.
    """
    found = exact_duplicates(docs, keep, memory_bytes).where("kept").select(
        F.col("doc_id").alias("_keep_id"), F.col("text_sha256").alias("_keep_sha"))
    lower = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    names = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").cast("long").alias("_id"),
                        F.sha2(lower, 256).alias("_sha"))
    once = (keyed.join(found, F.col("_id").eqNullSafe(F.col("_keep_id")) & (F.col("_sha") == F.col("_keep_sha")), "left_semi")
            .groupBy("_id", "_sha").agg(F.first("_row").alias("_row")))
    return once.select(*[F.col("_row").getField(c).alias(c) for c in names])
