"""Line dedup by a log-template tree.

Lines are parsed as log records are: a tree of fixed depth branches on the
number of tokens and on the leading tokens, where tokens with digits count as
a variable field.  In a leaf that recurs, the token that most lines have at a
place is a constant of the leaf's template and places without such a token
are variable; lines that agree with enough constants belong to the template.
The other lines have their own masked text as template.  A template that
recurs across unlike documents is boilerplate and its lines are dropped, except
in the document with the smallest id.  Short sentences recur by chance, long
passages do not: eight unlike documents are needed up to 14 words, fewer with
every word more, and two from 50 words on.

Copies of one document are not many documents: documents are counted by groups
of alike ones.  A document is alike to the first document with the same least
line hash, for any of eight hash functions, when half of their lines are the
same, one shared line (the one that is tested) left aside.  So no single line
decides, however low it hashes.
Lines are masked once and written; only the lines of recurring leaves go on, and
of them only hashes are shuffled, and the tokens of every distinct one.  A bit
map of fixed size holds the hashes of the recurring leaves, and later those of
the documents that lose lines.  It lets all of them through and few others, so
the lines and texts that stay as they are are not shuffled; a join follows that
is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorcast.llm.common import drop_stored, stored

DEPTH = 3
MIN_TOKENS = 3
MIN_DOCS = 8
# a template of so many tokens recurs when two unlike documents have it
LONG_TOKENS = 50
# alike documents are looked for by the least line hash of so many hash functions
SKETCHES = 8
# lines of a document that are compared, those with the least hashes
COMPARED = 64
# a constant is the token of more than this share of a leaf's lines
CONSTANT_SHARE = 0.5
# a line belongs to the leaf's template when it has this share of the tokens as constants
SIMILARITY = 0.7

# bits of the map of hashes (8 MB), in rows of F.bitmap_construct_agg's 32,768
MAP_BITS = 1 << 26
MAP_ROW_BITS = 1 << 15

_FIELD = "<*>"


def masked(lines: Column) -> Column:
    """Lines in lower case with their tokens between single blanks; tokens with digits are variable."""
    lower = F.transform(lines, lambda x: F.lower(x))
    blanks = F.transform(lower, lambda x: F.when(
        x.rlike(r"[\t\x0B\f\r\x00]|  "), F.regexp_replace(x, r"[ \t\x0B\f\r\x00]+", " ")).otherwise(x))
    fields = F.transform(blanks, lambda x: F.when(
        x.rlike("[0-9]"), F.regexp_replace(x, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", _FIELD)).otherwise(x))
    return F.transform(fields, lambda x: F.trim(x))


def _bit(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(MAP_BITS))


def _bit_map(hashes: DataFrame) -> DataFrame:
    """``(_map_row, _bits)``: the bits of a column ``hash``; at most ``MAP_BITS`` in all."""
    bit = _bit(F.col("hash"))
    return (hashes.where("hash is not null").groupBy(F.floor(bit / MAP_ROW_BITS).cast("int").alias("_map_row"))
            .agg(F.bitmap_construct_agg((bit % MAP_ROW_BITS).cast("long")).alias("_bits")))


def _marked(df: DataFrame, hashed: Column, bit_map: DataFrame) -> DataFrame:
    """The rows with a new column ``_marked``: true where the hash may be in the map."""
    bit = _bit(hashed)
    place = (bit % MAP_ROW_BITS).cast("int")
    rows = df.withColumn("_map_row", F.floor(bit / MAP_ROW_BITS).cast("int")).join(F.broadcast(bit_map), "_map_row", "left")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return rows.withColumn("_marked", F.coalesce(F.getbit(byte, place % 8) == 1, F.lit(False))).drop("_map_row", "_bits")


def _lines(keyed: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, pos, line, size, leaf, own)`` of every line with
    enough tokens; ``line`` is masked, its tokens stand between single blanks."""
    # made before the lines are exploded, or else it would be made for every line; the outer kind, as there are
    # always lines and the other has the masking done twice, also in an inferred filter
    split = keyed.select("doc_id", "text_hash", masked(F.split("text", "\n")).alias("lines"))
    rows = split.select("doc_id", "text_hash", F.posexplode_outer("lines").alias("pos", "line"))
    size = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    rows = rows.withColumn("size", size).where(F.col("size") >= MIN_TOKENS)
    lead = F.concat_ws(" ", F.col("size").cast("string"), F.substring_index("line", " ", DEPTH))
    return rows.select("doc_id", "text_hash", "pos", "line", "size", F.xxhash64(lead).alias("leaf"),
                       F.xxhash64("line").alias("own"))


def _alike(keyed: DataFrame) -> DataFrame:
    """``(text_hash, group)`` of the texts that are alike to one with a smaller
    hash; any other text is a group of its own."""
    hashes = F.transform(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x))
    texts = keyed.select("text_hash", F.array_sort(F.array_distinct(hashes)).alias("hashes")).where(F.size("hashes") > 0)
    least = F.array(*[F.array_min(F.transform("hashes", lambda h, k=k: F.xxhash64(h, F.lit(k)))) for k in range(SKETCHES)])
    texts, texts_path = stored(texts.select("text_hash", F.slice("hashes", 1, COMPARED).alias("hashes"), least.alias("least")), "line-sets")
    # copies have the same text hash and are one row from here on
    places = texts.select("text_hash", F.posexplode("least").alias("k", "value")).distinct()
    firsts = (places.groupBy("k", "value").agg(F.min("text_hash").alias("first"), F.max("text_hash").alias("last"))
              .where("first <> last").select("k", "value", "first"))
    firsts, firsts_path = stored(firsts, "line-set-firsts")
    places, places_path = stored(places, "line-set-places")
    # written, so that a line that a third of all texts have as their least can be split in the join
    pairs, pairs_path = stored(places.join(firsts, ["k", "value"]).where("text_hash <> first").select("text_hash", "first").distinct(), "line-set-pairs")
    for path in (firsts_path, places_path):
        drop_stored(keyed.sparkSession, path)
    sets = texts.groupBy("text_hash").agg(F.first("hashes").alias("hashes"))
    met = (pairs.join(sets, "text_hash").withColumnRenamed("hashes", "a")
           .join(sets.select(F.col("text_hash").alias("first"), F.col("hashes").alias("b")), "first"))
    both = F.slice(F.array_sort(F.array_union("a", "b")), 1, COMPARED)
    same = F.size(F.array_intersect(both, F.array_intersect("a", "b")))
    alike, _ = stored(met.where((same - 1) * 2 >= F.size(both) - 1).groupBy("text_hash").agg(F.min("first").alias("group")), "alike")
    for path in (texts_path, pairs_path):
        drop_stored(keyed.sparkSession, path)
    # the first document may be alike to an earlier one
    up = alike.select(F.col("text_hash").alias("group"), F.col("group").alias("up"))
    return alike.join(up, "group", "left").select("text_hash", F.coalesce("up", "group").alias("group"))


def _needed(min_docs: int) -> Column:
    """Unlike documents that a template of ``size`` tokens needs: ``min_docs`` for short ones, two for long ones."""
    return F.greatest(F.lit(min(2, min_docs)), F.least(F.lit(min_docs), F.ceil(F.lit(2 * LONG_TOKENS) / F.col("size"))))


def _recurring(rows: DataFrame, alike: DataFrame, min_docs: int) -> DataFrame:
    """Templates with enough unlike documents: ``(template, first)``, the first document of each."""
    per = rows.groupBy("template", "size", "text_hash").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    per = (per.join(alike, "text_hash", "left").groupBy("template", "size", F.coalesce("group", "text_hash").alias("group"))
           .agg(F.min("first").alias("first")))
    return (per.groupBy("template", "size").agg(F.count(F.lit(1)).alias("unlike"), F.min("first").alias("first"))
            .where(F.col("unlike") >= _needed(min_docs)).select("template", "first"))


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(doc_id, text_hash, drops)``: line numbers to drop, for documents that have some."""
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("text_hash", F.xxhash64("text")).where("text <> ''")
    lines, lines_path = stored(_lines(keyed), "lines")

    alike, _ = stored(_alike(keyed), "alike-groups")

    # a template recurs in a leaf that recurs: the lines of other leaves are done with
    leaves, leaves_path = stored(lines.select("leaf", "size", "text_hash").distinct().groupBy("leaf", "size").agg(F.count(F.lit(1)).alias("texts"))
                       .where(F.col("texts") >= _needed(min_docs)).select("leaf"), "leaves")
    leaf_map, leaf_map_path = stored(_bit_map(leaves.select(F.col("leaf").alias("hash"))), "leaf-map")
    maybe = _marked(lines, F.col("leaf"), leaf_map).where("_marked").drop("_marked")
    leaf_lines, leaf_lines_path = stored(maybe.join(leaves, "leaf", "left_semi"), "leaf-lines")
    for path in (lines_path, leaves_path, leaf_map_path):
        drop_stored(docs.sparkSession, path)
    shapes = (leaf_lines.groupBy("leaf", "own").agg(F.count(F.lit(1)).alias("n"), F.first("line").alias("line"))
              .select("leaf", "own", "n", F.split("line", " ").alias("tokens")))
    shapes, shapes_path = stored(shapes, "shapes")
    placed = shapes.select("leaf", "n", F.posexplode("tokens").alias("place", "token"))
    counted = placed.groupBy("leaf", "place", "token").agg(F.sum("n").alias("n"))
    top = counted.groupBy("leaf", "place").agg(F.max(F.struct("n", "token")).alias("top"), F.sum("n").alias("total"))
    constants = (top.where(F.col("top.n") > F.col("total") * CONSTANT_SHARE)
                 .select("leaf", "place", F.col("top.token").alias("token")))
    agreeing = (shapes.select("leaf", "own", F.size("tokens").alias("size"), F.posexplode("tokens").alias("place", "token"))
                .join(constants, ["leaf", "place", "token"], "left_semi"))
    grouped = (agreeing.groupBy("leaf", "own", "size").agg(F.count(F.lit(1)).alias("same"))
               .where(F.col("same") >= F.col("size") * SIMILARITY).select("leaf", "own", F.lit(True).alias("in_leaf")))

    # a template is the leaf's or the line's own
    named = (leaf_lines.select("doc_id", "text_hash", "pos", "size", "leaf", "own").join(grouped, ["leaf", "own"], "left")
             .select("doc_id", "text_hash", "pos", "size",
                     F.when(F.col("in_leaf"), F.xxhash64(F.lit("leaf"), "leaf")).otherwise(F.xxhash64(F.lit("own"), "leaf", "own"))
                     .alias("template")))
    named, _ = stored(named, "templates")
    for path in (leaf_lines_path, shapes_path):
        drop_stored(docs.sparkSession, path)
    # written, so that a template that a third of all lines have can be split in the join
    repeated, _ = stored(_recurring(named,
                                    alike, min_docs), "repeated")
    out = (named.join(repeated, "template")
           .where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash")))))
    return out.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("drops"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows with recurring lines dropped from ``text``, and ``n_lines`` and
    ``n_dropped``.

    Blank lines and lines of fewer than three tokens are never dropped.  Null
    and empty texts stay as they are (no lines).  Rows that repeat a document
    are treated alike and count as one; a null ``doc_id`` is allowed and comes
    before all others.  Other columns stay (columns named ``n_lines`` or
    ``n_dropped`` are replaced); an empty table gives an empty result.
    """
    drops, _ = stored(dropped_lines(docs, min_docs).select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), F.col("drops").alias("_drops")), "drops")
    text_map, _ = stored(_bit_map(drops.select(F.xxhash64("_doc", "_hash").alias("hash"))), "drop-map")
    base = docs.withColumn("_text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    base = _marked(base, F.xxhash64("doc_id", "_text_hash"), text_map)
    # texts that lose no line are not moved
    whole = base.where("not _marked").drop("_marked")
    joined = base.where("_marked").drop("_marked").join(
        drops, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text_hash") == F.col("_hash")), "left")
    joined = joined.unionByName(whole, allowMissingColumns=True)
    lines = F.split("text", "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("_drops", i)), "\n")
    return (joined.withColumn("n_lines", F.when(F.length("text") > 0, F.size(lines)).otherwise(0).cast("long"))
            .withColumn("n_dropped", F.coalesce(F.size("_drops"), F.lit(0)).cast("long"))
            .withColumn("n_dropped", F.greatest("n_dropped", F.lit(0).cast("long")))
            .withColumn("text", F.when(F.col("_drops").isNotNull(), kept).otherwise(F.col("text")))
            .drop("_doc", "_hash", "_drops", "_text_hash"))


def digest(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, text_sha256)`` of every row; the digest is of the text kept."""
    done = dedup_lines(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
