"""The registered queries of the corpus operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorcast.llm import (ann, bpe, collocations, edit_counts, embedding_dedup, exact_dedup, licenses, line_dedup, minhash, packing,
                            periodic_runs, pii, toxicity)
from sensorcast.llm.common import table

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"


def public_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(table(spark, sf_dir, "documents"), public_file(WORD_VOCABULARY), with_ids=False)


def op3_ann_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_file(BYTE_RANKS), _pattern())


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def edits_of(docs: DataFrame) -> DataFrame:
    """Stand-in edits of every document, in the schema that the operator
    expects: a deletion, a replacement and an insertion at places spread by
    hashes of the id."""
    place = F.pmod(F.xxhash64("doc_id", "seq"), F.greatest(F.length("text"), F.lit(1))).cast("int")
    cut = F.pmod(F.xxhash64("seq", "doc_id"), F.lit(40)).cast("int")
    return (docs.where("text is not null").select("doc_id", "text", F.explode(F.array(*map(F.lit, (0, 1, 2)))).alias("seq"))
            .select("doc_id", "seq", place.alias("start"), (place + F.when(F.col("seq") < 2, cut).otherwise(0)).alias("stop"),
                    F.when(F.col("seq") > 0, F.concat(F.lit(" edited"), F.col("seq"), F.lit(" text")))
                    .otherwise("").alias("replacement")))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return edit_counts.count_edited(docs, edits_of(docs), public_file(BYTE_RANKS), _pattern())


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP11_SQL = """WITH t AS (SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
      FROM w, (SELECT unnest([1, 2, 3, 4]) AS k)),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 30),
cuts AS (SELECT f.lang, f.k, f.phrase, f.f AS a, c.cut, string_split(f.phrase, ' ') AS ws FROM f, (SELECT unnest([1, 2, 3]) AS cut) c WHERE c.cut < f.k),
sides AS (SELECT c.lang, c.k, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * c.a // (x.f + y.f) AS score FROM cuts c
      JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.cut], ' ')
      JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.cut + 1:], ' ')),
best AS (SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
subs AS (SELECT lang, k, f, string_split(phrase, ' ') AS ws, s.size, unnest(range(1, k - s.size + 2)) AS i
      FROM f, (SELECT unnest([2, 3]) AS size) s WHERE f.k > s.size),
cover AS (SELECT lang, array_to_string(ws[i:i + size - 1], ' ') AS phrase, max(f) AS longer FROM subs GROUP BY ALL),
ranked AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, b.l, b.r, n.n,
      CAST(b.score AS BIGINT) AS score
      FROM best b JOIN n USING (lang) LEFT JOIN cover c ON c.lang = b.lang AND c.phrase = b.phrase
      WHERE c.longer IS NULL OR CAST(100 AS HUGEINT) * c.longer < CAST(80 AS HUGEINT) * b.a)
SELECT * FROM ranked WHERE rank <= 2000"""


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``; in every tenth document by crc32 of the id the words
    from a chosen place on repeat a chosen number of words.  Texts with a null
    id stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    arranged = docs.where(h % 10 == 0).select("doc_id", "text", words.alias("_w"), n.cast("long").alias("_n"), g.cast("long").alias("_g"))
    a = F.col("_g") % F.col("_n")
    p = 1 + F.floor((F.col("_n") - a) / (3 + F.col("_g") % 8))
    head = F.slice("_w", F.lit(1), a.cast("int"))
    cycle = F.slice("_w", (a + 1).cast("int"), p.cast("int"))
    whole = F.slice(F.concat(head, F.flatten(F.array_repeat(cycle, F.ceil((F.col("_n") - a) / p).cast("int")))), F.lit(1), F.col("_n").cast("int"))
    return docs.where((h % 10 != 0) | h.isNull()).select("doc_id", "text").unionByName(
        arranged.select("doc_id", F.when(F.col("_n") > 0, F.concat_ws(" ", whole)).otherwise(F.col("text")).alias("text")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(with_planted_periods(table(spark, sf_dir, "documents")))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


OP13_SQL = """WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)"""


QUERIES = {f.__name__: f for f in (
    op1_embedding_near_dedup, op2_best_fit_packing, op3_ann_permutation, op4_pii, op5_toxicity, op6_minhash_near_dedup, op7_line_dedup, op8_byte_bpe, op9_license_scan,
    op10_token_counts, op11_phrase_collocations, op12_periodic_runs, op13_exact_dedup)}
ORACLE: dict[str, str] = {"op11_phrase_collocations": OP11_SQL, "op13_exact_dedup": OP13_SQL}
