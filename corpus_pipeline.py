"""The corpus pipeline: each stage applies one operator to all rows that the
stage before kept.

toxicity (rejected documents go), line dedup (recurring lines go), MinHash
near-dedup (one document of each group stays), PII (spans are replaced) and
best-fit packing.  Stages get and return the columns of ``documents``; the
last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorcast.llm import line_dedup, minhash, packing, pii, toxicity
from sensorcast.llm.common import stored, table
from sensorcast.llm.queries import public_file, WORD_VOCABULARY

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject, unchanged.

    The model is fitted on labelled documents that are not held out; labels
    are no input of a decision.  Null and empty texts, null ids and repeated
    rows stay as they are; an empty table stays empty.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; recurring lines are cut out of the texts.  Null and empty
    texts, null ids and repeated rows stay; ``n_chars`` counts the new text."""
    done = line_dedup.dedup_lines(docs)
    return done.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
                           .cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group, unchanged: that with the smallest id.

    Of rows that repeat an id and a text one stays (the smallest of the other
    columns).  A row without an id belongs to the group of its text like any
    other, and stays only where no row of the group has an id; texts without
    words are alike to nothing, so of those each id and text stays once.
    """
    # ids for rows that have none, above all others and the same for equal texts
    made = F.lit(1 << 62) + F.pmod(F.xxhash64("text", F.lit("no id")), F.lit(1 << 60))
    rows = docs.select(*COLUMNS).withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), made))
    found = minhash.classified(rows.select(F.col("_id").alias("doc_id"), "text"))
    kept = found.where("first").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    once = (rows.withColumn("_hash", F.xxhash64("text")).join(kept, ["_id", "_hash"], "left_semi")
            .groupBy("_id", "_hash").agg(F.min(F.struct(*COLUMNS)).alias("r")))
    return once.select(*[F.col(f"r.{c}").alias(c) for c in COLUMNS])


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; spans of personal data are replaced by their kind.  Null
    and empty texts, null ids and repeated rows stay."""
    return pii.redact(docs).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in the sequences; a null or
    empty text is a piece of one token, and repeated rows are packed each."""
    return packing.best_fit_pack(docs, public_file(WORD_VOCABULARY), with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("best_fit_packing", pack),
]

# The classifier, the sketches and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; an empty table gives no pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
