"""A training corpus out of documents: language, repeated lines, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and reads only its ``docs``; what it returns is
written and read again as the next one's. All but the last return the columns of
``documents``. Different texts under one key are documents of their own; of rows alike in key
and text, those up to line dedup share their fate, and near-duplicate removal keeps one.

Defined results: documents without a letter have no language and go first, which takes the
NULL and empty texts; documents of which line dedup leaves no line go then; documents with
a NULL key are of no group and stay; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.llm import language, line_dedup, minhash, queries
from skylag.operators.row_ids import with_row_id
from skylag.sources.tables import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language; the others are rejected."""
    labelled = docs.filter(F.col("doc_id").isNotNull() & ~language.held_out())
    chain = language.train(labelled)
    if chain is None:
        # Nothing to learn from is no evidence against a document; those with a letter stay.
        return docs.select(*COLUMNS).filter(F.col("text").rlike(r"\p{L}"))
    found = language.labelled(docs.select(*COLUMNS), chain)
    return found.filter(F.col("lang_pred") != language.UNKNOWN).select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages seen before; those that lose all their lines go."""
    found = line_dedup.without_repeats(docs.select(*COLUMNS), min_words=queries.PASSAGE_WORDS)
    changed = F.col("n_removed") > 0
    found = found.filter(~changed | (F.trim("text") != ""))
    count = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", count).select(*COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of each group that shares four fifths of its five-word shingles."""
    # Rows go by a number of their own in the order of their keys, since keys may repeat.
    rows = docs.select(*COLUMNS, F.xxhash64("text").alias("__text"))
    rows = materialize(with_row_id(rows, ["doc_id", "__text"], "__row"), "numbered")
    number = F.when(F.col("doc_id").isNotNull(), F.col("__row")).alias("__row")
    found = minhash.near_duplicates(rows.select(number, "text"), key="__row", words=5, percent=80)
    gone = found.filter("NOT kept").select("__row")
    return rows.join(gone, "__row", "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the documents in sequences of 4096 tokens."""
    return queries.packed_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", without_repeated_lines),
    ("minhash_near_dedup", without_near_duplicates),
    ("best_fit_packing", packed),
]

# Language identification and packing have no SQL twin; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, name)
    return docs
