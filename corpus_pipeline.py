"""Cleaning pipeline over ``documents``: language, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridyield.llm.common import written
from gridyield.llm.language_id import learn, reject_unknown
from gridyield.llm.ngram_join import link_documents
from gridyield.llm.packing import encode_pieces, pack_pieces
from gridyield.llm.suffix_dedup import removed_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
CONTEXT = 2048
#: Bytes of a repeated passage, and of the grams it is found by. Passages of fifty words have 250 bytes and more in these languages (247 to
#: 396 for those that repeat on the small table); a longer string would miss the shorter ones of them.
PASSAGE, PASSAGE_GRAM = 240, 64
KEPT_WORDS = 150_000  # of a worker, which keeps them while other stages run
BATCH_ROWS = 1000  # of texts that an executor and its Python workers hold at a time


def small_batches(spark: SparkSession) -> None:
    """Python workers get at most ``BATCH_ROWS`` rows at a time. A setting of the session, so it holds for what runs later too."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; null texts and texts without a letter go."""
    small_batches(spark)
    return reject_unknown(docs, learn(docs)).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest doc_id, of equal ones that with the smallest hash.

    Rows are judged by their texts, so rows that share a doc_id but no text stay apart, and rows without a doc_id
    take part and come last. Texts without a word are near duplicates of nothing; of rows that repeat in all columns one stays.
    """
    small_batches(spark)
    # A hash of the whole row, up to collisions of 64 bits, stands for the doc_id. Nulls leave a hash as it is, so where they are is hashed too.
    rows = docs.withColumn("_row", F.xxhash64(*COLUMNS, *(F.col(c).isNull() for c in COLUMNS)))
    linked = link_documents(rows, doc_id="_row").select(F.col("doc_id").alias("_row"), "component_id").distinct()
    ids = rows.select("_row", F.col("doc_id").isNull().alias("without"), "doc_id").distinct()
    first = ids.join(linked, "_row").groupBy("component_id").agg(F.min(F.struct("without", "doc_id", "_row")).alias("first"))
    return rows.join(first.select("first._row"), "_row", "left_semi").dropDuplicates(["_row"]).select(COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of ``PASSAGE`` bytes or more that occur elsewhere. Characters that a passage cuts in two go with it.

    Every row stays, also with a null or empty text; rows that repeat lose what they share; an empty table gives one.
    """
    small_batches(spark)
    kept = removed_repeats(docs, length=PASSAGE, gram=PASSAGE_GRAM, others=["lang", "source", "n_chars"])
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).withColumnRenamed("kept", "text").select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of CONTEXT tokens.

    A null or empty text is one piece, its end id. Rows that repeat are packed each; an empty table gives no pieces.
    """
    small_batches(spark)
    pieces = encode_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), CONTEXT, end_id=0, kept_words=KEPT_WORDS)
    return pack_pieces(pieces, CONTEXT)


STAGES = [
    ("language_id", language),
    ("ngram_join", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("best_fit_packing", packing),
]
#: Language profiles, suffix sorting and byte-pair encoding have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
