"""Query of the SentencePiece encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridyield.llm.common import table
from gridyield.llm.sentence_pieces import decoded, encode

MODEL = "piece_bpe_32k.model"


def op3_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path(MODEL)
    rows = encode(table(spark, folder, "documents"), model)
    text = decoded(F.col("ids"), model)
    return rows.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", (F.crc32(text.cast("binary")) == F.col("text_crc32")).alias("round_trip")
    )
