"""Queries of the token files and of packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridyield.llm.common import table
from gridyield.llm.packing import encode_pieces, pack_pieces
from gridyield.llm.token_files import read_tokens, write_tokens

TOKENIZER = "byte_bpe_50k.json"
CONTEXT = 2048


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return read_tokens(write_tokens(docs, public_tokenizers.path(TOKENIZER), end_id=2), digest=True)


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    pieces = encode_pieces(docs, public_tokenizers.path(TOKENIZER), CONTEXT, end_id=0)
    return pack_pieces(pieces, CONTEXT).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
