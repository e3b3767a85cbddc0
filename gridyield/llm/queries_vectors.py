"""Queries over the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridyield.llm.common import table
from gridyield.llm.embedding_dedup import linked_vectors
from gridyield.llm.nearest import nearest_neighbours


def op1_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linked_vectors(table(spark, folder, "embeddings"))


def op4_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_neighbours(table(spark, folder, "embeddings"), every=100, k=10)
