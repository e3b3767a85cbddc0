"""Query of the n-gram Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridyield.llm.common import table
from gridyield.llm.ngram_join import link_documents


def op6_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return link_documents(table(spark, folder, "documents"))
