"""Query of the suffix-array deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridyield.llm.common import table
from gridyield.llm.suffix_dedup import removed_repeats


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return removed_repeats(table(spark, folder, "documents"))
