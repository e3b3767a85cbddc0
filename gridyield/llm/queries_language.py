"""Query of the language identification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridyield.llm.common import table
from gridyield.llm.language_id import bucket, learn, predicted

HELD_OUT = 2


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    profiles = learn(docs.where(bucket() != HELD_OUT))
    return docs.select("doc_id", (bucket() == HELD_OUT).alias("held_out"), predicted(profiles).alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score")
    )
