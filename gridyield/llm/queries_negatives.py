"""Query of the hard negatives, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridyield.llm.common import table
from gridyield.llm.hard_negatives import hard_negatives


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, folder, "embeddings").withColumn("label", moved))


OP11_SQL = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scores as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_dot_product(a.v, b.v) as bigint) as score
  from rows a join rows b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
), positives as (
  select * from scores where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), negatives as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
         row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id) as rank
  from positives p join scores n on p.anchor_id = n.anchor_id and not n.same
  where 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from negatives where rank <= 10
"""
