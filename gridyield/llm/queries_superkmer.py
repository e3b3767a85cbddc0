"""Query of the removal of repeated word windows, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridyield.llm.common import table
from gridyield.llm.superkmer import removed_windows


def op12_superkmer_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return removed_windows(table(spark, folder, "documents"))


OP12_SQL = r"""
with words as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
  select r, doc_id, i, array_to_string(w[i:i + 12], ' ') as words
  from (select r, doc_id, w, unnest(range(1, len(w) - 11)) as i from words where len(w) >= 13)
), least as (
  select words, min(doc_id) as first_id from windows group by words
), gone as (
  select distinct r, unnest(range(i, i + 13)) as i from windows join least using (words) where first_id < doc_id
), kept as (
  select r, string_agg(word, ' ' order by i) as kept, count(*) as n
  from (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from words) x anti join gone using (r, i) group by r
)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256, coalesce(kept, '') as kept
from words left join kept using (r)
"""
