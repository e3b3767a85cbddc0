"""Query of the collocations, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridyield.llm.collocations import collocations
from gridyield.llm.common import table


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


OP13_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents
), words as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), places as (
  select lang, w, unnest(range(1, len(w) + 1)) as i from words where len(w) > 0
), phrases as (
  select lang, w[i:i + m - 1] as p, count(*) as f from places, range(1, 5) s(m) where i + m - 1 <= len(w) group by 1, 2 having count(*) >= 30
), totals as (
  select lang, count(*) as n from places group by 1
), cuts as (
  select c.lang, c.p, c.f as a, k, l.f as l, r.f as r, (cast(c.f as hugeint) * 2000000) // (cast(l.f as hugeint) + r.f) as score
  from (select *, unnest(range(1, len(p))) as k from phrases where len(p) > 1) c
  join phrases l on l.lang = c.lang and l.p = c.p[1:k]
  join phrases r on r.lang = c.lang and r.p = c.p[k + 1:len(c.p)]
), best as (
  select * from cuts qualify row_number() over (partition by lang, p order by score, k) = 1
), inner_parts as (
  select lang, p[i:i + m - 1] as p, max(f) as longer
  from (select lang, p, f, m, unnest(range(1, len(p) - m + 2)) as i from phrases, range(2, 4) s(m) where len(p) > m) group by 1, 2
), kept as (
  select b.*, array_to_string(b.p, ' ') as phrase from best b left join inner_parts x on x.lang = b.lang and x.p = b.p
  where longer is null or 100 * cast(longer as hugeint) < 80 * cast(a as hugeint)
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from kept
)
select lang, rank, phrase, a, l, r, n, cast(score as bigint) as score from ranked join totals using (lang) where rank <= 2000
"""
