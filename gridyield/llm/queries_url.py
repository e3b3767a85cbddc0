"""Query of the URL filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridyield.llm.common import table
from gridyield.llm.url_filter import match_urls, rules_table

#: The rules of the contract.
BASE_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
#: Own rules, asked where no base rule fits: hosts of spam, and paths of pages without prose.
MORE_RULES = [
    ("cheap-pills.example.com", "", "block"), ("cheap-pills.example.net", "", "block"), ("cheap-pills.example.org", "", "block"),
    ("spam-farm.example.com", "", "block"), ("spam-farm.example.net", "", "block"), ("spam-farm.example.org", "", "block"),
    ("", "/*/login/", "block"), ("", "/login/", "block"), ("", "/cart/", "block"), ("", "/*/cart/", "block"),
    ("", "/casino/*", "block"), ("", "/*/casino/*", "block"),
]


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = [(*r, 0) for r in BASE_RULES] + [(*r, 1) for r in MORE_RULES]
    found = match_urls(table(spark, folder, "pages").select("page_id", "url"), rules_table(spark, rules))
    return found.select(
        "page_id", "host", "path", F.when(F.col("tier") == 0, F.col("rule")).alias("rule"),
        F.coalesce("action", F.lit("allow")).alias("verdict"), F.when(F.col("tier") == 1, F.col("rule")).alias("pattern"),
    )


def _values(rules) -> str:
    return ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in rules)


OP5_SQL = f"""
with p as (
  select page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
  from pages
), base(rhost, rpath, action) as (values {_values(BASE_RULES)}),
more(rhost, rpath, action) as (values {_values(MORE_RULES)}),
urls as (select distinct host, path from p where host <> ''),
b as (
  select u.host, u.path, max_by(rhost || rpath, struct_pack(n := length(rhost || rpath), b := r.action = 'block', t := rhost || rpath)) as rule,
         max_by(action, struct_pack(n := length(rhost || rpath), b := r.action = 'block', t := rhost || rpath)) as action
  from urls u, base r where (u.host = rhost or ends_with(u.host, '.' || rhost)) and starts_with(u.path, rpath) group by 1, 2
), m as (
  select u.host, u.path, max_by(rhost || rpath, struct_pack(n := length(rhost || rpath), b := r.action = 'block', t := rhost || rpath)) as pattern,
         max_by(action, struct_pack(n := length(rhost || rpath), b := r.action = 'block', t := rhost || rpath)) as action
  from urls u, more r where (rhost = '' or u.host = rhost or ends_with(u.host, '.' || rhost))
    and (case when rpath = '' then u.path = '' or starts_with(u.path, '/') else regexp_matches(u.path, '^' || replace(rpath, '*', '.*'), 's') end) group by 1, 2
)
select page_id, p.host, p.path, b.rule, coalesce(b.action, m.action, 'allow') as verdict, case when b.rule is null then m.pattern end as pattern
from p left join b on p.host = b.host and p.path = b.path left join m on p.host = m.host and p.path = m.path
"""
