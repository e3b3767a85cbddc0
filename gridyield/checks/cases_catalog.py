"""Catalog choices, coverage and result tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridyield.checks.registry import case
from gridyield.operators import coverage, upsert
from gridyield.sources import catalog

PERIOD_SQL = r"""select *, coalesce(try_cast(regexp_extract(path, '_(\d{4})-(\d{4})\.nc$', 1) as int), try_cast(regexp_extract(path, '_(\d{4})\.nc$', 1) as int)) as y0,
    coalesce(try_cast(regexp_extract(path, '_(\d{4})-(\d{4})\.nc$', 2) as int), try_cast(regexp_extract(path, '_(\d{4})\.nc$', 1) as int)) as y1
  from source_catalog"""


@case("filename_period", "source_catalog", "path #first_year #last_year",
      f"select distinct path, y0 as first_year, y1 as last_year from ({PERIOD_SQL}) x")
def _(d):
    return catalog.add_file_period(d.source_catalog, "path").select("path", "first_year", "last_year").distinct()


@case("best_source_version", "source_catalog", "region scenario var path", f"""
    select region, scenario, var, path from (select *, row_number() over (partition by region, scenario, var order by
        case when y0 <= 2020 and y1 >= 2050 then 0 when y0 is not null then 1 else 2 end,
        case when y0 <= 2020 and y1 >= 2050 then y1 - y0 else y0 - y1 end nulls first, y0 nulls first, path) as n
      from ({PERIOD_SQL}) x) y where n = 1""")
def _(d):
    return catalog.best_version(d.source_catalog, ["region", "scenario", "var"], "2020-2050")


RANKED_SQL = f"""select *, case when starts_with(path, var || '_3h_bcsd_on_0p1deg_' || region || '_' || model || '_' || scenario || '_') then 0
        when starts_with(path, var || '_') and instr(substr(path, length(var) + 2), '_' || region || '_' || model || '_' || scenario || '_') > 0 then 1
        when starts_with(path, var || '_') and instr(substr(path, length(var) + 2), scenario) > 0 then 2 end as k
    from ({PERIOD_SQL}) p"""
FILE_KEYS = ["region", "model", "scenario", "var"]


@case("discover_files", "source_catalog", "region model scenario var path", f"""
    select distinct region, model, scenario, var, path from (
      select *, min(k) over (partition by region, model, scenario, var) as best from ({RANKED_SQL}) x where k is not null) y where k = best""")
def _(d):
    return catalog.match_patterns(d.source_catalog, catalog.COUNTRY_PATTERNS, FILE_KEYS, "path")


@case("find_files", "source_catalog", "region model scenario var path", f"""
    select region, model, scenario, var, path from (select *, row_number() over (partition by region, model, scenario, var order by k,
        case when y0 <= 2020 and y1 >= 2030 then 0 when y0 is not null then 1 else 2 end,
        case when y0 <= 2020 and y1 >= 2030 then y1 - y0 else y0 - y1 end nulls first, y0 nulls first, path) as n
      from ({RANKED_SQL}) x where k is not null) y where n = 1""")
def _(d):
    return catalog.find_files(d.source_catalog, catalog.COUNTRY_PATTERNS, FILE_KEYS, "2020-2030")


@case("preferred_cf_file", "cf_catalog", "region scenario technology path", """
    select region, scenario, technology, coalesce(min(case when contains(path, '2015-2060') then path end), min(path)) as path
    from cf_catalog group by 1, 2, 3""")
def _(d):
    return catalog.preferred_file(d.cf_catalog, ["region", "scenario", "technology"])


@case("first_file_with_year", "cf_catalog", "region scenario technology path #n_candidates", """
    select region, scenario, technology, min(path) as path, count(distinct path) as n_candidates
    from cf_catalog c where exists (select 1 from cf_catalog x where x.path = c.path and x.year = 2024) group by 1, 2, 3""")
def _(d):
    files = d.cf_catalog.select("region", "scenario", "technology", "path").distinct()
    return catalog.first_with_year(files, d.cf_catalog, 2024, ["region", "scenario", "technology"])


@case("choose_cf_files", "cf_catalog", "region scenario path #n_candidates", """
    with k as (select distinct region, scenario, path, case
          when starts_with(path, 'wind_CF_' || region || '_') and instr(substr(path, length('wind_CF_' || region || '_') + 1), '_' || scenario || '_') > 0 then 0
          when starts_with(path, 'wind') and instr(substr(path, 5), region) > 0 and instr(path, scenario) > 0 then 1
          when instr(path, 'wind') > 0 and instr(path, scenario) > 0 then 2 when instr(path, scenario) > 0 then 3 end as k from cf_catalog)
    select region, scenario, min(path) as path, count(*) as n_candidates
    from (select *, min(k) over (partition by region, scenario) as best from k where k is not null) m
    where k = best and exists (select 1 from cf_catalog x where x.path = m.path and x.year = 2025) group by 1, 2""")
def _(d):
    return catalog.choose_cf_files(d.cf_catalog, d.cf_catalog, 2025, "wind")


@case("find_scalar_wind_files", "source_catalog", "scenario var path", f"""
    select scenario, var, path from (select *, row_number() over (partition by scenario, var order by k,
        case when y0 <= 2020 and y1 >= 2030 then 0 when y0 is not null then 1 else 2 end,
        case when y0 <= 2020 and y1 >= 2030 then y1 - y0 else y0 - y1 end nulls first, y0 nulls first, path) as n
      from (select *, case when starts_with(path, var || '_3h_bcsd_on_0.1deg_china_' || scenario || '_') then 0
               when starts_with(path, var || '_') and instr(substr(path, length(var) + 2), 'china_' || scenario || '_') > 0 then 1
               when starts_with(path, var || '_') and instr(substr(path, length(var) + 2), scenario) > 0 then 2 end as k
            from (select scenario, var, y0, y1, case when region = 'R1' then replace(path, '0p1deg_R1_M0', '0.1deg_china')
              when region = 'R2' then replace(path, 'R2_M0', 'china') else path end as path from ({PERIOD_SQL}) p) q) x where k is not null) y where n = 1""")
def _(d):
    path = F.when(F.col("region") == "R1", F.replace("path", F.lit("0p1deg_R1_M0"), F.lit("0.1deg_china"))).when(
        F.col("region") == "R2", F.replace("path", F.lit("R2_M0"), F.lit("china"))).otherwise(F.col("path"))
    renamed = d.source_catalog.withColumn("path", path)
    return catalog.find_files(renamed, catalog.CHINA_PATTERNS, ["scenario", "var"], "2020-2030")


@case("valid_regions", "source_catalog", "region", r"""
    select distinct region from source_catalog where region <> '' and not starts_with(region, '_') and not suffix(region, '_')
      and not suffix(region, '_repeated')""")
def _(d):
    return catalog.discover_regions(d.source_catalog)


@case("annual_region_list", "source_catalog", "region", "select region from source_catalog union select 'china'")
def _(d):
    return catalog.annual_regions(d.source_catalog)


@case("scenario_combinations", "yearly_catalog", "gcm realization rcm scenario", """
    select distinct gcm, realization, rcm, scenario from yearly_catalog
    where not starts_with(gcm, '_') and not starts_with(scenario, '_') and not suffix(scenario, '_')""")
def _(d):
    return catalog.combinations(d.yearly_catalog)


@case("yearly_files", "yearly_catalog", "var gcm realization rcm scenario #year path", r"""
    select var, gcm, realization, rcm, scenario, year, max(name) as path from (
      select *, try_cast(regexp_extract(name, '_(\d{4})\d{8}-\d{12}\.nc$', 1) as int) as year from yearly_catalog) x
    where year between 2020 and 2060 group by 1, 2, 3, 4, 5, 6""")
def _(d):
    return catalog.yearly_files(
        d.yearly_catalog, ["var", "gcm", "realization", "rcm", "scenario"], "2020-2060", "name", "name"
    ).withColumnRenamed("name", "path")


@case("available_years", "cf_daily", "energy #year", "select distinct energy, year from cf_daily where year between 1996 and 2000")
def _(d):
    return coverage.available_years(d.cf_daily, ["energy"], "1996-2000")


@case("year_month_spine", "cf_daily", "energy region #year #month", """
    select energy, region, y as year, m as month from (select energy, region, unnest(range(min(year), max(year) + 1)) as y
      from cf_daily group by 1, 2) s, (values (1), (2), (7)) v(m)""")
def _(d):
    return coverage.observed_spine(d.cf_daily, ["energy", "region"], "1,2,7")


@case("missing_months", "cf_daily", "energy region #year #month", """
    select energy, region, y as year, m as month from (select energy, region, unnest(range(min(year), max(year) + 1)) as y
      from cf_daily group by 1, 2) s, range(1, 13) v(m)
    except select energy, region, year, month(t) from cf_daily""")
def _(d):
    spine = coverage.observed_spine(d.cf_daily, ["energy", "region"])
    have = d.cf_daily.withColumn("month", F.month("t"))
    return coverage.missing_months(spine, have, ["energy", "region", "year", "month"])


VARIABLES = ["rsds", "uas", "vas"]


@case("common_years", "variable_years", "region #year", """
    select region, year from variable_years group by 1, 2 having count(distinct var) = 3""")
def _(d):
    return coverage.common_years(d.variable_years, VARIABLES, keys=["region"])


@case("missing_years", "variable_years", "region #year var", """
    select distinct a.region, a.year, v.var from variable_years a, (values ('rsds'), ('uas'), ('vas')) v(var)
    except select region, year, var from variable_years""")
def _(d):
    return coverage.missing_years(d.variable_years, VARIABLES, keys=["region"])


@case("pending_outputs", "cf_daily", "energy cell #year #month", """
    select distinct energy, cell, year, month(t) as month from cf_daily
    except select energy, cell, year, month(t) from cf_daily where cf >= 0.8937e0""")
def _(d):
    keys = ["energy", "cell", "year", "month"]
    rows = d.cf_daily.withColumn("month", F.month("t"))
    return coverage.pending(rows.select(*keys).distinct(), rows.where("cf >= 0.8937"), keys)


@case("concat_years", "cf_daily", "energy region cell t ~cf", """
    select energy, region, cell, t, cf from cf_daily where year <= 1997 union all
    select energy, region, cell, t, cf from cf_daily where year > 1997""")
def _(d):
    early, late = d.cf_daily.where("year <= 1997"), d.cf_daily.where("year > 1997")
    return coverage.concat({"early": early, "late": late}, step="7 days", refuse=("overlap", "gap"))


@case("source_intervals", "cf_daily", "source first last #n_rows", """
    select energy as source, min(t) as first, max(t) as last, count(*) as n_rows from cf_daily group by 1""")
def _(d):
    return coverage.source_intervals({e: d.cf_daily.where(F.col("energy") == e) for e in ("solar", "wind")})


@case("interval_issues", "cf_daily", "source issue first ends", """
    with s as (select 'y' || year as source, min(t) as first, max(t) as last from cf_daily where year <> 1998 group by year
        union all select 'again', min(t), max(t) from cf_daily where year = 1997 and month(t) = 6)
    select source, case when first <= ends then 'overlap' else 'gap' end as issue, first, ends from (
      select *, (select max(o.last) from s o where o.first < s.first) as ends from s) x where first <= ends or first > ends + interval 40 days""")
def _(d):
    sources = {f"y{y}": d.cf_daily.where(F.col("year") == y) for y in range(1990, 2006) if y != 1998}
    sources["again"] = d.cf_daily.where((F.col("year") == 1997) & (F.month("t") == 6))
    return coverage.interval_issues(coverage.source_intervals(sources), "40 days")


@case("requested_months", "cf_daily", "#year #month", """
    select y as year, m as month from range(1990, 2001) a(y), (values (1), (2), (7)) v(m)
    except select year, month(t) from cf_daily""")
def _(d):
    have = d.cf_daily.withColumn("month", F.month("t"))
    return coverage.missing_months(coverage.year_month_spine(d.spark, "1990-2000", "1,2,7"), have)


@case("upsert_keep_last", "", "o_custkey #year o_orderkey ~o_totalprice", """
    select o_custkey, year, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey, year order by fresh desc, o_orderkey desc) as n
      from (select o_custkey, year(o_orderdate) as year, o_orderkey, o_totalprice, case when o_orderstatus = 'P' then 1 else 0 end as fresh from orders) x) y
    where n = 1""")
def _(d):
    rows = d.orders.select("o_custkey", F.year("o_orderdate").alias("year"), "o_orderkey", "o_totalprice", "o_orderstatus")
    old, new = rows.where("o_orderstatus <> 'P'"), rows.where("o_orderstatus = 'P'")
    return upsert.upsert(old, new, ["o_custkey", "year"], "o_orderkey")


@case("upsert_sorted_key_order", "", "o_custkey #year o_orderkey", """
    select o_custkey, year(o_orderdate) as year, max(o_orderkey) as o_orderkey from orders group by 1, 2""")
def _(d):
    rows = d.orders.select("o_custkey", F.year("o_orderdate").alias("year"), "o_orderkey")
    return upsert.upsert_sorted(None, rows, ["o_custkey", "year"], "o_orderkey")
